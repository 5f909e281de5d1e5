"""Command line: ``python -m gaugeworks <job> --root <folder> [options]``."""

from __future__ import annotations

import argparse
from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.plans import jobs
from gaugeworks.session import get_session
from gaugeworks.sources.json_schema import compile_schema


ONLY = {
    ("landing",): ("feed_path", "contract_file"),
    ("bronze",): ("continuous",),
    ("bronze", "all"): ("check_contract",),
    ("silver", "gold", "all"): ("incremental",),
    ("bronze", "silver", "all"): ("max_files",),
    ("silver", "all"): ("null_ids_differ", "split_blocks"),
    ("gold", "all"): ("skip_optimize",),
    ("metrics",): ("dry_run",),
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gaugeworks")
    parser.add_argument("job", choices=("landing", "bronze", "silver", "gold", "metrics", "all"))
    parser.add_argument("--root", required=True, help="folder that holds all tables")
    parser.add_argument("--source-path", help="landing folder, if not under the root")
    parser.add_argument("--feed-path", help="folder of feed payloads, one JSON text a line (landing)")
    parser.add_argument("--contract-file", help="JSON schema that readings must meet before they land (landing)")
    parser.add_argument("--hourly-table", help="Gold table by hour, a name or a path")
    parser.add_argument("--daily-table", help="Gold table by day, a name or a path")
    parser.add_argument("--metrics-table", help="metrics table, a name or a path")
    parser.add_argument("--checkpoint-path", help="stream checkpoints, if not under the root")
    parser.add_argument("--continuous", action="store_true", help="keep polling (bronze only)")
    parser.add_argument("--check-contract", action="store_true", help="quarantine bad texts (bronze, all)")
    parser.add_argument("--incremental", action="store_true", help="only new Bronze files, only changed dates")
    parser.add_argument("--max-files", type=int, help="files per micro-batch (bronze, incremental silver, all)")
    parser.add_argument("--null-ids-differ", action="store_true", help="a null entry id equals no other (silver, all)")
    parser.add_argument("--split-blocks", action="store_true", help="new Silver table in blocks that split (silver, all)")
    parser.add_argument("--dry-run", action="store_true", help="show the metrics, store none (metrics only)")
    parser.add_argument("--skip-optimize", action="store_true", help="leave the Gold file layout as written")
    parser.add_argument("--frame-rows", type=int, default=settings.RISK_FRAME_ROWS, help="rows in the z-score frame")
    args = parser.parse_args(argv)
    # An option that a job does not know is refused, not ignored.
    for job, options in ONLY.items():
        for option in options:
            if getattr(args, option) and args.job not in job:
                parser.error(f"--{option.replace('_', '-')} is for {', '.join(job)}")
    if args.job == "landing" and not args.feed_path:
        parser.error("landing needs --feed-path")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    where = jobs.Locations.under(args.root)
    if args.source_path:
        where = replace(where, landing=args.source_path)
    if args.checkpoint_path:
        where = replace(where, checkpoints=args.checkpoint_path)
    names = {"hourly": args.hourly_table, "daily": args.daily_table, "metrics": args.metrics_table}
    where = replace(where, **{k: v for k, v in names.items() if v})
    bounds = {"maxFilesPerTrigger": args.max_files} if args.max_files else {}
    spark = get_session(f"gaugeworks-{args.job}")
    if args.job == "landing":
        channel = F.get_json_object("value", "$.channel.id").try_cast("int")
        payloads = spark.read.text(args.feed_path).select(channel.alias("channel_id"), F.col("value").alias("payload"))
        contract = compile_schema(Path(args.contract_file)) if args.contract_file else None
        jobs.run_landing(spark, payloads, where, contract=contract)
    elif args.job == "bronze":
        mode = "continuous" if args.continuous else "available_now"
        query = jobs.run_bronze(spark, where, mode, args.check_contract, **bounds)
        query.awaitTermination()
    elif args.job == "silver":
        jobs.run_silver(spark, where, args.incremental, null_safe=not args.null_ids_differ, split_blocks=args.split_blocks, **bounds)
    elif args.job == "gold":
        run = jobs.refresh_pending if args.incremental else jobs.run_gold
        run(spark, where, args.frame_rows, args.skip_optimize)
    elif args.job == "metrics":
        rows = jobs.run_metrics(spark, where, dry_run=args.dry_run)
        if args.dry_run:
            rows.show(1000, truncate=False)  # one row for each metric of the snapshot
    else:
        jobs.run_all(
            spark, where, args.incremental, args.frame_rows, args.skip_optimize, args.check_contract,
            not args.null_ids_differ, args.split_blocks, **bounds,
        )


if __name__ == "__main__":
    main()
