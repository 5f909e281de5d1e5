"""Times the registered queries and the whole job chain; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (names, comma-separated; default all) select what is run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.plans import jobs
from gaugeworks.plans.registry import QUERIES, raw_readings
from gaugeworks.session import work_path
from gaugeworks.sources.landing import write_landing

END_TO_END = "end_to_end"


def drain(df: DataFrame) -> None:
    """Compute all columns of all rows, without a sink's cost."""
    df.write.format("noop").mode("overwrite").save()


def end_to_end(spark: SparkSession, sf_dir: str) -> float:
    """Landing files through Bronze, Silver, Gold and metrics; landing not timed."""
    where = jobs.Locations.under(work_path(spark, "bench"))
    write_landing(raw_readings(spark, sf_dir), where.landing)
    started = time.perf_counter()
    jobs.run_all(spark, where)
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gaugeworks-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["daily_risk"](spark, sf_dir))  # warm-up
    seconds = {}
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        drain(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    if not wanted or END_TO_END in wanted:
        seconds[END_TO_END] = round(end_to_end(spark, sf_dir), 3)
        print(END_TO_END, seconds[END_TO_END], file=sys.stderr, flush=True)
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
