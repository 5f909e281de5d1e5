"""Session set-up and the shared work folder (SRC-10)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether a job's shuffle files go when it ends. Otherwise they stay until the driver collects its garbage.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app_name: str = "gaugeworks", conf: dict[str, str] | None = None) -> SparkSession:
    """Reuse the active session, or build one; the time zone is UTC either way."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        for key, value in (conf or {}).items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    return pin_utc(spark)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hour windows follow the epoch and dates the session zone; UTC makes them agree."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``; where it is not
    set, the session's warehouse is taken, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several branches: it is computed once, the
    lineage ends at durable files, and Spark knows its size when it plans joins.
    Shuffle files of the job go as it ends. The files written stay, since the result is read later; see :func:`staged`.
    """
    return _write_and_read(df, work_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str):
    """Like :func:`stage`, for results needed only inside the ``with`` block."""
    path = work_path(df.sparkSession, label)
    try:
        yield _write_and_read(df, path)
    finally:
        delete_path(df.sparkSession, path)


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(FREES_SHUFFLES)
    conf.set(FREES_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(FREES_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, wherever Spark's file systems reach."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def touch(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.create(folder, True).close()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it is not there."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory())


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within one file system; ``target`` must not exist."""
    files, folder = _folder(spark, source)
    if not files.rename(folder, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")
