"""Spark session for scripts, tests and the bench, and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Setting that names the folder every executor can reach.
SHARED_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; on a cluster the session comes from ``spark-submit``."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("areastats")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder of the session, removed when the application ends.

    The folder is the one ``spark.checkpoint.dir`` names. Where that is unset, as in tests, it is
    the warehouse, which driver and executors share as well; no machine-local folder is used.
    """
    base = spark.conf.get(SHARED_DIR, None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and base.startswith(("file:", "/")):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share; the warehouse {base} is a local one")
    root = f"{base.rstrip('/')}/areastats-{spark.sparkContext.applicationId}"
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return the table read back.

    This cuts the lineage: losing an executor afterwards costs a re-read of files, not a
    re-run of everything upstream. The table stays until the application ends, as lazy results
    still read it; ``staged`` removes it after use.
    """
    return _stage(df, shared_folder(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for as long as the block runs."""
    path = shared_folder(df.sparkSession, label)
    try:
        yield _stage(df, path)
    finally:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
