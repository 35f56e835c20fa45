"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

# Settings that only change how a plan runs; a cluster's own values win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "orderloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for materialised intermediate tables, readable by every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in one local process may do without
    (tests, a laptop): it gets a temporary folder. Anywhere else a missing setting is an error, because
    the driver's own disk is not the executors'.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="orderloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The frame written once as Parquet to the shared folder, for plans that read it several times.

    Column pruning and filters still reach the stored table, and a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kept/{uuid.uuid4().hex}"
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    df.withColumns({c: F.col(f"`{c}`").cast("string") for c in void}).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.withColumns({c: F.lit(None).cast("string") for c in void}).schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is planned or started inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def listing_tasks(spark: SparkSession) -> dict[str, str]:
    """Many folders are listed in four tasks per shuffle partition, not in one per folder."""
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}
