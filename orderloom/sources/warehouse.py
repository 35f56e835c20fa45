"""Warehouse tables and their CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EMPTY = "\u0001empty\u0001"  # stands for a quoted empty text while a file is read, which would else become NULL


def load_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables stored as ``<folder>/<name>.parquet``; nothing is read before it is used."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values of the session zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per table with a header; an empty table gets none. ``folder`` should be new."""
    for name, df in tables.items():
        if df.isEmpty():
            continue
        without_zone(df).write.mode("overwrite").option("header", True).option("emptyValue", '""').csv(
            f"{folder}/{name}"
        )


def export_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per exported table (empty ones left out) and, under a NULL name, their total."""
    rows = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        rows = row if rows is None else rows.unionByName(row)
    return rows.where("n > 0").rollup("table_name").agg(F.sum("n").alias("n"))


def read_export(spark: SparkSession, folder: str, name: str, schema: T.StructType | str) -> DataFrame:
    """The exported table of exactly that name, with its declared schema; empty texts stay apart from NULL."""
    read = (
        spark.read.schema(schema)
        .option("header", True)
        .option("emptyValue", _EMPTY)
        .option("mode", "FAILFAST")
        .csv(f"{folder}/{name}")
    )
    texts = [f.name for f in read.schema.fields if isinstance(f.dataType, T.StringType)]
    return read.withColumns({c: F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)) for c in texts}) if texts else read
