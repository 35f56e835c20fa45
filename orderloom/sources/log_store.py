"""The mail log as a stored table: hash buckets by message id, rewritten one by one.

A version says which folder holds each bucket. It is one small JSON file with a record per rewritten bucket and
appears in one rename when its job commits; until then, and if the job dies, readers see the version before.
A batch reads and rewrites the buckets of its own mails only. Older folders stay as they are, so a reader that
has begun keeps its rows, and ``read(version)`` shows an earlier state.

There is one writer at a time, as for the intake itself; two that commit the same version are told apart and
the later one fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import intake_log as il
from ..session import cut, settings

# a join by bucket and id takes sides that are dealt out by bucket only
BY_BUCKET = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
VERSION = "version long, bucket int, path string, buckets int, writer string, top_log_id long"


@dataclass
class LogStore:
    """``buckets`` counts for a new store only; a stored one keeps its own. Choose it so that a bucket is some
    100 MB at the size the log will reach."""

    spark: SparkSession
    root: str
    schema: StructType | str
    buckets: int = 1024

    def __post_init__(self) -> None:
        self.schema = StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema
        # no rows; the folder exists from here on
        self.spark.createDataFrame([], VERSION).write.mode("append").json(f"{self.root}/versions")

    def _versions(self) -> DataFrame:
        return self.spark.read.schema(VERSION).json(f"{self.root}/versions")

    def state(self, version: int | None = None) -> tuple[int, int, int, dict[int, str]]:
        """Version, number of buckets, largest log id, and the folder of each bucket: one record per bucket."""
        seen = self._versions()
        if version is not None:
            seen = seen.where(F.col("version") <= version)
        last = seen.groupBy("bucket").agg(F.max(F.struct("version", "path", "buckets")).alias("v")).select("bucket", "v.*").collect()
        top = seen.agg(F.max("version").alias("v"), F.max("top_log_id").alias("top")).first()
        folders = {r.bucket: r.path for r in last if r.bucket is not None}
        return top.v or 0, max((r.buckets for r in last), default=self.buckets), top.top or 0, folders

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(sorted(self.state(version)[3].values()))

    def _keyed(self, df: DataFrame, buckets: int) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("message_id"), F.lit(buckets)).cast("int"))

    def _touched(self, keyed: DataFrame) -> list[int]:
        return [r.bucket for r in keyed.select("bucket").distinct().collect()]

    def _commit(self, rows: DataFrame, version: int, buckets: int, top: int, changed: str | None = None) -> int:
        """Write the rows of some buckets in full and make them the next version; ``rows`` lie by bucket already.

        ``changed`` names a column that tells rows which differ from the stored ones: without any the folder stays
        unread and the version as it is.
        """
        writer = uuid.uuid4().hex
        folder = f"{self.root}/data/{version + 1}-{writer}"
        seen = Observation()
        if changed:
            rows = rows.observe(seen, F.count_if(F.col(changed)).alias("n"))
        rows.select(*self.schema.names, "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(folder)
        if changed and not seen.get["n"]:
            return version
        written = self.spark.read.schema("log_id long, bucket int").parquet(folder)
        found = written.groupBy("bucket").agg(F.max("log_id").alias("top"))
        most = F.greatest(F.lit(top), found.agg(F.max("top")).scalar())
        found.select(
            F.lit(version + 1).cast("long").alias("version"), "bucket", F.concat(F.lit(f"{folder}/bucket="), "bucket").alias("path"),
            F.lit(buckets).alias("buckets"), F.lit(writer).alias("writer"), most.alias("top_log_id"),
        ).coalesce(1).write.mode("append").json(f"{self.root}/versions")  # one record per bucket, one file
        rivals = self._versions().where(F.col("version") == version + 1).agg(F.min("writer").alias("first")).first()
        if rivals.first != writer:
            raise RuntimeError(f"another writer has committed version {version + 1} of the log")
        return version + 1

    def create(self, log: DataFrame) -> int:
        """Store a log where there is none."""
        version, buckets, top, _ = self.state()
        if version:
            raise ValueError("the log is stored already")
        return self._commit(self._keyed(log, buckets).repartition("bucket"), 0, buckets, top)

    def upsert(self, incoming: DataFrame, retry: bool = False, order: str = "file_name") -> int:
        """``intake_log.upsert`` of a batch into the stored log; the version after it.

        Buckets without a mail of the batch are neither read nor written. A batch that changes nothing commits
        nothing, so scanning the same mails again leaves the version as it is.
        """
        version, buckets, top, folders = self.state()
        batch = self._keyed(cut(incoming), buckets)
        touched = self._touched(batch)
        old = self._rows([folders[b] for b in touched if b in folders])
        merged = il.upsert(old, batch.drop("bucket"), retry, order, top=F.lit(top), changed="_changed")
        return self._commit(self._keyed(merged, buckets).repartition("bucket"), version, buckets, top, "_changed")

    def advance(self, results: DataFrame, stage: str, now: str | None = None) -> int:
        """``intake_log.advance`` for results ``(message_id, log_id, error)``; the version after it."""
        version, buckets, top, folders = self.state()
        keyed = self._keyed(cut(results), buckets)
        folders = [folders[b] for b in self._touched(keyed) if b in folders]
        if not folders:
            return version
        # log and results meet by bucket, as the buckets are written: the log is dealt out once
        with settings(self.spark, BY_BUCKET):
            old = self._keyed(self._rows(folders), buckets).repartition("bucket")
            moved = il.advance(old, keyed.select("bucket", "log_id", "error").repartition("bucket"), stage, now, ["bucket"], "_changed")
            return self._commit(moved, version, buckets, top, "_changed")
