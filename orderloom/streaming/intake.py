"""The intake as streams: mail files, repeated messages, hourly counts, fact appends, current status.

Every sink is a folder of Parquet files written per micro-batch under ``batch=<id>``. A replayed batch
overwrites its own folder, so a lost executor or a restart never doubles rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..functions.text import ORDER_NUMBER
from ..operators.fact import FACT_COLUMNS, Star, flatten, with_calendar
from ..session import listing_tasks, settings
from ..sources.mail import ingest_mail, stored_mail
from ..sources.sales_store import FEW_FILES, PERIOD, in_months, months_of


def mail_stream(spark: SparkSession, path: str, glob: str = "*.eml", per_batch: int = 1000, deep: bool = False) -> DataFrame:
    """New mail files, each picked up once (the checkpoint remembers them); ``deep`` also below the folder."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    with settings(spark, listing_tasks(spark)):
        return (
            spark.readStream.format("binaryFile")
            .schema(schema)
            .option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", per_batch)
            .option("recursiveFileLookup", deep)
            .load(path)
        )


def new_mails(spark: SparkSession, path: str) -> DataFrame:
    return ingest_mail(mail_stream(spark, path))


def new_stored_mails(spark: SparkSession, path: str, pattern: str = ORDER_NUMBER, per_batch: int = 1000) -> DataFrame:
    """New mails of a folder that ``write_mail`` fills; ``per_batch`` counts its files, each of many mails."""
    return ingest_mail(stored_mail(mail_stream(spark, path, "*.txt", per_batch, deep=True)), pattern)


def drop_repeats(messages: DataFrame, time: str, delay: str, key: str = "message_id") -> DataFrame:
    """First copy of a message; copies arriving within the delay are dropped and state stays bounded."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def hourly_counts(log: DataFrame, time: str, delay: str) -> DataFrame:
    """Processed and successful mails per hour; rows later than the delay are dropped."""
    return (
        log.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("w"))
        .agg(
            F.count("*").alias("processed_count"),
            F.count_if(F.col("processing_status") == "LOADED").alias("success_count"),
        )
        .select(F.col("w.start").alias("hour_bucket"), "processed_count", "success_count")
    )


def current_status(changes: DataFrame, key: str = "message_id") -> DataFrame:
    """Latest status per mail from status changes ``(key, ts, processing_status, log_id)``."""
    return changes.groupBy(key).agg(
        F.max_by("processing_status", F.struct("ts", "log_id")).alias("processing_status"),
        F.max("ts").alias("ts"),
        F.count("*").alias("changes"),
    )


FINISHED = ("LOADED", "FAILED")
# for ``settings``: state lies in RocksDB, on the executors' disks instead of their heaps
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def expiring_status(
    changes: DataFrame, key: str = "message_id", delay: str = "1 hour", keep: timedelta = timedelta(days=7),
    stale: timedelta = timedelta(days=90), finished: tuple[str, ...] = FINISHED, buckets: int = 4096,
) -> DataFrame:
    """``current_status`` whose state stays bounded: ``(key, processing_status, ts, log_id, changes)`` in update mode.

    A change that comes again counts once: a mail's state holds the ``log_id`` of its changes. The state of a
    finished mail goes ``keep`` after its last change, that of any other ``stale`` after, both by the watermark.
    Changes behind the watermark are dropped, so a replay of an expired mail adds nothing; a change that is
    really newer opens the mail again, with its count from 1. Changes without key, time or id are dropped. The
    largest ``(ts, log_id)`` is current, whatever the order of arrival. Meant for keys with few changes each.

    Mails share a state row by hash bucket, because a call of Python per mail takes many times the work on it. A
    batch reads and writes the buckets of its own mails: choose ``buckets``, fixed for a checkpoint, so that one
    holds some 1,000 open mails.
    """
    kind = changes.schema[key].dataType.simpleString()
    columns = ["key", "processing_status", "micros", "log_id", "changes"]

    def follow(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        # per mail: status, micros, log_id, until, seen
        mails = {m: [*rest] for m, *rest in zip(*state.get)} if state.exists else {}
        touched = {}
        for part in [] if state.hasTimedOut else parts:
            for m, *row in zip(part["key"].tolist(), part["micros"].tolist(), part["log_id"].tolist(), part["processing_status"]):
                if m not in touched:
                    status, micros, log_id, _, seen = mails.get(m, (None, None, None, None, []))
                    touched[m] = [None if micros is None else [micros, log_id, status], set(seen)]
                best, known = touched[m]
                known.add(row[1])
                if best is None or row[:2] > best[:2]:
                    touched[m][0] = row
        for m, ((micros, log_id, status), known) in touched.items():
            until = micros // 1000 + int((keep if status in finished else stale).total_seconds() * 1000)
            mails[m] = [status, micros, log_id, max(until, mark + 1), sorted(known)]
        mails = {m: r for m, r in mails.items() if m in touched or r[3] >= mark}
        if mails:
            state.update(tuple(map(list, zip(*[(m, *r) for m, r in mails.items()]))))
            state.setTimeoutTimestamp(max(min(r[3] for r in mails.values()), mark + 1))
        else:
            state.remove()
        if touched:
            yield pd.DataFrame([(m, r[2], r[0], r[1], len(known)) for m, (r, known) in touched.items()], columns=columns)

    rows = (
        changes.select(F.col(key).alias("key"), "processing_status", "ts", F.col("log_id").cast("long").alias("log_id"))
        .dropna(subset=["key", "ts", "log_id"])
        .withWatermark("ts", delay)
        .withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp")))
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    )
    current = rows.groupBy("bucket").applyInPandasWithState(
        follow, f"key {kind}, processing_status string, micros long, log_id long, changes long",
        f"key array<{kind}>, status array<string>, micros array<long>, log_id array<long>, until array<long>, seen array<array<long>>",
        "update", "EventTimeTimeout",
    )
    return current.select(F.col("key").alias(key), "processing_status", F.timestamp_micros("micros").alias("ts"), "log_id", "changes")


def to_folder(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run over everything available, one replaceable folder per micro-batch, then stop.

    A folder belongs to one checkpoint: batch numbers start again under another one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _run(df, write, checkpoint, mode)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current rows of an update-mode folder: the row of the last batch per key."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def append_facts(lines: DataFrame, star: Star, path: str, checkpoint: str) -> StreamingQuery:
    """Flatten newly validated lines and append those the fact folder does not hold yet.

    Files lie under ``run=<checkpoint>/batch=<id>`` and there by month. A replayed batch replaces its own folder;
    lines held by any other batch, also of an earlier checkpoint, are not written again. Stored keys are read
    from the months of the batch's lines only, so an order must keep its month. Of lines with one id in a batch
    the largest, column by column, is taken, so a replay writes the same row.
    """
    run = f"r{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        rest = F.struct(*[c for c in batch.columns if c != "line_id"])
        single = batch.groupBy("line_id").agg(F.max(rest).alias("r")).select("line_id", "r.*").select(*batch.columns)
        facts = lambda rows: flatten(Star(**{**star.__dict__, "order_line": rows})).select(*FACT_COLUMNS)
        if stored_keys(facts(batch), path, []) is not None:
            # stored lines go before the joins, in the exchange that looks for repeated ones
            orders = star.sales_order.join(batch.select("order_id"), "order_id", "left_semi")
            known = stored_keys(facts(batch), path, months_of(with_calendar(orders)))
            other = (F.col("run") != run) | (F.col("batch") != batch_id)
            single = single.join(known.where(other).select("line_id"), "line_id", "left_anti")
        with settings(batch.sparkSession, FEW_FILES):
            (
                facts(single).write.mode("overwrite").option("compression", "zstd")
                .option("partitionOverwriteMode", "static").partitionBy(*PERIOD).parquet(f"{path}/run={run}/batch={batch_id}")
            )

    return _run(lines, write, checkpoint, "append")


def stored_keys(facts: DataFrame, path: str, months: list[tuple]) -> DataFrame | None:
    """``(line_id, run, batch)`` stored in these months; folders that a failed batch left without files hold none."""
    schema = facts.select("line_id", *PERIOD).schema.add("run", "string").add("batch", "long")
    try:
        stored = facts.sparkSession.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(in_months(months)).select("line_id", "run", "batch")


def _run(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    # a stream keeps the settings it was started with
    with settings(df.sparkSession, listing_tasks(df.sparkSession)):
        query = (
            df.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
    query.awaitTermination()
    return query
