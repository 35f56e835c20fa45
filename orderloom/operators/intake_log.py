"""The mail log: keyed upsert, status machine and error tags."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import order_globally

# States of a mail and the stage that moves it.
STATES = ["PENDING", "EXTRACTED", "VALIDATED", "LOADED", "FAILED", "DUPLICATE"]
STAGES = {
    "EXTRACT": ("PENDING", "EXTRACTED"),
    "VALIDATE": ("EXTRACTED", "VALIDATED"),
    "LOAD": ("VALIDATED", "LOADED"),
}
REPLACED = ["from_address", "subject", "received_at", "attachment_name", "so_number", "customer_name_raw"]


def upsert(
    log: DataFrame, incoming: DataFrame, retry: bool = False, order: str = "file_name", top: Column | None = None,
    changed: str | None = None,
) -> DataFrame:
    """Merge scanned mails into the log by ``message_id``.

    Only mails still PENDING or FAILED take new values. Their status stays, unless ``retry`` sends FAILED
    ones back to PENDING. Of several copies in a batch the last by ``order`` wins; new mails get the next
    ``log_id`` in that order, after ``top`` (the largest in ``log`` unless given). ``changed`` names a further
    column: whether a row is new or differs from the one it had.
    """
    fields = [c for c in REPLACED if c in incoming.columns]
    latest = (
        incoming.groupBy("message_id")
        .agg(F.max_by(F.struct(*fields, "error"), F.col(order)).alias("new"), F.min(order).alias("seen"))
    )
    open_state = F.col("processing_status").isin("PENDING", "FAILED")
    is_new, has_new = F.col("log_id").isNull(), F.col("new").isNotNull()
    taken = has_new & (is_new | open_state)
    fresh = latest.join(log.select("message_id"), "message_id", "left_anti")
    numbered = order_globally(fresh.select("message_id", "seen"), F.col("seen"), "message_id").select(
        "message_id", "position"
    )
    if top is None:
        top = log.agg(F.coalesce(F.max("log_id"), F.lit(0)).alias("m")).scalar()
    merged = log.join(latest, "message_id", "full_outer").join(numbered, "message_id", "left")
    new_status = F.when(F.col("new.error").isNull(), "PENDING").otherwise("FAILED")
    kept_status = F.when(
        F.lit(retry) & taken & (F.col("processing_status") == "FAILED") & F.col("new.error").isNull(), "PENDING"
    ).otherwise(F.col("processing_status"))
    scan_failed = taken & F.col("new.error").isNotNull()
    after = {
        **{c: F.when(taken, F.col(f"new.{c}")).otherwise(F.col(c)) for c in fields},
        "processing_status": F.when(is_new, new_status).otherwise(kept_status),
        "error_stage": F.when(scan_failed, "EXTRACT").otherwise(F.col("error_stage")),
        "error_message": F.when(scan_failed, F.col("new.error")).otherwise(F.col("error_message")),
    }
    differs = reduce(or_, [~F.col(c).eqNullSafe(value) for c, value in after.items()], is_new)
    return merged.select(
        F.coalesce("log_id", top + F.col("position")).alias("log_id"),
        "message_id",
        *[value.alias(c) for c, value in after.items()],
        *[c for c in log.columns if c not in {"log_id", "message_id", *after}],
        *([differs.alias(changed)] if changed else []),
    )


def tag_error(stage: str, error: Column) -> Column:
    """Message kept for a failed stage; load errors are cut to 500 characters."""
    return F.left(error, F.lit(500)) if stage == "LOAD" else error


def advance(
    log: DataFrame, results: DataFrame, stage: str, now: str | None = None, keys: list[str] | None = None, changed: str | None = None
) -> DataFrame:
    """Apply stage results ``(log_id, error)``; mails in another state than the stage expects stay put.

    A loaded mail loses its error tags and is stamped with ``now``. ``keys``: columns of both sides that are equal
    where ``log_id`` is. ``changed`` names a further column: whether the mail has moved.
    """
    before, after = STAGES[stage]
    keys = [*(keys or []), "log_id"]
    outcome = results.select(*keys, F.col("error").alias("_error"), F.lit(True).alias("_seen"))
    joined = log.join(outcome, keys, "left")
    moved = F.coalesce("_seen", F.lit(False)) & (F.col("processing_status") == before)
    failed, passed = moved & F.col("_error").isNotNull(), moved & F.col("_error").isNull()
    clear = passed if stage == "LOAD" else F.lit(False)
    stamped = {}
    if stage == "LOAD" and now is not None:
        stamp = F.lit(now).cast(log.schema["processed_at"].dataType)
        stamped = {"processed_at": F.when(passed, stamp).otherwise(F.col("processed_at"))}
    out = joined.withColumns(  # all at once: each sees the state before
        {
            **stamped,
            "error_stage": F.when(failed, stage).when(~clear, F.col("error_stage")),
            "error_message": F.when(failed, tag_error(stage, F.col("_error"))).when(~clear, F.col("error_message")),
            "processing_status": F.when(failed, "FAILED").when(passed, after).otherwise(F.col("processing_status")),
            **({changed: F.coalesce(moved, F.lit(False))} if changed else {}),
        }
    )
    return out.drop("_error", "_seen")


def bad_states(log: DataFrame) -> DataFrame:
    """Rows whose status is none of the known ones."""
    return log.where(~F.coalesce(F.col("processing_status").isin(STATES), F.lit(False)))
