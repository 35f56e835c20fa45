"""State of the mail intake and the daily order flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, first_rows, in_month, nearest, ratio

# Intake stages shown in the funnel, in order.
FUNNEL_STAGES = ["EXTRACTED", "VALIDATED", "LOADED"]
# States that count as done.
DONE_STATES = ["LOADED", "SUCCESS"]


def status_totals(log: DataFrame) -> DataFrame:
    """Mails per status plus one total row (NULL status) with the success rate."""
    counts = log.groupBy(F.col("processing_status").alias("status")).agg(F.count("*").alias("count"))
    total = counts.agg(
        F.lit(None).cast("string").alias("status"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.when(F.col("status") == "LOADED", F.col("count"))), F.lit(0)).alias("loaded"),
    ).withColumn("success_rate", F.coalesce(F.bround(ratio("loaded", "count") * 100, 1), F.lit(0.0)))
    return counts.unionByName(total, allowMissingColumns=True)


def stage_funnel(log: DataFrame) -> DataFrame:
    """Mails now in each funnel stage, 0 for an empty one."""
    stages = log.sparkSession.createDataFrame(
        list(enumerate(FUNNEL_STAGES, 1)), "stage_order int, stage string"
    )
    counts = log.groupBy(F.col("processing_status").alias("stage")).agg(F.count("*").alias("n"))
    return stages.join(counts, "stage", "left").select(
        "stage_order", "stage", F.coalesce("n", F.lit(0)).alias("count")
    )


def daily(f: DataFrame, year: int, month: int) -> DataFrame:
    return (
        f.where(in_month(year, month))
        .groupBy("order_date")
        .agg(
            F.countDistinct("so_number").alias("order_count"),
            F.sum("line_total").alias("revenue"),
            F.sum("quantity").alias("quantity"),
        )
        .orderBy("order_date")
    )


def daily_stats(days: DataFrame, first: str, last: str) -> DataFrame:
    """Mean orders per active day, peak day, active and empty days over a dense calendar."""
    calendar = days.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("order_date")
    )
    dense = calendar.join(days, "order_date", "left")
    # the earliest day wins a tie
    peak = F.max_by("order_date", F.struct("order_count", -F.datediff("order_date", F.lit("1970-01-01"))))
    return dense.agg(
        nearest(ratio(F.sum("order_count"), F.count("order_count"))).alias("avg_orders"),
        peak.alias("peak_day"),
        F.max("order_count").alias("peak_orders"),
        F.count("order_count").alias("active_days"),
        F.count_if(F.col("order_count").isNull()).alias("empty_days"),
        F.sum("revenue").alias("revenue"),
    )


def recent_errors(log: DataFrame, n: int | None = 100) -> DataFrame:
    """The ``n`` latest mails that are not loaded; unprocessed ones come first."""
    return (
        log.where(~F.col("processing_status").isin(DONE_STATES))
        .orderBy(F.desc_nulls_first("processed_at"), "log_id")
        .transform(first_rows, n)
        .select(
            "log_id", "so_number", "from_address", F.col("processing_status").alias("status"), "processed_at"
        )
    )


def processing_timeline(log: DataFrame) -> DataFrame:
    """Processed and successful mails per hour; unprocessed mails form the last, NULL bucket."""
    return (
        log.groupBy(F.date_trunc("hour", "processed_at").alias("hour_bucket"))
        .agg(
            F.count("*").alias("processed_count"),
            F.count_if(F.col("processing_status") == "LOADED").alias("success_count"),
        )
        .orderBy(F.asc_nulls_last("hour_bucket"))
    )


def capacity(log: DataFrame, stats: DataFrame, days: int = 31, growth: float = 0.2) -> DataFrame:
    """Mails per day, projected volume after growth, and the hourly alert level."""
    return log.agg(F.count("*").alias("total")).select(
        nearest(as_double("total") / days).alias("mails_per_day"),
        nearest(as_double("total") * (1 + growth)).alias("projected_mails"),
        F.ceil(stats.select("avg_orders").scalar() * 2).cast("bigint").alias("alert_level"),
    )
