"""Revenue over time: months, quarters, seasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    UNCLASSIFIED,
    as_double,
    in_quarter,
    labelled,
    month_label,
    nearest,
    pct_change,
    ratio,
    sum_when,
    total_of,
)


def monthly_group(f: DataFrame) -> DataFrame:
    return (
        f.groupBy("fiscal_year", "fiscal_month", "group_name")
        .agg(
            F.date_format(F.trunc(F.min("order_date"), "month"), "yyyy-MM-dd").alias("period"),
            F.sum("line_total").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.countDistinct("so_number").alias("orders"),
        )
        .withColumn("group_name", labelled("group_name", UNCLASSIFIED))
        .orderBy("fiscal_year", "fiscal_month", F.desc("revenue"))
    )


def yoy(f: DataFrame, keys: dict[str, str], quarter: int, old: int, new: int) -> DataFrame:
    """Same quarter of two years side by side. ``keys`` maps a key column to its NULL label.

    Only the two quarters are read for the sums, but every key of the fact table keeps its row.
    """
    grouped = f.groupBy(*keys).agg(
        sum_when(in_quarter(old, quarter), "line_total").alias("q_old"),
        sum_when(in_quarter(new, quarter), "line_total").alias("q_new"),
    )
    return grouped.select(
        *[labelled(k, text) for k, text in keys.items()],
        "q_old",
        "q_new",
        pct_change("q_new", "q_old").alias("yoy_pct"),
    ).orderBy(F.desc_nulls_last("q_new"))


def heatmap(f: DataFrame) -> DataFrame:
    return f.groupBy("fiscal_year", "fiscal_month").agg(F.sum("line_total").alias("revenue"))


def heatmap_matrix(f: DataFrame) -> DataFrame:
    """One row per year, one column per month; explicit values avoid the extra job."""
    months = list(range(1, 13))
    wide = f.groupBy("fiscal_year").pivot("fiscal_month", months).agg(F.sum("line_total"))
    return wide.select("fiscal_year", *[F.col(str(m)).alias(f"m{m:02d}") for m in months])


def mom_waterfall(f: DataFrame) -> DataFrame:
    """Change against the previous month that has sales; the first month shows 0."""
    monthly = f.groupBy("fiscal_year", "fiscal_month").agg(
        month_label(F.min("order_date")).alias("label"), F.sum("line_total").alias("revenue")
    )
    # one row per month of history, so this ordering window stays small whatever the fact table holds
    by_month = Window.orderBy("fiscal_year", "fiscal_month")
    change = F.col("revenue") - F.lag("revenue").over(by_month)
    return monthly.select(
        "label", "revenue", F.coalesce(change, F.lit(0)).alias("mom_change")
    )


def monthly_pivot(f: DataFrame, groups: list[str]) -> DataFrame:
    """Month × group revenue, 0 where nothing was sold."""
    named = f.withColumn("group_name", labelled("group_name", UNCLASSIFIED))
    period = F.date_format("order_date", "yyyy-MM").alias("period")
    wide = named.groupBy(period).pivot("group_name", groups).agg(F.sum("line_total"))
    return wide.select(
        "period", *[F.coalesce(as_double(F.col(f"`{g}`")), F.lit(0.0)).alias(g) for g in groups]
    ).orderBy("period")


def seasonality_index(f: DataFrame) -> DataFrame:
    """Mean revenue of a calendar month against the mean of all months with sales; NULL if absent."""
    months = heatmap(f).groupBy("fiscal_month").agg(F.avg(as_double("revenue")).alias("month_avg"))
    overall = months.where("month_avg > 0").agg(F.avg("month_avg").alias("a")).scalar()
    spine = f.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("fiscal_month"))
    index = F.when(F.col("month_avg") > 0, nearest(F.col("month_avg") / overall * 100))
    return spine.join(months, "fiscal_month", "left").select("fiscal_month", index.alias("index"))


def overall_growth(yoy_rows: DataFrame) -> DataFrame:
    sums = yoy_rows.agg(F.sum("q_old").alias("old"), F.sum("q_new").alias("new"))
    return sums.select(F.when(F.col("old") > 0, pct_change("new", "old")).alias("overall_growth_pct"))


def time_insights(yoy_rows: DataFrame, season: DataFrame, waterfall: DataFrame) -> DataFrame:
    """Best and worst group, leading share, peak and low season, biggest gain and drop."""
    growth = F.coalesce("yoy_pct", F.lit(0.0))
    groups = yoy_rows.agg(
        F.max_by("group_name", F.struct(growth, "group_name")).alias("best_group"),
        F.min_by("group_name", F.struct(growth, "group_name")).alias("worst_group"),
        F.max("q_new").alias("top"),
        F.sum("q_new").alias("all"),
    )
    # first month wins ties on both ends
    peaks = season.where("index IS NOT NULL").agg(
        F.max_by("fiscal_month", F.struct("index", -F.col("fiscal_month"))).alias("peak_month"),
        F.min_by("fiscal_month", F.struct("index", "fiscal_month")).alias("low_month"),
        (F.max("index") - F.min("index")).alias("peak_bias"),
    )
    moves = waterfall.agg(
        F.max_by("label", "mom_change").alias("gain_label"),
        F.max("mom_change").alias("gain"),
        F.min_by("label", "mom_change").alias("drop_label"),
        F.min("mom_change").alias("drop"),
    )
    pick = lambda frame, name: frame.select(name).scalar().alias(name)
    return groups.select(
        "best_group",
        "worst_group",
        nearest(ratio("top", "all") * 100).alias("top_group_share"),
        *[pick(peaks, c) for c in ("peak_month", "low_month", "peak_bias")],
        *[pick(moves, c) for c in ("gain_label", "gain", "drop_label", "drop")],
    )


__all__ = [
    "heatmap", "heatmap_matrix", "mom_waterfall", "monthly_group", "monthly_pivot", "overall_growth",
    "seasonality_index", "time_insights", "total_of", "yoy",
]
