"""Dealer analytics: RFM, churn lists, baskets, concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import UNCLASSIFIED, as_double, first_rows, labelled, nearest, ratio, total_of
from ..functions.ranking import order_globally, tile
from ..session import cut
from .overview import dealer_revenue

# Segment names in display order with the lowest total that earns them.
SEGMENTS = [("Champions", 13), ("Loyal", 10), ("Promising", 7), ("At Risk", 4), ("Lost", None)]


def rfm_base(f: DataFrame, as_of: str) -> DataFrame:
    return (
        f.groupBy("customer_code", "customer_name", "province_name", "region")
        .agg(
            F.max("order_date").alias("last_order_date"),
            F.countDistinct("so_number").alias("frequency"),
            F.sum("line_total").alias("monetary"),
        )
        .withColumn("recency_days", F.datediff(F.lit(as_of).cast("date"), "last_order_date"))
    )


def rfm_scores(base: DataFrame, mode: str = "reference", key: str = "customer_code") -> DataFrame:
    """Quintile scores and their total.

    ``mode="reference"`` gives the best dealers score 1, so a high total marks the weakest dealers;
    ``mode="high_is_best"`` turns the scores round and is what a new report should use.
    """
    if mode not in ("reference", "high_is_best"):
        raise ValueError(mode)
    measures = {
        "r": as_double("recency_days"),
        "f": -as_double("frequency"),
        "m": -F.col("monetary"),
    }
    stored = out = cut(base)  # one row per dealer, ordered by each measure below
    for name, value in measures.items():
        ordered = order_globally(stored.select(key, value.alias("_value")), F.col("_value"), key)
        score = tile(F.col("position"), F.col("rows"), 5)
        out = out.join(ordered.select(key, (score if mode == "reference" else 6 - score).alias(f"{name}_score")), key)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return out.withColumn("rfm_total", total)


def segment_of(total: Column) -> Column:
    out = F.when(total.isNull(), "Unknown")
    for name, low in SEGMENTS[:-1]:
        out = out.when(total >= low, name)
    return out.otherwise(SEGMENTS[-1][0])


def rfm_segment(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_of(F.col("rfm_total")))


def rfm_segment_counts(segmented: DataFrame) -> DataFrame:
    """Dealers per segment in display order, 0 for an empty segment."""
    spark = segmented.sparkSession
    spine = spark.createDataFrame(
        [(i, name) for i, (name, _) in enumerate(SEGMENTS, 1)], "display_order int, segment string"
    )
    counts = segmented.groupBy("segment").agg(F.count("*").alias("n"))
    return spine.join(counts, "segment", "left").select(
        "display_order",
        "segment",
        F.coalesce("n", F.lit(0)).alias("dealers"),
        nearest(ratio(F.coalesce("n", F.lit(0)), total_of(counts, "n")) * 100).alias("share_pct"),
    )


def churn_list(activity: DataFrame, threshold: int = 45, n: int | None = 200) -> DataFrame:
    """Dealers silent for more than ``threshold`` days; the report holds the ``n`` longest first, ``None`` all."""
    silent = activity.where(F.col("days_since_last_order") > threshold)
    return silent if n is None else silent.orderBy(F.desc("days_since_last_order"), "customer_code").limit(n)


def top_dealers(f: DataFrame, n: int = 10) -> DataFrame:
    return (
        f.groupBy("customer_code", "customer_name", "province_name", "region")
        .agg(
            F.sum("line_total").alias("revenue"),
            F.countDistinct("so_number").alias("orders"),
            F.sum("quantity").alias("quantity"),
        )
        .orderBy(F.desc("revenue"), "customer_code")
        .limit(n)
    )


def basket(f: DataFrame) -> DataFrame:
    """Orders holding both groups, for every pair of product groups.

    Orders are first reduced to their set of groups and equal sets are counted, so pairs are spelled out
    once per distinct set instead of once per order. A set is never longer than the group dimension.
    """
    sets = (
        f.groupBy("so_number")
        .agg(F.array_sort(F.collect_set(F.coalesce("group_name", F.lit(UNCLASSIFIED)))).alias("groups"))
        .groupBy("groups")
        .agg(F.count("*").alias("orders"))
        .where(F.size("groups") > 1)
    )
    left = sets.select("orders", "groups", F.posexplode("groups").alias("i", "group_a"))
    pairs = left.select(
        "orders",
        "group_a",
        F.explode(F.slice("groups", F.col("i") + 2, F.size("groups"))).alias("group_b"),
    )
    return pairs.groupBy("group_a", "group_b").agg(F.sum("orders").alias("co_count")).orderBy(
        F.desc("co_count"), "group_a", "group_b"
    )


def pareto_curve(f: DataFrame) -> DataFrame:
    """Dealers by falling revenue with rank, dealer share and cumulative revenue share."""
    ranked = order_globally(dealer_revenue(f), -F.col("revenue"), "customer_code", amount="revenue", totals=True)
    return ranked.select(
        F.col("rank").alias("rnk"),
        "customer_code",
        "revenue",
        F.col("rows").alias("total_dealers"),
        F.round(ratio("rank", "rows") * 100.0, 1).alias("dealer_pct"),
        F.round(ratio("running", "total") * 100.0, 1).alias("cumulative_pct"),
    )


def pareto_cut(curve: DataFrame, share: float = 80) -> DataFrame:
    """First point of the curve that reaches ``share`` percent of revenue."""
    order = F.struct("cumulative_pct", "rnk", "customer_code")
    return curve.where(F.col("cumulative_pct") >= share).agg(
        F.min_by("dealer_pct", order).alias("dealer_pct"),
        F.min_by("cumulative_pct", order).alias("cumulative_pct"),
        F.min_by("rnk", order).alias("rnk"),
    )


def pareto_points(curve: DataFrame, n: int | None = 200) -> DataFrame:
    """The first ``n`` points, which is what the chart draws."""
    return curve.orderBy("rnk", "customer_code").transform(first_rows, n).select("dealer_pct", "cumulative_pct")


def churn_value(silent: DataFrame) -> DataFrame:
    """Revenue history at risk in a churn list."""
    top = silent.orderBy(F.desc("total_revenue"), "customer_code").limit(10)
    return silent.agg(
        F.count("*").alias("dealers"),
        F.sum("total_revenue").alias("revenue_at_risk"),
        F.round(F.avg(as_double("total_revenue")), 2).alias("mean_revenue"),
    ).withColumn("top10_revenue", total_of(top, "total_revenue"))


def dealer_insights(segmented: DataFrame, pairs: DataFrame) -> DataFrame:
    """Core dealers (the two best-named segments) and the most frequent group pair."""
    core = F.col("segment").isin("Champions", "Loyal")
    best = pairs.orderBy(F.desc("co_count"), "group_a", "group_b").limit(1)
    return segmented.agg(
        F.count_if(core).alias("core_dealers"), F.count("*").alias("all_dealers")
    ).select(
        "core_dealers",
        nearest(ratio("core_dealers", "all_dealers") * 100).alias("core_share"),
        *[best.select(c).scalar().alias(c) for c in ("group_a", "group_b", "co_count")],
        pairs.agg(F.count("*").alias("n")).scalar().alias("pair_count"),
    )
