"""Product analytics: hierarchy, portfolio quadrants, colours, best sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    UNCLASSIFIED,
    UNKNOWN_COLOR,
    as_double,
    in_quarter,
    labelled,
    nearest,
    pct,
    pct_change,
    ratio,
    sum_when,
    total_of,
)

GROWTH_THRESHOLD = 10.0


def hierarchy(f: DataFrame) -> DataFrame:
    """Group → line → SKU with revenue and quantity."""
    return (
        f.groupBy("group_name", "line_name", "product_code", "product_name")
        .agg(F.sum("line_total").alias("revenue"), F.sum("quantity").alias("quantity"))
        .select(
            labelled("group_name", UNCLASSIFIED),
            labelled("line_name", UNCLASSIFIED),
            "product_code",
            F.coalesce("product_name", F.col("product_code").cast("string")).alias("product_name"),
            "revenue",
            "quantity",
        )
        .orderBy(F.desc("revenue"))
    )


def hierarchy_rollup(f: DataFrame) -> DataFrame:
    """The same tree with totals on every level; level 1 = group, 2 = line, 3 = SKU.

    A line is identified together with its group. SKUs are summed before the rollup, so only the small
    per-SKU table is expanded to three levels.
    """
    skus = f.groupBy("group_name", "line_name", "product_code").agg(F.sum("line_total").alias("revenue"))
    named = skus.select(
        labelled("group_name", UNCLASSIFIED), labelled("line_name", UNCLASSIFIED), "product_code", "revenue"
    )
    tree = named.rollup("group_name", "line_name", "product_code").agg(
        F.sum("revenue").alias("revenue"), F.grouping_id().alias("gid")
    )
    level = F.when(F.col("gid") == 3, 1).when(F.col("gid") == 1, 2).when(F.col("gid") == 0, 3)
    return tree.withColumn("level", level).where("level IS NOT NULL").drop("gid")


def bcg(f: DataFrame, keys: list[str], quarter: int, old: int, new: int) -> DataFrame:
    """Growth/share quadrant per key: revenue against the interpolated median, growth against 10 %."""
    data = (
        f.groupBy(*keys)
        .agg(
            sum_when(in_quarter(old, quarter), "line_total").alias("q_old"),
            sum_when(in_quarter(new, quarter), "line_total").alias("q_new"),
            F.sum("line_total").alias("total_rev"),
            F.sum("quantity").alias("total_qty"),
        )
        .select(*[labelled(k, UNCLASSIFIED) for k in keys], "q_old", "q_new", "total_rev", "total_qty")
    )
    stats = data.agg(
        F.sum("total_rev").alias("t"), F.median(as_double("total_rev")).alias("m")
    )
    high_revenue = as_double("total_rev") > F.col("median_rev")
    high_growth = F.coalesce(F.col("yoy_pct") > GROWTH_THRESHOLD, F.lit(False))
    return (
        data.withColumn("median_rev", stats.select("m").scalar())
        .withColumn("revenue_share_pct", pct(F.col("total_rev"), stats.select("t").scalar()))
        .withColumn("yoy_pct", pct_change("q_new", "q_old"))
        .withColumn(
            "quadrant",
            F.when(high_revenue & high_growth, "Stars")
            .when(high_revenue, "Cash Cows")
            .when(high_growth, "Question Marks")
            .otherwise("Dogs"),
        )
        .drop("median_rev")
        .orderBy(F.desc("total_rev"))
    )


def color_heatmap(f: DataFrame, n: int = 25) -> DataFrame:
    """Colour × line for the ``n`` best-selling lines; rows without colour or line are left out."""
    cells = (
        f.where("line_name IS NOT NULL")
        .groupBy("color", "line_name")
        .agg(F.sum("quantity").alias("total_qty"), F.sum("line_total").alias("revenue"))
    )
    top = (
        cells.groupBy("line_name")
        .agg(F.sum("revenue").alias("line_revenue"))
        .orderBy(F.desc("line_revenue"), "line_name")
        .limit(n)
    )
    return (
        cells.where("color IS NOT NULL")
        .join(top.select("line_name"), "line_name", "left_semi")
        .select(labelled("color", UNKNOWN_COLOR), "line_name", "total_qty", "revenue")
        .orderBy("color", F.desc("total_qty"))
    )


def color_matrix(heat: DataFrame, colors: list[str]) -> DataFrame:
    """Dense line × colour quantities, 0 where nothing was sold."""
    wide = heat.groupBy("line_name").pivot("color", colors).agg(F.sum("total_qty"))
    return wide.select(
        "line_name", *[F.coalesce(as_double(F.col(f"`{c}`")), F.lit(0.0)).alias(c) for c in colors]
    )


def top_sku(f: DataFrame, n: int = 20, ascending: bool = False) -> DataFrame:
    """Best or worst ``n`` SKUs by revenue."""
    order = F.asc("revenue") if ascending else F.desc("revenue")
    return (
        f.groupBy("product_code", "product_name", "color", "line_name", "group_name")
        .agg(
            F.sum("quantity").alias("total_qty"),
            F.sum("line_total").alias("revenue"),
            F.countDistinct("so_number").alias("orders"),
        )
        .orderBy(order, "product_code")
        .limit(n)
        .select(
            "product_code",
            F.coalesce("product_name", F.col("product_code").cast("string")).alias("product_name"),
            F.coalesce("color", F.lit("")).alias("color"),
            labelled("line_name", UNCLASSIFIED),
            labelled("group_name", UNCLASSIFIED),
            "total_qty",
            "revenue",
            "orders",
        )
    )


def product_insights(quadrants: DataFrame, heat: DataFrame, best: DataFrame) -> DataFrame:
    """Quadrant sizes, cash-cow share, weight of the three best SKUs, leading colour cell."""
    is_cow = F.col("quadrant") == "Cash Cows"
    shares = quadrants.agg(
        F.count_if(F.col("quadrant") == "Stars").alias("stars"),
        F.count_if(is_cow).alias("cash_cows"),
        F.count_if(F.col("quadrant") == "Dogs").alias("dogs"),
        F.count_if(F.col("quadrant") == "Question Marks").alias("question_marks"),
        F.coalesce(F.sum(F.when(is_cow, F.col("total_rev"))), F.lit(0)).alias("cow"),
        F.sum("total_rev").alias("all"),
    )
    three = best.orderBy(F.desc("revenue"), "product_code").limit(3).agg(F.sum("revenue").alias("r")).scalar()
    cell = heat.agg(
        F.max_by("color", F.struct("total_qty", "color", "line_name")).alias("c"),
        F.max("total_qty").alias("top"),
        F.sum("total_qty").alias("all"),
    )
    leader = best.agg(F.max_by("product_code", F.struct("revenue", "product_code")).alias("p")).scalar()
    return shares.select(
        "stars",
        "cash_cows",
        "dogs",
        "question_marks",
        nearest(ratio("cow", "all") * 100).alias("cash_cow_share"),
        leader.alias("top_product"),
        nearest(ratio(three, total_of(best, "revenue")) * 100).alias("top3_share"),
        cell.select("c").scalar().alias("top_color"),
        nearest(ratio(cell.select("top").scalar(), cell.select("all").scalar()) * 100).alias("top_color_share"),
    )
