"""Colour demand: history, trend, projected mix, slow movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NOT_AVAILABLE, as_double, in_quarter, labelled, total_of

# Growth assumed for the next quarter, limit of a stable trend, words for the trend.
MIX_FACTOR = 1.2
TREND_LIMIT = 10
RISING, FALLING, STABLE = "tăng", "giảm", "ổn định"


def color_monthly(f: DataFrame) -> DataFrame:
    return (
        f.where("color IS NOT NULL")
        .groupBy("fiscal_year", "fiscal_month", "color")
        .agg(F.sum("quantity").alias("qty"), F.sum("line_total").alias("revenue"))
    )


def color_trend(f: DataFrame, quarter: int, old: int, new: int) -> DataFrame:
    """Quarter against the year before, for colours sold in either."""
    before, after = in_quarter(old, quarter), in_quarter(new, quarter)
    qty = as_double("quantity")
    base = (
        f.where(F.col("color").isNotNull() & (before | after))
        .groupBy("color")
        .agg(
            F.sum(F.when(before, qty).otherwise(0.0)).alias("q0"), F.sum(F.when(after, qty).otherwise(0.0)).alias("q1")
        )
    )
    whole = F.greatest(total_of(base, "q1"), F.lit(1.0))
    yoy = F.when(F.col("q0") > 0, F.bround((F.col("q1") - F.col("q0")) / F.greatest("q0", F.lit(1.0)) * 100, 1))
    return base.select(
        "color",
        F.bround("q0", 0).cast("bigint").alias("qty_old"),
        F.bround("q1", 0).cast("bigint").alias("qty_new"),
        yoy.alias("yoy_pct"),
        F.bround(F.col("q1") / whole * 100, 1).alias("pct_of_quarter"),
    )


def color_mix(trend: DataFrame, factor: float = MIX_FACTOR) -> DataFrame:
    """Projected quantity and share per colour; shares relate to the total without colour growth."""
    growth = F.coalesce("yoy_pct", F.lit(0.0))
    qty = F.bround(F.col("qty_new") * (1 + growth / 100) * factor, 0).cast("bigint")
    whole = F.greatest(total_of(trend, "qty_new") * F.lit(factor).cast("double"), F.lit(1.0))
    word = F.when(growth > TREND_LIMIT, RISING).when(growth < -TREND_LIMIT, FALLING).otherwise(STABLE)
    return trend.withColumn("projected_qty", qty).select(
        "color",
        "projected_qty",
        F.bround(F.col("projected_qty") / whole * 100, 1).alias("projected_pct"),
        word.alias("trend"),
        "yoy_pct",
        "qty_new",
    )


def color_lists(trend: DataFrame, n: int = 5) -> DataFrame:
    """The largest growing and the largest declining colours."""
    growth = F.coalesce("yoy_pct", F.lit(0.0))
    rising = trend.where(growth > TREND_LIMIT).orderBy(F.desc("qty_new"), "color").limit(n)
    falling = trend.where(growth < -TREND_LIMIT).orderBy(F.desc("qty_new"), "color").limit(n)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "color", "qty_new")
    return side(rising, "growing").unionByName(side(falling, "declining"))


def slow_movers(f: DataFrame, as_of: str, since: str, min_qty: float = 15, n: int | None = 50) -> DataFrame:
    """SKUs under a quantity or without a sale since a day, longest unsold first."""
    out = (
        f.groupBy("product_code", "product_name", "color", "line_name", "group_name")
        .agg(
            F.sum("quantity").alias("total_qty"),
            F.sum("line_total").alias("total_revenue"),
            F.max("order_date").alias("last_sale_date"),
        )
        .where((F.col("total_qty") < min_qty) | (F.col("last_sale_date") < F.lit(since).cast("date")))
        .withColumn("days_no_sale", F.datediff(F.lit(as_of).cast("date"), "last_sale_date"))
        .withColumns({c: labelled(c, NOT_AVAILABLE) for c in ("color", "line_name", "group_name")})
    )
    return out.orderBy(F.desc("days_no_sale"), "total_qty", "product_code").limit(n) if n else out
