"""Sales by region and province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    UNKNOWN_PLACE,
    in_quarter,
    labelled,
    nearest,
    pct_even,
    ratio,
    total_of,
)
from ..functions.grains import orders_and_dealers
from .timeline import yoy


def _by_place(f: DataFrame, keys: list[str]) -> DataFrame:
    base = orders_and_dealers(f, keys)
    return base.select(
        *[labelled(k, UNKNOWN_PLACE) for k in keys],
        "revenue",
        F.col("orders").alias("order_count"),
        F.col("dealers").alias("dealer_count"),
        F.col("qty").alias("quantity"),
    )


def provinces(f: DataFrame) -> DataFrame:
    return (
        _by_place(f, ["region", "province_name"])
        .withColumn("avg_revenue_per_dealer", F.round(ratio("revenue", "dealer_count"), 0))
        .orderBy(F.desc("revenue"))
    )


def province_growth(f: DataFrame, quarter: int, old: int, new: int) -> DataFrame:
    """Quarter against the year before, provinces with sales in either."""
    keys = {"province_name": UNKNOWN_PLACE, "region": UNKNOWN_PLACE}
    # provinces without sales in both quarters fall out anyway, so only the two quarters are read
    two_quarters = f.where(in_quarter(old, quarter) | in_quarter(new, quarter))
    return (
        yoy(two_quarters, keys, quarter, old, new)
        .where((F.col("q_old") > 0) | (F.col("q_new") > 0))
        .orderBy(F.desc_nulls_last("yoy_pct"))
    )


def regions(f: DataFrame) -> DataFrame:
    base = _by_place(f, ["region"])
    return base.withColumn("pct", pct_even(F.col("revenue"), total_of(base, "revenue"))).orderBy(
        F.desc("revenue")
    )


def province_extremes(by_province: DataFrame, growth: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` strongest and weakest provinces with their growth."""
    cols = ["province_name", "revenue"]
    top = by_province.select(*cols).orderBy(F.desc("revenue"), "province_name").limit(n)
    bottom = by_province.select(*cols).orderBy("revenue", "province_name").limit(n)
    both = top.withColumn("side", F.lit("top")).unionByName(bottom.withColumn("side", F.lit("bottom")))
    return both.join(growth.select("province_name", "yoy_pct"), "province_name", "left")


def geo_rollup(f: DataFrame) -> DataFrame:
    """Region → province tree; the region rows carry a NULL province."""
    named = (
        f.groupBy("region", "province_name")
        .agg(F.sum("line_total").alias("revenue"))
        .select(labelled("region", UNKNOWN_PLACE), labelled("province_name", UNKNOWN_PLACE), "revenue")
    )
    tree = named.rollup("region", "province_name").agg(F.sum("revenue").alias("revenue"))
    return tree.where("region IS NOT NULL")


def growth_split(growth: DataFrame) -> DataFrame:
    """Growing and shrinking provinces; the strongest move of each side first."""
    side = F.when(F.col("yoy_pct") > 0, "growing").when(F.col("yoy_pct") < 0, "shrinking")
    return (
        growth.withColumn("side", side)
        .where("side IS NOT NULL")
        .select("side", "province_name", "yoy_pct")
        .orderBy("side", F.desc(F.abs("yoy_pct")), "province_name")
    )


def network_efficiency(by_region: DataFrame, by_province: DataFrame, min_dealers: int = 3) -> DataFrame:
    """Revenue per dealer: best and worst known region, best province with enough dealers."""
    per = F.when(F.col("dealer_count") > 0, ratio("revenue", "dealer_count")).otherwise(0.0)
    ranked = by_region.where(F.col("region") != UNKNOWN_PLACE).withColumn("per", per)
    best = by_province.where(F.col("dealer_count") >= min_dealers).agg(
        F.max_by("province_name", F.struct("avg_revenue_per_dealer", "province_name")).alias("p")
    )
    return ranked.agg(
        F.max_by("region", F.struct("per", "region")).alias("best_region"),
        F.round(F.max("per"), 2).alias("best_per_dealer"),
        F.min_by("region", F.struct("per", "region")).alias("worst_region"),
        F.round(F.min("per"), 2).alias("worst_per_dealer"),
        F.round(F.max("per") / F.min("per"), 1).alias("spread"),
    ).withColumn("best_province", best.scalar())


def coverage(province: DataFrame, f: DataFrame) -> DataFrame:
    """Provinces with sales out of all provinces."""
    sold = f.select("province_id").distinct()
    covered = province.join(sold, "province_id", "left_semi").agg(F.count("*").alias("n"))
    return province.agg(F.count("*").alias("total_provinces")).select(
        "total_provinces",
        covered.scalar().alias("covered"),
    ).select(
        "*",
        (F.col("total_provinces") - F.col("covered")).alias("uncovered"),
        nearest(ratio("covered", "total_provinces") * 100).alias("coverage_pct"),
    )
