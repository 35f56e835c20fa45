"""Headline figures of a month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    UNCLASSIFIED,
    as_double,
    in_month,
    in_quarter,
    labelled,
    month_label,
    nearest,
    pct,
    pct_change,
    pct_even,
    ratio,
    total_of,
)
from ..functions.grains import orders_and_dealers
from ..functions.ranking import order_globally


def monthly_base(f: DataFrame) -> DataFrame:
    """Per month: revenue, distinct orders, quantity, lines, distinct dealers, mean unit price."""
    base = orders_and_dealers(f, ["fiscal_year", "fiscal_month"])
    return base.withColumn("avg_unit_price", F.round(ratio("revenue", "qty"), 0))


def last_order_dates(f: DataFrame) -> DataFrame:
    return f.groupBy("customer_code").agg(F.max("order_date").alias("last_order_date"))


def active_dealers(f: DataFrame, as_of: str, days: int = 45) -> DataFrame:
    """Dealers whose last order is at most ``days`` old."""
    silent = F.datediff(F.lit(as_of).cast("date"), "last_order_date")
    return last_order_dates(f).agg(F.count_if(silent <= days).alias("active_dealers"))


def quarter_totals(f: DataFrame, year: int, quarter: int) -> DataFrame:
    return f.where(in_quarter(year, quarter)).agg(
        F.sum("line_total").alias("revenue_q"), F.countDistinct("so_number").alias("orders_q")
    )


def dealer_revenue(f: DataFrame) -> DataFrame:
    return f.groupBy("customer_code").agg(F.sum("line_total").alias("revenue"))


def pareto_share(f: DataFrame, top: float = 0.2) -> DataFrame:
    """Revenue share of dealers ranked in the top fraction; ties at the border count."""
    ranked = order_globally(dealer_revenue(f), -F.col("revenue"), "customer_code")
    inside = F.col("rank") <= F.ceil(as_double("rows") * top)
    return ranked.agg(
        F.sum(F.when(inside, F.col("revenue"))).alias("part"), F.sum("revenue").alias("whole")
    ).select(pct("part", "whole").alias("pareto_top_pct"))


def kpi(
    f: DataFrame,
    month: tuple[int, int],
    previous: tuple[int, int],
    year_ago: tuple[int, int],
    quarter: tuple[int, int],
    as_of: str,
) -> DataFrame:
    """One headline row; no row when one of the three months has no sales."""
    wanted = [month, previous, year_ago]
    base = monthly_base(f.where(in_month(*month) | in_month(*previous) | in_month(*year_ago)))

    def of(period: tuple[int, int], column: str):
        return F.max(F.when(in_month(*period), F.col(column))).alias(f"{column}_{wanted.index(period)}")

    columns = ["revenue", "orders", "qty", "total_lines", "dealers", "avg_unit_price"]
    row = base.agg(
        F.count("*").alias("months"),
        *[of(month, c) for c in columns],
        of(previous, "revenue"), of(previous, "orders"), of(year_ago, "revenue"),
    ).where(F.col("months") == 3)
    q = quarter_totals(f, *quarter)
    return row.select(
        F.col("revenue_0").alias("revenue"),
        F.col("orders_0").alias("orders"),
        F.col("qty_0").alias("qty"),
        F.col("dealers_0").alias("dealers"),
        F.round(ratio("revenue_0", "dealers_0"), 0).alias("avg_per_dealer"),
        F.col("avg_unit_price_0").alias("avg_unit_price"),
        F.round(ratio("total_lines_0", "orders_0"), 1).alias("lines_per_order"),
        pct_change("revenue_0", "revenue_1").alias("mom_revenue_pct"),
        pct_change("orders_0", "orders_1").alias("mom_orders_pct"),
        pct_change("revenue_0", "revenue_2").alias("yoy_revenue_pct"),
        active_dealers(f, as_of).scalar().alias("active_dealers"),
        pareto_share(f).scalar().alias("pareto_top20_pct"),
        q.select("revenue_q").scalar().alias("revenue_q1"),
        q.select("orders_q").scalar().alias("orders_q1"),
    )


def group_revenue(f: DataFrame, year: int, month: int) -> DataFrame:
    """Revenue and quantity by product group in one month, with its share."""
    groups = (
        f.where(in_month(year, month))
        .groupBy("group_name")
        .agg(F.sum("line_total").alias("revenue"), F.sum("quantity").alias("quantity"))
        .withColumn("group_name", labelled("group_name", UNCLASSIFIED))
    )
    return groups.withColumn("pct", pct_even(F.col("revenue"), total_of(groups, "revenue"))).orderBy(
        F.desc("revenue")
    )


def sparkline(f: DataFrame) -> DataFrame:
    return (
        f.groupBy("fiscal_year", "fiscal_month")
        .agg(month_label(F.min("order_date")).alias("label"), F.sum("line_total").alias("revenue"))
        .orderBy("fiscal_year", "fiscal_month")
    )


def target_attainment(kpi_row: DataFrame) -> DataFrame:
    """Percent of target reached: revenue, orders and active dealers."""
    # Growth targets on the quarter's monthly mean, and the retention target.
    revenue_target = as_double("revenue_q1") * 1.1 / 3
    orders_target = as_double("orders_q1") * 1.05 / 3
    dealer_target = as_double("dealers") * 0.85
    return kpi_row.select(
        nearest(ratio("revenue", revenue_target) * 100).alias("revenue_vs_target"),
        nearest(ratio("orders", orders_target) * 100).alias("orders_vs_target"),
        nearest(ratio("active_dealers", dealer_target) * 100).alias("active_vs_target"),
    )


def overview_insights(kpi_row: DataFrame, groups: DataFrame) -> DataFrame:
    """Leading group of the month and the split into active and silent dealers."""
    lead = groups.agg(F.max_by("group_name", "revenue").alias("g"), F.max_by("pct", "revenue").alias("p"))
    return kpi_row.select(
        lead.select("g").scalar().alias("top_group"),
        lead.select("p").scalar().alias("top_group_pct"),
        "active_dealers",
        (F.col("dealers") - F.col("active_dealers")).alias("silent_dealers"),
        F.round(ratio("active_dealers", "dealers") * 100, 0).alias("active_pct"),
        nearest(as_double("dealers") * 0.2).alias("top20_dealers"),
    )
