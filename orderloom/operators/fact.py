"""The flat sales fact table and the views on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, ratio

# The columns of the fact table, in order.
FACT_COLUMNS = [
    "order_date", "fiscal_year", "fiscal_quarter", "fiscal_month", "week_of_year",
    "so_number", "order_id", "line_id",
    "customer_code", "customer_name", "province_id", "province_name", "region",
    "product_code", "product_name", "color", "line_id_fk", "line_name", "group_code", "group_name",
    "quantity", "unit_price", "line_total",
]

_CALENDAR = {"fiscal_year", "fiscal_quarter", "fiscal_month", "week_of_year"}
_ORDER = {"order_date", "customer_code"} | _CALENDAR
_PLACE = {"province_name", "region"}
_CUSTOMER = {"customer_name", "customer_tier", "province_id"} | _PLACE
_GROUP = {"group_name"}
_LINE = {"line_name", "group_code"} | _GROUP
_PRODUCT = {"product_name", "color", "line_id_fk"} | _LINE


@dataclass
class Star:
    """The normalised tables behind the fact table, under their role names."""

    order_line: DataFrame
    sales_order: DataFrame
    customer: DataFrame
    province: DataFrame
    product: DataFrame
    product_line: DataFrame | None = None
    product_group: DataFrame | None = None


def with_calendar(df: DataFrame, date: str = "order_date") -> DataFrame:
    """Fiscal parts equal calendar parts; the week is the ISO week."""
    d = F.col(date)
    return df.withColumns(
        {
            "fiscal_year": F.year(d),
            "fiscal_quarter": F.quarter(d),
            "fiscal_month": F.month(d),
            "week_of_year": F.weekofyear(d).cast("smallint"),
        }
    )


def flatten(
    star: Star, columns: list[str] | None = None, keep_orphans: bool = False, late: dict[str, str] | None = None
) -> DataFrame:
    """Lines ⋈ (product ⟕ line ⟕ group) ⋈ (orders ⋈ customers ⟕ province).

    The rows are the same whatever ``columns`` are asked for: the joins that drop lines without order,
    dealer or product are always planned, the outer ones only where a column needs them.
    ``keep_orphans=True`` plans only the joins the columns need, so orphan lines stay where it can.
    No side is forced to broadcast: the planner does so for a dimension it measures as small and
    sort-merge joins the rest. Calendar parts are computed after the joins, and so are the line columns of ``late``
    (SQL over the columns of ``order_line``): exchanges carry what they are computed from, which is narrower.
    """
    wanted = list(columns) if columns else FACT_COLUMNS
    need = set(wanted)
    everything = not keep_orphans
    out = star.order_line
    if need & _PRODUCT or everything:
        product = star.product
        if need & _LINE and "line_name" not in product.columns:
            product = product.join(star.product_line, "line_id", "left")
            if need & _GROUP:
                product = product.join(star.product_group, "group_code", "left")
        product = product.withColumnRenamed("line_id", "line_id_fk")
        keep = ["product_code"] + [c for c in product.columns if c in need & _PRODUCT]
        out = out.join(product.select(*keep), "product_code")
    if need & (_ORDER | _CUSTOMER) or everything:
        # dealer and place join the orders first, so that the many lines are dealt out by order only; that comes
        # last, so that the lines of an order stay together and orders are counted with little to exchange
        orders = star.sales_order.select("order_id", "order_date", "customer_code")
        if need & _CUSTOMER or everything:
            dealer_cols = ["customer_code", "customer_name", "province_id"]
            if "customer_tier" in need:
                dealer_cols.append("customer_tier")
            orders = orders.join(star.customer.select(*dealer_cols), "customer_code")
        if need & _PLACE:
            orders = orders.join(star.province.select("province_id", "province_name", "region"), "province_id", "left")
        out = out.join(orders, "order_id")
    if need & _CALENDAR:
        out = with_calendar(out)
    return out.select(*[F.expr(late[c]).alias(c) if late and c in late else c for c in wanted])


def refresh(fact: DataFrame, star: Star) -> DataFrame:
    """Rows to append: flattened lines whose ``line_id`` the fact table does not hold yet.

    An anti join, so a NULL key in the fact table never blocks the refresh.
    """
    known = fact.select("line_id").where(F.col("line_id").isNotNull()).distinct()
    fresh = Star(**{**star.__dict__, "order_line": star.order_line.join(known, "line_id", "left_anti")})
    return flatten(fresh)


def month_report(fact: DataFrame) -> DataFrame:
    return fact.groupBy("fiscal_year", "fiscal_month").agg(
        F.count("*").alias("rows"),
        F.countDistinct("so_number").alias("orders"),
        F.sum("line_total").alias("revenue"),
    )


def customer_activity(fact: DataFrame, as_of: str) -> DataFrame:
    """Per dealer: orders, revenue, first and last order, days since the last."""
    return (
        fact.groupBy("customer_code", "customer_name", "province_name", "region")
        .agg(
            F.countDistinct("so_number").alias("total_orders"),
            F.sum("line_total").alias("total_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("days_since_last_order", F.datediff(F.lit(as_of).cast("date"), "last_order_date"))
    )


def monthly_by_group(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("fiscal_year", "fiscal_month", "group_code", "group_name")
        .agg(
            F.countDistinct("so_number").alias("order_count"),
            F.sum("quantity").alias("total_qty"),
            F.sum("line_total").alias("total_revenue"),
        )
        .withColumn("avg_unit_price", F.round(ratio("total_revenue", "total_qty"), 2))
    )


def seconds_between(start: str, end: str) -> Column:
    """Elapsed seconds with microseconds, whatever the two timestamp kinds are."""
    micros = [F.unix_micros(F.col(c).cast("timestamp")) for c in (end, start)]
    return as_double(micros[0] - micros[1]) / 1e6


def email_kpi(log: DataFrame) -> DataFrame:
    """Mail totals by outcome, pass rate and mean processing time."""
    status = F.col("processing_status")
    return (
        log.agg(
            F.count("*").alias("total_emails"),
            F.count_if(status == "LOADED").alias("loaded_ok"),
            F.count_if(status == "FAILED").alias("failed"),
            F.count_if(status == "DUPLICATE").alias("duplicates"),
            F.avg(seconds_between("received_at", "processed_at")).alias("mean_s"),
        )
        .withColumn("pass_rate_pct", F.round(ratio("loaded_ok", "total_emails") * 100.0, 2))
        .withColumn("avg_processing_seconds", F.round("mean_s", 2))
        .drop("mean_s")
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Mail counts by status, followed by the KPI figures, as name/value rows."""
    counts = log.groupBy("processing_status").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("status").alias("section"), F.col("processing_status").alias("name"), "value"
    )
    kpi = email_kpi(log)
    names = kpi.columns
    unpivoted = kpi.select(*[as_double(c).alias(c) for c in names]).unpivot([], names, "name", "value")
    return counts.unionByName(unpivoted.select(F.lit("kpi").alias("section"), "name", "value"))
