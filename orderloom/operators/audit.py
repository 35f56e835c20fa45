"""Data-quality checks: each returns the offending rows or a small table of counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import code_order, first_rows, in_month, of_month, ratio, total_of

# Fragments that betray a name printed with a broken font.
BROKEN_NAME = r"(?U)\bnn\b|Thnn|Nhnn|\bnnp\b|Thnng|Nhnt|\bHnng\b|\bChinc\b|Xanh\s*dnn|\bnen\b"
BROKEN_EXTRACT = r"(?U)(?<![a-zA-Z])nn(?![a-zA-Z])|Thnng|Nhnt|nnp\b|Hnng\b|Chinc\b|nen\b(?! )|\bnn\b"
GENERATED_CODE = r"^KH-\d+$"


def broken(name: str, pattern: str = BROKEN_NAME) -> Column:
    return F.coalesce(F.col(name).rlike(pattern), F.lit(False))


def status_distribution(log: DataFrame) -> DataFrame:
    counts = log.groupBy("processing_status").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(ratio(F.col("n"), total_of(counts, "n")) * 100, 1))


def broken_names(df: DataFrame, code: str, name: str) -> DataFrame:
    return df.where(broken(name)).select(code, name)


def line_arithmetic(lines: DataFrame, tol: int = 2) -> DataFrame:
    """Lines whose total is off the rounded quantity × price (halves away from zero)."""
    expected = F.round(F.col("quantity") * F.col("unit_price"), 0)
    return (
        lines.withColumn("expected", expected)
        .withColumn("diff", F.col("line_total") - F.col("expected"))
        .where(F.abs("diff") > tol)
        .select("line_id", "so_number", "product_code", "quantity", "unit_price", "line_total", "expected", "diff")
    )


def order_totals_off(orders: DataFrame, lines: DataFrame, tol: int = 2, n: int | None = 20) -> DataFrame:
    """Orders (also those without lines) whose total differs from the sum of their lines, worst first."""
    sums = lines.groupBy("order_id").agg(F.sum("line_total").alias("s"))
    out = (
        orders.join(sums, "order_id", "left")
        .withColumn("sum_lines", F.coalesce("s", F.lit(0)))
        .withColumn("diff", F.abs(F.col("total_amount") - F.col("sum_lines")))
        .where(F.col("diff") > tol)
        .select("order_id", "so_number", "total_amount", "sum_lines", "diff")
    )
    return out.orderBy(F.desc("diff"), "order_id").limit(n) if n else out


def footer_vs_loaded(records: DataFrame, orders: DataFrame, tol: int = 2) -> DataFrame:
    """Footer totals ``(log_id, so_number, footer_total)`` against loaded orders; the last footer counts."""
    last = (
        records.where("so_number IS NOT NULL AND footer_total IS NOT NULL")
        .groupBy("so_number")
        .agg(F.max_by("footer_total", "log_id").alias("footer_total"))
    )
    return (
        last.join(orders.select("so_number", "total_amount"), "so_number")
        .withColumn("db_total", F.col("total_amount").cast("bigint"))
        .withColumn("diff", F.col("db_total") - F.col("footer_total"))
        .where(F.abs("diff") > tol)
        .select("so_number", "footer_total", "db_total", "diff")
    )


def coverage_counts(log: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    count = F.count("*")
    return log.agg(
        count.alias("total_mails"), F.count_if(F.col("processing_status") == "LOADED").alias("loaded")
    ).select(
        "*",
        F.round(ratio("loaded", "total_mails") * 100, 1).alias("loaded_pct"),
        orders.agg(count.alias("n")).scalar().alias("orders"),
        lines.agg(count.alias("n")).scalar().alias("lines"),
    )


def not_loaded(log: DataFrame, orders: DataFrame, n: int | None = 30) -> DataFrame:
    """Mails with an order number that reached neither LOADED nor the order table."""
    out = (
        log.where((F.col("processing_status") != "LOADED") & F.col("so_number").isNotNull())
        .join(orders.select("so_number"), "so_number", "left_anti")
        .select("so_number", "log_id", "processing_status")
    )
    return out.orderBy("so_number", "log_id").limit(n) if n else out


def failures_by_reason(log: DataFrame, n: int | None = 20) -> DataFrame:
    return (
        log.where("processing_status = 'FAILED'")
        .groupBy("error_stage", F.left("error_message", F.lit(80)).alias("reason"))
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "error_stage", "reason")
        .transform(first_rows, n)
    )


def generated_dealers(customer: DataFrame) -> DataFrame:
    coded = customer.where(F.col("customer_code").rlike(GENERATED_CODE))
    bad = broken("customer_name")
    return coded.agg(
        F.count("*").alias("generated"), F.count_if(bad).alias("broken_names"), F.count_if(~bad).alias("clean_names")
    )


def orphan_products(lines: DataFrame, product: DataFrame) -> DataFrame:
    """Distinct product codes on lines that no product has."""
    return (
        lines.select("product_code")
        .distinct()
        .join(product.select("product_code"), "product_code", "left_anti")
        .where("product_code IS NOT NULL")
    )


def null_conditions(orders: DataFrame, lines: DataFrame, customer: DataFrame, log: DataFrame) -> DataFrame:
    """Nine conditions as ``(field, n_bad)``, one pass per table."""
    missing = lambda c: F.count_if(F.col(c).isNull())
    low = lambda c, ok: F.count_if(F.col(c).isNull() | ~ok)
    per_table = [
        orders.agg(
            missing("order_date").alias("sales_order.order_date"),
            missing("customer_code").alias("sales_order.customer_code"),
            missing("total_amount").alias("sales_order.total_amount"),
        ),
        lines.agg(
            missing("product_code").alias("order_line.product_code"),
            low("quantity", F.col("quantity") > 0).alias("order_line.quantity"),
            low("unit_price", F.col("unit_price") >= 0).alias("order_line.unit_price"),
            missing("line_total").alias("order_line.line_total"),
        ),
        customer.agg(low("customer_name", F.col("customer_name") != "").alias("customer.customer_name")),
        log.agg(missing("so_number").alias("email_log.so_number")),
    ]
    out = None
    for row in per_table:
        names = row.columns
        long = row.unpivot([], [F.col(f"`{n}`") for n in names], "field", "n_bad")
        out = long if out is None else out.unionByName(long)
    return out


def issues(counts: DataFrame) -> DataFrame:
    """Checks that found something, from ``(check_id, n_bad)``."""
    return counts.where(F.col("n_bad") > 0)


def dates_outside(orders: DataFrame, first: str, last: str) -> DataFrame:
    inside = F.col("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return orders.where(~inside).select("so_number", "order_date")


def empty_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return orders.join(lines.select("order_id"), "order_id", "left_anti").select("so_number")


def repeated_products(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("so_number", "product_code")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .orderBy(F.desc("n"), "so_number", "product_code")
    )


def zero_price(lines: DataFrame) -> DataFrame:
    return lines.where("unit_price = 0").select("line_id", "so_number", "product_code", "quantity")


def large_quantity(lines: DataFrame, limit: float = 1000) -> DataFrame:
    return (
        lines.where(F.col("quantity") > limit)
        .select("line_id", "so_number", "product_code", "quantity")
        .orderBy(F.desc("quantity"), "line_id")
    )


def _lines_of(lines: DataFrame, period: DataFrame, year: int, month: int) -> DataFrame:
    """Lines of the orders of a period; of lines stored by month only that month is read."""
    if "fiscal_month" in lines.columns:
        lines = lines.where(in_month(year, month))
    return lines.join(period.select("order_id"), "order_id", "left_semi")


def fact_in_step(lines: DataFrame, orders: DataFrame, fact: DataFrame, year: int, month: int) -> DataFrame:
    """Lines of the period against fact rows of the period."""
    n_lines = _lines_of(lines, of_month(orders, year, month), year, month).agg(F.count("*").alias("order_lines"))
    n_fact = fact.where(in_month(year, month)).agg(F.count("*").alias("n"))
    return n_lines.select(
        "order_lines", n_fact.scalar().alias("fact_rows")
    ).withColumn("gap", F.abs(F.col("order_lines") - F.col("fact_rows")))


def new_without_tax(customer: DataFrame, last_old_code: str) -> DataFrame:
    """Dealers coded above ``last_old_code`` (by number) without a tax code."""
    no_tax = F.col("tax_code").isNull() | (F.col("tax_code") == "")
    return customer.where((code_order("customer_code") > code_order(F.lit(last_old_code))) & no_tax).select("customer_code", "customer_name")


def repeated_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("so_number").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def plausibility(fact: DataFrame, year: int, month: int, min_revenue: float, min_mean: float) -> DataFrame:
    row = fact.where(in_month(year, month)).agg(
        F.coalesce(F.sum("line_total"), F.lit(0)).alias("revenue"),
        F.countDistinct("so_number").alias("orders"),
        F.round(ratio(F.sum("line_total"), F.count("line_total")), 2).alias("mean_line"),
    )
    status = (
        F.when(F.col("revenue") < min_revenue, "WARN")
        .when(F.coalesce("mean_line", F.lit(0.0)) < min_mean, "WARN")
        .otherwise("OK")
    )
    return row.withColumn("status", status)


def other_states(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("processing_status").agg(F.count("*").alias("n")).where(F.col("processing_status") != "LOADED")
    )


def period_totals(orders: DataFrame, lines: DataFrame, year: int, month: int) -> DataFrame:
    """Orders and lines of a period: counts, amounts, date range."""
    period = of_month(orders, year, month)
    inner = _lines_of(lines, period, year, month).agg(
        F.count("*").alias("n"), F.sum("quantity").alias("q"), F.sum("line_total").alias("r")
    )
    return period.agg(
        F.count("*").alias("so_count"),
        F.min("order_date").alias("min_date"),
        F.max("order_date").alias("max_date"),
        F.sum("total_amount").alias("order_revenue"),
    ).select(
        "*",
        *[inner.select(c).scalar().alias(name) for c, name in
          (("n", "line_count"), ("q", "total_qty"), ("r", "line_revenue"))],
    )


def top_period_dealers(orders: DataFrame, customer: DataFrame, year: int, month: int, n: int | None = 10) -> DataFrame:
    per_dealer = (
        of_month(orders, year, month)
        .groupBy("customer_code")
        .agg(F.count("*").alias("so_count"), F.sum("total_amount").alias("revenue"))
    )
    return (
        per_dealer.join(customer.select("customer_code", "customer_name"), "customer_code")
        .orderBy(F.desc("revenue"), "customer_code")
        .transform(first_rows, n)
    )


def dealers_above(customer: DataFrame, number: int) -> DataFrame:
    coded = customer.where(F.col("customer_code").rlike(GENERATED_CODE))
    return coded.agg(
        F.count_if(F.substring("customer_code", 4, 18).cast("bigint") > number).alias("new_dealers")
    )


def mismatched_orders(orders: DataFrame, lines: DataFrame, year: int, month: int, tol: int = 2) -> DataFrame:
    """Orders of a period, with lines, whose total differs from the sum of the lines: the count."""
    period = of_month(orders, year, month)
    sums = _lines_of(lines, period, year, month).groupBy("order_id").agg(F.sum("line_total").alias("s"))
    return period.join(sums, "order_id").agg(
        F.count_if(F.abs(F.col("total_amount") - F.col("s")) > tol).alias("mismatched_orders")
    )


def orphan_lines(lines: DataFrame, product: DataFrame) -> DataFrame:
    return lines.join(product.select("product_code"), "product_code", "left_anti").agg(
        F.count("*").alias("orphan_lines")
    )


def last_failures(log: DataFrame, n: int | None = 5) -> DataFrame:
    return (
        log.where("processing_status = 'FAILED'")
        .orderBy(F.desc("log_id"))
        .transform(first_rows, n)
        .select("log_id", "so_number", "error_stage", F.left("error_message", F.lit(120)).alias("error"))
    )


Check = tuple[str, str, Callable[[], DataFrame]]


def run_checks(checks: list[Check]) -> DataFrame:
    """``(check_id, status, n_bad)`` for checks ``(id, severity, rows)``; severity is FAIL or WARN.

    A check that cannot even be planned is reported as ERROR and does not stop the others.
    """
    out = None
    for check_id, severity, rows in checks:
        try:
            found = rows().agg(F.count("*").alias("n_bad"))
        except Exception:  # noqa: BLE001
            unknown = F.lit(None).cast("bigint").alias("n_bad")
            found, severity = SparkSession.active().range(1).select(unknown), "ERROR"
        status = F.when(F.col("n_bad") == 0, "OK").otherwise(F.lit(severity))
        row = found.select(F.lit(check_id).alias("check_id"), status.alias("status"), "n_bad")
        out = row if out is None else out.unionByName(row)
    return out


def scorecard(results: DataFrame) -> DataFrame:
    """How many checks ran, passed and failed."""
    ok = F.col("status") == "OK"
    return results.agg(
        F.count("*").alias("checks"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed")
    )

