"""Ad-hoc questions in SQL over the named tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from .operators.fact import Star, customer_activity, email_kpi, flatten, monthly_by_group

# Rows shown, and what a caller reads instead of rows.
ROW_LIMIT = 50
ONLY_SELECT = "Lỗi: Chỉ hỗ trợ truy vấn SELECT."
FAILED = "Lỗi truy vấn: "
NO_ROWS = "Không có dữ liệu."

VIEW_NOTES = {
    "fact_sales": "one flat row per order line; prefer it to joining the tables",
    "sales_order": "one row per order",
    "order_line": "one row per order line",
    "customer": "one row per dealer",
    "product": "one row per article",
    "product_line": "article lines, each in one product group",
    "product_group": "product groups",
    "province": "provinces and their regions",
    "email_log": "one row per order mail with its current state",
    "v_customer_activity": "orders, revenue, first and last order and days since the last one, per dealer",
    "v_monthly_by_group": "orders, quantity, revenue and mean unit price per month and product group",
    "v_email_processing_kpi": "mails by outcome, share loaded and mean processing time",
}
# a column means the same in every view that has it
COLUMN_NOTES = {
    "order_date": "day of the order",
    "fiscal_year": "calendar year of the order",
    "fiscal_quarter": "calendar quarter of the order, 1 to 4",
    "fiscal_month": "calendar month of the order, 1 to 12",
    "week_of_year": "ISO week of the order",
    "so_number": "number of the order, as on its document",
    "order_id": "key of the order",
    "line_id": "key of the order line; in product and product_line key of the article line",
    "line_id_fk": "key of the article line",
    "customer_code": "key of the dealer",
    "customer_name": "name of the dealer",
    "tax_code": "tax code of the dealer",
    "customer_tier": "class of the dealer",
    "province_id": "key of the province",
    "province_name": "name of the province",
    "region": "region of the province",
    "product_code": "key of the article",
    "product_name": "name of the article",
    "color": "colour of the article",
    "line_name": "name of the article line; NULL: not classified",
    "group_code": "key of the product group",
    "group_name": "name of the product group",
    "quantity": "pieces ordered",
    "unit_price": "price of a piece",
    "line_total": "amount of the line",
    "total_amount": "amount of the order",
    "total_orders": "distinct orders of the dealer",
    "total_revenue": "sum of line amounts",
    "first_order_date": "day of the dealer's first order",
    "last_order_date": "day of the dealer's last order",
    "days_since_last_order": "days from the last order to the day asked for",
    "order_count": "distinct orders",
    "total_qty": "sum of pieces",
    "avg_unit_price": "revenue over pieces",
    "log_id": "key of the log row",
    "message_id": "id of the mail",
    "from_address": "sender of the mail",
    "received_at": "when the mail came",
    "processed_at": "when it was loaded; NULL: not yet",
    "processing_status": "state of the mail in the intake",
    "payload": "what was read from the mail, as JSON",
    "total_emails": "mails in the log",
    "loaded_ok": "mails loaded",
    "failed": "mails that failed",
    "duplicates": "mails of an order that was there already",
    "pass_rate_pct": "loaded mails in percent of all",
    "avg_processing_seconds": "mean seconds from receipt to loading",
}


def documented(df: DataFrame, notes: dict[str, str]) -> DataFrame:
    """The frame with a comment on each column that has a note; a caller's own comment stays."""
    for field in df.schema.fields:
        if field.name in notes and "comment" not in field.metadata:
            df = df.withMetadata(field.name, {**field.metadata, "comment": notes[field.name]})
    return df


def register_views(
    spark: SparkSession, star: Star, as_of: str, log: DataFrame | None = None, fact: DataFrame | None = None,
    notes: dict[str, str] | None = None,
) -> list[str]:
    """Temporary views for analysts; returns their names.

    ``fact`` is the stored fact table (else it is joined from the star), ``log`` the mail log, whose two views are
    absent without it. Article lines and groups come from their own tables or, in a star that holds them with the
    article, from there. Comments on the columns, ``COLUMN_NOTES`` and ``notes``, are read with
    ``DESCRIBE`` or ``spark.catalog.listColumns``.
    """
    fact = flatten(star) if fact is None else fact
    lines, groups = star.product_line, star.product_group
    if lines is None:
        lines = star.product.where("line_id IS NOT NULL").select("line_id", "line_name", "group_code").distinct()
    if groups is None:
        groups = star.product.where("group_code IS NOT NULL").select("group_code", "group_name").distinct()
    views = {
        "order_line": star.order_line,
        "sales_order": star.sales_order,
        "customer": star.customer,
        "province": star.province,
        "product": star.product,
        "product_line": lines,
        "product_group": groups,
        "fact_sales": fact,
        "v_customer_activity": customer_activity(fact, as_of),
        "v_monthly_by_group": monthly_by_group(fact),
    }
    if log is not None:
        views |= {"email_log": log, "v_email_processing_kpi": email_kpi(log)}
    for name, df in views.items():
        documented(df, {**COLUMN_NOTES, **(notes or {})}).createOrReplaceTempView(name)
    return list(views)


def schema_notes(spark: SparkSession, names: list[str]) -> DataFrame:
    """What an analyst reads first: ``(view, view_note, column, type, note)`` of the registered views."""
    rows = [
        (name, VIEW_NOTES.get(name), c.name, c.dataType, c.description)
        for name in names for c in spark.catalog.listColumns(name)
    ]
    return spark.createDataFrame(rows, "view string, view_note string, column string, type string, note string")


def is_select(sql: str) -> bool:
    """Whether a text starts with SELECT; everything else, WITH included, is refused."""
    return re.match(r"\s*SELECT\b", sql, re.IGNORECASE) is not None


def run_select(spark: SparkSession, sql: str, limit: int = ROW_LIMIT) -> DataFrame | str:
    """The first rows of a read-only query, or the message to show instead."""
    if not is_select(sql):
        return ONLY_SELECT
    try:
        return spark.sql(sql.strip()).limit(limit)
    except AnalysisException as e:
        return f"{FAILED}{e}"


def answer(spark: SparkSession, sql: str, limit: int = ROW_LIMIT) -> DataFrame | str:
    """Like ``run_select``, with a message for an empty result."""
    result = run_select(spark, sql, limit)
    if isinstance(result, str):
        return result
    return NO_ROWS if result.isEmpty() else result
