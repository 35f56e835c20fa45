"""Rules on extracted records.

A record is one row ``(log_id, header, lines, footer_total)``; rules on its lines run inside the row, so
validation needs no shuffle except for the look-ups against loaded orders and known products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_UNIT, ORDER_NUMBER, let

TOLERANCE = 2
# Fixed value: how a product seen for the first time is named until somebody names it.
PLACEHOLDER_NAME = "San pham moi"

_SO = "header.so_number"


def _no_errors() -> Column:
    return F.array().cast("array<string>")


def _error(condition: Column, text) -> Column:
    message = F.lit(text) if isinstance(text, str) else text
    return F.when(condition, F.array(message)).otherwise(_no_errors())


def rule_v1(strict: bool = False, pattern: str = ORDER_NUMBER) -> Column:
    """Order number present; ``strict`` also tests its form."""
    so = F.col(_SO)
    missing = F.coalesce(so == "", F.lit(True))
    bad_form = ~F.coalesce(so, F.lit("")).rlike(f"^{pattern}$") if strict else F.lit(False)
    return F.when(missing, _error(missing, "V1_NO_SO_NUMBER")).otherwise(_error(bad_form, "V1_BAD_SO_NUMBER"))


def rule_v2(window: tuple[str, str] | None = None) -> Column:
    """Order date present; with a window also inside it."""
    date = F.col("header.order_date")
    missing = _error(date.isNull(), "V2_NO_ORDER_DATE")
    if window is None:
        return missing
    first, last = (F.lit(d).cast("date") for d in window)
    return F.when(date.isNull(), missing).otherwise(_error(~date.between(first, last), "V2_DATE_OUTSIDE"))


def rule_nonempty() -> Column:
    return _error(F.coalesce(F.size("lines"), F.lit(0)) <= 0, "LINES_EMPTY")


def _number(line: Column, field: str) -> Column:
    return F.coalesce(line[field], F.lit(0))


def line_v4(line: Column, i: Column) -> Column:
    at = F.concat(F.lit(":line"), (i + 1).cast("string"))
    return F.concat(
        _error(_number(line, "quantity") <= 0, F.concat(F.lit("V4_QTY_NONPOSITIVE"), at)),
        _error(_number(line, "unit_price") < 0, F.concat(F.lit("V4_PRICE_NEGATIVE"), at)),
    )


def line_v5(line: Column, i: Column, tol: int = TOLERANCE) -> Column:
    """Line total against half-even rounded quantity × price."""
    expected = F.bround(_number(line, "quantity").cast("double") * _number(line, "unit_price"), 0).cast("bigint")
    total = _number(line, "line_total").cast("bigint")

    def message(e: Column) -> Column:
        text = F.concat(
            F.lit("V5_LINE_TOTAL_MISMATCH:line"), (i + 1).cast("string"),
            F.lit(":got="), total.cast("string"), F.lit(",expected="), e.cast("string"),
        )
        return _error(F.abs(total - e) > tol, text)

    return let(expected, message)


def over_lines(rule) -> Column:
    """Errors of a line rule over all lines, in line order."""
    return F.flatten(F.transform(F.coalesce("lines", F.array()), rule))


def rule_v4() -> Column:
    return over_lines(line_v4)


def rule_v5(tol: int = TOLERANCE) -> Column:
    return over_lines(lambda line, i: line_v5(line, i, tol))


def rule_v6(tol: int = TOLERANCE) -> Column:
    """Warning only: footer against the sum of the lines; silent without a footer."""
    total = F.aggregate(
        F.coalesce("lines", F.array()), F.lit(0).cast("bigint"), lambda acc, x: acc + _number(x, "line_total").cast("bigint")
    )
    off = F.abs(total - F.col("footer_total")) > tol
    text = F.concat(
        F.lit("V6_FOOTER_MISMATCH:sum="), total.cast("string"), F.lit(",footer="), F.col("footer_total").cast("string")
    )
    return F.when(F.coalesce(off, F.lit(False)) & (F.size("lines") > 0), text)


def mark_duplicates(records: DataFrame, loaded: DataFrame, in_batch: bool = False) -> DataFrame:
    """Add ``v7``: the order is loaded already or, with ``in_batch``, was seen earlier in the batch.

    The first mail per order comes from a map-side combined ``min`` joined back on the order number, so a
    number shared by many mails is split by the skew-join rule instead of landing in one window.
    """
    known = loaded.select(F.col("so_number").alias("_known")).where("_known IS NOT NULL").distinct()
    out = records.withColumn("_so", F.col(_SO)).join(known, F.col("_so") == F.col("_known"), "left")
    error = F.when(
        F.col("_known").isNotNull(), F.array(F.concat(F.lit("V7_DUPLICATE_SO:"), "_so"))
    )
    if in_batch:
        first = (
            records.select(F.col(_SO).alias("_k"), "log_id")
            .where("_k IS NOT NULL")
            .groupBy("_k")
            .agg(F.min("log_id").alias("_first"))
        )
        out = out.join(first, F.col("_so") == F.col("_k"), "left")
        later = F.col("log_id") > F.col("_first")
        error = error.when(later, F.array(F.concat(F.lit("V7_DUPLICATE_IN_BATCH:"), "_so")))
    return out.withColumn("v7", F.coalesce(error, _no_errors())).drop("_so", "_known", "_k", "_first")


def validate(
    records: DataFrame,
    loaded: DataFrame,
    *,
    tol: int = TOLERANCE,
    strict: bool = False,
    pattern: str = ORDER_NUMBER,
    window: tuple[str, str] | None = None,
    in_batch: bool = False,
) -> DataFrame:
    """Add ``errors`` (array, rule order then line order), ``error_message`` and ``warning``."""

    def of_line(line: Column, i: Column) -> Column:
        return F.concat(line_v4(line, i), line_v5(line, i, tol))

    errors = F.concat(rule_v1(strict, pattern), F.col("v7"), rule_v2(window), rule_nonempty(), over_lines(of_line))
    return (
        mark_duplicates(records, loaded, in_batch)
        .withColumn("errors", errors)
        .withColumn("warning", rule_v6(tol))
        .withColumn("error_message", F.nullif(F.array_join("errors", "; "), F.lit("")))
        .drop("v7")
    )


def discover_products(codes: DataFrame, product: DataFrame, label: str = "") -> DataFrame:
    """Rows to add to the product table for codes it does not know; a NULL code is not one."""
    new = codes.select("product_code").dropna().distinct().join(product.select("product_code"), "product_code", "left_anti")
    name = F.concat(F.lit(f"{PLACEHOLDER_NAME}{' ' + label if label else ''} - "), F.col("product_code").cast("string"))
    return new.select(
        "product_code",
        name.alias("product_name"),
        F.lit(DEFAULT_UNIT).alias("unit"),
        F.lit(True).alias("is_active"),
    )


def valid(validated: DataFrame) -> DataFrame:
    return validated.where("error_message IS NULL")


def rejected(validated: DataFrame) -> DataFrame:
    """Quarantine rows."""
    columns = ["log_id", F.col(_SO).alias("so_number"), F.col("error_message").alias("errors")]
    if "pdf_path" in validated.columns:
        columns.append("pdf_path")
    return validated.where("error_message IS NOT NULL").select(*columns)


def outcome_counts(validated: DataFrame) -> DataFrame:
    outcome = F.when(F.col("error_message").isNull(), "VALIDATED").otherwise("FAILED").alias("outcome")
    return validated.groupBy(outcome).agg(F.count("*").alias("n"), F.count("warning").alias("warnings"))
