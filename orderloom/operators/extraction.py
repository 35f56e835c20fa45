"""From order documents to structured records, one narrow pass per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

LINE_TYPE = (
    "struct<stt:string,product_code:string,product_name:string,unit:string,"
    "quantity:decimal(18,3),unit_price:bigint,line_total:bigint>"
)


def cells_to_line(cells: Column) -> Column:
    """One table row as a line item; NULL without a product code or with fewer than three numbers.

    The last three numeric cells right of the code are quantity, price and total; the cells in between
    hold the name, from which the unit is taken out.
    """
    trimmed = F.transform(cells, lambda c: tx.strip(F.coalesce(c, F.lit(""))))
    return tx.let(trimmed, lambda t: tx.let(_marked(t), lambda m: _line_from(t, m)))


def _marked(cells: Column) -> Column:
    """Per cell, 1-based: its position, whether it is a code, whether it holds a number."""
    return F.transform(
        cells,
        lambda c, i: F.struct(
            (i + 1).alias("at"),
            c.rlike(tx.PRODUCT_CODE).alias("code"),
            c.rlike(r"[\d.,]").alias("number"),
        ),
    )


def _line_from(cells: Column, marks: Column) -> Column:
    first_code = F.array_min(F.transform(F.filter(marks, lambda m: m["code"]), lambda m: m["at"]))

    def with_code(code_at: Column) -> Column:
        right = F.filter(marks, lambda m: (m["at"] > code_at) & m["number"] & ~m["code"])
        return tx.let(
            F.transform(right, lambda m: m["at"]),
            lambda numeric: F.when(F.size(numeric) >= 3, _fill(cells, code_at, numeric)),
        )

    return tx.let(first_code, lambda code_at: F.when(code_at.isNotNull(), with_code(code_at)))


def _fill(cells: Column, code_at: Column, numeric: Column) -> Column:
    qty_at = F.try_element_at(numeric, F.lit(-3))
    between = F.slice(cells, code_at + 1, qty_at - code_at - 1)
    is_unit = lambda c: F.lower(c).isin(tx.UNITS)
    return tx.let(
        between,
        lambda b: F.struct(
            F.when(cells[0].rlike(r"^\d+$"), cells[0]).alias("stt"),
            F.try_element_at(cells, code_at).alias("product_code"),
            tx.strip(F.array_join(F.filter(b, lambda c: ~is_unit(c)), " ")).alias("product_name"),
            F.coalesce(F.try_element_at(F.filter(b, is_unit), F.lit(-1)), F.lit(tx.DEFAULT_UNIT)).alias("unit"),
            tx.parse_qty(F.try_element_at(cells, qty_at)).alias("quantity"),
            tx.to_int(F.try_element_at(cells, F.try_element_at(numeric, F.lit(-2)))).alias("unit_price"),
            tx.to_int(F.try_element_at(cells, F.try_element_at(numeric, F.lit(-1)))).alias("line_total"),
        ),
    )


def table_rows(tables: Column) -> Column:
    """Data rows of all tables: tables under two rows are ignored, a header row is skipped."""

    def data_rows(table: Column) -> Column:
        first = F.try_element_at(table, F.lit(1))
        names = lambda c: F.exists(
            F.array(*map(F.lit, tx.HEADER_WORDS)), lambda w: F.contains(F.lower(c), w)
        )
        has_header = F.coalesce(F.exists(first, lambda c: F.coalesce(names(c), F.lit(False))), F.lit(False))
        rows = F.when(has_header, F.slice(table, F.lit(2), F.size(table))).otherwise(table)
        return F.when(F.size(table) >= 2, rows).otherwise(F.slice(table, 1, 0))

    return F.flatten(F.transform(F.coalesce(tables, F.array()), data_rows))


_FIELD = "\x1f"  # unit separator: cannot occur inside a printed field


def text_to_lines(text: Column) -> Column:
    """Line items printed as plain text rows."""
    one_break = F.translate(text, "\r\v\f", "\n\n\n")
    rows = F.filter(F.split(one_break, "\n"), lambda r: r.rlike(tx.TEXT_LINE))
    marked = _FIELD.join(f"${i}" for i in range(1, 8))
    return F.transform(
        rows,
        lambda r: tx.let(
            F.split(F.regexp_replace(r, tx.TEXT_LINE, marked), _FIELD),
            lambda part: F.struct(
                part[0].alias("stt"),
                part[1].alias("product_code"),
                tx.strip(part[2]).alias("product_name"),
                part[3].alias("unit"),
                tx.parse_qty(part[4]).alias("quantity"),
                tx.to_int(part[5]).alias("unit_price"),
                tx.to_int(part[6]).alias("line_total"),
            ),
        ),
    )


def table_lines(tables: Column) -> Column:
    return F.filter(F.transform(table_rows(tables), cells_to_line), lambda x: x.isNotNull())


def header(text: Column, own: str, pattern: str = tx.ORDER_NUMBER) -> Column:
    return F.struct(
        tx.doc_order_number(text, pattern).alias("so_number"),
        tx.doc_date(text).alias("order_date"),
        tx.doc_buyer(text).alias("customer_name"),
        tx.buyer_tax(text, own).alias("tax_code"),
        tx.doc_address(text).alias("address"),
    )


def extract_orders(docs: DataFrame, own: str, pattern: str = tx.ORDER_NUMBER) -> DataFrame:
    """Documents ``(doc_id, text, tables, parse_error)`` to records with header, lines, total, error.

    Rows never fail: a reader error or an empty line list is stated in ``error``. Lines come from the
    tables, and from the text only when no table row qualifies.
    """
    text = F.col("nfc_text")
    out = (
        docs.withColumn("nfc_text", tx.nfc(F.col("text")))
        .withColumn("from_tables", table_lines(F.col("tables")))
        .withColumn(
            "lines",
            F.when(F.size("from_tables") > 0, F.col("from_tables")).otherwise(text_to_lines(text)),
        )
    )
    failed = F.col("parse_error").isNotNull()
    error = F.when(failed, F.concat(F.lit("PDF_PARSE_ERROR: "), "parse_error")).when(
        F.coalesce(F.size("lines"), F.lit(0)) <= 0, "NO_LINES_PARSED"
    )
    return out.select(
        *[c for c in docs.columns if c not in ("text", "tables", "parse_error")],
        F.when(~failed, header(text, own, pattern)).alias("header"),
        F.when(~failed, F.col("lines")).alias("lines"),
        F.when(~failed, tx.footer_total(text)).alias("footer_total"),
        error.alias("error"),
    )


def explode_lines(records: DataFrame, key: str) -> DataFrame:
    """Record lines as rows with their 1-based position."""
    # for a plain column the optimizer filters on its size below the parsing, which then runs twice for every row
    lines = F.transform("lines", lambda x: x)
    return records.select(key, F.posexplode(lines).alias("pos", "line")).select(
        key, (F.col("pos") + 1).alias("line_no"), "line.*"
    )


def match_document(log: DataFrame, docs: DataFrame) -> DataFrame:
    """The staged document of each mail: by order number, else by attachment name.

    A later document replaces an earlier one of the same file name, so a mail has one row.
    """
    docs = docs.groupBy("file_name").agg(F.max("doc_id").alias("doc_id"))
    by_number = F.concat(F.translate("so_number", ".", "_"), F.lit(".pdf"))
    first = docs.select(F.col("file_name").alias("_n"), F.col("doc_id").alias("_d1"))
    second = docs.select(F.col("file_name").alias("_a"), F.col("doc_id").alias("_d2"))
    joined = (
        log.withColumn("_by_number", by_number)
        .join(first, F.col("_by_number") == F.col("_n"), "left")
        .join(second, F.col("attachment_name") == F.col("_a"), "left")
        .withColumn("doc_id", F.coalesce("_d1", "_d2"))
    )
    return joined.withColumn(
        "error", F.when(F.col("doc_id").isNull(), "PDF file not found in staging")
    ).drop("_by_number", "_n", "_a", "_d1", "_d2")
