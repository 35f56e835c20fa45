"""Extraction plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import extraction as ex
from .documents import NUMBER_PATTERN, OWN_TAX_CODE, WITH_SLIP, rendered, slips
from .registry import Registry
from .star import Warehouse

reg = Registry()


def over_text(w: Warehouse, name: str, expr):
    return rendered(w).select("doc_id", expr.alias(name))


@reg.plan(
    "ext_01_nfc",
    "SELECT doc_id, md5(nfc_normalize(concat(text, 'e', chr(769)))) AS digest FROM documents",
)
def _(w: Warehouse):
    open_accent = F.concat("text", F.lit("e\u0301"))
    return w.table("documents").select("doc_id", F.md5(tx.nfc(open_accent)).alias("digest"))


@reg.plan("ext_02_order_number", f"{WITH_SLIP} SELECT doc_id, so_text AS so_number FROM slip")
def _(w: Warehouse):
    lower = F.concat(F.lit("Dat hang "), F.lower("so_text"), F.lit(" - dai ly"))
    subject = F.when(F.col("as_text"), F.lit("Don hang moi")).otherwise(lower)
    stem = F.concat(F.lit("mail_"), "so_text")
    return slips(w).select("doc_id", tx.order_number(subject, stem, NUMBER_PATTERN).alias("so_number"))


@reg.plan(
    "ext_03_dealer_name",
    "SELECT c_custkey AS customer_code, CASE WHEN c_custkey % 7 <> 3 THEN c_name END AS dealer FROM customer",
)
def _(w: Warehouse):
    body = F.when(F.col("c_custkey") % 7 == 3, F.lit("Kính gửi,\nKhách hàng: abc")).otherwise(
        F.concat(F.lit("Kính gửi,\nĐẠI LÝ : Tên : "), "c_name", F.lit(".;\r\nTrân trọng"))
    )
    return w.table("customer").select(F.col("c_custkey").alias("customer_code"), tx.dealer_name(body).alias("dealer"))


@reg.plan("ext_04_doc_order_number", f"{WITH_SLIP} SELECT doc_id, so_text AS so_number FROM slip")
def _(w: Warehouse):
    return over_text(w, "so_number", tx.doc_order_number(F.col("text"), NUMBER_PATTERN))


@reg.plan("ext_05_doc_date", f"{WITH_SLIP} SELECT doc_id, strftime(order_date, '%Y-%m-%d') AS order_date FROM slip")
def _(w: Warehouse):
    return over_text(w, "order_date", tx.doc_date(F.col("text")))


@reg.plan("ext_06_buyer_tax", f"{WITH_SLIP} SELECT doc_id, tax_code FROM slip")
def _(w: Warehouse):
    return over_text(w, "tax_code", tx.buyer_tax(F.col("text"), OWN_TAX_CODE))


@reg.plan("ext_07_doc_buyer", f"{WITH_SLIP} SELECT doc_id, buyer FROM slip")
def _(w: Warehouse):
    return over_text(w, "buyer", tx.doc_buyer(F.col("text")))


@reg.plan("ext_08_doc_address", f"{WITH_SLIP} SELECT doc_id, address FROM slip")
def _(w: Warehouse):
    return over_text(w, "address", tx.doc_address(F.col("text")))


@reg.plan("ext_09_footer_total", f"{WITH_SLIP} SELECT doc_id, footer AS footer_total FROM slip")
def _(w: Warehouse):
    return over_text(w, "footer_total", tx.footer_total(F.col("text")))


CODES = """CASE p_partkey % 5 WHEN 0 THEN lpad(p_partkey::VARCHAR, 12, '0') WHEN 1 THEN concat('TP', p_partkey, '.01-2')
 WHEN 2 THEN concat('156.01.12.', lpad(p_partkey::VARCHAR, 4, '0')) WHEN 3 THEN p_partkey::VARCHAR
 ELSE concat('tp', p_partkey, '.1') END"""


@reg.plan(
    "ext_10_is_product_code",
    f"SELECT p_partkey AS product, {CODES} AS code, p_partkey % 5 < 3 AS is_code FROM part",
)
def _(w: Warehouse):
    part = w.table("part").selectExpr("p_partkey AS product", CODES.replace("::VARCHAR", "::STRING") + " AS code")
    return part.withColumn("is_code", tx.is_product_code(F.col("code")))


LINES_SQL = """SELECT doc_id, 1::BIGINT AS line_no, '1' AS stt, code1 AS product_code, name1 AS product_name, 'Chiếc' AS unit,
 qty1::DOUBLE AS quantity, price1 AS unit_price, total1 AS line_total FROM slip WHERE {where}
 UNION ALL SELECT doc_id, 2, '2', code2, 'phu kien', 'Bộ', qty2::DOUBLE, price2, total2 FROM slip WHERE {where}"""


def lines_out(frame):
    return ex.explode_lines(frame, "doc_id")


@reg.plan(
    "ext_11_cells_to_line",
    f"""{WITH_SLIP} SELECT doc_id, code1 AS product_code, name1 AS product_name, 'cái' AS unit, qty1 + 0.5::DOUBLE AS quantity,
 price1 AS unit_price, total1 AS line_total FROM slip WHERE NOT as_text""",
)
def _(w: Warehouse):
    # a leading empty cell, the unit before the name, a decimal comma; text documents get too few numbers
    cells = F.array(
        F.lit(None).cast("string"), F.lit("x"), F.concat(F.lit(" "), "code1"), F.lit("cái"), "name1",
        F.concat(F.col("qty1").cast("string"), F.lit(",5")), F.when(~F.col("as_text"), F.col("price1").cast("string")),
        F.col("total1").cast("string"),
    )
    line = slips(w).select("doc_id", ex.cells_to_line(cells).alias("line"))
    return line.where("line IS NOT NULL").select("doc_id", "line.*").drop("stt")


@reg.plan(
    "ext_12_table_rows",
    f"""{WITH_SLIP} SELECT doc_id, CASE WHEN as_text THEN 0 ELSE 4 END AS data_rows,
 CASE WHEN as_text THEN '' ELSE concat('1', code1, '|3', code1, '|2', code2, '|3', code1) END AS rows FROM slip""",
)
def _(w: Warehouse):
    rows = ex.table_rows(F.col("tables"))
    shown = F.array_join(F.transform(rows, lambda r: F.concat(r[0], r[1])), "|")
    return rendered(w).select("doc_id", F.size(rows).alias("data_rows"), shown.alias("rows"))


@reg.plan("ext_13_text_to_lines", f"{WITH_SLIP} {LINES_SQL.format(where='true')}")
def _(w: Warehouse):
    return lines_out(rendered(w).select("doc_id", ex.text_to_lines(F.col("text")).alias("lines")))


# Each order total printed in one of seven ways; the expected value follows from the way, not from parsing.
WAYS_SQL = """WITH v AS (SELECT o_orderkey AS k, o_orderkey % 7 AS way, CAST(floor(o_totalprice) AS BIGINT) AS n FROM orders)"""


def money_texts(w: Warehouse):
    v = w.table("orders").selectExpr("o_orderkey AS k", "o_orderkey % 7 AS way", "CAST(floor(o_totalprice) AS BIGINT) AS n")
    commas = F.format_number("n", 0)
    way = F.col("way")
    text = (
        F.when(way == 0, grouped(commas)).when(way == 1, commas)
        .when(way == 2, F.concat(grouped(commas), F.lit(",50")))
        .when(way == 3, F.concat(F.lit(" "), F.col("n").cast("string"), F.lit(" ")))
        .when(way == 4, F.lit("abc")).when(way == 5, F.lit(""))
    )
    return v.withColumn("text", text)


def grouped(commas):
    return F.translate(commas, ",", ".")


@reg.plan(
    "ext_14_to_int",
    f"{WAYS_SQL} SELECT k, CASE WHEN way IN (0, 1, 3) THEN n WHEN way = 2 THEN round_even(n + 0.5::DOUBLE, 0)::BIGINT"
    " ELSE 0 END AS amount FROM v",
)
def _(w: Warehouse):
    return money_texts(w).select("k", tx.to_int(F.col("text")).alias("amount"))


@reg.plan(
    "ext_14_to_int_locale",
    f"{WAYS_SQL} SELECT k, CASE WHEN way IN (0, 1, 3) THEN n WHEN way = 2 THEN round_even(n + 0.5::DOUBLE, 0)::BIGINT"
    " ELSE 0 END AS amount FROM v",
)
def _(w: Warehouse):
    return money_texts(w).select("k", tx.to_int(F.col("text"), "locale").alias("amount"))


@reg.plan(
    "ext_15_parse_qty",
    f"{WITH_SLIP} SELECT doc_id, CASE WHEN as_text THEN qty1 + 0.5::DOUBLE ELSE qty1::DOUBLE END AS quantity FROM slip",
)
def _(w: Warehouse):
    q = F.col("qty1").cast("string")
    shown = F.when(F.col("as_text"), F.concat(F.lit(" "), q, F.lit(",5"))).otherwise(F.concat(q, F.lit(".0")))
    return slips(w).select("doc_id", tx.parse_qty(shown).alias("quantity"))


@reg.plan(
    "ext_16_strict_values",
    f"""{WITH_SLIP} SELECT doc_id, total1 * 100 AS amount, qty1 + 0.5::DOUBLE AS quantity, true AS numeric_cell,
 qty1 <= 48 AS qty_ok FROM slip""",
)
def _(w: Warehouse):
    grouped_total = F.translate(F.format_number("total1", 0), ",", ".")
    money = F.concat(grouped_total, F.lit(",00"))
    qty = F.concat(F.col("qty1").cast("string"), F.lit(",5"))
    value = tx.strict_qty(qty)
    return slips(w).select(
        "doc_id",
        tx.strict_int(money).alias("amount"),
        value.alias("quantity"),
        tx.strict_numeric_cell(grouped_total).alias("numeric_cell"),
        tx.strict_qty_in_bounds(value, 49).alias("qty_ok"),
    )


@reg.plan(
    "ext_17_body_triple",
    f"{WITH_SLIP} SELECT doc_id, CASE WHEN as_text THEN tax_code END AS tax_code, footer AS amount FROM slip",
)
def _(w: Warehouse):
    # a spaced label is accepted, another case is not
    label = F.when(F.col("as_text"), "MST : ").otherwise("mst: ")
    body = F.concat(F.lit("Don "), "so_text", F.lit(", "), label, "tax_code", F.lit(", trị giá "),
                    F.translate(F.format_number("footer", 0), ",", "."), F.lit(" đ"))
    return slips(w).select("doc_id", tx.body_triple(body).alias("t")).select("doc_id", "t.tax_code", "t.amount")


def records(w: Warehouse):
    return ex.extract_orders(rendered(w), OWN_TAX_CODE, NUMBER_PATTERN)


@reg.plan(
    "ext_18_extract_headers",
    f"""{WITH_SLIP} SELECT doc_id, so_text AS so_number, strftime(order_date, '%Y-%m-%d') AS order_date,
 buyer AS customer_name, tax_code, address, footer AS footer_total, 2 AS n_lines, NULL::VARCHAR AS error FROM slip""",
)
def _(w: Warehouse):
    return records(w).select("doc_id", "header.*", "footer_total", F.size("lines").alias("n_lines"), "error")


@reg.plan("ext_18_extract_lines", f"{WITH_SLIP} {LINES_SQL.format(where='true')}")
def _(w: Warehouse):
    return lines_out(records(w))


@reg.plan(
    "ext_18_extract_noise",
    """SELECT 'documents' AS source, 'NO_LINES_PARSED' AS error, count(*) AS n, 0 AS numbers FROM documents UNION ALL
 SELECT 'pages', 'NO_LINES_PARSED', count(*), 0 FROM pages UNION ALL
 SELECT 'conversations', 'NO_LINES_PARSED', count(*), 0 FROM conversations""",
)
def _(w: Warehouse):
    def texts(table: str, column: str):
        return w.table(table).select(
            F.lit(table).alias("source"),
            F.col(column).alias("text"),
            F.lit(None).cast("array<array<array<string>>>").alias("tables"),
            F.lit(None).cast("string").alias("parse_error"),
        )

    noise = texts("documents", "text").union(texts("pages", "html")).union(texts("conversations", "text"))
    return (
        ex.extract_orders(noise, OWN_TAX_CODE)
        .groupBy("source", "error")
        .agg(F.count("*").alias("n"), F.count("header.so_number").alias("numbers"))
    )


@reg.plan(
    "ext_19_match_document",
    """SELECT o_orderkey AS log_id, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey END AS doc_id,
 CASE WHEN o_orderkey % 4 >= 2 THEN 'PDF file not found in staging' END AS error FROM orders""",
)
def _(w: Warehouse):
    from .documents import HEAD

    heads = w.table("orders").selectExpr("o_orderkey AS log_id", f"{HEAD['so_text']} AS so_text")
    kind = F.col("log_id") % 4
    named = F.concat(F.translate("so_text", ".", "_"), F.lit(".pdf"))
    own = F.concat(F.lit("attachment-"), "log_id", F.lit(".pdf"))
    # staged under the order number (0), under the attachment name (1), or not at all (2, 3)
    docs = heads.where(kind < 2).select(
        F.when(kind == 0, named).otherwise(own).alias("file_name"), F.col("log_id").alias("doc_id")
    )
    # every eighth was staged before under the same name
    docs = docs.unionByName(docs.where("doc_id % 8 < 2").withColumn("doc_id", -F.col("doc_id")))
    log = heads.select("log_id", F.when(kind != 3, F.col("so_text")).alias("so_number"), own.alias("attachment_name"))
    return ex.match_document(log, docs).select("log_id", "doc_id", "error")
