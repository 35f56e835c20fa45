"""Order documents rendered from the test tables, one per order line row.

Each document carries two lines, so that rendering needs no grouping and every document stays small
whatever the key distribution of the source. What is parsed back must equal the source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .star import CENTS, LINE_KEY, QTY_INT, Warehouse

OWN_TAX_CODE = "0100000001"
# the fixed pattern, opened at the front so that more than 10^6 orders stay distinct
NUMBER_PATTERN = r"BH\d{2,}\.\d{4}"

# Readable by both engines: the values a document must give back.
PRICE = f"CAST(floor({CENTS} / CAST({QTY_INT} AS DOUBLE)) AS BIGINT)"
SLIP = {
    "doc_id": LINE_KEY,
    "order_key": "l_orderkey",
    "part_key": "l_partkey",
    "code1": "lpad(CAST(l_partkey AS STRING), 12, '0')",
    "name1": "concat('xe dap ', l_returnflag, ' ', l_linestatus)",
    "qty1": QTY_INT,
    "price1": PRICE,
    "total1": f"{QTY_INT} * {PRICE}",
    "code2": "concat('9', lpad(CAST(l_suppkey AS STRING), 11, '0'))",
    "qty2": "CAST(l_linenumber AS BIGINT)",
    "price2": "CAST(125000 AS BIGINT)",
    "total2": "CAST(l_linenumber AS BIGINT) * 125000",
    "as_text": "l_orderkey % 3 = 0",
}
HEAD = {
    "order_key": "o_orderkey",
    "so_text": "printf('BH%02d.%04d', CAST(floor(o_orderkey / CAST(10000 AS DOUBLE)) AS BIGINT), o_orderkey % 10000)",
    "order_date": "CAST(o_orderdate AS DATE)",
    "tax_code": "lpad(CAST(o_custkey AS STRING), 10, '0')",
    "buyer": "concat('Cua hang ', CAST(o_custkey AS STRING))",
    "address": "concat('So ', CAST(o_custkey AS STRING), ' duong Le Loi')",
}


def _sql(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"


SLIP_SQL = (
    f"slip0 AS ({_sql(SLIP, 'lineitem')}), head AS ({_sql(HEAD, 'orders')}), slip AS (SELECT slip0.*, "
    "head.* EXCLUDE (order_key), total1 + total2 AS footer FROM slip0 JOIN head USING (order_key))"
)
WITH_SLIP = f"WITH {SLIP_SQL}"


def slips(w: Warehouse, tasks: int | None = None) -> DataFrame:
    """The values of every document, before rendering.

    Rendering and parsing cost far more than reading: lines are dealt out by order over ``tasks`` tasks, the
    session's number of shuffle partitions unless given, more where the base files are large, however few files
    or row groups hold them. A number that is asked for is not merged away for small tables.
    """
    tasks = tasks or w.partitions
    lines = w.table("lineitem").selectExpr(*[f"{e} AS {n}" for n, e in SLIP.items()])
    heads = w.table("orders").selectExpr(*[f"{e} AS {n}" for n, e in HEAD.items()])
    return lines.repartition(tasks, "order_key").join(heads, "order_key").withColumn("footer", F.col("total1") + F.col("total2"))


def grouped_digits(column: str):
    return F.translate(F.format_number(column, 0), ",", ".")


def rendered(w: Warehouse) -> DataFrame:
    """``(doc_id, text, tables, parse_error)``; one third of the documents has no usable table."""
    return render(slips(w))


def render(values: DataFrame, *keep: str) -> DataFrame:
    """The documents of ``slips``, with the columns ``keep`` in front."""
    row1 = [F.lit("1"), F.col("code1"), F.col("name1"), F.lit("Chiếc"), F.col("qty1").cast("string"),
            grouped_digits("price1"), grouped_digits("total1")]
    row2 = [F.lit("2"), F.col("code2"), F.lit("phu kien"), F.lit("Bộ"), F.col("qty2").cast("string"),
            grouped_digits("price2"), grouped_digits("total2")]
    titles = ["STT", "Mã hàng", "Tên hàng", "ĐVT", "SL", "Đơn giá", "Thành tiền"]
    head = F.array(*map(F.lit, titles))
    short = F.array(F.lit("3"), F.col("code1"), F.lit("hang tang"), F.lit("1"))
    note = F.array(F.array(F.lit("ghi chu"), F.lit("1000000000000")))
    tables = F.when(
        F.col("as_text"), F.array(note)
    ).otherwise(F.array(note, F.array(head, F.array(*row1), short), F.array(F.array(*row2), short)))
    day = F.concat_ws("/", F.dayofmonth("order_date"), F.month("order_date"), F.year("order_date"))
    text = F.concat_ws(
        "\n",
        F.lit(f"DON DAT HANG  MST: {OWN_TAX_CODE}"),
        F.concat(F.lit("So don: "), "so_text"),
        F.concat(F.lit("Ngày: "), day),
        F.concat(F.lit("Đại lý: "), "buyer", F.lit("   MST: "), "tax_code"),
        F.concat(F.lit("Địa chỉ: "), "address"),
        F.array_join(head, " "),
        F.array_join(F.array(*row1), " "),
        F.array_join(F.array(*row2), "  "),
        F.concat(F.lit("Tổng giá trị đơn hàng: "), grouped_digits("footer")),
    )
    return values.select(
        *keep, "doc_id", text.alias("text"), tables.alias("tables"), F.lit(None).cast("string").alias("parse_error")
    )
