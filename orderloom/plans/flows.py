"""Source, sink, stream and ad-hoc plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import adhoc
from ..operators import extraction as ex
from ..session import cut, settings
from ..sources import mail as ml
from ..sources import records as rc
from ..sources import warehouse as wh
from ..streaming import intake as st
from .documents import HEAD, NUMBER_PATTERN, OWN_TAX_CODE, WITH_SLIP, render, rendered, slips
from .fact_overview import ACTIVITY_SQL, FACT_OUT, KPI_LOG
from .intake import LINES_SQL
from .registry import Registry
from .star import AS_OF, EMAIL_LOG, FACT_SQL, ORDER_LINE, WITH_FACT, WITH_LOG, Warehouse, run_folder, select_list, sql_select

reg = Registry()


# ------------------------------------------------------------------------------------------- sources


# One mail per order, readable by both engines; every seventh has no attachment.
_CRLF = "chr(13), chr(10)"
_LINES = [
    "'Message-ID: <', CAST(order_key AS STRING), '@mail>'", "'From: Dai ly <d', tax_code, '@example.com>'",
    "'Subject: Dat hang ', so_text", "'MIME-Version: 1.0'", "'Content-Type: multipart/mixed; boundary=b1'", "''",
    "'--b1'", "'Content-Type: text/plain; charset=utf-8'", "'Content-Transfer-Encoding: 8bit'", "''",
    "'Khách hàng: ', buyer", "'--b1'",
]
_ATTACHED = [
    "'Content-Type: application/pdf; name=don.pdf'", "'Content-Transfer-Encoding: base64'", "''",
    "base64(CAST(so_text AS BINARY))", "'--b1--'",
]
ORDER_MAIL = {
    "order_key": "order_key",
    "name": "concat('mail_', CAST(order_key AS STRING))",
    "text": f"concat({', '.join(f'{x}, {_CRLF}' for x in _LINES)}, CASE WHEN order_key % 7 = 0 THEN '--b1--' ELSE"
    f" concat({f', {_CRLF}, '.join(_ATTACHED)}) END)",
}
ORDER_MAIL_SQL = f"WITH head AS ({sql_select(HEAD, 'orders')}), mail AS ({sql_select(ORDER_MAIL, 'head')})"


def order_mails(w: Warehouse) -> DataFrame:
    return w.view(HEAD, "orders").selectExpr(*select_list(ORDER_MAIL))


@reg.plan(
    "src_01_read_mail",
    f"""{ORDER_MAIL_SQL} SELECT concat(name, '.eml') AS file_name, strlen(text) + 1 AS length,
 md5(concat(text, chr(10))) AS digest FROM mail""",
)
def _(w: Warehouse):
    path = run_folder(w)
    ml.write_mail(order_mails(w), path)
    files = ml.stored_mail(ml.read_mail(w.spark, path, "*.txt", deep=True))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", F.md5("content").alias("digest"))


def mail_files(values: DataFrame) -> DataFrame:
    """A mail per document of ``slips``: some without attachment, without id or with an unreadable date."""
    kind = F.pmod(F.col("order_key"), F.lit(20))
    line = lambda *parts: F.concat(*[F.col(p[1:]) if p.startswith("=") else F.lit(p) for p in parts])
    head = F.concat_ws(
        "\r\n",
        F.when(kind != 3, line("Message-ID: <", "=doc_id", "@mail>")),
        line("From: Dai ly <d", "=tax_code", "@example.com>"),
        F.when(kind == 4, F.lit("Subject: Don hang")).otherwise(line("Subject: Dat hang ", "=so_text")),
        F.when(kind == 5, F.lit("Date: hom nay")).otherwise(
            F.concat(F.lit("Date: "), F.date_format("order_date", "dd MMM yyyy"), F.lit(" 08:30:00 +0700"))
        ),
        F.lit("MIME-Version: 1.0"),
        F.lit('Content-Type: multipart/mixed; boundary="b1"'),
    )
    body = F.concat_ws(
        "\r\n", F.lit("--b1"), F.lit("Content-Type: text/plain; charset=utf-8"), F.lit("Content-Transfer-Encoding: 8bit"),
        F.lit(""), F.concat(F.lit("Khách hàng: "), "buyer"), F.lit(""),
    )
    pdf = F.concat_ws(
        "\r\n", F.lit("--b1"), F.lit('Content-Type: application/pdf; name="don.pdf"'),
        F.lit("Content-Transfer-Encoding: base64"), F.lit('Content-Disposition: attachment; filename="don.pdf"'),
        F.lit(""), F.base64(F.col("so_text").cast("binary")), F.lit(""),
    )
    text = F.concat(head, F.lit("\r\n\r\n"), body, F.when(kind == 6, F.lit("")).otherwise(pdf), F.lit("--b1--\r\n"))
    path = F.concat(F.lit("/mail/"), "so_text", F.lit("_"), "doc_id", F.lit(".eml"))
    return values.select(path.alias("path"), F.encode(text, "utf-8").alias("content"))


MAIL_SQL = """SELECT concat(so_text, '_', doc_id, '.eml') AS file_name,
 CASE WHEN order_key % 20 = 3 THEN concat('<no-id-', so_text, '_', doc_id, '>') ELSE concat('<', doc_id, '@mail>') END AS message_id,
 concat('d', tax_code, '@example.com') AS from_address, so_text AS so_number, buyer AS customer_name_raw,
 CASE WHEN order_key % 20 <> 5 THEN strftime(order_date, '%Y-%m-%d 01:30:00') END AS received_at,
 CASE WHEN order_key % 20 <> 6 THEN 'don.pdf' END AS attachment_name,
 CASE WHEN order_key % 20 <> 6 THEN so_text END AS attached,
 CASE WHEN order_key % 20 = 6 THEN 'NO_PDF_ATTACHMENT' END AS error FROM slip"""


@reg.plan("src_02_ingest_mail", f"{WITH_SLIP} {MAIL_SQL}")
def _(w: Warehouse):
    mails = ml.ingest_mail(mail_files(slips(w)), NUMBER_PATTERN)
    return mails.select(
        "file_name", "message_id", "from_address", "so_number", "customer_name_raw", "received_at", "attachment_name",
        F.decode("attachment", "utf-8").alias("attached"), "error",
    )


def stored_records(w: Warehouse) -> DataFrame:
    path = run_folder(w)
    rc.write_extracted(ex.extract_orders(rendered(w), OWN_TAX_CODE, NUMBER_PATTERN), path)
    return rc.read_extracted(w.spark, path)


@reg.plan("src_03_write_extracted", f"{WITH_SLIP} SELECT count(*) AS records, 2 * count(*) AS lines, 0 AS unreadable FROM slip")
def _(w: Warehouse):
    return stored_records(w).agg(
        F.count("*").alias("records"), F.sum(F.size("lines")).alias("lines"), F.count("_corrupt_record").alias("unreadable")
    )


@reg.plan("src_04_read_extracted", f"{WITH_SLIP} {LINES_SQL.format(where='true')}")
def _(w: Warehouse):
    return ex.explode_lines(stored_records(w), "doc_id")


@reg.plan(
    "src_05_with_payload",
    """SELECT event_id AS log_id, concat('user', user_id) AS sender, json_extract(props, '$.k')::BIGINT AS k,
 json_extract(props, '$.k')::BIGINT AS nested_k FROM events""",
)
def _(w: Warehouse):
    typed = w.table("events").select(
        F.col("event_id").alias("log_id"),
        F.concat(F.lit("user"), "user_id").alias("sender"),
        F.from_json("props", "k bigint").alias("inner"),
    )
    snap = rc.with_payload(typed, ["sender", "inner"]).select("log_id", "extracted_payload")
    nested = F.try_variant_get("extracted_payload", "$.inner.k", "bigint")
    back = rc.from_payload(snap.withColumn("nested_k", nested), "sender string, inner struct<k:bigint>")
    return back.select("log_id", "sender", F.col("inner.k").alias("k"), "nested_k")


TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]


@reg.plan(
    "src_06_load_star",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
)
def _(w: Warehouse):
    tables = wh.load_tables(w.spark, w.folder, TABLES)
    return wh.export_manifest(tables).where("table_name IS NOT NULL")


def exported(w: Warehouse) -> tuple[str, dict[str, DataFrame]]:
    tables = {
        "product": w.product,
        "province": w.province,
        "customer": w.customer,
        "sales_order": w.sales_order,
        "order_line": w.order_line,
        "email_log": w.email_log.withColumn("received_at", F.col("received_at").cast("timestamp")),
        "product_price": w.product.where("false"),
    }
    path = run_folder(w)
    wh.export_csv(tables, path)
    return path, tables


@reg.plan(
    "src_07_export_csv",
    f"""{WITH_LOG} SELECT log_id, message_id, strftime(received_at, '%Y-%m-%d %H:%M:%S') AS received_at, processing_status,
 strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM mail""",
)
def _(w: Warehouse):
    path, tables = exported(w)
    schema = wh.without_zone(tables["email_log"]).schema
    back = wh.read_export(w.spark, path, "email_log", schema)
    return back.select("log_id", "message_id", "received_at", "processing_status", "processed_at")


EXPORT_KEYS = {
    "product": ("product_code", "prod"),
    "customer": ("customer_code", "cust"),
    "sales_order": ("order_id", "so"),
    "order_line": ("line_id", "line"),
}


@reg.plan(
    "src_07_export_all",
    f"WITH {FACT_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n, count(DISTINCT {k}) AS keys, min({k})::VARCHAR AS low, max({k})::VARCHAR AS high FROM {v}"
        for n, (k, v) in EXPORT_KEYS.items()
    ),
)
def _(w: Warehouse):
    path, tables = exported(w)
    out = None
    for name, (key, _view) in EXPORT_KEYS.items():
        back = wh.read_export(w.spark, path, name, wh.without_zone(tables[name]).schema)
        ends = [F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")]
        row = back.agg(F.count("*").alias("n"), F.countDistinct(key).alias("keys"), *ends).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@reg.plan(
    "src_08_export_manifest",
    """WITH c AS (SELECT 'product' AS table_name, count(*) AS n FROM part UNION ALL SELECT 'province', count(*) FROM nation
 UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'sales_order', count(*) FROM orders
 UNION ALL SELECT 'order_line', count(*) FROM lineitem) SELECT table_name, n FROM c UNION ALL SELECT NULL, sum(n)::BIGINT FROM c""",
)
def _(w: Warehouse):
    names = ["product", "province", "customer", "sales_order", "order_line"]
    tables = {n: getattr(w, n) for n in names}
    return wh.export_manifest({**tables, "product_price": w.product.where("false")})


@reg.plan(
    "src_09_read_export",
    f"""WITH {FACT_SQL} SELECT line_id, order_id, so_number, product_code, quantity::DOUBLE AS quantity,
 unit_price::DOUBLE AS unit_price, line_total::DOUBLE AS line_total FROM line""",
)
def _(w: Warehouse):
    path = run_folder(w)
    wh.export_csv({"order_line": w.order_line}, path)
    return wh.read_export(w.spark, path, "order_line", w.order_line.schema)


# ------------------------------------------------------------------------------------------- streams


def event_stream(w: Warehouse) -> DataFrame:
    """The mail log as a stream over its table file."""
    raw = (
        w.spark.readStream.schema(w.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(w.folder)
    )
    return raw.selectExpr(*select_list(EMAIL_LOG)).withColumn("ts", F.col("received_at").cast("timestamp"))


@reg.plan(
    "str_01_mail_stream",
    """SELECT event_id AS log_id, 1::BIGINT AS seen FROM events""",
)
def _(w: Warehouse):
    # two runs over the same folder and checkpoint: the second finds nothing new
    path = run_folder(w)
    for _run in range(2):
        st.to_folder(event_stream(w).select("log_id"), f"{path}/out", f"{path}/checkpoint")
    return w.spark.read.parquet(f"{path}/out").groupBy("log_id").agg(F.count("*").alias("seen"))


@reg.plan(
    "str_01_new_mails",
    """WITH head AS (SELECT * FROM (""" + sql_select(HEAD, "orders") + """))
SELECT concat('mail_', order_key, '.eml') AS file_name, concat('<', order_key, '@mail>') AS message_id,
 concat('d', tax_code, '@example.com') AS from_address, so_text AS so_number, buyer AS customer_name_raw,
 CASE WHEN order_key % 7 <> 0 THEN so_text END AS attached,
 CASE WHEN order_key % 7 = 0 THEN 'NO_PDF_ATTACHMENT' END AS error, 1::BIGINT AS seen FROM head""",
)
def _(w: Warehouse):
    # mails arrive in two lots; the second run of the same checkpoint meets the first lot again
    path = run_folder(w)
    for lot in (0, 1):
        ml.write_mail(order_mails(w).where(F.col("order_key") % 2 == lot), f"{path}/box")
        mails = st.new_stored_mails(w.spark, f"{path}/box", NUMBER_PATTERN, per_batch=10_000)
        st.to_folder(mails.drop("path"), f"{path}/out", f"{path}/checkpoint")
    read = w.spark.read.parquet(f"{path}/out").withColumn("attached", F.decode("attachment", "utf-8"))
    columns = ["file_name", "message_id", "from_address", "so_number", "customer_name_raw", "attached", "error"]
    return read.groupBy(*columns).agg(F.count("*").alias("seen"))


@reg.plan("str_02_drop_repeats", "SELECT event_id AS log_id, 1::BIGINT AS copies FROM events")
def _(w: Warehouse):
    path = run_folder(w)
    twice = event_stream(w).select("log_id", "message_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    st.to_folder(st.drop_repeats(twice, "ts", "1 hour"), f"{path}/out", f"{path}/checkpoint")
    return w.spark.read.parquet(f"{path}/out").groupBy("log_id").agg(F.count("*").alias("copies"))


@reg.plan(
    "str_03_hourly_counts",
    f"""{WITH_LOG} SELECT strftime(date_trunc('hour', received_at), '%Y-%m-%d %H:%M:%S') AS hour_bucket, count(*) AS processed_count,
 count(*) FILTER (processing_status = 'LOADED') AS success_count FROM mail GROUP BY 1""",
)
def _(w: Warehouse):
    path = run_folder(w)
    st.to_folder(st.hourly_counts(event_stream(w), "ts", "40 days"), f"{path}/out", f"{path}/checkpoint", "update")
    return st.latest(w.spark, f"{path}/out", ["hour_bucket"])


@reg.plan("str_04_append_facts", f"{WITH_FACT} SELECT {FACT_OUT} FROM fact")
def _(w: Warehouse):
    # the lines are delivered twice under different checkpoints, as after a lost one; facts stay single
    path = run_folder(w)
    for run in range(2):
        raw = (
            w.spark.readStream.schema(w.table("lineitem").schema)
            .option("pathGlobFilter", "lineitem.parquet")
            .parquet(w.folder)
        )
        lines = raw.selectExpr(*select_list(ORDER_LINE))
        st.append_facts(lines, w.star, f"{path}/fact", f"{path}/checkpoint-{run}")
    return w.spark.read.parquet(f"{path}/fact").drop("run", "batch")


@reg.plan(
    "str_05_current_status",
    f"""{WITH_LOG} SELECT from_address, arg_max(processing_status, (received_at, log_id)) AS processing_status, count(*) AS changes
 FROM mail GROUP BY from_address""",
)
def _(w: Warehouse):
    path = run_folder(w)
    changes = event_stream(w).select("from_address", "ts", "processing_status", "log_id")
    st.to_folder(st.current_status(changes, "from_address"), f"{path}/out", f"{path}/checkpoint", "update")
    return st.latest(w.spark, f"{path}/out", ["from_address"]).drop("ts")


@reg.plan(
    "str_05_expiring_status",
    f"""{WITH_LOG} SELECT message_id, log_id * 2 + 1 AS log_id, processing_status,
 strftime(received_at + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS at, 2::BIGINT AS changes FROM mail""",
)
def _(w: Warehouse):
    # every mail is first pending, then in its state; both changes come twice
    path = run_folder(w)
    change = lambda status, ts, nth: F.struct(status.alias("processing_status"), ts.alias("ts"), (F.col("log_id") * 2 + nth).alias("log_id"))
    first = change(F.lit("PENDING"), F.col("ts"), 0)
    then = change(F.col("processing_status"), F.expr("ts + INTERVAL 30 MINUTES"), 1)
    changes = event_stream(w).select("message_id", F.explode(F.array(then, first, then, first)).alias("c")).select("message_id", "c.*")
    with settings(w.spark, st.STATE_ON_DISK):
        st.to_folder(st.expiring_status(changes), f"{path}/out", f"{path}/checkpoint", "update")
    last = st.latest(w.spark, f"{path}/out", ["message_id"])
    return last.select("message_id", "log_id", "processing_status", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "changes")


# -------------------------------------------------------------------------------------------- ad hoc


@reg.plan(
    "sql_01_named_views",
    f"""{WITH_FACT}, {ACTIVITY_SQL} SELECT region, count(*) AS dealers, sum(total_revenue)::DOUBLE AS revenue FROM activity
 GROUP BY region""",
)
def _(w: Warehouse):
    adhoc.register_views(w.spark, w.star, AS_OF)
    return w.spark.sql(
        "SELECT region, count(*) AS dealers, sum(total_revenue) AS revenue FROM v_customer_activity GROUP BY region"
    )


@reg.plan(
    "sql_01_named_views_all",
    f"""{WITH_FACT}, {WITH_LOG.removeprefix('WITH ')}, k AS ({KPI_LOG})
SELECT 'group' AS part, group_name AS name, count(DISTINCT line_id_fk) AS n, sum(line_total)::DOUBLE AS value FROM fact GROUP BY group_name
UNION ALL SELECT 'region', region, count(DISTINCT so_number), sum(line_total)::DOUBLE FROM fact GROUP BY region
UNION ALL SELECT 'month', concat(fiscal_year, '-', fiscal_month), count(DISTINCT so_number), sum(line_total)::DOUBLE
 FROM fact GROUP BY fiscal_year, fiscal_month
UNION ALL SELECT 'status', processing_status, count(*), NULL FROM mail GROUP BY processing_status
UNION ALL SELECT 'loaded', NULL, loaded_ok, pass_rate_pct FROM k""",
)
def _(w: Warehouse):
    adhoc.register_views(w.spark, w.snowflake, AS_OF, w.email_log, w.fact())
    return w.spark.sql("""
WITH groups AS (
  SELECT g.group_name, p.line_id, sum(l.line_total) AS value
  FROM order_line l JOIN sales_order USING (order_id) JOIN customer USING (customer_code)
  JOIN product p USING (product_code) LEFT JOIN product_line pl ON pl.line_id = p.line_id
  LEFT JOIN product_group g ON g.group_code = pl.group_code
  GROUP BY g.group_name, p.line_id),
regions AS (
  SELECT region, so_number, sum(line_total) AS value FROM fact_sales GROUP BY region, so_number)
SELECT 'group' AS part, group_name AS name, count(line_id) AS n, CAST(sum(value) AS DOUBLE) AS value FROM groups GROUP BY group_name
UNION ALL SELECT 'region', region, count(so_number), CAST(sum(value) AS DOUBLE) FROM regions GROUP BY region
UNION ALL SELECT 'month', concat(fiscal_year, '-', fiscal_month), sum(order_count), CAST(sum(total_revenue) AS DOUBLE) FROM (
  SELECT fiscal_year, fiscal_month, count(DISTINCT so_number) AS order_count, sum(line_total) AS total_revenue
  FROM fact_sales GROUP BY fiscal_year, fiscal_month) GROUP BY fiscal_year, fiscal_month
UNION ALL SELECT 'status', processing_status, count(*), NULL FROM email_log GROUP BY processing_status
UNION ALL SELECT 'loaded', NULL, loaded_ok, pass_rate_pct FROM v_email_processing_kpi""")


@reg.plan(
    "sql_02_run_select",
    f"""{WITH_FACT} SELECT customer_code, sum(line_total)::DOUBLE AS revenue FROM fact GROUP BY customer_code
 ORDER BY revenue DESC, customer_code LIMIT 50""",
)
def _(w: Warehouse):
    adhoc.register_views(w.spark, w.star, AS_OF)
    return adhoc.run_select(
        w.spark,
        "SELECT customer_code, sum(line_total) AS revenue FROM fact_sales GROUP BY customer_code"
        " ORDER BY revenue DESC, customer_code",
    )


# ------------------------------------------------------------------------------------- whole intake

def intake_star(w: Warehouse):
    """The dimensions an intake run meets, and the orders loaded before it."""
    from ..operators.fact import Star
    from .rules import loaded

    dealers = w.table("customer").selectExpr(
        "printf('KH-%05d', c_custkey) AS customer_code", "c_name AS customer_name", f"{DEALER_TAX} AS tax_code",
        "c_nationkey AS province_id",
    )
    product = w.product.where("product_code % 400 <> 8").withColumn(
        "product_code", F.lpad(F.col("product_code").cast("string"), 12, "0")
    )
    return Star(w.order_line, loaded(w), dealers, w.province, product)


DEALER_TAX = "CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE lpad(CAST(c_custkey AS STRING), 10, '0') END"


@reg.plan(
    "ld_06_run_intake",
    f"""{WITH_SLIP}, f AS (SELECT min(doc_id) AS doc_id FROM slip WHERE order_key % 400 <> 1 GROUP BY so_text),
g AS (SELECT slip.*, tax_code::BIGINT AS c, row_number() OVER (ORDER BY doc_id) AS order_id FROM slip JOIN f USING (doc_id)),
n AS (SELECT c, row_number() OVER (ORDER BY min(doc_id)) AS i FROM g WHERE c % 50 = 1 GROUP BY c),
d AS (SELECT g.*, CASE WHEN n.c IS NULL THEN printf('KH-%05d', g.c) ELSE printf('KH-%05d', (SELECT max(c_custkey) FROM customer) + i) END
 AS customer_code, CASE WHEN n.c IS NULL THEN c_name ELSE buyer END AS customer_name, CASE WHEN n.c IS NULL THEN n_name END AS province_name
 FROM g LEFT JOIN n ON n.c = g.c JOIN customer ON c_custkey = g.c LEFT JOIN nation ON n_nationkey = c_nationkey),
l AS (SELECT *, 1 AS line_no, code1 AS product_code, qty1 AS q, price1 AS p, total1 AS t FROM d UNION ALL
 SELECT *, 2, code2, qty2, price2, total2 FROM d),
pk AS (SELECT lpad(p_partkey::VARCHAR, 12, '0') AS product_code, p_name FROM part WHERE p_partkey % 400 <> 8)
SELECT concat(order_id, '-', line_no) AS line_id, order_id, so_text AS so_number, strftime(order_date, '%Y-%m-%d') AS order_date,
 customer_code, customer_name, province_name, l.product_code, coalesce(p_name, concat('San pham moi - ', l.product_code)) AS product_name,
 q::DOUBLE AS quantity, p::DOUBLE AS unit_price, t::DOUBLE AS line_total FROM l LEFT JOIN pk ON pk.product_code = l.product_code""",
)
def _(w: Warehouse):
    from ..operators.chain import run_intake

    docs = rendered(w).withColumnRenamed("doc_id", "log_id").withColumn("mail_name", F.lit(None).cast("string"))
    star = intake_star(w)
    return run_intake(docs, star, OWN_TAX_CODE, pattern=NUMBER_PATTERN).facts.select(
        "line_id", "order_id", "so_number", "order_date", "customer_code", "customer_name", "province_name",
        "product_code", "product_name", "quantity", "unit_price", "line_total",
    )


# mails in order of their files; an order's document is its last one
RUN_SQL = f"""{WITH_SLIP}, mail AS (SELECT *, row_number() OVER (ORDER BY concat(so_text, '_', doc_id, '.eml')) AS log_id FROM slip),
f AS (SELECT so_text, min(log_id) AS log_id, max(doc_id) AS doc_id FROM mail WHERE order_key % 20 <> 6 AND order_key % 400 <> 1
 GROUP BY so_text)"""


_runs: dict = {}


def stored_run(w: Warehouse):
    """Rendered mails and documents through a run that keeps its state, and once more; one per state of the tables."""
    from ..operators.run import IntakeRun

    key = w.state()
    if key in _runs:
        return _runs[key]
    run = IntakeRun(w.spark, run_folder(w), intake_star(w), OWN_TAX_CODE, pattern=NUMBER_PATTERN, buckets=32)
    # the values are kept, not what is rendered from them; each document meets every slip of its id, as many as there are
    same = F.count("*").over(Window.partitionBy("order_key", "doc_id")).cast("int")
    kept = cut(slips(w).withColumn("_same", same).withColumn("_nth", F.explode(F.array_repeat(F.lit(1), F.col("_same")))).drop("_same", "_nth"))
    file_name = F.concat(F.translate("so_text", ".", "_"), F.lit(".pdf")).alias("file_name")
    docs = render(kept, "so_text").select(file_name, "doc_id", "text", "tables", "parse_error")
    mails = mail_files(kept)
    run.run(mails, docs, "2001-08-01 00:00:00")
    again = run.run(mails, docs, "2001-08-02 00:00:00")
    if again:
        raise RuntimeError(f"a second run did something: {again}")
    _runs[key] = run
    return run


@reg.plan(
    "ld_06_run_stored",
    f"""{RUN_SQL},
g AS (SELECT mail.* EXCLUDE (log_id), f.log_id, tax_code::BIGINT AS c, row_number() OVER (ORDER BY f.log_id) AS order_id
 FROM mail JOIN f USING (doc_id)),
n AS (SELECT c, row_number() OVER (ORDER BY min(log_id)) AS i FROM g WHERE c % 50 = 1 GROUP BY c),
d AS (SELECT g.*, CASE WHEN n.c IS NULL THEN printf('KH-%05d', g.c) ELSE printf('KH-%05d', (SELECT max(c_custkey) FROM customer) + i) END
 AS customer_code, CASE WHEN n.c IS NULL THEN c_name ELSE buyer END AS customer_name, CASE WHEN n.c IS NULL THEN n_name END AS province_name
 FROM g LEFT JOIN n ON n.c = g.c JOIN customer ON c_custkey = g.c LEFT JOIN nation ON n_nationkey = c_nationkey),
l AS (SELECT *, 1 AS line_no, code1 AS product_code, qty1 AS q, price1 AS p, total1 AS t FROM d UNION ALL
 SELECT *, 2, code2, qty2, price2, total2 FROM d),
pk AS (SELECT lpad(p_partkey::VARCHAR, 12, '0') AS product_code, p_name FROM part WHERE p_partkey % 400 <> 8)
SELECT concat(order_id, '-', line_no) AS line_id, order_id, so_text AS so_number, strftime(order_date, '%Y-%m-%d') AS order_date,
 customer_code, customer_name, province_name, l.product_code, coalesce(p_name, concat('San pham moi - ', l.product_code)) AS product_name,
 q::DOUBLE AS quantity, p::DOUBLE AS unit_price, t::DOUBLE AS line_total FROM l LEFT JOIN pk ON pk.product_code = l.product_code""",
)
def _(w: Warehouse):
    return stored_run(w).facts().select(
        "line_id", "order_id", "so_number", "order_date", "customer_code", "customer_name", "province_name",
        "product_code", "product_name", "quantity", "unit_price", "line_total",
    )


REJECT_SQL = f"""{RUN_SQL}, rejected AS (SELECT mail.log_id, so_text AS so_number, CASE WHEN order_key % 400 = 1
 THEN concat('V7_DUPLICATE_SO:', so_text) WHEN f.log_id < mail.log_id THEN concat('V7_DUPLICATE_IN_BATCH:', so_text) END AS errors
 FROM mail LEFT JOIN f USING (so_text) WHERE order_key % 20 <> 6)"""


@reg.plan("src_10_write_rejects", f"{REJECT_SQL} SELECT * FROM rejected WHERE errors IS NOT NULL")
def _(w: Warehouse):
    return stored_run(w).rejects()


@reg.plan(
    "ing_02_run_states",
    f"""{REJECT_SQL} SELECT mail.log_id, so_text AS so_number, CASE WHEN order_key % 20 = 6 OR errors IS NOT NULL THEN 'FAILED' ELSE 'LOADED' END
 AS processing_status, CASE WHEN order_key % 20 = 6 THEN 'EXTRACT' WHEN errors IS NOT NULL THEN 'VALIDATE' END AS error_stage,
 CASE WHEN order_key % 20 = 6 THEN 'NO_PDF_ATTACHMENT' ELSE errors END AS error_message,
 CASE WHEN order_key % 20 <> 6 AND errors IS NULL THEN '2001-08-01 00:00:00' END AS processed_at
 FROM mail LEFT JOIN rejected USING (log_id)""",
)
def _(w: Warehouse):
    return stored_run(w).log.read().select(
        "log_id", "so_number", "processing_status", "error_stage", "error_message", "processed_at")
