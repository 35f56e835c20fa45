"""Audit, reconciliation and repair plans over tables with planted faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import audit as au
from ..operators import reconcile as rc
from ..operators import repair as fx
from ..sources.sales_store import SalesStore
from ..sources.warehouse import export_csv, read_export
from .registry import Registry
from .rules import DEALER, DEALER_SQL
from .star import FACT_SQL, FAULTY_SQL, LOG_SQL, MONTH, YEAR, Warehouse, run_folder, select_list

reg = Registry()

# --------------------------------------------------------------------------------------- planted data

NAME_FAULT = "CASE WHEN p_partkey % 100 = 9 THEN concat('Xe nnp Thnng Nhnt ', p_name) ELSE p_name END"
PRODUCT = {
    "product_code": "p_partkey",
    "product_name": NAME_FAULT,
    "color": "CASE WHEN p_partkey % 50 = 10 THEN NULL ELSE split_part(p_name, ' ', 1) END",
}
LOG = {
    "log_id": "log_id",
    "from_address": "from_address",
    "processing_status": "processing_status",
    "so_number": "CASE WHEN log_id % 90 = 3 THEN NULL ELSE so_number END",
    "error_stage": "CASE WHEN processing_status = 'FAILED' THEN CASE log_id % 3 WHEN 0 THEN 'EXTRACT' WHEN 1 THEN 'VALIDATE'"
    " ELSE 'LOAD' END END",
    "error_message": "CASE WHEN processing_status = 'FAILED' THEN concat(repeat('cause ', 20), log_id % 7) END",
}
BAD_ORDER = {
    "order_id": "order_id",
    "so_number": "CASE WHEN order_id % 500 = 0 THEN so_number + 1 ELSE so_number END",
    "order_date": "CASE WHEN order_id % 300 = 3 THEN NULL ELSE order_date END",
    "customer_code": "customer_code",
    "total_amount": "total_amount",
}
CUSTOMER = {
    "customer_code": "c_custkey",
    "customer_name": "CASE WHEN c_custkey % 90 = 5 THEN '' WHEN c_custkey % 90 = 6 THEN 'Cua hang nnp' ELSE c_name END",
}
BASE_SQL = f"""WITH {FACT_SQL}, {FAULTY_SQL}, {LOG_SQL}, {DEALER_SQL}, lg AS (SELECT {', '.join(select_list(LOG))} FROM mail),
product AS (SELECT {", ".join(select_list(PRODUCT))} FROM part), bad_so AS (SELECT {', '.join(select_list(BAD_ORDER))} FROM so),
customer2 AS (SELECT {', '.join(select_list(CUSTOMER))} FROM customer),
known AS (SELECT product_code FROM product WHERE product_code % 400 <> 8)"""


def product(w: Warehouse) -> DataFrame:
    return w.table("part").selectExpr(*select_list(PRODUCT))


def known(w: Warehouse) -> DataFrame:
    return product(w).where("product_code % 400 <> 8").select("product_code")


def log(w: Warehouse) -> DataFrame:
    return w.email_log.selectExpr(*select_list(LOG))


def bad_orders(w: Warehouse) -> DataFrame:
    return w.sales_order.selectExpr(*select_list(BAD_ORDER))


def customer(w: Warehouse) -> DataFrame:
    return w.table("customer").selectExpr(*select_list(CUSTOMER))


def dealers(w: Warehouse) -> DataFrame:
    named = {**DEALER, "customer_name": "CASE WHEN c_custkey % 90 = 6 THEN 'Cua hang nnp' ELSE c_name END"}
    return w.table("customer").selectExpr(*select_list(named))


BROKEN = r"""'\bnn\b|Thnn|Nhnn|\bnnp\b|Thnng|Nhnt|\bHnng\b|\bChinc\b|Xanh\s*dnn|\bnen\b'"""


def plan(name: str, sql: str):
    """Plan checked by SQL over the planted tables; SQL starting with a comma adds tables first."""
    return reg.plan(name, f"{BASE_SQL}{'' if sql.startswith(',') else ' '}{sql}")


# ----------------------------------------------------------------------------------------- DQ 01 – 13


@plan(
    "dq_01_status_distribution",
    """SELECT processing_status, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM mail) * 100, 1) AS pct
 FROM mail GROUP BY ALL""",
)
def _(w: Warehouse):
    return au.status_distribution(log(w))


@plan("dq_02_broken_product_names", f"SELECT product_code, product_name FROM product WHERE regexp_matches(product_name, {BROKEN})")
def _(w: Warehouse):
    return au.broken_names(product(w), "product_code", "product_name")


@plan("dq_03_broken_customer_names", f"SELECT customer_code, customer_name FROM customer2 WHERE regexp_matches(customer_name, {BROKEN})")
def _(w: Warehouse):
    return au.broken_names(customer(w), "customer_code", "customer_name")


ARITHMETIC = """SELECT line_id, so_number, product_code, quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price,
 line_total::DOUBLE AS line_total, round(quantity * unit_price)::DOUBLE AS expected,
 (line_total - round(quantity * unit_price))::DOUBLE AS diff FROM bad_line
 WHERE abs(line_total - round(quantity * unit_price)) > 2"""


@plan("dq_04_line_arithmetic", ARITHMETIC)
def _(w: Warehouse):
    return au.line_arithmetic(w.faulty_lines)


TOTALS = """SELECT o.order_id, o.so_number, o.total_amount::DOUBLE AS total_amount, coalesce(sum(l.line_total), 0)::DOUBLE
 AS sum_lines, abs(o.total_amount - coalesce(sum(l.line_total), 0))::DOUBLE AS diff FROM so o LEFT JOIN bad_line l
 ON l.order_id = o.order_id GROUP BY o.order_id, o.so_number, o.total_amount HAVING abs(o.total_amount - coalesce(sum(l.line_total), 0)) > 2"""


@plan("dq_05_order_totals_off", f"{TOTALS} ORDER BY diff DESC, o.order_id LIMIT 20")
def _(w: Warehouse):
    return au.order_totals_off(w.sales_order, w.faulty_lines)


@plan("dq_05_order_totals_off_all", TOTALS)
def _(w: Warehouse):
    return au.order_totals_off(w.sales_order, w.faulty_lines, n=None)


# every order is read twice: the first reading is wrong, the last one counts
FOOTER = "CAST(floor(total_amount) AS BIGINT) + CASE WHEN order_id % 350 = 7 THEN 150 ELSE 0 END"


def footers(w: Warehouse) -> DataFrame:
    last = w.sales_order.selectExpr("order_id + 1000000000 AS log_id", "so_number", f"{FOOTER} AS footer_total")
    first = w.sales_order.selectExpr("order_id AS log_id", "so_number", "CAST(7 AS BIGINT) AS footer_total")
    return first.unionByName(last)


@plan(
    "dq_06_footer_vs_loaded",
    f"""SELECT so_number, {FOOTER} AS footer_total, floor(total_amount)::BIGINT AS db_total,
 floor(total_amount)::BIGINT - ({FOOTER}) AS diff FROM so WHERE abs(floor(total_amount) - ({FOOTER})) > 2""",
)
def _(w: Warehouse):
    return au.footer_vs_loaded(footers(w), w.sales_order)


@plan(
    "dq_07_coverage_counts",
    """SELECT count(*) AS total_mails, count(*) FILTER (processing_status = 'LOADED') AS loaded,
 round(count(*) FILTER (processing_status = 'LOADED') / count(*)::DOUBLE * 100, 1) AS loaded_pct,
 (SELECT count(*) FROM so) AS orders, (SELECT count(*) FROM line) AS lines FROM lg""",
)
def _(w: Warehouse):
    return au.coverage_counts(log(w), w.sales_order, w.order_line)


MISSING = """SELECT so_number, log_id, processing_status FROM lg WHERE processing_status <> 'LOADED' AND so_number IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM so WHERE so.so_number = lg.so_number AND so.order_id % 3 = 0)"""


@plan("dq_08_not_loaded", f"{MISSING} ORDER BY so_number, log_id LIMIT 30")
def _(w: Warehouse):
    return au.not_loaded(log(w), w.sales_order.where("order_id % 3 = 0"))


@plan("dq_08_not_loaded_all", MISSING)
def _(w: Warehouse):
    return au.not_loaded(log(w), w.sales_order.where("order_id % 3 = 0"), n=None)


@plan(
    "dq_09_failures_by_reason",
    """SELECT error_stage, left(error_message, 80) AS reason, count(*) AS cnt FROM lg WHERE processing_status = 'FAILED'
 GROUP BY ALL ORDER BY cnt DESC, error_stage, reason LIMIT 20""",
)
def _(w: Warehouse):
    return au.failures_by_reason(log(w))


@plan(
    "dq_10_generated_dealers",
    """SELECT count(*) AS generated, count(*) FILTER (c_custkey % 90 = 6) AS broken_names,
 count(*) FILTER (c_custkey % 90 <> 6) AS clean_names FROM customer""",
)
def _(w: Warehouse):
    return au.generated_dealers(dealers(w))


@plan("dq_11_orphan_products", "SELECT DISTINCT product_code FROM line WHERE product_code NOT IN (SELECT product_code FROM known)")
def _(w: Warehouse):
    return au.orphan_products(w.order_line, known(w))


@plan(
    "dq_12_null_conditions",
    """SELECT 'sales_order.order_date' AS field, count(*) AS n_bad FROM bad_so WHERE order_date IS NULL UNION ALL
 SELECT 'sales_order.customer_code', count(*) FROM bad_so WHERE customer_code IS NULL UNION ALL
 SELECT 'sales_order.total_amount', count(*) FROM bad_so WHERE total_amount IS NULL UNION ALL
 SELECT 'order_line.product_code', count(*) FROM bad_line WHERE product_code IS NULL UNION ALL
 SELECT 'order_line.quantity', count(*) FROM bad_line WHERE quantity IS NULL OR quantity <= 0 UNION ALL
 SELECT 'order_line.unit_price', count(*) FROM bad_line WHERE unit_price IS NULL OR unit_price < 0 UNION ALL
 SELECT 'order_line.line_total', count(*) FROM bad_line WHERE line_total IS NULL UNION ALL
 SELECT 'customer.customer_name', count(*) FROM customer2 WHERE customer_name IS NULL OR customer_name = '' UNION ALL
 SELECT 'email_log.so_number', count(*) FROM lg WHERE so_number IS NULL""",
)
def _(w: Warehouse):
    return au.null_conditions(bad_orders(w), w.faulty_lines, customer(w), log(w))


def checks(w: Warehouse):
    return [
        ("A2-products", "FAIL", lambda: au.broken_names(product(w), "product_code", "product_name")),
        ("A3-arithmetic", "FAIL", lambda: au.line_arithmetic(w.faulty_lines)),
        ("A9-orphans", "FAIL", lambda: au.orphan_products(w.order_line, known(w))),
        ("C03-repeated", "WARN", lambda: au.repeated_products(w.order_line)),
        ("C04-zero-price", "FAIL", lambda: au.zero_price(w.faulty_lines)),
        ("C05-quantity", "WARN", lambda: au.large_quantity(w.order_line, 1000)),
        ("C08-repeated-orders", "FAIL", lambda: au.repeated_orders(bad_orders(w))),
        ("clean-arithmetic", "FAIL", lambda: au.line_arithmetic(w.order_line)),
        ("not-plannable", "FAIL", lambda: w.order_line.select("no_such_column")),
    ]


RESULTS = f"""r AS (SELECT * FROM (VALUES
 ('A2-products', 'FAIL', (SELECT count(*) FROM product WHERE regexp_matches(product_name, {BROKEN}))),
 ('A3-arithmetic', 'FAIL', (SELECT count(*) FROM ({ARITHMETIC}))),
 ('A9-orphans', 'FAIL', (SELECT count(DISTINCT product_code) FROM line WHERE product_code % 400 = 8)),
 ('C03-repeated', 'WARN', (SELECT count(*) FROM (SELECT 1 FROM line GROUP BY so_number, product_code HAVING count(*) > 1))),
 ('C04-zero-price', 'FAIL', (SELECT count(*) FROM bad_line WHERE unit_price = 0)), ('C05-quantity', 'WARN', 0),
 ('C08-repeated-orders', 'FAIL', (SELECT count(*) FROM (SELECT 1 FROM bad_so GROUP BY so_number HAVING count(*) > 1))),
 ('clean-arithmetic', 'FAIL', 0), ('not-plannable', 'ERROR', NULL)) t(check_id, severity, n_bad)),
res AS (SELECT check_id, CASE WHEN n_bad = 0 THEN 'OK' ELSE severity END AS status, n_bad FROM r)"""


@reg.plan("dq_13_issue_list", f"{BASE_SQL}, {RESULTS} SELECT * FROM res WHERE n_bad > 0")
def _(w: Warehouse):
    return au.issues(au.run_checks(checks(w)))


# ----------------------------------------------------------------------------------------- DQ 14 – 29


@plan(
    "dq_14_dates_outside",
    "SELECT so_number, strftime(order_date, '%Y-%m-%d') AS order_date FROM bad_so WHERE NOT order_date BETWEEN DATE '1996-01-01' AND DATE '2001-06-30'",
)
def _(w: Warehouse):
    return au.dates_outside(bad_orders(w), "1996-01-01", "2001-06-30")


@plan("dq_15_empty_orders", "SELECT so_number FROM so WHERE NOT EXISTS (SELECT 1 FROM line WHERE line.order_id = so.order_id)")
def _(w: Warehouse):
    return au.empty_orders(w.sales_order, w.order_line)


@plan("dq_16_repeated_products", "SELECT so_number, product_code, count(*) AS n FROM line GROUP BY ALL HAVING count(*) > 1")
def _(w: Warehouse):
    return au.repeated_products(w.order_line)


@plan("dq_17_zero_price", "SELECT line_id, so_number, product_code, quantity::DOUBLE AS quantity FROM bad_line WHERE unit_price = 0")
def _(w: Warehouse):
    return au.zero_price(w.faulty_lines)


@plan("dq_18_large_quantity", "SELECT line_id, so_number, product_code, quantity::DOUBLE AS quantity FROM line WHERE quantity > 48")
def _(w: Warehouse):
    return au.large_quantity(w.order_line, 48)


@plan(
    "dq_19_fact_in_step",
    f"""SELECT a AS order_lines, b AS fact_rows, abs(a - b) AS gap FROM (SELECT
 (SELECT count(*) FROM line JOIN so USING (order_id) WHERE year(order_date) = {YEAR} AND month(order_date) = {MONTH}) AS a,
 (SELECT count(*) FROM fact WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH} AND product_code % 400 <> 8) AS b)""",
)
def _(w: Warehouse):
    fact = w.fact("fiscal_year", "fiscal_month", "product_code").where("product_code % 400 <> 8")
    return au.fact_in_step(w.store.lines, w.store.orders, fact, YEAR, MONTH)


@plan("dq_20_new_without_tax", "SELECT customer_code, customer_name FROM dealer WHERE customer_code > 'KH-00702' AND tax_code IS NULL")
def _(w: Warehouse):
    return au.new_without_tax(w.table("customer").selectExpr(*select_list(DEALER)), "KH-00702")


@plan("dq_21_repeated_orders", "SELECT so_number, count(*) AS n FROM bad_so GROUP BY so_number HAVING count(*) > 1")
def _(w: Warehouse):
    return au.repeated_orders(bad_orders(w))


@plan(
    "dq_22_plausibility",
    f"""SELECT coalesce(sum(line_total), 0)::DOUBLE AS revenue, count(DISTINCT so_number) AS orders,
 round(sum(line_total)::DOUBLE / count(*), 2) AS mean_line,
 CASE WHEN sum(line_total) < 10000000000 OR avg(line_total) < 100000 THEN 'WARN' ELSE 'OK' END AS status
 FROM fact WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH}""",
)
def _(w: Warehouse):
    f = w.fact("fiscal_year", "fiscal_month", "so_number", "line_total")
    return au.plausibility(f, YEAR, MONTH, 10_000_000_000, 100_000)


@plan("dq_23_other_states", "SELECT processing_status, count(*) AS n FROM lg WHERE processing_status <> 'LOADED' GROUP BY ALL")
def _(w: Warehouse):
    return au.other_states(log(w))


PERIOD = f"year(order_date) = {YEAR} AND month(order_date) = {MONTH}"


@plan(
    "dq_24_period_totals",
    f"""SELECT count(*) AS so_count, strftime(min(order_date), '%Y-%m-%d') AS min_date, strftime(max(order_date), '%Y-%m-%d')
 AS max_date, sum(total_amount)::DOUBLE AS order_revenue, (SELECT count(*) FROM line JOIN so USING (order_id) WHERE {PERIOD})
 AS line_count, (SELECT sum(quantity)::DOUBLE FROM line JOIN so USING (order_id) WHERE {PERIOD}) AS total_qty,
 (SELECT sum(line_total)::DOUBLE FROM line JOIN so USING (order_id) WHERE {PERIOD}) AS line_revenue FROM so WHERE {PERIOD}""",
)
def _(w: Warehouse):
    return au.period_totals(w.store.orders, w.store.lines, YEAR, MONTH)


@plan(
    "dq_25_top_period_dealers",
    f"""SELECT customer_code, customer_name, count(*) AS so_count, sum(total_amount)::DOUBLE AS revenue FROM so
 JOIN cust USING (customer_code) WHERE {PERIOD} GROUP BY ALL ORDER BY revenue DESC, customer_code LIMIT 10""",
)
def _(w: Warehouse):
    return au.top_period_dealers(w.store.orders, w.customer, YEAR, MONTH)


@plan("dq_26_dealers_above", "SELECT count(*) AS new_dealers FROM customer WHERE c_custkey > 798")
def _(w: Warehouse):
    return au.dealers_above(dealers(w), 798)


@plan(
    "dq_27_mismatched_orders",
    f"""SELECT count(*) AS mismatched_orders FROM (SELECT 1 FROM so JOIN line USING (order_id) WHERE {PERIOD}
 GROUP BY order_id, total_amount HAVING abs(total_amount - sum(line_total)) > 2)""",
)
def _(w: Warehouse):
    return au.mismatched_orders(w.store.orders, w.store.lines, YEAR, MONTH)


@plan("dq_28_orphan_lines", "SELECT count(*) AS orphan_lines FROM line WHERE product_code NOT IN (SELECT product_code FROM known)")
def _(w: Warehouse):
    return au.orphan_lines(w.order_line, known(w))


@plan(
    "dq_29_last_failures",
    """SELECT log_id, so_number, error_stage, left(error_message, 120) AS error FROM lg WHERE processing_status = 'FAILED'
 ORDER BY log_id DESC LIMIT 5""",
)
def _(w: Warehouse):
    return au.last_failures(log(w))


# ----------------------------------------------------------------------------------------- DQ 30 – 44

DOC_HEAD = {
    "so_number": "o_orderkey",
    "order_date": "date_add(CAST(o_orderdate AS DATE), CASE WHEN o_orderkey % 300 = 3 THEN {one} ELSE {zero} END)",
    "tax_code": "CASE WHEN o_orderkey % 450 = 4 THEN '0000000000' WHEN o_orderkey % 450 = 5 THEN NULL ELSE lpad(CAST(o_custkey AS STRING), 10, '0') END",
    "total": "CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 350 = 7 THEN 150 WHEN o_orderkey % 350 = 8 THEN 300 ELSE 0 END",
}
ORD_HEAD = {
    "so_number": "o_orderkey",
    "order_date": "CAST(o_orderdate AS DATE)",
    "tax_code": "lpad(CAST(o_custkey AS STRING), 10, '0')",
    "total": "CAST(o_totalprice AS DECIMAL(18,2))",
}


def _head(columns: dict[str, str], spark_side: bool) -> str:
    text = ", ".join(select_list(columns))
    one, zero = ("1", "0") if spark_side else ("INTERVAL 1 DAY", "INTERVAL 0 DAY")
    return text.replace("{one}", one).replace("{zero}", zero)


DOC_SQL = f"""dline AS (SELECT * FROM bad_line WHERE product_code % 400 <> 8),
dh0 AS (SELECT {_head(DOC_HEAD, False)} FROM orders), oh0 AS (SELECT {_head(ORD_HEAD, False)} FROM orders),
dn AS (SELECT so_number, count(*) AS n_lines FROM dline GROUP BY 1), onn AS (SELECT so_number, count(*) AS n_lines FROM line GROUP BY 1),
dh AS (SELECT dh0.*, coalesce(n_lines, 0) AS n_lines FROM dh0 LEFT JOIN dn ON dn.so_number = dh0.so_number WHERE dh0.so_number % 40 <> 1),
oh AS (SELECT oh0.*, coalesce(n_lines, 0) AS n_lines FROM oh0 LEFT JOIN onn ON onn.so_number = oh0.so_number WHERE oh0.so_number % 40 <> 2)"""


def doc_lines(w: Warehouse) -> DataFrame:
    return w.faulty_lines.where("product_code % 400 <> 8")


def heads(w: Warehouse, columns: dict[str, str], lines: DataFrame, hole: int) -> DataFrame:
    n = lines.groupBy("so_number").agg(F.count("*").alias("n"))
    base = w.table("orders").selectExpr(*_head_list(columns)).where(f"so_number % 40 <> {hole}")
    return base.join(n, "so_number", "left").withColumn("n_lines", F.coalesce("n", F.lit(0))).drop("n")


def _head_list(columns: dict[str, str]) -> list[str]:
    return [s.replace("{one}", "1").replace("{zero}", "0") for s in select_list(columns)]


def doc_heads(w: Warehouse) -> DataFrame:
    return heads(w, DOC_HEAD, doc_lines(w), 1)


def order_heads(w: Warehouse) -> DataFrame:
    return heads(w, ORD_HEAD, w.order_line, 2)


@plan(
    "dq_30_body_vs_loaded",
    f""", {DOC_SQL} SELECT d.so_number, concat_ws(',', CASE WHEN d.tax_code <> o.tax_code THEN 'TAX_CODE' END,
 CASE WHEN floor(d.total) <> 0 AND abs(floor(d.total) - floor(o.total)) > 200 THEN 'TOTAL' END) AS issues
 FROM dh0 d JOIN oh0 o ON o.so_number = d.so_number""",
)
def _(w: Warehouse):
    bodies = w.table("orders").selectExpr(*_head_list(DOC_HEAD)).select(
        "so_number", "tax_code", F.floor("total").alias("amount")
    )
    dealer = w.table("customer").selectExpr(
        "c_custkey AS customer_code", "lpad(CAST(c_custkey AS STRING), 10, '0') AS tax_code"
    )
    return rc.body_vs_loaded(bodies, w.sales_order, dealer)


# Lines by their position in the order. In documents % 50 = 11 stand in reverse, and totals % 60 = 7 are 500 off.
POSITIONS = "SELECT *, row_number() OVER (PARTITION BY so_number ORDER BY line_id) AS i, count(*) OVER (PARTITION BY so_number) AS n"
DOC_POSITION = "CASE WHEN so_number % 50 = 11 THEN n + 1 - i ELSE i END"
DOC_TOTAL = "line_total + CASE WHEN so_number % 60 = 7 THEN 500 ELSE 0 END"

LINE_ISSUES = f"""pd AS (SELECT so_number, product_code, quantity, unit_price, {DOC_TOTAL} AS line_total, {DOC_POSITION} AS pos
 FROM ({POSITIONS} FROM dline)),
po AS (SELECT *, i AS pos FROM ({POSITIONS} FROM line)),
li AS (SELECT d.so_number, d.product_code <> o.product_code AS p, abs(d.quantity - o.quantity) > 0.01 AS q,
 abs(d.unit_price - o.unit_price) > 200 AS pr, abs(d.line_total - o.line_total) > 200 AS t
 FROM pd d JOIN po o ON o.so_number = d.so_number AND o.pos = d.pos),
lc AS (SELECT so_number, count(*) FILTER (p) AS p, count(*) FILTER (q) AS q, count(*) FILTER (pr) AS pr, count(*) FILTER (t) AS t
 FROM li GROUP BY so_number),
cmp AS (SELECT d.so_number, concat_ws(',', CASE WHEN d.order_date IS DISTINCT FROM o.order_date THEN 'ORDER_DATE' END,
 CASE WHEN d.tax_code <> o.tax_code THEN 'TAX_CODE' END, CASE WHEN d.n_lines <> o.n_lines THEN 'LINE_COUNT' END,
 CASE WHEN d.total <> 0 AND o.total <> 0 AND abs(d.total - o.total) > 200 THEN 'FOOTER' END) AS header_issues,
 CASE WHEN d.n_lines = o.n_lines THEN coalesce(p, 0) ELSE 0 END AS product_lines,
 CASE WHEN d.n_lines = o.n_lines THEN coalesce(q, 0) ELSE 0 END AS qty_lines,
 CASE WHEN d.n_lines = o.n_lines THEN coalesce(pr, 0) ELSE 0 END AS price_lines,
 CASE WHEN d.n_lines = o.n_lines THEN coalesce(t, 0) ELSE 0 END AS total_lines
 FROM dh d JOIN oh o ON o.so_number = d.so_number LEFT JOIN lc ON lc.so_number = d.so_number)"""


def compared(w: Warehouse) -> DataFrame:
    order = Window.partitionBy("so_number")
    at = {"i": F.row_number().over(order.orderBy("line_id")), "n": F.count("*").over(order)}
    docs = doc_lines(w).withColumns(at).withColumns({"line_total": F.expr(DOC_TOTAL), "pos": F.expr(DOC_POSITION)})
    lines = w.order_line.withColumns(at).withColumn("pos", F.col("i"))
    return rc.deep_compare(doc_heads(w), docs, order_heads(w), lines, "pos")


@plan("dq_31_deep_compare", f", {DOC_SQL}, {LINE_ISSUES} SELECT * FROM cmp")
def _(w: Warehouse):
    return compared(w)


@plan(
    "dq_32_outcomes",
    f""", {DOC_SQL}, {LINE_ISSUES} SELECT k.so_number, CASE WHEN c.so_number IS NULL THEN 'SKIP' WHEN header_issues = ''
 AND product_lines + qty_lines + price_lines + total_lines = 0 THEN 'OK' ELSE 'FAIL' END AS outcome
 FROM (SELECT so_number FROM dh UNION SELECT so_number FROM oh) k LEFT JOIN cmp c ON c.so_number = k.so_number""",
)
def _(w: Warehouse):
    return rc.outcomes(order_heads(w), doc_heads(w), compared(w))


@plan(
    "dq_33_count_chain",
    f""", {DOC_SQL} SELECT *, mail_files = log_rows AS log_complete, orders >= records AS orders_complete FROM (SELECT
 (SELECT count(*) FROM events) AS mail_files, (SELECT count(*) FROM lg) AS log_rows, (SELECT count(*) FROM dh) AS records,
 (SELECT count(*) FROM oh) AS orders, (SELECT count(*) FROM dh WHERE so_number NOT IN (SELECT so_number FROM oh)) AS missing_orders)""",
)
def _(w: Warehouse):
    return rc.count_chain(w.table("events"), log(w), doc_heads(w), order_heads(w))


@plan(
    "dq_34_line_counts_off",
    f""", {DOC_SQL} SELECT so_number, dn.n_lines AS n_extracted, onn.n_lines AS n_loaded FROM dn JOIN onn USING (so_number)
 WHERE dn.n_lines <> onn.n_lines""",
)
def _(w: Warehouse):
    return rc.line_counts_off(doc_lines(w), w.order_line)


@plan(
    "dq_35_paired_differences",
    f""", {DOC_SQL}, uneven AS (SELECT so_number FROM dn JOIN onn USING (so_number) WHERE dn.n_lines <> onn.n_lines),
a AS (SELECT *, row_number() OVER (PARTITION BY so_number ORDER BY product_code, line_id) AS i FROM dline
 WHERE so_number NOT IN (SELECT so_number FROM uneven)),
b AS (SELECT *, row_number() OVER (PARTITION BY so_number ORDER BY product_code, line_id) AS i FROM line
 WHERE so_number NOT IN (SELECT so_number FROM uneven))
SELECT * FROM (SELECT a.so_number, a.product_code, abs(a.quantity - b.quantity) > 0.001 AS qty_off,
 abs(a.unit_price - b.unit_price) > 0 AS price_off, abs(a.line_total - b.line_total) > 2 AS total_off
 FROM a JOIN b ON a.so_number = b.so_number AND a.i = b.i) WHERE qty_off OR price_off OR total_off""",
)
def _(w: Warehouse):
    return rc.paired_differences(doc_lines(w), w.order_line, "line_id")


@plan(
    "dq_36_header_differences",
    f""", {DOC_SQL} SELECT * FROM (SELECT d.so_number, coalesce(abs(d.total - o.total) > 2, false) AS footer_off,
 coalesce(d.order_date <> o.order_date, false) AS date_off, coalesce(d.tax_code <> o.tax_code, false) AS tax_off
 FROM dh d JOIN oh o ON o.so_number = d.so_number) WHERE footer_off OR date_off OR tax_off""",
)
def _(w: Warehouse):
    return rc.header_differences(doc_heads(w), order_heads(w))


STATE_FAULT = "CASE WHEN event_id % 700 = 9 THEN 'DONE' WHEN event_id % 700 = 10 THEN NULL ELSE 'PENDING' END"


@plan("dq_37_bad_states", f"SELECT event_id AS log_id, {STATE_FAULT} AS processing_status FROM events WHERE event_id % 700 IN (9, 10)")
def _(w: Warehouse):
    from ..operators.intake_log import bad_states

    return bad_states(w.table("events").selectExpr("event_id AS log_id", f"{STATE_FAULT} AS processing_status"))


@plan(
    "dq_38_broken_names_spread",
    """SELECT (SELECT count(DISTINCT product_code) FROM line WHERE product_code % 100 = 9) AS broken_extracted,
 (SELECT count(DISTINCT product_code) FROM line WHERE product_code % 200 = 9) AS broken_stored""",
)
def _(w: Warehouse):
    lines = w.order_line.join(product(w).select("product_code", "product_name"), "product_code")
    stored = product(w).withColumn(
        "product_name", F.when(F.col("product_code") % 200 == 109, "Xe dap").otherwise(F.col("product_name"))
    )
    bad = au.broken("product_name", au.BROKEN_EXTRACT)
    return rc.spread_of_broken_names(lines, stored, bad, bad)


EXPORT_GAP = "order_id % 1000 <> 3"
FACT_DAMAGE = "CASE WHEN order_id % 700 = 5 THEN 1 ELSE 0 END"


def export_pairs(w: Warehouse, *names: str):
    """Tables and what is read back from their CSV export; the exported rows were damaged before."""
    tables = {
        "sales_order": w.sales_order,
        "order_line": w.order_line,
        "fact_sales": w.fact("line_id", "order_id", "quantity", "line_total"),
        "customer": w.customer.select("customer_code"),
        "product": w.product.select("product_code"),
        "product_line": w.product.select("line_id").distinct(),  # shares its prefix with another table
        "province": w.province.select("province_id"),
    }
    tables = {n: df for n, df in tables.items() if not names or n in names}
    damage = {
        "sales_order": lambda df: df.where(EXPORT_GAP),
        "order_line": lambda df: df.where(EXPORT_GAP),
        "fact_sales": lambda df: df.withColumn("line_total", F.expr(f"line_total + {FACT_DAMAGE}").cast("decimal(18,2)")),
        "customer": lambda df: df.where("customer_code % 90 <> 4"),
        "product": lambda df: df.where("product_code % 500 <> 9"),
    }
    path = run_folder(w)
    written = {n: damage.get(n, lambda x: x)(df) for n, df in tables.items()}
    export_csv(written, path)
    # an empty table has no export
    return {n: (df, written[n] if written[n].isEmpty() else read_export(w.spark, path, n, df.schema)) for n, df in tables.items()}


@plan(
    "dq_39_rows_vs_export",
    f"""SELECT *, table_rows = export_rows AS equal FROM (SELECT 'sales_order' AS table_name, count(*) AS table_rows,
 count(*) FILTER ({EXPORT_GAP}) AS export_rows FROM so UNION ALL SELECT 'order_line', count(*), count(*) FILTER ({EXPORT_GAP}) FROM line
 UNION ALL SELECT 'fact_sales', count(*), count(*) FROM fact
 UNION ALL SELECT 'customer', count(*), count(*) FILTER (customer_code % 90 <> 4) FROM cust
 UNION ALL SELECT 'product', count(*), count(*) FILTER (product_code % 500 <> 9) FROM prod
 UNION ALL SELECT 'product_line', n, n FROM (SELECT count(*) AS n FROM (SELECT DISTINCT line_id FROM prod))
 UNION ALL SELECT 'province', count(*), count(*) FROM prov)""",
)
def _(w: Warehouse):
    return rc.table_vs_export(export_pairs(w))


@plan(
    "dq_40_sums_vs_export",
    f"""SELECT *, abs(table_sum - export_sum) < 0.01 AS equal FROM (
 SELECT 'sales_order' AS table_name, 'total_amount' AS column_name, sum(total_amount)::DOUBLE AS table_sum,
 sum(total_amount) FILTER ({EXPORT_GAP})::DOUBLE AS export_sum FROM so UNION ALL
 SELECT 'order_line', 'line_total', sum(line_total)::DOUBLE, sum(line_total) FILTER ({EXPORT_GAP})::DOUBLE FROM line UNION ALL
 SELECT 'order_line', 'quantity', sum(quantity)::DOUBLE, sum(quantity) FILTER ({EXPORT_GAP})::DOUBLE FROM line UNION ALL
 SELECT 'fact_sales', 'line_total', sum(line_total)::DOUBLE, sum(line_total + {FACT_DAMAGE})::DOUBLE FROM fact UNION ALL
 SELECT 'fact_sales', 'quantity', sum(quantity)::DOUBLE, sum(quantity)::DOUBLE FROM fact)""",
)
def _(w: Warehouse):
    pairs = export_pairs(w, "sales_order", "order_line", "fact_sales")
    columns = {"sales_order": ["total_amount"], "order_line": ["line_total", "quantity"], "fact_sales": ["line_total", "quantity"]}
    return rc.sums_vs_export({n: (*pairs[n], c) for n, c in columns.items()})


# the fact table misses orders % 70 = 3 and holds history the order table lost (orders % 70 = 4)
def partial(w: Warehouse):
    return w.sales_order.where("order_id % 70 <> 4"), w.fact("order_id", "so_number", "quantity", "line_total").where(
        "order_id % 70 <> 3"
    )


PARTIAL = """po AS (SELECT * FROM so WHERE order_id % 70 <> 4), pf AS (SELECT * FROM fact WHERE order_id % 70 <> 3)"""


@plan(
    "dq_41_orders_vs_fact",
    f""", {PARTIAL} SELECT count(f) AS fact_orders, count(o) AS sales_orders, count(*) FILTER (o IS NULL) AS extra_in_fact,
 count(*) FILTER (f IS NULL) AS missing_in_fact FROM (SELECT DISTINCT so_number AS o FROM po) FULL JOIN
 (SELECT DISTINCT so_number AS f FROM pf) ON o = f""",
)
def _(w: Warehouse):
    return rc.orders_vs_fact(*partial(w))


@plan(
    "dq_42_shared_sums",
    f""", {PARTIAL}, a AS (SELECT sum(line_total)::DOUBLE AS x, sum(quantity)::DOUBLE AS y FROM line
 WHERE so_number IN (SELECT so_number FROM po) AND so_number IN (SELECT so_number FROM pf)),
 b AS (SELECT sum(line_total)::DOUBLE AS x, sum(quantity)::DOUBLE AS y FROM pf WHERE so_number IN (SELECT so_number FROM po))
 SELECT a.x AS line_amount, a.y AS line_qty, b.x AS fact_amount, b.y AS fact_qty, abs(a.x - b.x) <= 2 AS amount_ok,
 abs(a.y - b.y) < 0.01 AS qty_ok FROM a, b""",
)
def _(w: Warehouse):
    orders, fact = partial(w)
    return rc.shared_sums(w.order_line, orders, fact)


@plan(
    "dq_43_key_differences",
    """SELECT order_id, CASE order_id % 1000 WHEN 3 THEN 'missing' ELSE 'extra' END AS side FROM so WHERE order_id % 1000 IN (3, 4)""",
)
def _(w: Warehouse):
    export = export_pairs(w, "sales_order")["sales_order"][1]
    return rc.key_differences(w.sales_order.where("order_id % 1000 <> 4"), export, "order_id")


@reg.plan(
    "dq_44_scorecard",
    f"""{BASE_SQL}, {RESULTS} SELECT count(*) AS checks, count(*) FILTER (status = 'OK') AS passed,
 count(*) FILTER (status <> 'OK') AS failed FROM res""",
)
def _(w: Warehouse):
    return au.scorecard(au.run_checks(checks(w)))


@reg.plan("dq_44_check_results", f"{BASE_SQL}, {RESULTS} SELECT check_id, status, n_bad FROM res")
def _(w: Warehouse):
    return au.run_checks(checks(w))


# ----------------------------------------------------------------------------------------------- FIX

RAW = """CASE p_partkey % 4 WHEN 0 THEN concat('Xe nnp mau nn ', p_name, ' Chinc') WHEN 1 THEN concat('nnpx Trnng ', p_name)
 WHEN 2 THEN concat('Bno ngnc ', p_name, ' Chinc nen') ELSE p_name END"""
MEANT = """CASE p_partkey % 4 WHEN 0 THEN concat('Xe đạp mau Đỏ ', p_name) WHEN 1 THEN concat('nnpx Trắng ', p_name)
 WHEN 2 THEN concat('Bảo ngọc ', p_name, ' Chiếc đen') ELSE p_name END"""
MANUAL = "p_partkey % 60 = 0"


def manual(w: Warehouse) -> DataFrame:
    return w.table("part").where(MANUAL).selectExpr("p_partkey AS product_code", "concat('Ten ', p_partkey, ' Chiếc') AS manual_name")


@reg.plan(
    "fix_01_restore_name",
    f"""SELECT p_partkey AS product_code, CASE WHEN {MANUAL} THEN concat('Ten ', p_partkey, ' Chiếc') ELSE {MEANT} END
 AS restored FROM part""",
)
def _(w: Warehouse):
    products = w.table("part").selectExpr("p_partkey AS product_code", f"{RAW} AS raw_name")
    return fx.restore_names(products, manual(w)).select("product_code", "restored")


PLACEHOLDER = "CASE WHEN p_partkey % 30 < 3 THEN concat('San pham moi T7 - ', p_partkey) ELSE p_name END"


def placeholders(w: Warehouse) -> DataFrame:
    return w.table("part").selectExpr("p_partkey AS product_code", f"{PLACEHOLDER} AS product_name")


def repaired(w: Warehouse) -> DataFrame:
    """Products named by the documents of orders with an even key; the smallest (order, line) is first."""
    names = w.table("part").selectExpr("p_partkey AS product_code", f"{RAW} AS raw")
    lines = w.table("lineitem").where("l_partkey % 30 <> 2").join(names, F.col("l_partkey") == F.col("product_code"))
    doc = lines.selectExpr(
        "l_orderkey AS log_id", "l_linenumber AS line_no", "product_code", "raw AS product_name"
    )
    return fx.repair_products(placeholders(w), doc, manual(w))


REPAIRED = f"""rp AS (SELECT p_partkey AS product_code, CASE WHEN p_partkey % 30 < 2 AND p_partkey IN (SELECT l_partkey FROM lineitem)
 THEN CASE WHEN {MANUAL} THEN concat('Ten ', p_partkey, ' Chiếc') ELSE {MEANT} END ELSE {PLACEHOLDER} END AS product_name FROM part)"""


@reg.plan("fix_02_repair_products", f"WITH {REPAIRED} SELECT * FROM rp")
def _(w: Warehouse):
    return repaired(w)


@reg.plan(
    "fix_03_propagate",
    f"""WITH {REPAIRED}, {FACT_SQL} SELECT line_id, fact.product_code, rp.product_name FROM fact
 JOIN rp ON rp.product_code = fact.product_code""",
)
def _(w: Warehouse):
    return fx.propagate(w.fact("line_id", "product_code", "product_name"), repaired(w), "product_name")


@reg.plan(
    "fix_03_propagate_stored",
    f"""WITH {REPAIRED}, {FACT_SQL} SELECT line_id, fact.product_code, coalesce(rp.product_name, fact.product_name) AS product_name
 FROM fact LEFT JOIN rp ON rp.product_code = fact.product_code""",
)
def _(w: Warehouse):
    store = SalesStore(run_folder(w), w.star, w.partitions, w.raw).create()
    store.repair_product(repaired(w), "product_name")
    return store.fact("line_id", "product_code", "product_name")


@plan(
    "fix_04_repair_price",
    """SELECT line_id, quantity::DOUBLE AS quantity, line_total::DOUBLE AS line_total,
 CASE WHEN abs(line_total - round(quantity * unit_price)) > 2 THEN CASE WHEN quantity > 0 THEN
 ((CAST(line_total * 100 AS BIGINT) * 20000 + quantity::BIGINT) // (2 * quantity::BIGINT)) / 1000000.0::DOUBLE END
 ELSE unit_price::DOUBLE END AS unit_price FROM bad_line""",
)
def _(w: Warehouse):
    return fx.repair_price(w.faulty_lines).select("line_id", "quantity", "line_total", "unit_price")


def colored(w: Warehouse) -> DataFrame:
    colors = w.table("part").where("p_partkey % 100 = 10").selectExpr("p_partkey AS product_code", "'xanh' AS new_color")
    return fx.fill_color(product(w), colors, "small")


@plan(
    "fix_05_fill_color",
    """SELECT product_code, product_name, CASE WHEN color IS NULL AND product_name LIKE 'small%' AND product_code % 100 = 10
 THEN 'xanh' ELSE color END AS color FROM product""",
)
def _(w: Warehouse):
    return colored(w)


SIBLING = {
    "product_code": "lpad(CAST(p_partkey AS STRING), 12, '0')",
    "line_id": "CASE WHEN p_partkey % 50 = 10 THEN NULL ELSE CAST(p_size AS BIGINT) END",
}


@reg.plan(
    "fix_06_sibling_line",
    f"""WITH p AS (SELECT {", ".join(select_list(SIBLING))} FROM part), s AS (SELECT left(product_code, 9) AS k, min(line_id) AS line_id
 FROM p GROUP BY k) SELECT product_code, coalesce(p.line_id, s.line_id) AS line_id FROM p LEFT JOIN s ON s.k = left(product_code, 9)""",
)
def _(w: Warehouse):
    return fx.sibling_line(w.table("part").selectExpr(*select_list(SIBLING)))


@reg.plan(
    "fix_07_verify_repair",
    f"""{BASE_SQL}, {REPAIRED}, fixed AS (SELECT quantity, line_total, CASE WHEN abs(line_total - round(quantity * unit_price)) > 2
 THEN CASE WHEN quantity > 0 THEN CAST(((CAST(line_total * 100 AS BIGINT) * 20000 + quantity::BIGINT) // (2 * quantity::BIGINT))
 AS DECIMAL(20,0)) * 0.000001::DECIMAL(7,6) END ELSE unit_price END AS unit_price FROM bad_line)
 SELECT (SELECT count(*) FROM rp WHERE product_name LIKE 'San pham moi%') AS placeholders_left,
 (SELECT count(*) FROM product WHERE color IS NULL AND NOT (product_name LIKE 'small%' AND product_code % 100 = 10)) AS colors_left,
 (SELECT count(*) FROM fixed WHERE abs(line_total - round(quantity * unit_price)) > 2) AS arithmetic_left,
 (SELECT sum(line_total)::DOUBLE FROM fixed) AS total_after, (SELECT sum(line_total)::DOUBLE FROM bad_line) AS total_before""",
)
def _(w: Warehouse):
    merged = repaired(w).join(colored(w).select("product_code", "color"), "product_code")
    return fx.verify_repair(merged, fx.repair_price(w.faulty_lines), w.faulty_lines)
