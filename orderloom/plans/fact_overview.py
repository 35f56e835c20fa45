"""Fact table and overview plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fact as fa
from ..operators import overview as ov
from ..operators.fact import Star, flatten
from ..sources.sales_store import SalesStore, write_by_month
from .registry import Registry
from .star import AS_OF, MONTH, PREV_MONTH, PREV_YEAR, QUARTER, WITH_FACT, WITH_LOG, YEAR, Warehouse, run_folder

reg = Registry()

FACT_OUT = """strftime(order_date, '%Y-%m-%d') AS order_date, fiscal_year::BIGINT AS fiscal_year,
 fiscal_quarter::BIGINT AS fiscal_quarter, fiscal_month::BIGINT AS fiscal_month, week_of_year::BIGINT AS week_of_year,
 so_number, order_id, line_id, customer_code, customer_name, province_id::BIGINT AS province_id, province_name,
 region, product_code, product_name, color, line_id_fk, line_name, group_code, group_name,
 quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price, line_total::DOUBLE AS line_total"""


@reg.plan("fact_01_build_fact", f"{WITH_FACT} SELECT {FACT_OUT} FROM fact")
def _(w: Warehouse):
    return fa.flatten(w.snowflake)


@reg.plan(
    "fact_02_with_calendar",
    """SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
 year(o_orderdate) AS fiscal_year, quarter(o_orderdate) AS fiscal_quarter, month(o_orderdate) AS fiscal_month,
 weekofyear(o_orderdate) AS week_of_year FROM orders""",
)
def _(w: Warehouse):
    return fa.with_calendar(w.sales_order.select("order_id", "order_date"))


@reg.plan(
    "fact_03_refresh_fact",
    f"{WITH_FACT} SELECT {FACT_OUT} FROM fact WHERE order_id % 400 <> 1",
)
def _(w: Warehouse):
    # orders with key % 400 = 1 are in the fact table already, next to one row whose line_id is NULL
    loaded = w.order_line.where("order_id % 400 = 1").selectExpr("line_id")
    broken = w.order_line.where("order_id = 2").selectExpr("CAST(NULL AS STRING) AS line_id")
    return fa.refresh(loaded.union(broken), w.star)


@reg.plan("fact_01_store_fact", f"{WITH_FACT} SELECT {FACT_OUT} FROM fact")
def _(w: Warehouse):
    return SalesStore(run_folder(w), w.snowflake, w.partitions).create().fact()


@reg.plan(
    "fact_03_refresh_stored",
    f"""{WITH_FACT}, stored AS (SELECT * FROM fact UNION ALL BY NAME
 SELECT * REPLACE (CAST(NULL AS VARCHAR) AS line_id) FROM fact WHERE order_id = 2) SELECT {FACT_OUT} FROM stored""",
)
def _(w: Warehouse):
    # one line in seven is stored, next to rows whose line_id is NULL; the refresh of all lines runs twice
    part = Star(**{**w.star.__dict__, "order_line": w.order_line.where("product_code % 7 = 1")})
    lines, late = w.raw
    store = SalesStore(run_folder(w), part, w.partitions, (lines.where("product_code % 7 = 1"), late)).create()
    broken = flatten(Star(**{**w.star.__dict__, "order_line": w.order_line.where("order_id = 2")}))
    write_by_month(broken.withColumn("line_id", F.lit(None).cast("string")), f"{store.root}/fact")
    store.refresh(w.star, raw=w.raw)
    if store.refresh(w.star, raw=w.raw):
        raise RuntimeError("a second refresh appended rows")
    return store.fact()


MONTH_REPORT = """SELECT fiscal_year::BIGINT AS fiscal_year, fiscal_month::BIGINT AS fiscal_month, count(*) AS rows,
 count(DISTINCT so_number) AS orders, sum(line_total)::DOUBLE AS revenue FROM fact GROUP BY ALL"""


@reg.plan("fact_04_fact_report", f"{WITH_FACT} {MONTH_REPORT}")
def _(w: Warehouse):
    return fa.month_report(w.fact("fiscal_year", "fiscal_month", "so_number", "line_total"))


ACTIVITY_SQL = f"""activity AS (SELECT customer_code, customer_name, province_name, region,
 count(DISTINCT so_number) AS total_orders, sum(line_total) AS total_revenue, min(order_date) AS first_order_date,
 max(order_date) AS last_order_date, DATE '{AS_OF}' - max(order_date) AS days_since_last_order
 FROM fact GROUP BY ALL)"""
ACTIVITY_COLS = ["customer_code", "customer_name", "province_name", "region", "so_number", "line_total", "order_date"]


@reg.plan(
    "fact_05_customer_activity",
    f"""{WITH_FACT}, {ACTIVITY_SQL} SELECT customer_code, customer_name, province_name, region, total_orders,
 total_revenue::DOUBLE AS total_revenue, strftime(first_order_date, '%Y-%m-%d') AS first_order_date,
 strftime(last_order_date, '%Y-%m-%d') AS last_order_date, days_since_last_order FROM activity""",
)
def _(w: Warehouse):
    return fa.customer_activity(w.fact(*ACTIVITY_COLS), AS_OF)


@reg.plan(
    "fact_06_monthly_by_group",
    f"""{WITH_FACT} SELECT fiscal_year, fiscal_month, group_code, group_name, count(DISTINCT so_number) AS order_count,
 sum(quantity)::DOUBLE AS total_qty, sum(line_total)::DOUBLE AS total_revenue,
 round(sum(line_total)::DOUBLE / sum(quantity)::DOUBLE, 2) AS avg_unit_price FROM fact
 GROUP BY fiscal_year, fiscal_month, group_code, group_name""",
)
def _(w: Warehouse):
    return fa.monthly_by_group(
        w.fact("fiscal_year", "fiscal_month", "group_code", "group_name", "so_number", "quantity", "line_total")
    )


KPI_LOG = """SELECT count(*) AS total_emails, count(*) FILTER (processing_status = 'LOADED') AS loaded_ok,
 count(*) FILTER (processing_status = 'FAILED') AS failed,
 count(*) FILTER (processing_status = 'DUPLICATE') AS duplicates,
 round(100.0 * count(*) FILTER (processing_status = 'LOADED') / nullif(count(*), 0), 2) AS pass_rate_pct,
 round(avg((epoch_us(processed_at) - epoch_us(received_at)) / 1000000.0), 2) AS avg_processing_seconds FROM mail"""


@reg.plan("fact_07_email_kpi", f"{WITH_LOG} {KPI_LOG}")
def _(w: Warehouse):
    return fa.email_kpi(w.email_log)


@reg.plan(
    "fact_08_run_summary",
    f"""{WITH_LOG}, k AS ({KPI_LOG}) SELECT 'status' AS section, processing_status AS name,
 count(*)::DOUBLE AS value FROM mail GROUP BY ALL UNION ALL
 SELECT 'kpi', name, value FROM (SELECT total_emails::DOUBLE AS total_emails, loaded_ok::DOUBLE AS loaded_ok,
 failed::DOUBLE AS failed, duplicates::DOUBLE AS duplicates, pass_rate_pct, avg_processing_seconds FROM k)
 UNPIVOT (value FOR name IN (total_emails, loaded_ok, failed, duplicates, pass_rate_pct, avg_processing_seconds))""",
)
def _(w: Warehouse):
    return fa.run_summary(w.email_log)


# ---------------------------------------------------------------------------------------- overview

MONTHLY_SQL = """monthly AS (SELECT fiscal_year, fiscal_month, sum(line_total) AS revenue,
 count(DISTINCT so_number) AS orders, sum(quantity) AS qty, count(*) AS total_lines,
 count(DISTINCT customer_code) AS dealers,
 round(sum(line_total)::DOUBLE / nullif(sum(quantity)::DOUBLE, 0), 0) AS avg_unit_price FROM fact GROUP BY ALL)"""
BASE_COLS = ["fiscal_year", "fiscal_month", "fiscal_quarter", "so_number", "customer_code", "quantity", "line_total"]


@reg.plan(
    "ovw_01_monthly_base",
    f"""{WITH_FACT}, {MONTHLY_SQL} SELECT fiscal_year, fiscal_month, revenue::DOUBLE AS revenue, orders,
 qty::DOUBLE AS qty, total_lines, dealers, avg_unit_price FROM monthly""",
)
def _(w: Warehouse):
    return ov.monthly_base(w.fact(*BASE_COLS))


KPI_SQL = f"""{ACTIVITY_SQL}, {MONTHLY_SQL},
cur AS (SELECT * FROM monthly WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH}),
prev AS (SELECT * FROM monthly WHERE fiscal_year = {PREV_YEAR} AND fiscal_month = {PREV_MONTH}),
yoy AS (SELECT * FROM monthly WHERE fiscal_year = {YEAR - 1} AND fiscal_month = {MONTH}),
q AS (SELECT sum(line_total) AS revenue_q, count(DISTINCT so_number) AS orders_q FROM fact
 WHERE fiscal_year = {YEAR} AND fiscal_quarter = {QUARTER}),
rev AS (SELECT customer_code, sum(line_total) AS r FROM fact GROUP BY customer_code),
ranked AS (SELECT r, rank() OVER (ORDER BY r DESC) AS rnk, count(*) OVER () AS n, sum(r) OVER () AS t FROM rev),
pareto AS (SELECT round(100.0 * (sum(r)::DOUBLE / max(t)::DOUBLE), 1) AS pct FROM ranked WHERE rnk <= ceil(n * 0.2)),
kpi AS (SELECT cur.revenue::DOUBLE AS revenue, cur.orders, cur.qty::DOUBLE AS qty, cur.dealers,
 round(cur.revenue::DOUBLE / nullif(cur.dealers, 0), 0) AS avg_per_dealer, cur.avg_unit_price,
 round(cur.total_lines::DOUBLE / nullif(cur.orders, 0), 1) AS lines_per_order,
 round(100.0 * (cur.revenue::DOUBLE - prev.revenue::DOUBLE) / nullif(prev.revenue::DOUBLE, 0), 1) AS mom_revenue_pct,
 round(100.0 * (cur.orders - prev.orders)::DOUBLE / nullif(prev.orders, 0), 1) AS mom_orders_pct,
 round(100.0 * (cur.revenue::DOUBLE - yoy.revenue::DOUBLE) / nullif(yoy.revenue::DOUBLE, 0), 1) AS yoy_revenue_pct,
 (SELECT count(*) FROM activity WHERE days_since_last_order <= 45) AS active_dealers,
 (SELECT pct FROM pareto) AS pareto_top20_pct, (SELECT revenue_q::DOUBLE FROM q) AS revenue_q1,
 (SELECT orders_q FROM q) AS orders_q1 FROM cur, prev, yoy)"""


def kpi_row(w: Warehouse):
    f = w.fact("order_date", *BASE_COLS)
    return ov.kpi(f, (YEAR, MONTH), (PREV_YEAR, PREV_MONTH), (YEAR - 1, MONTH), (YEAR, QUARTER), AS_OF)


@reg.plan("ovw_02_kpi", f"{WITH_FACT}, {KPI_SQL} SELECT * FROM kpi")
def _(w: Warehouse):
    return kpi_row(w)


@reg.plan(
    "ovw_03_active_dealers",
    f"""{WITH_FACT}, {ACTIVITY_SQL} SELECT count(*) AS active_dealers FROM activity
 WHERE days_since_last_order <= 45""",
)
def _(w: Warehouse):
    return ov.active_dealers(w.fact("customer_code", "order_date"), AS_OF)


@reg.plan(
    "ovw_04_quarter_totals",
    f"{WITH_FACT}, {KPI_SQL} SELECT revenue_q::DOUBLE AS revenue_q, orders_q FROM q",
)
def _(w: Warehouse):
    return ov.quarter_totals(w.fact(*BASE_COLS), YEAR, QUARTER)


@reg.plan("ovw_05_pareto_share", f"{WITH_FACT}, {KPI_SQL} SELECT pct AS pareto_top_pct FROM pareto")
def _(w: Warehouse):
    return ov.pareto_share(w.fact("customer_code", "line_total"))


GROUP_REV_SQL = f"""gr AS (SELECT coalesce(group_name, 'Chưa phân loại') AS group_name, sum(line_total) AS revenue,
 sum(quantity) AS quantity FROM fact WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH} GROUP BY ALL),
grp AS (SELECT group_name, revenue::DOUBLE AS revenue, quantity::DOUBLE AS quantity,
 round_even(revenue::DOUBLE / (SELECT sum(revenue)::DOUBLE FROM gr) * 100, 1) AS pct FROM gr)"""
GROUP_COLS = ["fiscal_year", "fiscal_month", "group_name", "quantity", "line_total"]


@reg.plan("ovw_06_group_revenue", f"{WITH_FACT}, {GROUP_REV_SQL} SELECT * FROM grp")
def _(w: Warehouse):
    return ov.group_revenue(w.fact(*GROUP_COLS), YEAR, MONTH)


@reg.plan(
    "ovw_07_sparkline",
    f"""{WITH_FACT} SELECT fiscal_year, fiscal_month, strftime(date_trunc('month', min(order_date)), '%m/%Y') AS label,
 sum(line_total)::DOUBLE AS revenue FROM fact GROUP BY fiscal_year, fiscal_month""",
)
def _(w: Warehouse):
    return ov.sparkline(w.fact("fiscal_year", "fiscal_month", "order_date", "line_total"))


@reg.plan(
    "ovw_08_target_attainment",
    f"""{WITH_FACT}, {KPI_SQL} SELECT
 floor(revenue / nullif(revenue_q1 * 1.1::DOUBLE / 3, 0) * 100 + 0.5)::BIGINT AS revenue_vs_target,
 floor(orders / nullif(orders_q1 * 1.05::DOUBLE / 3, 0) * 100 + 0.5)::BIGINT AS orders_vs_target,
 floor(active_dealers / nullif(dealers * 0.85::DOUBLE, 0) * 100 + 0.5)::BIGINT AS active_vs_target FROM kpi""",
)
def _(w: Warehouse):
    return ov.target_attainment(kpi_row(w))


@reg.plan(
    "ovw_09_overview_insights",
    f"""{WITH_FACT}, {KPI_SQL}, {GROUP_REV_SQL} SELECT (SELECT arg_max(group_name, revenue) FROM grp) AS top_group,
 (SELECT arg_max(pct, revenue) FROM grp) AS top_group_pct, active_dealers, dealers - active_dealers AS silent_dealers,
 round(active_dealers / nullif(dealers::DOUBLE, 0) * 100, 0) AS active_pct,
 floor(dealers * 0.2::DOUBLE + 0.5)::BIGINT AS top20_dealers FROM kpi""",
)
def _(w: Warehouse):
    return ov.overview_insights(kpi_row(w), ov.group_revenue(w.fact(*GROUP_COLS), YEAR, MONTH))
