"""Forecast, colour and churn plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import churn as ch
from ..operators import colors as co
from ..operators import forecast as fc
from ..session import cut
from ..sources.warehouse import export_csv, read_export
from .registry import Registry
from .star import AS_OF, QUARTER, WITH_FACT, YEAR, Warehouse, run_folder

reg = Registry()
OLD, NEW = YEAR - 1, YEAR
MONTHS = [f"{YEAR}-04", f"{YEAR}-05", f"{YEAR}-06"]
MILLION = 1e6
GROUP = ["order_date", "group_name", "group_code", "quantity", "line_total"]


def series(w: Warehouse):
    return fc.monthly_series(w.fact(*GROUP), ["group_name", "group_code"])


def total(w: Warehouse):
    return fc.monthly_series(w.fact("order_date", "quantity", "line_total"), [])


SERIES_SQL = f"""ser AS (SELECT date_trunc('month', order_date)::DATE AS ds, coalesce(group_name, 'Chưa phân loại') AS group_name,
 group_code, sum(line_total)::DOUBLE AS revenue, sum(quantity)::DOUBLE AS quantity FROM fact GROUP BY 1, 2, 3),
tot AS (SELECT date_trunc('month', order_date)::DATE AS ds, sum(line_total)::DOUBLE AS revenue, sum(quantity)::DOUBLE AS quantity
 FROM fact GROUP BY 1),
pr AS (SELECT month(ds) AS m, sum(revenue) FILTER (year(ds) = {OLD}) AS b, sum(revenue) FILTER (year(ds) = {NEW}) AS a FROM tot
 WHERE quarter(ds) = {QUARTER} AND year(ds) IN ({OLD}, {NEW}) GROUP BY 1),
gr AS (SELECT count(*) AS pairs, coalesce(median((a - b) / b), 0.15::DOUBLE) AS growth FROM pr WHERE a > 0 AND b > 0),
base AS (SELECT coalesce(avg(revenue), 0) * (1 + (SELECT growth FROM gr) * 0.5::DOUBLE) AS base FROM tot
 WHERE year(ds) = {NEW} AND quarter(ds) = {QUARTER}),
fcst AS (SELECT ds, greatest(base * wt, 0) AS total FROM base, (VALUES ('{MONTHS[0]}', 0.95::DOUBLE), ('{MONTHS[1]}', 1.05::DOUBLE),
 ('{MONTHS[2]}', 1.0::DOUBLE)) t(ds, wt)),
sh0 AS (SELECT group_name, sum(CASE WHEN year(ds) = {NEW} AND quarter(ds) = {QUARTER} THEN revenue ELSE 0 END) AS q FROM ser GROUP BY 1),
shr AS (SELECT group_name, q / greatest((SELECT sum(q) FROM sh0), 1) AS share FROM sh0),
alloc AS (SELECT group_name, ds, round_even(total * share, 0) AS yhat, round_even(total * share * 0.8::DOUBLE, 0) AS lower,
 round_even(total * share * 1.2::DOUBLE, 0) AS upper FROM fcst, shr)"""
WITH_SERIES = f"{WITH_FACT}, {SERIES_SQL}"


@reg.plan(
    "fc_01_monthly_series",
    f"{WITH_SERIES} SELECT strftime(ds, '%Y-%m-%d') AS ds, group_name, group_code, revenue, quantity FROM ser",
)
def _(w: Warehouse):
    return series(w)


@reg.plan("fc_01_monthly_total", f"{WITH_SERIES} SELECT strftime(ds, '%Y-%m-%d') AS ds, revenue, quantity FROM tot")
def _(w: Warehouse):
    return total(w)


@reg.plan(
    "fc_02_yoy_growth",
    f"{WITH_SERIES} SELECT pairs, round(growth, 9) AS growth, round(growth * 0.5::DOUBLE, 9) AS damped_growth FROM gr",
)
def _(w: Warehouse):
    g = fc.yoy_growth(total(w), QUARTER, OLD, NEW)
    return g.select("pairs", F.round("growth", 9).alias("growth"), F.round("damped_growth", 9).alias("damped_growth"))


def forecast(w: Warehouse):
    return fc.yoy_forecast(total(w), QUARTER, OLD, NEW, MONTHS)


@reg.plan("fc_03_yoy_forecast", f"{WITH_SERIES} SELECT ds, round(total, 2) AS total FROM fcst")
def _(w: Warehouse):
    return forecast(w).select("ds", F.round("total", 2).alias("total"))


def shares(w: Warehouse):
    return fc.group_shares(series(w), QUARTER, NEW)


def allocated(w: Warehouse):
    return fc.allocate_forecast(forecast(w), shares(w))


@reg.plan("fc_04_allocate_forecast", f"{WITH_SERIES} SELECT * FROM alloc")
def _(w: Warehouse):
    return allocated(w)


STEP2 = "round_even(round_even(round_even({0}, 2) + {1}, 2) + {2}, 2)"


@reg.plan(
    "fc_04_allocated_totals",
    f"""{WITH_SERIES}, p AS (SELECT group_name, max(total * share / 1000000) FILTER (ds = '{MONTHS[0]}') AS a,
 max(total * share / 1000000) FILTER (ds = '{MONTHS[1]}') AS b, max(total * share / 1000000) FILTER (ds = '{MONTHS[2]}') AS c
 FROM fcst, shr GROUP BY group_name) SELECT group_name, {STEP2.format("a", "b", "c")} AS total FROM p""",
)
def _(w: Warehouse):
    return fc.allocated_totals(forecast(w), shares(w), MILLION)


def holt_sql(name: str, rows: str) -> str:
    """Tables for the smoothing of ``rows`` (``key, ds, y``): every pair of weights is carried from month to month."""
    return f"""{name}_y AS (SELECT key, list(y ORDER BY ds) AS y FROM ({rows}) GROUP BY key HAVING count(*) >= 2),
{name}_s AS (SELECT key, y, a.i / 20::DOUBLE AS alpha, b.i / 20::DOUBLE AS beta, 2 AS step, y[1] AS level, y[2] - y[1] AS trend,
 0::DOUBLE AS sse FROM {name}_y, (SELECT unnest(range(1, 20)) AS i) a, (SELECT unnest(range(1, 20)) AS i) b UNION ALL
 SELECT key, y, alpha, beta, step + 1, nl, beta * (nl - level) + (1 - beta) * {fc.PHI}::DOUBLE * trend, sse + (y[step] - ahead) * (y[step] - ahead)
 FROM (SELECT *, alpha * y[step] + (1 - alpha) * ahead AS nl FROM (SELECT *, level + {fc.PHI}::DOUBLE * trend AS ahead FROM {name}_s
 WHERE step <= len(y)))),
{name} AS (SELECT key, e.forecast AS forecast, e.alpha AS alpha, e.beta AS beta, e.sse AS sse FROM (SELECT key, min(struct_pack(sse := sse,
 alpha := alpha, beta := beta, forecast := level + {fc.PHI}::DOUBLE * trend)) AS e FROM {name}_s WHERE step > len(y) GROUP BY key))"""


WITH_HOLT = WITH_SERIES.replace("WITH ", "WITH RECURSIVE ", 1)


@reg.plan(
    "fc_05_holt",
    f"""{WITH_HOLT}, {holt_sql("h", "SELECT group_name AS key, ds, revenue AS y FROM ser")}
 SELECT key AS group_name, forecast, alpha, beta, sse FROM h""",
)
def _(w: Warehouse):
    return fc.holt(series(w), ["group_name"])


@reg.plan(
    "fc_06_backtest",
    f"""{WITH_HOLT}, edge AS (SELECT max(ds) AS held, count(*) AS n FROM tot),
bef AS (SELECT * FROM tot WHERE ds < (SELECT held FROM edge)), {holt_sql("h", "SELECT 1 AS key, ds, revenue AS y FROM bef")},
g AS (SELECT group_name, coalesce(sum(revenue) FILTER (ds = (SELECT held FROM edge)), 0) AS a,
 coalesce(sum(revenue) FILTER (ds = (SELECT max(ds) FROM bef)), 0) AS p FROM ser GROUP BY 1),
q AS (SELECT *, (SELECT forecast FROM h) * p / (SELECT greatest(sum(p), 1) FROM g) AS predicted FROM g)
SELECT group_name, round_even(a / 1000000, 2) AS actual, round_even(predicted / 1000000, 2) AS predicted,
 round_even(least(CASE WHEN a > 0 THEN abs(a - predicted) / greatest(a, 1) * 100 ELSE {fc.APE_CAP} END, {fc.APE_CAP}), 1)::DOUBLE AS mape_pct
 FROM q WHERE (SELECT n FROM edge) >= 4""",
)
def _(w: Warehouse):
    return fc.backtest(total(w), series(w), MILLION)


@reg.plan(
    "fc_07_flat_forecast",
    f"""{WITH_SERIES}, m AS (SELECT avg(revenue) AS total FROM (SELECT revenue FROM tot ORDER BY ds DESC LIMIT 3))
 SELECT ds, round(m.total, 2) AS total FROM m, (VALUES ('{MONTHS[0]}'), ('{MONTHS[1]}'), ('{MONTHS[2]}')) t(ds)""",
)
def _(w: Warehouse):
    flat = fc.flat_forecast(total(w), MONTHS)
    broken = forecast(w).withColumn("total", F.lit(float("nan")))
    return fc.forecast_or_flat(broken, flat).select("ds", F.round("total", 2).alias("total"))


SKU = ["fiscal_year", "fiscal_quarter", "product_code", "product_name", "color", "line_name", "group_name", "quantity", "line_total"]


@reg.plan(
    "fc_08_sku_projection",
    f"""{WITH_SERIES} SELECT product_code, product_name, color, line_name, group_name, sum(quantity)::DOUBLE AS total_qty,
 sum(line_total)::DOUBLE AS total_revenue, round_even(sum(line_total)::DOUBLE / (SELECT sum(line_total)::DOUBLE FROM fact
 WHERE fiscal_year = {NEW} AND fiscal_quarter = {QUARTER}) * (SELECT sum(total) FROM fcst) / 1000000, 2) AS projected
 FROM fact WHERE fiscal_year = {NEW} AND fiscal_quarter = {QUARTER} GROUP BY product_code, product_name, color, line_name, group_name
 ORDER BY total_revenue DESC, product_code LIMIT 20""",
)
def _(w: Warehouse):
    return fc.sku_projection(w.fact(*SKU), forecast(w), NEW, QUARTER, unit=MILLION)


@reg.plan(
    "fc_09_forecast_bands",
    f"""{WITH_SERIES} SELECT ds, floor(sum(yhat) / 1000000 * 10 + 0.5::DOUBLE) / 10 AS yhat,
 floor(sum(lower) / 1000000 * 10 + 0.5::DOUBLE) / 10 AS lower, floor(sum(upper) / 1000000 * 10 + 0.5::DOUBLE) / 10 AS upper
 FROM alloc GROUP BY ds""",
)
def _(w: Warehouse):
    return fc.forecast_bands(allocated(w), MILLION)


@reg.plan(
    "fc_09_forecast_timeline",
    f"""{WITH_SERIES}, past AS (SELECT group_name, strftime(ds, '%Y-%m') AS ds, sum(revenue) AS v FROM ser GROUP BY 1, 2)
 SELECT coalesce(p.group_name, a.group_name) AS group_name, coalesce(p.ds, a.ds) AS ds, coalesce(v, yhat) AS value, lower, upper,
 v IS NULL AS is_forecast FROM past p FULL JOIN alloc a ON a.group_name = p.group_name AND a.ds = p.ds""",
)
def _(w: Warehouse):
    return fc.forecast_timeline(series(w), allocated(w))


# -------------------------------------------------------------------------------------------- colours


@reg.plan(
    "col_01_color_monthly",
    f"""{WITH_FACT} SELECT fiscal_year, fiscal_month, color, sum(quantity)::DOUBLE AS qty, sum(line_total)::DOUBLE AS revenue
 FROM fact WHERE color IS NOT NULL GROUP BY ALL""",
)
def _(w: Warehouse):
    return co.color_monthly(w.fact("fiscal_year", "fiscal_month", "color", "quantity", "line_total"))


TREND_SQL = f"""c0 AS (SELECT color, sum(CASE WHEN fiscal_year = {OLD} THEN quantity ELSE 0 END)::DOUBLE AS q0,
 sum(CASE WHEN fiscal_year = {NEW} THEN quantity ELSE 0 END)::DOUBLE AS q1 FROM fact WHERE color IS NOT NULL
 AND fiscal_quarter = {QUARTER} AND fiscal_year IN ({OLD}, {NEW}) GROUP BY color),
trend AS (SELECT color, round_even(q0, 0)::BIGINT AS qty_old, round_even(q1, 0)::BIGINT AS qty_new,
 CASE WHEN q0 > 0 THEN round_even((q1 - q0) / greatest(q0, 1) * 100, 1) END AS yoy_pct,
 round_even(q1 / greatest((SELECT sum(q1) FROM c0), 1) * 100, 1) AS pct_of_quarter FROM c0)"""


def trend(w: Warehouse):
    return co.color_trend(w.fact("fiscal_year", "fiscal_quarter", "color", "quantity"), QUARTER, OLD, NEW)


@reg.plan("col_02_color_trend", f"{WITH_FACT}, {TREND_SQL} SELECT * FROM trend")
def _(w: Warehouse):
    return trend(w)


@reg.plan(
    "col_03_color_mix",
    f"""{WITH_FACT}, {TREND_SQL}, m AS (SELECT *, round_even(qty_new * (1 + coalesce(yoy_pct, 0) / 100) * 1.2::DOUBLE, 0)::BIGINT
 AS projected_qty FROM trend) SELECT color, projected_qty, round_even(projected_qty /
 greatest((SELECT sum(qty_new) FROM trend)::DOUBLE * 1.2::DOUBLE, 1) * 100, 1) AS projected_pct,
 CASE WHEN coalesce(yoy_pct, 0) > 10 THEN 'tăng' WHEN coalesce(yoy_pct, 0) < -10 THEN 'giảm' ELSE 'ổn định' END AS trend,
 yoy_pct, qty_new FROM m""",
)
def _(w: Warehouse):
    return co.color_mix(trend(w))


@reg.plan(
    "col_04_color_lists",
    f"""{WITH_FACT}, {TREND_SQL} (SELECT 'growing' AS side, color, qty_new FROM trend WHERE coalesce(yoy_pct, 0) > 10
 ORDER BY qty_new DESC, color LIMIT 5) UNION ALL (SELECT 'declining', color, qty_new FROM trend
 WHERE coalesce(yoy_pct, 0) < -10 ORDER BY qty_new DESC, color LIMIT 5)""",
)
def _(w: Warehouse):
    return co.color_lists(trend(w))


SLOW_SQL = f"""SELECT product_code, product_name, color, line_name, group_name, sum(quantity)::DOUBLE AS total_qty,
 sum(line_total)::DOUBLE AS total_revenue, strftime(max(order_date), '%Y-%m-%d') AS last_sale_date,
 DATE '{AS_OF}' - max(order_date) AS days_no_sale FROM fact GROUP BY product_code, product_name, color, line_name, group_name
 HAVING sum(quantity) < 400 OR max(order_date) < DATE '2001-04-01'"""
SLOW = ["product_code", "product_name", "color", "line_name", "group_name", "order_date", "quantity", "line_total"]


@reg.plan("col_05_slow_movers", f"{WITH_FACT} {SLOW_SQL} ORDER BY days_no_sale DESC, total_qty, product_code LIMIT 50")
def _(w: Warehouse):
    return co.slow_movers(w.fact(*SLOW), AS_OF, "2001-04-01", 400)


@reg.plan("col_05_slow_movers_all", f"{WITH_FACT} {SLOW_SQL}")
def _(w: Warehouse):
    return co.slow_movers(w.fact(*SLOW), AS_OF, "2001-04-01", 400, n=None)


# ---------------------------------------------------------------------------------------------- churn

CHURN = ["customer_code", "customer_name", "province_name", "region", "order_date", "so_number", "line_total"]
SINCE = "2001-05-01"
INTERVAL_SQL = """iv AS (SELECT customer_code, avg(d) AS avg_interval_days FROM (SELECT customer_code,
 order_date - lag(order_date) OVER (PARTITION BY customer_code ORDER BY order_date) AS d
 FROM (SELECT DISTINCT customer_code, order_date FROM fact)) WHERE d IS NOT NULL GROUP BY customer_code)"""
FEATURE_SQL = f"""{INTERVAL_SQL}, feat0 AS (SELECT customer_code, max(customer_name) AS customer_name,
 max(province_name) AS province_name, max(region) AS region, DATE '{AS_OF}' - max(order_date) AS recency_days,
 count(DISTINCT so_number) AS frequency, sum(line_total)::DOUBLE AS monetary,
 count(DISTINCT CASE WHEN order_date >= DATE '{SINCE}' THEN so_number END) AS freq_90d,
 coalesce(sum(CASE WHEN order_date >= DATE '{SINCE}' THEN line_total END), 0)::DOUBLE AS mon_90d,
 count(DISTINCT date_trunc('month', order_date)) AS months_active,
 coalesce(sum(CASE WHEN fiscal_year = {NEW} AND fiscal_quarter = {QUARTER} THEN line_total END), 0)::DOUBLE AS q1,
 coalesce(sum(CASE WHEN fiscal_year = {OLD} AND fiscal_quarter = {QUARTER} THEN line_total END), 0)::DOUBLE AS q0
 FROM fact GROUP BY customer_code),
feat AS (SELECT f.* EXCLUDE (q0, q1), monetary / frequency AS avg_order_value, coalesce(avg_interval_days, 999) AS avg_interval_days,
 CASE WHEN q0 > 0 THEN round(100.0 * (q1 - q0) / q0, 1) ELSE 0 END AS qoq_pct FROM feat0 f
 LEFT JOIN iv ON iv.customer_code = f.customer_code)"""


def features(w: Warehouse):
    return ch.churn_features(w.fact(*CHURN), AS_OF, SINCE, QUARTER, OLD, NEW)


@reg.plan("chn_01_order_intervals", f"{WITH_FACT}, {INTERVAL_SQL} SELECT * FROM iv")
def _(w: Warehouse):
    return ch.order_intervals(w.fact("customer_code", "order_date"))


@reg.plan("chn_02_churn_features", f"{WITH_FACT}, {FEATURE_SQL} SELECT * FROM feat")
def _(w: Warehouse):
    return features(w)


@reg.plan(
    "chn_03_churn_label",
    f"""{WITH_FACT}, {FEATURE_SQL} SELECT customer_code, {", ".join(f"{c}::DOUBLE AS {c}" for c in ch.FEATURES)},
 CASE WHEN recency_days > 45 THEN 1 ELSE 0 END AS is_churned FROM feat""",
)
def _(w: Warehouse):
    return ch.churn_label(features(w)).select("customer_code", *ch.FEATURES, "is_churned")


def model(w: Warehouse):
    """Trained on the data as it is at the call."""
    return ch.fit_churn(ch.churn_label(features(w)))


def scored(w: Warehouse, model):
    return ch.score_churn(model, ch.churn_label(features(w)))


# models have no SQL form: rows only here, invariants in the tests
@reg.plan("chn_04_fit_churn")
def _(w: Warehouse):
    importances = model(w).stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(ch.FEATURES, importances)]
    return w.spark.createDataFrame(rows, "feature string, importance double")


@reg.plan("chn_05_churn_cv")
def _(w: Warehouse):
    return ch.churn_cv(ch.churn_label(features(w)))


@reg.plan("chn_06_score_churn")
def _(w: Warehouse):
    return scored(w, model(w)).select("customer_code", "is_churned", "churn_proba", "churn_segment")


@reg.plan("chn_07_churn_priority")
def _(w: Warehouse):
    return ch.churn_priority(scored(w, model(w)))


@reg.plan(
    "chn_07_priority_of_recency",
    f"""{WITH_FACT}, {FEATURE_SQL}, p AS (SELECT customer_code, least(recency_days, 1000) / 10::DOUBLE AS churn_proba,
 (rank() OVER (ORDER BY monetary) + (count(*) OVER (PARTITION BY monetary) - 1) / 2) / (count(*) OVER ())::DOUBLE * 100 AS pct
 FROM feat) SELECT customer_code, churn_proba, round_even(100 - churn_proba, 1) AS prob_order_30d,
 round_even(pct * churn_proba / 100, 1) AS priority_score FROM p""",
)
def _(w: Warehouse):
    # the ranking part of the operator, checked with a probability that SQL can state
    proba = F.least(F.col("recency_days"), F.lit(1000)) / F.lit(10.0)
    frame = features(w).withColumns({"churn_proba": proba, "churn_segment": F.lit("x")})
    return ch.churn_priority(frame).select("customer_code", "churn_proba", "prob_order_30d", "priority_score")


# what follows a model, checked with a probability that SQL can state
RECENCY_SQL = f"""{WITH_FACT}, {FEATURE_SQL}, known AS (SELECT *, least(recency_days, 100)::DOUBLE AS churn_proba,
 (rank() OVER (ORDER BY monetary) + (count(*) OVER (PARTITION BY monetary) - 1) / 2) / (count(*) OVER ())::DOUBLE * 100 AS pct,
 CASE WHEN recency_days <= 0 THEN NULL WHEN recency_days <= 30 THEN 'Ổn định' WHEN recency_days <= 50 THEN 'Theo dõi'
 WHEN recency_days <= 70 THEN 'Cảnh báo' ELSE 'Nguy hiểm' END AS churn_segment FROM feat)"""


def by_recency(w: Warehouse):
    days = F.least(F.col("recency_days"), F.lit(100))
    return features(w).withColumns({"churn_proba": days.cast("double"), "churn_segment": ch.band_of(days / F.lit(100.0))})


@reg.plan(
    "chn_05_folds",
    f"""{WITH_FACT}, {FEATURE_SQL}, lab AS (SELECT customer_code, CASE WHEN recency_days > 45 THEN 1 ELSE 0 END AS is_churned FROM feat)
 SELECT customer_code, is_churned, (row_number() OVER (ORDER BY is_churned, customer_code) % {ch.FOLDS})::INTEGER AS fold FROM lab""",
)
def _(w: Warehouse):
    return ch.with_folds(ch.churn_label(features(w))).select("customer_code", "is_churned", "fold")


@reg.plan("chn_08_bands_of_recency", f"{RECENCY_SQL} SELECT churn_segment, count(*) AS dealers FROM known GROUP BY 1")
def _(w: Warehouse):
    return ch.churn_bands(by_recency(w))


@reg.plan(
    "src_11_high_risk_stored",
    f"""{RECENCY_SQL} SELECT customer_code, customer_name, province_name, region, recency_days, frequency, churn_proba,
 round_even(100 - churn_proba, 1) AS prob_order_30d, round_even(pct * churn_proba / 100, 1) AS priority_score, churn_segment
 FROM known WHERE churn_proba > {ch.HIGH_RISK_PCT}""",
)
def _(w: Warehouse):
    calls, folder = cut(ch.high_risk(ch.churn_priority(by_recency(w)))), run_folder(w)
    export_csv({"high_risk": calls}, folder)
    return calls if calls.isEmpty() else read_export(w.spark, folder, "high_risk", calls.schema)


@reg.plan("chn_08_churn_bands")
def _(w: Warehouse):
    return ch.churn_bands(scored(w, model(w)))


@reg.plan("src_11_high_risk_export")
def _(w: Warehouse):
    return ch.high_risk(ch.churn_priority(scored(w, model(w))))
