"""Time, product, dealer, geography and operations plans."""

from __future__ import annotations

from ..operators import dealers as de
from ..operators import fact as fa
from ..operators import geography as ge
from ..operators import operations as op
from ..operators import products as pr
from ..operators import timeline as ti
from .fact_overview import ACTIVITY_COLS, ACTIVITY_SQL
from .registry import Registry
from .star import AS_OF, LOG_SQL, MONTH, QUARTER, WITH_FACT, WITH_LOG, YEAR, Warehouse

reg = Registry()
NONE = "Chưa phân loại"
GROUPS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
COLORS = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
OLD, NEW = YEAR - 1, YEAR
Q_OLD = f"CASE WHEN fiscal_year = {OLD} AND fiscal_quarter = {QUARTER} THEN line_total END"
Q_NEW = f"CASE WHEN fiscal_year = {NEW} AND fiscal_quarter = {QUARTER} THEN line_total END"
PAIR = f"sum({Q_OLD})::DOUBLE AS q_old, sum({Q_NEW})::DOUBLE AS q_new"
YOY = "round(100.0 * (q_new - q_old) / nullif(q_old, 0), 1)"

# -------------------------------------------------------------------------------------------- time


@reg.plan(
    "tim_01_monthly_group",
    f"""{WITH_FACT} SELECT fiscal_year, fiscal_month, strftime(date_trunc('month', min(order_date)), '%Y-%m-%d') AS period,
 coalesce(group_name, '{NONE}') AS group_name, sum(line_total)::DOUBLE AS revenue, sum(quantity)::DOUBLE AS quantity,
 count(DISTINCT so_number) AS orders FROM fact GROUP BY fiscal_year, fiscal_month, fact.group_name""",
)
def _(w: Warehouse):
    return ti.monthly_group(
        w.fact("fiscal_year", "fiscal_month", "order_date", "group_name", "so_number", "quantity", "line_total")
    )


YOY_SQL = f"""y0 AS (SELECT coalesce(group_name, '{NONE}') AS group_name, {PAIR} FROM fact GROUP BY fact.group_name),
yoy AS (SELECT group_name, q_old, q_new, {YOY} AS yoy_pct FROM y0)"""


def group_yoy(w: Warehouse):
    f = w.fact("fiscal_year", "fiscal_quarter", "group_name", "line_total")
    return ti.yoy(f, {"group_name": NONE}, QUARTER, OLD, NEW)


@reg.plan("tim_02_yoy", f"{WITH_FACT}, {YOY_SQL} SELECT * FROM yoy")
def _(w: Warehouse):
    return group_yoy(w)


def month_cols(w: Warehouse):
    return w.fact("fiscal_year", "fiscal_month", "order_date", "line_total")


@reg.plan(
    "tim_03_heatmap",
    f"""{WITH_FACT} SELECT fiscal_year, fiscal_month, sum(line_total)::DOUBLE AS revenue FROM fact
 GROUP BY fiscal_year, fiscal_month""",
)
def _(w: Warehouse):
    return ti.heatmap(month_cols(w))


@reg.plan(
    "tim_03_heatmap_matrix",
    f"{WITH_FACT} SELECT fiscal_year, "
    + ", ".join(f"sum(CASE WHEN fiscal_month = {m} THEN line_total END)::DOUBLE AS m{m:02d}" for m in range(1, 13))
    + " FROM fact GROUP BY fiscal_year",
)
def _(w: Warehouse):
    return ti.heatmap_matrix(month_cols(w))


MOM_SQL = """mon AS (SELECT fiscal_year, fiscal_month, strftime(date_trunc('month', min(order_date)), '%m/%Y') AS label,
 sum(line_total) AS revenue FROM fact GROUP BY fiscal_year, fiscal_month),
mom AS (SELECT label, revenue::DOUBLE AS revenue,
 coalesce(revenue - lag(revenue) OVER (ORDER BY fiscal_year, fiscal_month), 0)::DOUBLE AS mom_change FROM mon)"""


@reg.plan("tim_04_mom_waterfall", f"{WITH_FACT}, {MOM_SQL} SELECT * FROM mom")
def _(w: Warehouse):
    return ti.mom_waterfall(month_cols(w))


@reg.plan(
    "tim_05_monthly_pivot",
    f"{WITH_FACT} SELECT strftime(order_date, '%Y-%m') AS period, "
    + ", ".join(
        f"coalesce(sum(CASE WHEN group_name = '{g}' THEN line_total END)::DOUBLE, 0) AS \"{g}\"" for g in GROUPS
    )
    + " FROM fact GROUP BY 1",
)
def _(w: Warehouse):
    return ti.monthly_pivot(w.fact("order_date", "group_name", "line_total"), GROUPS)


SEASON_SQL = """hm AS (SELECT fiscal_year, fiscal_month, sum(line_total)::DOUBLE AS revenue FROM fact
 GROUP BY fiscal_year, fiscal_month), ma AS (SELECT fiscal_month, avg(revenue) AS a FROM hm GROUP BY fiscal_month),
season AS (SELECT m AS fiscal_month, CASE WHEN a > 0 THEN
 floor(a / (SELECT avg(a) FROM ma WHERE a > 0) * 100 + 0.5)::BIGINT END AS index
 FROM range(1, 13) t(m) LEFT JOIN ma ON fiscal_month = m)"""


@reg.plan("tim_06_seasonality_index", f"{WITH_FACT}, {SEASON_SQL} SELECT * FROM season")
def _(w: Warehouse):
    return ti.seasonality_index(month_cols(w))


@reg.plan(
    "tim_07_overall_growth",
    f"""{WITH_FACT}, {YOY_SQL} SELECT CASE WHEN sum(q_old) > 0 THEN
 round(100.0 * (sum(q_new) - sum(q_old)) / sum(q_old), 1) END AS overall_growth_pct FROM yoy""",
)
def _(w: Warehouse):
    return ti.overall_growth(group_yoy(w))


@reg.plan(
    "tim_08_time_insights",
    f"""{WITH_FACT}, {YOY_SQL}, {SEASON_SQL}, {MOM_SQL} SELECT
 (SELECT group_name FROM yoy ORDER BY coalesce(yoy_pct, 0) DESC, group_name DESC LIMIT 1) AS best_group,
 (SELECT group_name FROM yoy ORDER BY coalesce(yoy_pct, 0), group_name LIMIT 1) AS worst_group,
 (SELECT floor(max(q_new) / sum(q_new) * 100 + 0.5)::BIGINT FROM yoy) AS top_group_share,
 (SELECT fiscal_month FROM season WHERE index IS NOT NULL ORDER BY index DESC, fiscal_month LIMIT 1) AS peak_month,
 (SELECT fiscal_month FROM season WHERE index IS NOT NULL ORDER BY index, fiscal_month LIMIT 1) AS low_month,
 (SELECT max(index) - min(index) FROM season) AS peak_bias,
 (SELECT label FROM mom ORDER BY mom_change DESC LIMIT 1) AS gain_label, (SELECT max(mom_change) FROM mom) AS gain,
 (SELECT label FROM mom ORDER BY mom_change LIMIT 1) AS drop_label, (SELECT min(mom_change) FROM mom) AS drop""",
)
def _(w: Warehouse):
    f = month_cols(w)
    return ti.time_insights(group_yoy(w), ti.seasonality_index(f), ti.mom_waterfall(f))


# ---------------------------------------------------------------------------------------- products


@reg.plan(
    "prd_01_hierarchy",
    f"""{WITH_FACT} SELECT coalesce(group_name, '{NONE}') AS group_name, coalesce(line_name, '{NONE}') AS line_name,
 product_code, coalesce(product_name, product_code::VARCHAR) AS product_name, sum(line_total)::DOUBLE AS revenue,
 sum(quantity)::DOUBLE AS quantity FROM fact
 GROUP BY fact.group_name, fact.line_name, product_code, fact.product_name""",
)
def _(w: Warehouse):
    return pr.hierarchy(
        w.fact("group_name", "line_name", "product_code", "product_name", "quantity", "line_total")
    )


@reg.plan(
    "prd_02_hierarchy_rollup",
    f"""{WITH_FACT} SELECT group_name, line_name, product_code, sum(line_total)::DOUBLE AS revenue,
 CASE grouping(group_name, line_name, product_code) WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS level FROM fact
 GROUP BY ROLLUP (group_name, line_name, product_code) HAVING grouping(group_name) = 0""",
)
def _(w: Warehouse):
    return pr.hierarchy_rollup(w.fact("group_name", "line_name", "product_code", "line_total"))


def bcg_sql(keys: list[str]) -> str:
    label = ", ".join(f"coalesce({k}, '{NONE}') AS {k}" for k in keys)
    return f"""d AS (SELECT {label}, {PAIR}, sum(line_total)::DOUBLE AS total_rev, sum(quantity)::DOUBLE AS total_qty
 FROM fact GROUP BY {", ".join(f"fact.{k}" for k in keys)}),
e AS (SELECT *, round(100.0 * (total_rev / (SELECT sum(total_rev) FROM d)), 1) AS revenue_share_pct,
 {YOY} AS yoy_pct, (SELECT median(total_rev) FROM d) AS med FROM d),
bcg AS (SELECT * EXCLUDE (med), CASE WHEN total_rev > med AND coalesce(yoy_pct, 0) > 10 THEN 'Stars'
 WHEN total_rev > med THEN 'Cash Cows' WHEN coalesce(yoy_pct, 0) > 10 THEN 'Question Marks' ELSE 'Dogs' END
 AS quadrant FROM e)"""


def bcg(w: Warehouse, keys: list[str]):
    return pr.bcg(w.fact("fiscal_year", "fiscal_quarter", *keys, "quantity", "line_total"), keys, QUARTER, OLD, NEW)


@reg.plan("prd_03_bcg", f"{WITH_FACT}, {bcg_sql(['group_name'])} SELECT * FROM bcg")
def _(w: Warehouse):
    return bcg(w, ["group_name"])


@reg.plan("prd_04_bcg_line", f"{WITH_FACT}, {bcg_sql(['line_name', 'group_name'])} SELECT * FROM bcg")
def _(w: Warehouse):
    return bcg(w, ["line_name", "group_name"])


HEAT_SQL = """heat AS (SELECT color, line_name, sum(quantity)::DOUBLE AS total_qty, sum(line_total)::DOUBLE AS revenue
 FROM fact WHERE color IS NOT NULL AND line_name IN (SELECT line_name FROM fact WHERE line_name IS NOT NULL
 GROUP BY line_name ORDER BY sum(line_total) DESC, line_name LIMIT 20) GROUP BY ALL)"""


def heat(w: Warehouse):
    return pr.color_heatmap(w.fact("color", "line_name", "quantity", "line_total"), 20)


@reg.plan("prd_05_color_heatmap", f"{WITH_FACT}, {HEAT_SQL} SELECT * FROM heat")
def _(w: Warehouse):
    return heat(w)


@reg.plan(
    "prd_06_color_matrix",
    f"{WITH_FACT}, {HEAT_SQL} SELECT line_name, "
    + ", ".join(f"coalesce(sum(CASE WHEN color = '{c}' THEN total_qty END), 0) AS {c}" for c in COLORS)
    + " FROM heat GROUP BY line_name",
)
def _(w: Warehouse):
    return pr.color_matrix(heat(w), COLORS)


SKU_COLS = ["product_code", "product_name", "color", "line_name", "group_name", "so_number", "quantity", "line_total"]


def sku_sql(name: str, n: int, direction: str) -> str:
    return f"""{name} AS (SELECT product_code, coalesce(product_name, product_code::VARCHAR) AS product_name,
 coalesce(color, '') AS color, coalesce(line_name, '{NONE}') AS line_name, coalesce(group_name, '{NONE}') AS group_name,
 sum(quantity)::DOUBLE AS total_qty, sum(line_total)::DOUBLE AS revenue, count(DISTINCT so_number) AS orders FROM fact
 GROUP BY product_code, fact.product_name, fact.color, fact.line_name, fact.group_name
 ORDER BY revenue {direction}, product_code LIMIT {n})"""


@reg.plan("prd_07_top_sku", f"{WITH_FACT}, {sku_sql('sku', 20, 'DESC')} SELECT * FROM sku")
def _(w: Warehouse):
    return pr.top_sku(w.fact(*SKU_COLS), 20)


@reg.plan("prd_07_bottom_sku", f"{WITH_FACT}, {sku_sql('sku', 20, 'ASC')} SELECT * FROM sku")
def _(w: Warehouse):
    return pr.top_sku(w.fact(*SKU_COLS), 20, ascending=True)


@reg.plan(
    "prd_08_product_insights",
    f"""{WITH_FACT}, {bcg_sql(["group_name"])}, {HEAT_SQL}, {sku_sql("sku", 20, "DESC")} SELECT
 count(*) FILTER (quadrant = 'Stars') AS stars, count(*) FILTER (quadrant = 'Cash Cows') AS cash_cows,
 count(*) FILTER (quadrant = 'Dogs') AS dogs, count(*) FILTER (quadrant = 'Question Marks') AS question_marks,
 floor(coalesce(sum(total_rev) FILTER (quadrant = 'Cash Cows'), 0) / sum(total_rev) * 100 + 0.5)::BIGINT
 AS cash_cow_share, (SELECT product_code FROM sku ORDER BY revenue DESC, product_code DESC LIMIT 1) AS top_product,
 (SELECT floor((SELECT sum(revenue) FROM (SELECT revenue FROM sku ORDER BY revenue DESC, product_code LIMIT 3))
 / sum(revenue) * 100 + 0.5)::BIGINT FROM sku) AS top3_share,
 (SELECT color FROM heat ORDER BY total_qty DESC, color DESC, line_name DESC LIMIT 1) AS top_color,
 (SELECT floor(max(total_qty) / sum(total_qty) * 100 + 0.5)::BIGINT FROM heat) AS top_color_share FROM bcg""",
)
def _(w: Warehouse):
    return pr.product_insights(bcg(w, ["group_name"]), heat(w), pr.top_sku(w.fact(*SKU_COLS), 20))


# ----------------------------------------------------------------------------------------- dealers

DEALER_COLS = ["customer_code", "customer_name", "province_name", "region", "order_date", "so_number", "line_total"]
RFM_BASE = f"""base AS (SELECT customer_code, customer_name, province_name, region, max(order_date) AS last_order_date,
 DATE '{AS_OF}' - max(order_date) AS recency_days, count(DISTINCT so_number) AS frequency,
 sum(line_total)::DOUBLE AS monetary FROM fact GROUP BY ALL)"""


def rfm_sql(flip: str = "") -> str:
    return f"""{RFM_BASE}, s AS (SELECT *,
 {flip}ntile(5) OVER (ORDER BY recency_days, customer_code) AS r_score,
 {flip}ntile(5) OVER (ORDER BY frequency DESC, customer_code) AS f_score,
 {flip}ntile(5) OVER (ORDER BY monetary DESC, customer_code) AS m_score FROM base),
rfm AS (SELECT * REPLACE (strftime(last_order_date, '%Y-%m-%d') AS last_order_date),
 r_score + f_score + m_score AS rfm_total FROM s),
seg AS (SELECT *, CASE WHEN rfm_total IS NULL THEN 'Unknown' WHEN rfm_total >= 13 THEN 'Champions'
 WHEN rfm_total >= 10 THEN 'Loyal' WHEN rfm_total >= 7 THEN 'Promising' WHEN rfm_total >= 4 THEN 'At Risk'
 ELSE 'Lost' END AS segment FROM rfm)"""


def rfm(w: Warehouse, mode: str = "reference"):
    return de.rfm_scores(de.rfm_base(w.fact(*DEALER_COLS), AS_OF), mode)


@reg.plan(
    "cst_01_rfm_base",
    f"""{WITH_FACT}, {RFM_BASE} SELECT * REPLACE (strftime(last_order_date, '%Y-%m-%d') AS last_order_date)
 FROM base""",
)
def _(w: Warehouse):
    return de.rfm_base(w.fact(*DEALER_COLS), AS_OF)


@reg.plan("cst_02_rfm_scores", f"{WITH_FACT}, {rfm_sql()} SELECT * FROM rfm")
def _(w: Warehouse):
    return rfm(w)


@reg.plan("cst_02_rfm_scores_high_is_best", f"{WITH_FACT}, {rfm_sql('6 - ')} SELECT * FROM rfm")
def _(w: Warehouse):
    return rfm(w, "high_is_best")


@reg.plan("cst_03_rfm_segment", f"{WITH_FACT}, {rfm_sql()} SELECT * FROM seg")
def _(w: Warehouse):
    return de.rfm_segment(rfm(w))


@reg.plan(
    "cst_04_rfm_segment_counts",
    f"""{WITH_FACT}, {rfm_sql()}, o(display_order, segment) AS (VALUES (1, 'Champions'), (2, 'Loyal'),
 (3, 'Promising'), (4, 'At Risk'), (5, 'Lost')), c AS (SELECT segment, count(*) AS n FROM seg GROUP BY segment)
 SELECT display_order, o.segment, coalesce(n, 0) AS dealers,
 floor(coalesce(n, 0) / (SELECT count(*) FROM seg)::DOUBLE * 100 + 0.5)::BIGINT AS share_pct
 FROM o LEFT JOIN c ON o.segment = c.segment""",
)
def _(w: Warehouse):
    return de.rfm_segment_counts(de.rfm_segment(rfm(w)))


SILENT_SQL = f"""{ACTIVITY_SQL}, silent AS (SELECT customer_code, customer_name, province_name, region, total_orders,
 total_revenue::DOUBLE AS total_revenue, strftime(first_order_date, '%Y-%m-%d') AS first_order_date,
 strftime(last_order_date, '%Y-%m-%d') AS last_order_date, days_since_last_order FROM activity
 WHERE days_since_last_order > 45)"""


def silent(w: Warehouse, n: int | None = None):
    return de.churn_list(fa.customer_activity(w.fact(*ACTIVITY_COLS), AS_OF), n=n)


@reg.plan(
    "cst_05_churn_list",
    f"{WITH_FACT}, {SILENT_SQL} SELECT * FROM silent ORDER BY days_since_last_order DESC, customer_code LIMIT 200",
)
def _(w: Warehouse):
    return silent(w, 200)


@reg.plan("cst_05_churn_list_all", f"{WITH_FACT}, {SILENT_SQL} SELECT * FROM silent")
def _(w: Warehouse):
    return silent(w)


@reg.plan(
    "cst_06_top_dealers",
    f"""{WITH_FACT} SELECT customer_code, customer_name, province_name, region, sum(line_total)::DOUBLE AS revenue,
 count(DISTINCT so_number) AS orders, sum(quantity)::DOUBLE AS quantity FROM fact
 GROUP BY customer_code, customer_name, province_name, region ORDER BY revenue DESC, customer_code LIMIT 10""",
)
def _(w: Warehouse):
    return de.top_dealers(
        w.fact("customer_code", "customer_name", "province_name", "region", "so_number", "quantity", "line_total")
    )


BASKET_SQL = f"""og AS (SELECT DISTINCT so_number, coalesce(group_name, '{NONE}') AS g FROM fact),
pairs AS (SELECT a.g AS group_a, b.g AS group_b, count(DISTINCT a.so_number) AS co_count FROM og a JOIN og b
 ON a.so_number = b.so_number AND a.g < b.g GROUP BY a.g, b.g)"""


def pairs(w: Warehouse):
    return de.basket(w.fact("so_number", "group_name"))


@reg.plan("cst_07_basket", f"{WITH_FACT}, {BASKET_SQL} SELECT * FROM pairs")
def _(w: Warehouse):
    return pairs(w)


CURVE_SQL = """cr AS (SELECT customer_code, sum(line_total) AS revenue FROM fact GROUP BY customer_code),
rk AS (SELECT *, rank() OVER (ORDER BY revenue DESC) AS rnk, count(*) OVER () AS n, sum(revenue) OVER () AS t,
 sum(revenue) OVER (ORDER BY revenue DESC, customer_code ROWS UNBOUNDED PRECEDING) AS cum FROM cr),
curve AS (SELECT rnk, customer_code, revenue::DOUBLE AS revenue, n AS total_dealers,
 round(rnk::DOUBLE / n * 100, 1) AS dealer_pct, round(cum::DOUBLE / t::DOUBLE * 100, 1) AS cumulative_pct FROM rk)"""


def curve(w: Warehouse):
    return de.pareto_curve(w.fact("customer_code", "line_total"))


@reg.plan("cst_08_pareto_curve", f"{WITH_FACT}, {CURVE_SQL} SELECT * FROM curve")
def _(w: Warehouse):
    return curve(w)


@reg.plan(
    "cst_09_pareto_cut",
    f"""{WITH_FACT}, {CURVE_SQL} SELECT dealer_pct, cumulative_pct, rnk FROM curve WHERE cumulative_pct >= 80
 ORDER BY cumulative_pct, rnk, customer_code LIMIT 1""",
)
def _(w: Warehouse):
    return de.pareto_cut(curve(w))


@reg.plan(
    "cst_09_pareto_points",
    f"""{WITH_FACT}, {CURVE_SQL} SELECT dealer_pct, cumulative_pct FROM curve ORDER BY rnk, customer_code LIMIT 200""",
)
def _(w: Warehouse):
    return de.pareto_points(curve(w))


@reg.plan(
    "cst_10_churn_value",
    f"""{WITH_FACT}, {SILENT_SQL} SELECT count(*) AS dealers, sum(total_revenue) AS revenue_at_risk,
 round(avg(total_revenue), 2) AS mean_revenue, (SELECT sum(total_revenue) FROM (SELECT total_revenue FROM silent
 ORDER BY total_revenue DESC, customer_code LIMIT 10)) AS top10_revenue FROM silent""",
)
def _(w: Warehouse):
    return de.churn_value(silent(w))


@reg.plan(
    "cst_11_dealer_insights",
    f"""{WITH_FACT}, {rfm_sql()}, {BASKET_SQL}, b AS (SELECT * FROM pairs ORDER BY co_count DESC, group_a, group_b
 LIMIT 1) SELECT count(*) FILTER (segment IN ('Champions', 'Loyal')) AS core_dealers,
 floor(count(*) FILTER (segment IN ('Champions', 'Loyal')) / count(*)::DOUBLE * 100 + 0.5)::BIGINT AS core_share,
 (SELECT group_a FROM b) AS group_a, (SELECT group_b FROM b) AS group_b, (SELECT co_count FROM b) AS co_count,
 (SELECT count(*) FROM pairs) AS pair_count FROM seg""",
)
def _(w: Warehouse):
    return de.dealer_insights(de.rfm_segment(rfm(w)), pairs(w))


# --------------------------------------------------------------------------------------- geography

PLACE = "Không xác định"
PLACE_COLS = ["region", "province_name", "so_number", "customer_code", "quantity", "line_total"]
PROV_SQL = f"""pv AS (SELECT coalesce(region, '{PLACE}') AS region, coalesce(province_name, '{PLACE}') AS province_name,
 sum(line_total)::DOUBLE AS revenue, count(DISTINCT so_number) AS order_count,
 count(DISTINCT customer_code) AS dealer_count, sum(quantity)::DOUBLE AS quantity,
 round(sum(line_total)::DOUBLE / nullif(count(DISTINCT customer_code), 0), 0) AS avg_revenue_per_dealer FROM fact
 GROUP BY fact.region, fact.province_name)"""
GROWTH_SQL = f"""g0 AS (SELECT coalesce(province_name, '{PLACE}') AS province_name,
 coalesce(region, '{PLACE}') AS region, {PAIR} FROM fact GROUP BY fact.province_name, fact.region
 HAVING q_old > 0 OR q_new > 0), growth AS (SELECT *, {YOY} AS yoy_pct FROM g0)"""
REGION_SQL = f"""rg AS (SELECT coalesce(region, '{PLACE}') AS region, sum(line_total)::DOUBLE AS revenue,
 count(DISTINCT so_number) AS order_count, count(DISTINCT customer_code) AS dealer_count,
 sum(quantity)::DOUBLE AS quantity, round_even(sum(line_total)::DOUBLE /
 (SELECT sum(line_total)::DOUBLE FROM fact) * 100, 1) AS pct FROM fact GROUP BY fact.region)"""


def provinces(w: Warehouse):
    return ge.provinces(w.fact(*PLACE_COLS))


def growth(w: Warehouse):
    f = w.fact("fiscal_year", "fiscal_quarter", "province_name", "region", "line_total")
    return ge.province_growth(f, QUARTER, OLD, NEW)


def regions(w: Warehouse):
    return ge.regions(w.fact(*[c for c in PLACE_COLS if c != "province_name"]))


@reg.plan("geo_01_provinces", f"{WITH_FACT}, {PROV_SQL} SELECT * FROM pv")
def _(w: Warehouse):
    return provinces(w)


@reg.plan("geo_02_province_growth", f"{WITH_FACT}, {GROWTH_SQL} SELECT * FROM growth")
def _(w: Warehouse):
    return growth(w)


@reg.plan("geo_03_regions", f"{WITH_FACT}, {REGION_SQL} SELECT * FROM rg")
def _(w: Warehouse):
    return regions(w)


@reg.plan(
    "geo_04_province_extremes",
    f"""{WITH_FACT}, {PROV_SQL}, {GROWTH_SQL}, x AS (
 (SELECT 'top' AS side, province_name, revenue FROM pv ORDER BY revenue DESC, province_name LIMIT 10) UNION ALL
 (SELECT 'bottom', province_name, revenue FROM pv ORDER BY revenue, province_name LIMIT 10))
 SELECT side, x.province_name, revenue, yoy_pct FROM x LEFT JOIN growth ON growth.province_name = x.province_name""",
)
def _(w: Warehouse):
    return ge.province_extremes(provinces(w), growth(w))


@reg.plan(
    "geo_05_geo_rollup",
    f"""{WITH_FACT} SELECT region, province_name, sum(line_total)::DOUBLE AS revenue FROM fact
 GROUP BY ROLLUP (region, province_name) HAVING grouping(region) = 0""",
)
def _(w: Warehouse):
    return ge.geo_rollup(w.fact("region", "province_name", "line_total"))


@reg.plan(
    "geo_06_growth_split",
    f"""{WITH_FACT}, {GROWTH_SQL} SELECT CASE WHEN yoy_pct > 0 THEN 'growing' ELSE 'shrinking' END AS side,
 province_name, yoy_pct FROM growth WHERE yoy_pct <> 0""",
)
def _(w: Warehouse):
    return ge.growth_split(growth(w))


@reg.plan(
    "geo_07_network_efficiency",
    f"""{WITH_FACT}, {PROV_SQL}, {REGION_SQL}, e AS (SELECT region, revenue / dealer_count AS per FROM rg
 WHERE region <> '{PLACE}') SELECT (SELECT region FROM e ORDER BY per DESC, region DESC LIMIT 1) AS best_region,
 round(max(per), 2) AS best_per_dealer, (SELECT region FROM e ORDER BY per, region LIMIT 1) AS worst_region,
 round(min(per), 2) AS worst_per_dealer, round(max(per) / min(per), 1) AS spread,
 (SELECT province_name FROM pv WHERE dealer_count >= 3
 ORDER BY avg_revenue_per_dealer DESC, province_name DESC LIMIT 1) AS best_province FROM e""",
)
def _(w: Warehouse):
    return ge.network_efficiency(regions(w), provinces(w))


@reg.plan(
    "geo_08_coverage",
    f"""{WITH_FACT} SELECT count(*) AS total_provinces, count(*) FILTER (s) AS covered, count(*) FILTER (NOT s)
 AS uncovered, floor(count(*) FILTER (s) / count(*)::DOUBLE * 100 + 0.5)::BIGINT AS coverage_pct FROM
 (SELECT province_id IN (SELECT province_id FROM fact WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH}) AS s
 FROM prov)""",
)
def _(w: Warehouse):
    from ..functions.columns import in_month

    sold = w.fact("province_id", "fiscal_year", "fiscal_month").where(in_month(YEAR, MONTH))
    return ge.coverage(w.province, sold)


# -------------------------------------------------------------------------------------- operations


@reg.plan(
    "ops_01_status_totals",
    f"""{WITH_LOG}, c AS (SELECT processing_status AS status, count(*) AS count FROM mail GROUP BY ALL)
 SELECT status, count, NULL::BIGINT AS loaded, NULL::DOUBLE AS success_rate FROM c UNION ALL
 SELECT NULL, sum(count)::BIGINT, sum(count) FILTER (status = 'LOADED')::BIGINT,
 round_even(sum(count) FILTER (status = 'LOADED')::DOUBLE / sum(count)::DOUBLE * 100, 1) FROM c""",
)
def _(w: Warehouse):
    return op.status_totals(w.email_log)


@reg.plan(
    "ops_02_stage_funnel",
    f"""{WITH_LOG}, s(stage_order, stage) AS (VALUES (1, 'EXTRACTED'), (2, 'VALIDATED'), (3, 'LOADED'))
 SELECT stage_order, stage, (SELECT count(*) FROM mail WHERE processing_status = stage) AS count FROM s""",
)
def _(w: Warehouse):
    return op.stage_funnel(w.email_log)


DAILY_SQL = f"""dly AS (SELECT order_date, count(DISTINCT so_number) AS order_count, sum(line_total)::DOUBLE AS revenue,
 sum(quantity)::DOUBLE AS quantity FROM fact WHERE fiscal_year = {YEAR} AND fiscal_month = {MONTH} GROUP BY order_date)"""


def days(w: Warehouse):
    f = w.fact("fiscal_year", "fiscal_month", "order_date", "so_number", "quantity", "line_total")
    return op.daily(f, YEAR, MONTH)


@reg.plan(
    "ops_03_daily",
    f"{WITH_FACT}, {DAILY_SQL} SELECT * REPLACE (strftime(order_date, '%Y-%m-%d') AS order_date) FROM dly",
)
def _(w: Warehouse):
    return days(w)


# the calendar spans two months, so that days without orders occur
STATS_SQL = f"""cal AS (SELECT unnest(generate_series(DATE '{YEAR}-07-01', DATE '{YEAR}-08-31', INTERVAL 1 DAY))::DATE
 AS d), dense AS (SELECT d, dly.* EXCLUDE (order_date) FROM cal LEFT JOIN dly ON order_date = d),
st AS (SELECT floor(sum(order_count)::DOUBLE / count(order_count) + 0.5)::BIGINT AS avg_orders,
 (SELECT strftime(d, '%Y-%m-%d') FROM dense ORDER BY order_count DESC NULLS LAST, d LIMIT 1) AS peak_day,
 max(order_count) AS peak_orders, count(order_count) AS active_days, count(*) - count(order_count) AS empty_days,
 sum(revenue) AS revenue FROM dense)"""


def stats(w: Warehouse):
    return op.daily_stats(days(w), f"{YEAR}-07-01", f"{YEAR}-08-31")


@reg.plan("ops_04_daily_stats", f"{WITH_FACT}, {DAILY_SQL}, {STATS_SQL} SELECT * FROM st")
def _(w: Warehouse):
    return stats(w)


@reg.plan(
    "ops_05_recent_errors",
    f"""{WITH_LOG} SELECT log_id, so_number, from_address, processing_status AS status,
 strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM mail WHERE processing_status NOT IN
 ('LOADED', 'SUCCESS') ORDER BY mail.processed_at DESC NULLS FIRST, log_id LIMIT 100""",
)
def _(w: Warehouse):
    return op.recent_errors(w.email_log)


@reg.plan(
    "ops_06_processing_timeline",
    f"""{WITH_LOG} SELECT strftime(date_trunc('hour', processed_at), '%Y-%m-%d %H:%M:%S') AS hour_bucket,
 count(*) AS processed_count, count(*) FILTER (processing_status = 'LOADED') AS success_count FROM mail GROUP BY 1""",
)
def _(w: Warehouse):
    return op.processing_timeline(w.email_log)


@reg.plan(
    "ops_07_capacity",
    f"""{WITH_FACT}, {LOG_SQL}, {DAILY_SQL}, {STATS_SQL} SELECT
 floor(count(*)::DOUBLE / 31 + 0.5)::BIGINT AS mails_per_day,
 floor(count(*)::DOUBLE * 1.2::DOUBLE + 0.5)::BIGINT AS projected_mails,
 ceil((SELECT avg_orders FROM st) * 2)::BIGINT AS alert_level FROM mail""",
)
def _(w: Warehouse):
    return op.capacity(w.email_log, stats(w))
