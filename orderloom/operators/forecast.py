"""Revenue forecast and backtest on monthly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NOT_AVAILABLE, UNCLASSIFIED, as_double, in_quarter, labelled, nearest
from ..functions.text import let

# Growth assumed without any comparable month pair, damping, weights of the three months,
# half-width of the band.
FALLBACK_GROWTH = 0.15
DAMPING = 0.5
MONTH_SHAPE = [0.95, 1.05, 1.0]
BAND = 0.2
BILLION = 1e9
PHI = 0.85
APE_CAP = 999.0


def monthly_series(f: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue and quantity per month and key; no key gives the total series."""
    ds = F.trunc("order_date", "month").alias("ds")
    out = f.groupBy(ds, *keys).agg(F.sum("line_total").alias("revenue"), F.sum("quantity").alias("quantity"))
    return out.withColumn("group_name", labelled("group_name", UNCLASSIFIED)) if "group_name" in keys else out


def _quarter(ds: str, year: int, quarter: int) -> Column:
    return (F.year(ds) == year) & (F.quarter(ds) == quarter)


def yoy_growth(total: DataFrame, quarter: int, old: int, new: int, damp: float = DAMPING) -> DataFrame:
    """Median growth of the month pairs with sales in both years, as found and damped."""
    revenue = as_double("revenue")
    pairs = (
        total.where(_quarter("ds", old, quarter) | _quarter("ds", new, quarter))
        .groupBy(F.month("ds").alias("m"))
        .agg(
            F.sum(F.when(F.year("ds") == old, revenue)).alias("before"),
            F.sum(F.when(F.year("ds") == new, revenue)).alias("after"),
        )
        .where("before > 0 AND after > 0")
    )
    found = pairs.agg(
        F.count("*").alias("pairs"), F.median((F.col("after") - F.col("before")) / F.col("before")).alias("g")
    )
    return found.select(
        "pairs", F.coalesce("g", F.lit(FALLBACK_GROWTH)).alias("growth")
    ).withColumn("damped_growth", F.col("growth") * damp)


def yoy_forecast(
    total: DataFrame, quarter: int, old: int, new: int, months: list[str],
    damp: float = DAMPING, shape: list[float] = MONTH_SHAPE,
) -> DataFrame:
    """Forecast of the following quarter: quarter mean × damped growth × month weight, never negative."""
    growth = yoy_growth(total, quarter, old, new, damp).select("damped_growth").scalar()
    mean = total.where(_quarter("ds", new, quarter)).agg(
        F.coalesce(F.avg(as_double("revenue")), F.lit(0.0)).alias("mean")
    )
    base = mean.select((F.col("mean") * (1 + growth)).alias("base"))
    spelled = F.array(*[F.struct(F.lit(m).alias("ds"), F.lit(s).alias("weight")) for m, s in zip(months, shape)])
    return base.select("base", F.inline(spelled)).select(
        "ds", F.greatest(F.col("base") * F.col("weight"), F.lit(0.0)).alias("total")
    )


def flat_forecast(total: DataFrame, months: list[str]) -> DataFrame:
    """Fallback: the mean of the last three months, the same for every month; 0 without three months."""
    last = total.orderBy(F.desc("ds")).limit(3).agg(
        F.when(F.count("*") >= 3, F.avg(as_double("revenue"))).otherwise(0.0).alias("total")
    )
    return last.select(F.explode(F.array(*map(F.lit, months))).alias("ds"), "total").select("ds", "total")


def forecast_or_flat(forecast: DataFrame, flat: DataFrame) -> DataFrame:
    """The forecast, month by month replaced by the flat one where it has no value."""
    return flat.select("ds", F.col("total").alias("_flat")).join(forecast, "ds", "left").select(
        "ds", F.coalesce(F.nanvl("total", F.lit(None)), "_flat").alias("total")
    )


def group_shares(series: DataFrame, quarter: int, year: int) -> DataFrame:
    """Share of each group in a quarter; groups without sales in it get 0."""
    in_q = F.when(_quarter("ds", year, quarter), as_double("revenue")).otherwise(0.0)
    groups = series.groupBy("group_name").agg(F.sum(in_q).alias("q"))
    whole = groups.agg(F.greatest(F.sum("q"), F.lit(1.0)).alias("t")).scalar()
    return groups.select("group_name", (F.col("q") / whole).alias("share"))


def allocate_forecast(forecast: DataFrame, shares: DataFrame) -> DataFrame:
    """Month totals split over the groups with their band."""
    months = F.array_sort(F.collect_list(F.struct("ds", "total")))  # as many entries as forecast months
    split = shares.withColumn("months", forecast.agg(months.alias("m")).scalar()).select(
        "group_name", "share", F.inline("months")
    )
    y = F.col("total") * F.col("share")
    return split.select(
        "group_name",
        "ds",
        F.bround(y, 0).alias("yhat"),
        F.bround(y * (1 - BAND), 0).alias("lower"),
        F.bround(y * (1 + BAND), 0).alias("upper"),
    )


def allocated_totals(forecast: DataFrame, shares: DataFrame, unit: float = BILLION) -> DataFrame:
    """Quarter total per group in ``unit``, rounded to two decimals after every month."""
    months = forecast.agg(F.array_sort(F.collect_list(F.struct("ds", "total"))).alias("m")).scalar()
    total = F.aggregate(
        "months", F.lit(0.0), lambda acc, m: F.bround(acc + m["total"] * F.col("share") / unit, 2)
    )
    return shares.withColumn("months", months).select("group_name", total.alias("total"))


def holt(series: DataFrame, keys: list[str], value: str = "revenue", phi: float = PHI, steps: int = 20) -> DataFrame:
    """One-step forecast by damped-trend exponential smoothing, one row per key.

    The series of a key is one array (one entry per month). Level and trend weights come from a grid: the
    pair with the smallest squared one-step error wins. Level starts at the first value, trend at the first
    difference.
    """
    point = F.struct(F.col("ds"), as_double(value).alias("y"))
    arrays = series.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))
    y = arrays.withColumn("y", F.transform("points", lambda p: p["y"])).where(F.size("y") >= 2)
    weights = [i / steps for i in range(1, steps)]
    grid = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in weights for b in weights])
    start = F.struct(
        F.col("y")[0].alias("level"), (F.col("y")[1] - F.col("y")[0]).alias("trend"), F.lit(0.0).alias("sse")
    )

    def step(state: Column, value: Column, a: Column, b: Column) -> Column:
        ahead = state["level"] + phi * state["trend"]
        level = a * value + (1 - a) * ahead
        return F.struct(
            level.alias("level"),
            (b * (level - state["level"]) + (1 - b) * phi * state["trend"]).alias("trend"),
            (state["sse"] + (value - ahead) * (value - ahead)).alias("sse"),
        )

    def fitted(g: Column) -> Column:
        end = F.aggregate(F.slice("y", F.lit(2), F.size("y")), start, lambda s, v: step(s, v, g["a"], g["b"]))
        return let(
            end,
            lambda e: F.struct(
                e["sse"].alias("sse"), g["a"].alias("alpha"), g["b"].alias("beta"),
                (e["level"] + phi * e["trend"]).alias("forecast"),
            ),
        )

    best = F.array_min(F.transform(grid, fitted)).alias("best")
    return y.select(*keys, best).select(*keys, "best.forecast", "best.alpha", "best.beta", "best.sse")


def backtest(total: DataFrame, series: DataFrame, unit: float = BILLION) -> DataFrame:
    """Last month held out: forecast from the months before, split by the share of the previous month.

    No row with fewer than four months. The error in percent is capped at 999.
    """
    last = total.agg(F.max("ds").alias("d"), F.count("*").alias("n"))
    held_out, months = last.select("d").scalar(), last.select("n").scalar()
    before = total.where(F.col("ds") < held_out)
    previous = before.agg(F.max("ds").alias("d")).scalar()
    predicted = holt(before, []).select("forecast").scalar()
    revenue = as_double("revenue")
    groups = (
        series.withColumn("_last", held_out)
        .withColumn("_prev", previous)
        .groupBy("group_name")
        .agg(
            F.coalesce(F.sum(F.when(F.col("ds") == F.col("_last"), revenue)), F.lit(0.0)).alias("a"),
            F.coalesce(F.sum(F.when(F.col("ds") == F.col("_prev"), revenue)), F.lit(0.0)).alias("p"),
        )
    )
    whole = groups.agg(F.greatest(F.sum("p"), F.lit(1.0)).alias("t")).scalar()
    p = F.col("predicted")
    ape = F.when(F.col("a") > 0, F.abs(F.col("a") - p) / F.greatest("a", F.lit(1.0)) * 100).otherwise(APE_CAP)
    return (
        groups.withColumn("n", months)
        .where(F.col("n") >= 4)
        .withColumn("predicted", predicted * F.col("p") / whole)
        .select(
            "group_name",
            F.bround(F.col("a") / unit, 2).alias("actual"),
            F.bround(p / unit, 2).alias("predicted"),
            F.bround(F.least(ape, F.lit(APE_CAP)), 1).alias("mape_pct"),
        )
    )


def top_quarter_skus(f: DataFrame, year: int, quarter: int, n: int = 20) -> DataFrame:
    return (
        f.where(in_quarter(year, quarter))
        .groupBy("product_code", "product_name", "color", "line_name", "group_name")
        .agg(F.sum("quantity").alias("total_qty"), F.sum("line_total").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "product_code")
        .limit(n)
        .withColumns({c: labelled(c, NOT_AVAILABLE) for c in ("color", "line_name", "group_name")})
    )


def sku_projection(
    f: DataFrame, forecast: DataFrame, year: int, quarter: int, n: int = 20, unit: float = BILLION
) -> DataFrame:
    """The best SKUs of the quarter and their part of the forecast."""
    whole = f.where(in_quarter(year, quarter)).agg(
        F.greatest(F.sum("line_total").cast("double"), F.lit(1.0)).alias("t")
    )
    ahead = forecast.agg(F.sum("total").alias("t")).scalar()
    share = as_double("total_revenue") / whole.scalar()
    return top_quarter_skus(f, year, quarter, n).withColumn("projected", F.bround(share * ahead / unit, 2))


def forecast_bands(allocated: DataFrame, unit: float = BILLION) -> DataFrame:
    """Month totals with their band, in ``unit`` to one decimal."""
    shown = lambda c: (nearest(F.sum(c) / unit * 10) / 10).alias(c)
    return allocated.groupBy("ds").agg(*[shown(c) for c in ("yhat", "lower", "upper")])


def forecast_timeline(series: DataFrame, allocated: DataFrame) -> DataFrame:
    """Past and forecast months of every group in one table; the past wins."""
    past = series.groupBy("group_name", F.date_format("ds", "yyyy-MM").alias("ds")).agg(
        F.sum(as_double("revenue")).alias("past")
    )
    both = past.join(allocated, ["group_name", "ds"], "full_outer")
    return both.select(
        "group_name", "ds", F.coalesce("past", "yhat").alias("value"), "lower", "upper",
        F.col("past").isNull().alias("is_forecast"),
    )
