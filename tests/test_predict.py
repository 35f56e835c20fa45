import pytest
from pyspark.sql import functions as F

from orderloom.operators import churn as ch
from orderloom.operators import forecast as fc
from orderloom.plans import predict as pp
from orderloom.plans.star import Warehouse

from conftest import SMALL


def months(spark, values):
    rows = [(f"2025-{i + 1:02d}-01", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "d string, revenue double").select(F.to_date("d").alias("ds"), "revenue")


def test_holt_continues_a_constant_series(spark):
    row = fc.holt(months(spark, [7] * 8), []).first()
    assert row.forecast == pytest.approx(7) and row.sse == pytest.approx(0)


def test_holt_error_is_the_smallest_on_the_grid(spark):
    y = [5, 9, 4, 8, 12, 7]
    got = fc.holt(months(spark, y), []).first()

    def run(a, b):
        level, trend, sse = y[0], y[1] - y[0], 0.0
        for v in y[1:]:
            ahead = level + fc.PHI * trend
            sse += (v - ahead) ** 2
            new = a * v + (1 - a) * ahead
            level, trend = new, b * (new - level) + (1 - b) * fc.PHI * trend
        return sse, level + fc.PHI * trend

    grid = [i / 20 for i in range(1, 20)]
    best = min(run(a, b)[0] for a in grid for b in grid)
    assert got.sse == pytest.approx(best)
    assert got.forecast == pytest.approx(run(got.alpha, got.beta)[1])


def test_backtest_needs_four_months(spark):
    short = months(spark, [1, 2, 3])
    grouped = short.withColumn("group_name", F.lit("g"))
    assert fc.backtest(short, grouped).count() == 0
    full = months(spark, [4e9, 4e9, 4e9, 4e9])
    row = fc.backtest(full, full.withColumn("group_name", F.lit("g"))).first()
    assert (row.actual, row.predicted, row.mape_pct) == (4.0, 4.0, 0.0)


def test_growth_falls_back_without_pairs(spark):
    row = fc.yoy_growth(months(spark, [1, 2, 3]), 1, 2024, 2025).first()
    assert (row.pairs, row.growth) == (0, 0.15)


def test_forecast_split_adds_up(spark):
    w = Warehouse(spark, SMALL)
    total = pp.forecast(w).agg(F.sum("total")).first()[0]
    parts = pp.allocated(w).agg(F.sum("yhat")).first()[0]
    assert parts == pytest.approx(total, rel=1e-4)
    assert pp.shares(w).agg(F.sum("share")).first()[0] == pytest.approx(1)


def test_churn_scores(spark):
    w = Warehouse(spark, SMALL)
    labelled = ch.churn_label(pp.features(w))
    n = labelled.count()
    scored = ch.score_churn(ch.fit_churn(labelled, trees=5), labelled).cache()
    assert scored.where("churn_proba BETWEEN 0 AND 100").count() == n
    assert ch.churn_bands(scored).agg(F.sum("dealers")).first()[0] == n
    priority = ch.churn_priority(scored)
    assert priority.where("priority_score BETWEEN 0 AND 100 AND prob_order_30d + churn_proba = 100").count() == n
    assert ch.high_risk(priority).where("churn_proba <= 70").count() == 0
    again = ch.score_churn(ch.fit_churn(labelled, trees=5), labelled)
    assert again.select("customer_code", "churn_proba").exceptAll(scored.select("customer_code", "churn_proba")).isEmpty()
    cv = ch.churn_cv(labelled, trees=3, folds=3).first()
    assert 0 <= cv.roc_auc_mean <= 1 and cv.total_dealers == n


def test_churn_model_ignores_input_partitions_and_size(spark):
    labelled = ch.churn_label(pp.features(Warehouse(spark, SMALL))).cache()
    small, large = (ch.fit_churn(labelled.repartition(n), trees=5) for n in (1, 8))
    nodes = [[t.toDebugString.split("\n")[1:] for t in m.stages[-1].trees] for m in (small, large)]  # without the name
    assert nodes[0] == nodes[1]
    for rows in (1, 100_000, 200_000):  # the old switch gave 1, 2 and 4 partitions
        keys = spark.range(rows).selectExpr("id AS customer_code", "0 AS is_churned", *[f"0D AS {c}" for c in ch.FEATURES])
        with ch._training_table(keys, ch.PARTITIONS) as data:
            assert data.rdd.getNumPartitions() == ch.PARTITIONS


def test_churn_model_follows_changed_data(spark, monkeypatch):
    w, seen = Warehouse(spark, SMALL), []
    monkeypatch.setattr(ch, "fit_churn", lambda labelled: seen.append(labelled.count()) or len(seen))
    first = pp.features(w).limit(50)
    for f in (first, first.limit(20)):  # one path, other data
        monkeypatch.setattr(pp, "features", lambda _, f=f: f)
        pp.model(w)
    assert seen == [50, 20]


def test_folds_are_stratified(spark):
    df = spark.range(103).selectExpr("id AS customer_code", "CAST(id % 4 = 0 AS INT) AS is_churned")
    counts = ch.with_folds(df).groupBy("is_churned", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r.is_churned == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_zero_probability_has_no_band(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.3, 0.31, 0.7, 0.71, 1.0)], "p double")
    got = [r[0] for r in df.select(ch.band_of(F.col("p"))).collect()]
    assert got == [None, "Ổn định", "Theo dõi", "Cảnh báo", "Nguy hiểm", "Nguy hiểm"]
