"""Dealer churn: features, model, scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from statistics import fmean, pstdev

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, in_quarter
from ..functions.ranking import order_globally

# Model inputs (recency is left out, it defines the label), label limit, model settings,
# probability bands.
FEATURES = [
    "frequency", "monetary", "freq_90d", "mon_90d", "avg_order_value", "months_active", "avg_interval_days", "qoq_pct",
]
CHURN_DAYS = 45
NO_INTERVAL = 999.0
TREES, STEP, DEPTH, SUBSAMPLE, SEED, FOLDS = 200, 0.05, 3, 0.8, 42, 5
BANDS = [(0.3, "Ổn định"), (0.5, "Theo dõi"), (0.7, "Cảnh báo"), (1.0, "Nguy hiểm")]
HIGH_RISK_PCT = 70
PARTITIONS = 8  # of the training table, at every size


def dealer_days(f: DataFrame) -> DataFrame:
    """Orders and revenue per dealer and day.

    Lines are summed per order, then per day, so a dealer with very many lines is spread over its orders.
    """
    per_order = f.groupBy("customer_code", "order_date", "so_number").agg(
        F.sum("line_total").alias("amount"),
        F.max("customer_name").alias("customer_name"),
        F.max("province_name").alias("province_name"),
        F.max("region").alias("region"),
    )
    return per_order.groupBy("customer_code", "order_date").agg(
        F.count("*").alias("orders"),
        F.sum("amount").alias("amount"),
        *[F.max(c).alias(c) for c in ("customer_name", "province_name", "region")],
    )


def order_intervals(f: DataFrame) -> DataFrame:
    """Mean days between order days, for dealers with at least two.

    The gaps add up to last minus first day, so their mean needs no ordering.
    """
    days = f.select("customer_code", "order_date").distinct()
    return (
        days.groupBy("customer_code")
        .agg(F.count("*").alias("n"), F.datediff(F.max("order_date"), F.min("order_date")).alias("span"))
        .where(F.col("n") > 1)
        .select("customer_code", (F.col("span") / (F.col("n") - 1)).alias("avg_interval_days"))
    )


def churn_features(f: DataFrame, as_of: str, since: str, quarter: int, old: int, new: int) -> DataFrame:
    """One feature row per dealer as of a day; ``since`` starts the recent window."""
    days = dealer_days(f).withColumns(
        {"fiscal_year": F.year("order_date"), "fiscal_quarter": F.quarter("order_date")}
    )
    recent = F.col("order_date") >= F.lit(since).cast("date")
    zero = F.lit(0)
    amount_when = lambda c: F.coalesce(F.sum(F.when(c, F.col("amount"))), zero)
    base = days.groupBy("customer_code").agg(
        *[F.max(c).alias(c) for c in ("customer_name", "province_name", "region")],
        F.datediff(F.lit(as_of).cast("date"), F.max("order_date")).alias("recency_days"),
        F.sum("orders").alias("frequency"),
        F.sum("amount").alias("monetary"),
        F.coalesce(F.sum(F.when(recent, F.col("orders"))), zero).alias("freq_90d"),
        amount_when(recent).alias("mon_90d"),
        F.countDistinct(F.trunc("order_date", "month")).alias("months_active"),
        amount_when(in_quarter(new, quarter)).alias("q_new"),
        amount_when(in_quarter(old, quarter)).alias("q_old"),
        F.count("*").alias("n_days"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("span"),
    )
    growth = F.round(
        100.0 * (as_double("q_new") - as_double("q_old")) / F.nullif(as_double("q_old"), F.lit(0.0)), 1
    )
    return base.select(
        "customer_code", "customer_name", "province_name", "region", "recency_days", "frequency", "monetary",
        "freq_90d", "mon_90d", (as_double("monetary") / F.col("frequency")).alias("avg_order_value"), "months_active",
        F.when(F.col("n_days") > 1, F.col("span") / (F.col("n_days") - 1)).otherwise(NO_INTERVAL).alias("avg_interval_days"),
        F.when(F.col("q_old") > 0, growth).otherwise(0.0).alias("qoq_pct"),
    )


def churn_label(features: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Label and numeric inputs; missing inputs count as 0."""
    numeric = {c: F.coalesce(as_double(c), F.lit(0.0)) for c in FEATURES}
    return features.withColumns(numeric).withColumn("is_churned", (F.col("recency_days") > days).cast("int"))


def _stages(trees: int) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            GBTClassifier(
                featuresCol="features", labelCol="is_churned", maxIter=trees, stepSize=STEP, maxDepth=DEPTH,
                subsamplingRate=SUBSAMPLE, seed=SEED,
            ),
        ]
    )


@contextmanager
def _training_table(labelled: DataFrame, partitions: int, *extra: str):
    """The model inputs, held while training, dealt out by dealer over a fixed number of partitions.

    The seeded row sampling draws per partition, so ``partitions`` is part of the model: it never follows
    from the row count or from how the input lies. Rows lie in key order, so the sampling repeats.
    """
    data = labelled.select("customer_code", "is_churned", *FEATURES, *extra).persist()
    try:
        yield data.repartition(partitions, "customer_code").sortWithinPartitions("customer_code")
    finally:
        data.unpersist()


def fit_churn(labelled: DataFrame, trees: int = TREES, partitions: int = PARTITIONS) -> PipelineModel:
    """Scaled gradient-boosted trees, trained in ``partitions`` tasks; another number gives another model."""
    with _training_table(labelled, partitions) as data:
        return _stages(trees).fit(data)


def with_folds(labelled: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Stratified folds: dealers numbered label by label and dealt out in turn."""
    numbered = order_globally(labelled, F.col("is_churned"), "customer_code")
    keep = [F.col(c) for c in labelled.columns]
    return numbered.select(*keep, F.pmod(F.col("position"), F.lit(folds)).cast("int").alias("fold"))


def churn_cv(labelled: DataFrame, trees: int = TREES, folds: int = FOLDS, partitions: int = PARTITIONS) -> DataFrame:
    """Mean and spread of the ROC area over the folds, with the label counts."""
    evaluator = BinaryClassificationEvaluator(labelCol="is_churned")
    with _training_table(with_folds(labelled, folds), partitions, "fold") as data, ThreadPoolExecutor(folds) as pool:

        def area(k: int) -> float:
            model = _stages(trees).fit(data.where(F.col("fold") != k))
            return evaluator.evaluate(model.transform(data.where(F.col("fold") == k)))

        areas = list(pool.map(area, range(folds)))
    return labelled.agg(F.sum("is_churned").alias("churn_count"), F.count("*").alias("total_dealers")).select(
        F.lit(round(fmean(areas), 3)).alias("roc_auc_mean"),
        F.lit(round(pstdev(areas), 3)).alias("roc_auc_std"),
        "churn_count",
        "total_dealers",
    )


def band_of(probability):
    """Name of the probability band; exactly 0 belongs to none."""
    out = F.when(probability <= 0, F.lit(None).cast("string"))
    for high, name in BANDS:
        out = out.when(probability <= high, name)
    return out


def score_churn(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    scored = model.transform(labelled).withColumn("_p", vector_to_array("probability")[1])
    keep = [F.col(c) for c in labelled.columns]
    return scored.select(
        *keep, F.bround(F.col("_p") * 100, 1).alias("churn_proba"), band_of(F.col("_p")).alias("churn_segment")
    )


def churn_priority(scored: DataFrame) -> DataFrame:
    """Percentile of revenue (ties share their mean rank) × churn probability, and the complement."""
    ranked = order_globally(scored, F.col("monetary"), "customer_code")
    percentile = (F.col("rank") + (F.col("ties") - 1) / 2) / F.col("rows") * 100
    return ranked.select(
        "customer_code", "customer_name", "province_name", "region", "recency_days", "frequency", "monetary",
        "freq_90d", "avg_order_value", "churn_proba", "churn_segment",
        F.bround(100 - F.col("churn_proba"), 1).alias("prob_order_30d"),
        F.bround(percentile * F.col("churn_proba") / 100, 1).alias("priority_score"),
    ).orderBy(F.desc("priority_score"), "customer_code")


def churn_bands(scored: DataFrame) -> DataFrame:
    return scored.groupBy("churn_segment").agg(F.count("*").alias("dealers")).orderBy(F.desc("dealers"))


def high_risk(priority: DataFrame, limit: float = HIGH_RISK_PCT) -> DataFrame:
    """Dealers to call, ten columns."""
    return priority.where(F.col("churn_proba") > limit).select(
        "customer_code", "customer_name", "province_name", "region", "recency_days", "frequency", "churn_proba",
        "prob_order_30d", "priority_score", "churn_segment",
    )
