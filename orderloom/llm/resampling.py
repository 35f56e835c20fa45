"""Quality by importance resampling.

Two generative models of hashed word n-grams are counted: one over target text, one over all text. A
document's log weight is the log ratio of its probability under the two. Adding Gumbel noise to log weights
and taking the largest keys samples without replacement in proportion to the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import order_globally
from ..session import cut
from .common import keep_columns, uniform

BUCKETS = 10_000
KEEP_PERCENT = 85
SEED = 20240609
TARGET_ROWS = 50_000  # labelled rows at most that the target model is counted from
AT_ONCE = 256  # texts whose words are in memory together


def _hashed(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and bucket of every word and word pair of the texts."""
    split = [t.encode("utf-8", "replace").lower().split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = np.fromiter((zlib.crc32(w) for ws in split for w in ws), np.uint64, int(sizes.sum()))
    row = np.repeat(np.arange(len(split)), sizes)
    together = row[:-1] == row[1:]
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[together]
    grams = np.concatenate([words, pairs])
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.concatenate([row, row[:-1][together]]), ((grams >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, text_column: str, target: Column, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n_raw, n_target)`` over all rows; at most ``buckets`` rows, summed per task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, chosen = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                part = batch.iloc[start : start + AT_ONCE]
                row, bucket = _hashed(part["text"].tolist(), buckets)
                raw += np.bincount(bucket, minlength=buckets)
                chosen += np.bincount(bucket[part["target"].to_numpy(bool)[row]], minlength=buckets)
        yield pd.DataFrame({"bucket": np.arange(buckets), "n_raw": raw, "n_target": chosen})

    rows = docs.select(F.col(f"`{text_column}`").alias("text"), F.coalesce(target, F.lit(False)).alias("target"))
    parts = rows.mapInPandas(count, "bucket long, n_raw long, n_target long")
    return parts.groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))


def log_ratios(counts: list[tuple[int, int, int]], buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability per bucket, with one added to every count."""
    raw, target = np.ones(buckets), np.ones(buckets)
    for bucket, n_raw, n_target in counts:
        raw[bucket] += n_raw
        target[bucket] += n_target
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratios: np.ndarray, text_column: str = "text") -> DataFrame:
    """``docs`` with ``log_weight``; a NULL or empty text has 0."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # of ``buckets`` numbers

    @F.pandas_udf("double")
    def weigh(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        for start in range(0, len(texts), AT_ONCE):
            part = texts.iloc[start : start + AT_ONCE].tolist()
            row, bucket = _hashed(part, len(shared.value))
            out[start : start + len(part)] = np.bincount(row, weights=shared.value[bucket], minlength=len(part))
        return pd.Series(out)

    return keep_columns(docs, {"log_weight": weigh(F.col(f"`{text_column}`"))})


def marked_target(docs: DataFrame, ids: DataFrame, id_column: str = "doc_id", rows: int = TARGET_ROWS) -> DataFrame:
    """``docs`` with ``_target``: true for at most ``rows`` of the ``ids`` (one column), chosen by hash.

    The bound keeps the marks small enough to broadcast, so texts are not shuffled to meet their labels.
    The raw model always counts every row.
    """
    name = ids.columns[0]
    few = ids.select(F.col(f"`{name}`").alias("_target_id")).dropna().distinct().orderBy(F.xxhash64("_target_id"), "_target_id")
    marks = F.broadcast(few.limit(rows).withColumn("_target", F.lit(True)))
    joined = docs.join(marks, docs[f"`{id_column}`"] == marks["_target_id"], "left").drop("_target_id")
    return joined.withColumn("_target", F.coalesce("_target", F.lit(False)))


def resample(
    docs: DataFrame, target: Column, id_column: str = "doc_id", text_column: str = "text",
    keep_percent: int = KEEP_PERCENT, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``(id, log_weight, sample_key, kept)``, one row per row of ``docs``.

    ``target`` marks the rows of target text. ``floor(keep_percent * rows / 100)`` rows are kept, those with
    the largest keys; equal keys by id and text. Noise depends on seed, id and text only: reruns agree, and
    repeated rows share a key. A NULL text counts as empty, a NULL id or target flag is allowed (the flag
    as false). Without target rows all ratios come from the added counts. An empty table gives no rows.
    """
    counts = bucket_counts(docs, text_column, target, buckets).collect()
    ratios = log_ratios([tuple(r) for r in counts], buckets)
    text = F.col(f"`{text_column}`")
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    weighed = log_weights(slim, ratios, "text")
    row_key = F.xxhash64("id", F.xxhash64("text"))
    noise = -F.log(-F.log(F.greatest(uniform(seed, row_key), F.lit(2.0**-53))))
    keyed = cut(weighed.select("id", "log_weight", (F.col("log_weight") + noise).alias("sample_key"), row_key.alias("_row")))
    ordered = order_globally(keyed, -F.col("sample_key"), "_row", prefix="_k")
    limit = F.floor(F.col("_krows") * keep_percent / 100)
    return ordered.select("id", "log_weight", "sample_key", (F.col("_kposition") <= limit).alias("kept"))
