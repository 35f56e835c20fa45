"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams. A document is compared to each profile
by the out-of-place distance: how far apart the ranks of its own most frequent n-grams stand, with the
largest distance for n-grams that the profile lacks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_columns

TOP = 300  # n-grams per profile
UNKNOWN = "und"
AT_ONCE = 64  # texts whose n-grams are in memory together
_NO_LETTERS = re.compile(r"[\W\d_]+")
_SPACE = 32
_BITS = 21  # of a code point


def _codes(text: str | None) -> np.ndarray:
    """Lower-case letters of the text as code points, words set apart by single spaces; empty without a letter."""
    plain = _NO_LETTERS.sub(" ", text.lower()).strip() if text else ""
    if not any(map(str.isalpha, plain)):
        return np.zeros(0, np.int64)
    return np.frombuffer(f" {plain} ".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """1-, 2- and 3-grams inside words, word ends included, each as one number."""
    space = codes == _SPACE
    two = (codes[:-1] << _BITS) | codes[1:]
    three = (two[:-1] << _BITS) | codes[2:]
    return np.concatenate([codes[~space], two[~(space[:-1] & space[1:])], three[~space[1:-1]]])


def _counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(_ngrams(codes))
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[starts], np.diff(np.append(starts, len(grams)))


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([a[1], b[1]])).astype(np.int64)


def profiles(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP) -> DataFrame:
    """``(lang, gram, place)``: the ``top`` n-grams of each language over all rows with text and language.

    Counts are summed per task before they are shuffled. Equal counts are ordered by n-gram, so the result
    does not depend on the order of rows.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                for lang, texts in batch.iloc[start : start + AT_ONCE].groupby("lang")["text"]:
                    codes = [c for c in map(_codes, texts) if len(c)]
                    if codes:
                        more = _counts(np.concatenate(codes))
                        sums[lang] = _added(sums[lang], more) if lang in sums else more
        for lang, (grams, n) in sums.items():
            yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    rows = docs.select(F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang")).dropna()
    sums = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the limit on the bare row number lets every task keep its own best before the languages meet
    first = sums.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
    return first.select("lang", "gram", (F.col("r") - 1).alias("place"))


def predict(docs: DataFrame, table: list[tuple[str, int, int]], text_column: str = "text", top: int = TOP) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; existing columns of these names are replaced.

    ``table`` holds the rows of ``profiles``: ``top`` per language. The score is 1 for a document whose
    n-grams stand in the same order as the profile's and 0 if the profile has none of them. Equal distances
    go to the language that sorts first. A text that is NULL or has no letter, and every text when there is
    no profile, gives ``und`` and 0. Whole texts are read; repeated rows give equal results.
    """
    langs = sorted({r[0] for r in table})
    grams = np.array(sorted({r[1] for r in table}), np.int64)
    places = np.full((len(grams) + 1, len(langs)), -1, np.int32)
    for lang, gram, place in table:
        places[np.searchsorted(grams, gram), langs.index(lang)] = place

    def one(text: str | None) -> tuple[str, float]:
        codes = _codes(text)
        if not len(codes) or not langs:
            return UNKNOWN, 0.0
        own, n = _counts(codes)
        if len(own) > top:
            least = np.partition(n, len(n) - top)[len(n) - top]
            own, n = own[n >= least], n[n >= least]
        own = own[np.argsort(-n, kind="stable")[:top]]
        at = np.searchsorted(grams, own)
        at[grams[np.minimum(at, len(grams) - 1)] != own] = len(grams)
        there = places[at]
        apart = np.where(there < 0, top, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return langs[best], float(1 - apart[best] / (top * len(own)))

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])

    judged = docs.withColumn("_lang", judge(F.col(f"`{text_column}`")))
    return keep_columns(judged, {"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")


def identify(docs: DataFrame, learn_from: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP) -> DataFrame:
    """``predict`` with profiles of ``learn_from``; ``top`` rows a language pass the driver."""
    table = [(r.lang, r.gram, r.place) for r in profiles(learn_from, text_column, lang_column, top).collect()]
    return predict(docs, table, text_column, top)
