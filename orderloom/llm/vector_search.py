"""Exact top-k search with a vector-approximation file.

Vectors are stored twice: exactly, and in blocks of one-byte cells per component (each block has its own
grid). A scan of the cells bounds every inner product from below and above. The k-th best lower bound of a
query, over all blocks, rules out every vector whose upper bound is smaller. Of the rest, exact vectors are
read best bound first: the k best-bounded ones in a first round, and in a second only those whose bound
still reaches the k-th exact score. Nothing is approximate in the result.

Query blocks meet vector blocks in an equi-join on numbered parts of the vectors; both sides are cut into
blocks of bounded size. Of equal vectors only the k + 1 smallest ids can be in an answer; the others are no
candidates, so a vector that fills a third of the table is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

SCALE = 256
BLOCK = 4096  # vectors in a block of cells
QUERY_BLOCK = 1024
BLOCKS_PER_PART = 64  # blocks of cells that one copy of the queries serves, once there are many
LIMB = 2**32  # scores are compared as multiples of this and a rest, so none leaves its range


def integer_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(id, v, dim)`` with ``floor(256 * x)`` as long for each component, beyond the long range its ends.

    Rows with a NULL id, a NULL or empty vector, or a NULL or non-finite component are left out. Of several
    rows with one id the smallest vector counts.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    id_ = F.col(f"`{id_column}`").cast("long").alias("id")
    rows = df.select(id_, F.when(usable, vector).alias("x")).where("id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
    ends = F.lit(-(2.0**63)), F.lit(2.0**63)
    ints = F.transform("x", lambda x: F.floor(F.least(F.greatest(x * SCALE, ends[0]), ends[1])).cast("long"))
    return rows.select("id", ints.alias("v")).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dim, ids, vectors)`` of at most ``size`` rows each."""
    waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
    for batch in batches:
        for i, v, dim in zip(batch["id"], batch["v"], batch["dim"], strict=True):
            rows = waiting.setdefault(dim, [])
            rows.append((i, v))
            if len(rows) == size:
                yield dim, np.array([r[0] for r in rows], np.int64), np.stack([r[1] for r in rows]).astype(np.int64)
                waiting[dim] = []
    for dim, rows in waiting.items():
        if rows:
            yield dim, np.array([r[0] for r in rows], np.int64), np.stack([r[1] for r in rows]).astype(np.int64)


def approximate(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """The approximation file: ``(dim, block, ids, cells, low, width)``, one row per block.

    Component d of a vector in cell c lies in ``low[d] + c * width[d]`` to ``low[d] + (c + 1) * width[d]``.
    """

    def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, ids, v in _blocks(batches, block):
            low = v.min(axis=0).astype(float)
            width = np.maximum((v.max(axis=0) - low) / 256, 2.0**-20)
            cells = np.minimum((v - low) / width, 255).astype(np.uint8)
            yield pd.DataFrame({"dim": [dim], "block": [int(ids.min())], "ids": [ids.tobytes()], "cells": [cells.tobytes()],
                                "low": [low.tobytes()], "width": [width.tobytes()]})

    return vectors.mapInPandas(quantise, "dim int, block long, ids binary, cells binary, low binary, width binary")


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, ids, v in _blocks(batches, size):
            yield pd.DataFrame({"dim": [dim], "query_ids": [ids.tobytes()], "queries": [v.tobytes()]})

    return queries.mapInPandas(pack, "dim int, query_ids binary, queries binary")


def bounds(ids: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray, queries: np.ndarray):
    """Lower and upper bounds of all inner products, queries by vectors."""
    q = queries.astype(float)
    middle = low + (cells + 0.5) * width
    about = q @ middle.T
    # half a cell in every component, and room for rounding
    slack = np.abs(q) @ (width / 2) + 1e-12 * (np.abs(q) @ np.abs(middle).max(axis=0)) + 1e-6
    return about - slack[:, None], about + slack[:, None]


def scan(pairs: DataFrame, k: int) -> DataFrame:
    """``(query_id, id, lower, upper)``: per pair of blocks, the vectors that may be among a query's best ``k``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, query_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.query_ids, np.int64)
                cells = np.frombuffer(r.cells, np.uint8).reshape(len(ids), r.dim)
                queries = np.frombuffer(r.queries, np.int64).reshape(len(query_ids), r.dim)
                lower, upper = bounds(ids, cells, np.frombuffer(r.low), np.frombuffer(r.width), queries)
                own = query_ids[:, None] == ids[None, :]
                lower[own] = upper[own] = -np.inf
                if len(ids) > k:
                    cut_off = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
                else:
                    cut_off = np.full(len(query_ids), -np.inf)
                q, v = np.nonzero((upper >= cut_off[:, None]) & ~own)
                yield pd.DataFrame({"query_id": query_ids[q], "id": ids[v], "lower": lower[q, v], "upper": upper[q, v]})

    return pairs.mapInPandas(run, "query_id long, id long, lower double, upper double")


def _product(a: str, b: str) -> Column:
    """The exact inner product as ``(high, low)``: ``high * LIMB + low`` with ``0 <= low < LIMB``."""
    wide, zero = "decimal(38,0)", F.lit(0).cast("decimal(38,0)")
    largest = lambda v: F.aggregate(v, F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x.cast("double"))))
    short = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    limb = F.lit(LIMB).cast("long")

    def total(part):
        return F.aggregate(F.zip_with(a, b, lambda x, y: (part(x).cast("decimal(19,0)") * y.cast("decimal(19,0)")).cast(wide)),
                           zero, lambda s, x: (s + x).cast(wide))

    low = total(lambda x: F.pmod(x, limb))
    carry = F.floor(low / F.lit(LIMB).cast("decimal(11,0)"))
    high = (total(lambda x: F.floor((x - F.pmod(x, limb)) / limb)) + carry).cast(wide)
    rest = (low - carry * F.lit(LIMB).cast("decimal(11,0)")).cast("long")
    fits = largest(a) * largest(b) * F.size(a) < 2.0**62
    return F.when(fits, F.struct(F.shiftright(short, 32).cast(wide).alias("high"), short.bitwiseAND(limb - 1).alias("low"))).otherwise(
        F.struct(high.alias("high"), rest.alias("low")))


def _exact(candidates: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    v = vectors.select("id", F.col("v").alias("_v"))
    q = queries.select(F.col("id").alias("query_id"), F.col("v").alias("_q"))
    return candidates.join(v, "id").join(q, "query_id").select("query_id", "id", _product("_v", "_q").alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` largest integer inner products of every query.

    ``is_query`` is a condition on ``id``. Candidates are all vectors of the query's length but its own id;
    ties go to the smaller id; a query with fewer candidates gets all of them, one with none no rows. Ranks are
    exact whatever the components; a score beyond the long range is NULL. See ``integer_vectors`` for rows
    that take no part. Other columns are not looked at.
    """
    vectors = cut(integer_vectors(df, id_column, vector_column))
    queries = vectors.where(is_query)
    by_vector = Window.partitionBy("v").orderBy("id")  # the limit is applied before the shuffle too
    candidates = vectors.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1).drop("_n")
    # full blocks, however many partitions hold the rows: every block yields k candidates a query at least
    candidates = cut(candidates)
    cells = cut(approximate(candidates.coalesce(max(1, -(-candidates.count() // BLOCK)))))
    n_blocks = cells.count()
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n_blocks, spread), -(-n_blocks // BLOCKS_PER_PART))
    numbered = cells.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)))
    copied = query_blocks(queries).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn(
        "part", F.col("part").cast("long")
    )
    found = cut(scan(numbered.join(copied, ["dim", "part"]), k))
    # the k-th best lower bound over all blocks; then best bounds first
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"), "id")
    whole = Window.partitionBy("query_id")
    kth = F.max(F.when(F.col("_l") == k, F.col("lower"))).over(whole)
    open_ = found.withColumn("_l", F.row_number().over(by_lower)).withColumn("_kth", kth).where(
        "_kth IS NULL OR upper >= _kth"
    )
    by_upper = Window.partitionBy("query_id").orderBy(F.desc("upper"), "id")
    open_ = cut(open_.withColumn("_u", F.row_number().over(by_upper)).select("query_id", "id", "upper", "_u"))
    first = cut(_exact(open_.where(F.col("_u") <= k), vectors, queries))
    about = F.col("score.high").cast("double") * LIMB + F.col("score.low")
    reach = first.groupBy("query_id").agg(F.min(about - F.abs(about) * 1e-12).alias("_reach"))  # room for rounding
    rest = open_.where(F.col("_u") > k).join(reach, "query_id").where(F.col("upper") >= F.col("_reach"))
    scores = first.unionByName(_exact(rest.select("query_id", "id"), vectors, queries))
    whole_score = F.expr(f"CAST(try_multiply(score.high, {LIMB}BD) AS DECIMAL(38,0))") + F.col("score.low")
    return _best(scores, k).select("query_id", "rank", "id", whole_score.try_cast("long").alias("score"))
