"""Whitening of embeddings with covariances from polarisation, in exact integers.

Components are integers ``floor(256 * c)``. Over the distinct vectors, tasks sum the squares of the centred
values of every dimension and of every sum of two dimensions. With ``Q(y)`` the sum of squares of ``y``, the
covariance of two dimensions is half of ``Q(x + y) - Q(x) - Q(y)``: no product of two dimensions is formed.

Values are centred at the integer next below the mean, ``z = x - floor(S / n)``, which keeps them small; what
is left of the mean is taken off exactly, as ``n * sum((z - T / n)^2) = n * Q - T^2`` with ``T`` the sum of ``z``.
All sums are exact: 64-bit where a batch cannot leave that range, else Python integers, and decimals of 38
digits between tasks (more is an error). A model holds one number per pair of dimensions, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

SCALE = 256
ROWS = 1024  # vectors whose squares are in memory together
WIDE = 2**62  # sums below this are taken in 64 bits


class Model(NamedTuple):
    """The whitening of the vectors of one length."""

    n: int  # distinct vectors
    centre: np.ndarray  # floor(S / n) per dimension, as Python integers
    rest: np.ndarray  # S - n * centre
    axes: np.ndarray  # one unit vector per column
    values: np.ndarray  # their eigenvalues, falling
    explained: np.ndarray  # shares of the trace

    @property
    def alive(self) -> np.ndarray:
        """Components along which the vectors vary at all."""
        return self.values > len(self.centre) * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)


def integer_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(id, x, dim)`` with ``floor(256 * c)`` as long for each entry; rows with a NULL vector or one that
    holds NULL or non-finite entries are left out. Values beyond the long range become its ends."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.when(finite, vector).alias("c")).where("c IS NOT NULL")
    long = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(2.0**63)), F.lit(-(2.0**63)))).cast("long")
    return rows.select("id", F.transform("c", long).alias("x"), F.size("c").alias("dim")).where("dim > 0")


def _stacks(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dim, rows, vectors)`` of one batch, at most ``rows`` vectors each."""
    dims = np.asarray(batch.column("dim"))
    lists = batch.column("x")
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        for k in range(0, len(at), rows):
            part = at[k : k + rows]
            yield int(dim), part, np.asarray(lists.take(pa.array(part)).flatten()).reshape(len(part), dim)


def _shift(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, int]:
    """``x - centre`` exactly, and the largest absolute value."""
    low, high = x.min(axis=0).astype(object) - centre, x.max(axis=0).astype(object) - centre
    most = max(max(map(abs, low)), max(map(abs, high)))
    if most < WIDE and max(map(abs, centre)) < WIDE:
        return x - centre.astype(np.int64), most  # may wrap in between, not in the result
    return x.astype(object) - centre, most


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: distinct vectors and the sum of each dimension; one record per length and dimension."""
    entries = distinct.select("dim", F.posexplode("x").alias("i", "x"))
    out: dict[int, tuple[int, list[int]]] = {}
    sums = entries.groupBy("dim", "i").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(28,0)")).alias("s"))
    for r in sums.orderBy("dim", "i").collect():
        out.setdefault(r.dim, (r.n, []))[1].append(int(r.s))
    return out


def squares(distinct: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``(dim, i, j, q)``: exact sums of squares of the centred dimension ``i`` (``j = i``) or of the sum of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _stacks(batch):
                z, most = _shift(x, centres[dim])
                if 4 * most * most * len(z) >= WIDE:
                    z = z.astype(object)
                acc = total.setdefault(dim, np.full((dim, dim), 0, object))
                for i in range(dim):
                    pair = z[:, i:] + z[:, i : i + 1]
                    pair[:, 0] = z[:, i]
                    acc[i, i:] += (pair * pair).sum(axis=0)
        for dim, acc in total.items():
            i, j = np.triu_indices(dim)
            q = pa.array([str(v) for v in acc[i, j]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), q], names=["dim", "i", "j", "q"])

    parts = distinct.mapInArrow(run, "dim int, i int, j int, q string")
    return parts.groupBy("dim", "i", "j").agg(F.sum(F.col("q").cast("decimal(38,0)")).alias("q"))


def fit(distinct: DataFrame, components: int = 4) -> dict[int, Model]:
    """One model per vector length, from vectors ``(x, dim)`` without repeats."""
    sums = _sums(distinct)
    shifted = {}
    for dim, (n, s) in sums.items():
        centre = np.array([v // n for v in s], object)
        shifted[dim] = n, centre, np.array(s, object) - n * centre
    pairs: dict[int, np.ndarray] = {dim: np.full((dim, dim), 0, object) for dim in sums}
    for r in squares(distinct, {dim: c for dim, (_, c, _) in shifted.items()}).toLocalIterator():
        pairs[r.dim][r.i, r.j] = int(r.q)
    models = {}
    for dim, (n, centre, rest) in shifted.items():
        q = pairs[dim]
        # n^2 times the variance of each dimension, then of each sum of two
        single = n * q.diagonal() - rest * rest
        both = n * q - (rest[:, None] + rest[None, :]) ** 2
        cross = both - single[:, None] - single[None, :]
        v = np.zeros((dim, dim))
        for i, j in zip(*np.triu_indices(dim, 1), strict=True):
            v[i, j] = v[j, i] = cross[i, j] / (2 * n * n)
        v[np.diag_indices(dim)] = [a / (n * n) for a in single]
        values, axes = np.linalg.eigh(v)
        keep = np.argsort(-values, kind="stable")[:components]
        trace = float(sum(single) / (n * n))
        share = values[keep] / trace if trace > 0 else np.full(len(keep), np.nan)
        models[dim] = Model(n, centre, rest, axes[:, keep], values[keep], share)
    return models


def project(x: np.ndarray, m: Model) -> np.ndarray:
    """Whitened vectors; NaN for components along which nothing varies."""
    z, _ = _shift(x, m.centre)
    centred = z.astype(float) - np.array([r / m.n for r in m.rest])
    out = np.full((len(x), len(m.values)), np.nan)
    out[:, m.alive] = centred @ m.axes[:, m.alive] / np.sqrt(m.values[m.alive])
    return out


def deviations(x: np.ndarray, m: Model) -> list[int]:
    """``sum((n * x - S)^2)`` per vector, exactly."""
    z, most = _shift(x, m.centre)
    if len(m.centre) * most * max(most, m.n) >= WIDE:
        z = z.astype(object)
    rest = m.rest.astype(z.dtype)
    own, cross, last = (z * z).sum(axis=1), (z * rest).sum(axis=1), sum(r * r for r in m.rest)
    return [m.n * (m.n * int(a) - 2 * int(b)) + last for a, b in zip(own, cross, strict=True)]


def whitened(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``vectors`` with ``n``, ``deviation`` (NULL beyond the long range) and ``w``, the whitened components."""
    names = [*vectors.columns, "n", "deviation", "w"]
    schema = vectors.selectExpr("*", "1L AS n", "CAST(NULL AS BIGINT) AS deviation", "CAST(NULL AS ARRAY<DOUBLE>) AS w").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _stacks(batch):
                m = models[dim]
                rows = pa.Table.from_batches([batch]).take(pa.array(at)).combine_chunks().to_batches()[0]
                far = pa.array([d if d < 2**63 else None for d in deviations(x, m)], pa.int64())
                w = project(x, m)
                flat = pa.array(w.ravel(), from_pandas=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1], np.int32)), flat)
                n = pa.array(np.full(len(at), m.n, np.int64))
                yield pa.RecordBatch.from_arrays([*rows.columns, n, far, lists], names=names)

    return vectors.mapInArrow(run, schema)


def identity_errors(distinct: DataFrame, models: dict[int, Model]) -> dict[int, float | None]:
    """Per vector length: the largest absolute entry of the whitened vectors' covariance minus the identity."""
    if not models:
        return {}
    rows = whitened(distinct, models)
    most = max(len(m.values) for m in models.values())
    w = [F.get("w", F.lit(k)) for k in range(most)]
    means = {r.dim: r for r in rows.groupBy("dim").agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(w)]).collect()}
    out = {}
    for dim, mean in means.items():
        off = [c - F.lit(mean[f"m{k}"]) for k, c in enumerate(w)]
        pairs = [(a, b) for a in range(most) for b in range(a, most)]
        row = rows.where(F.col("dim") == dim).agg(*[F.avg(off[a] * off[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
        gaps = [abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs if row[f"c{a}_{b}"] is not None]
        out[dim] = max(gaps, default=None)
    return out


def whiten(df: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, one row per usable row and component.

    Rows with a NULL vector, or one holding NULL or non-finite entries, are left out; empty vectors have no
    components and give no rows. NULL and repeated ids stay, each row for itself; repeated vectors count once
    in the fit. Vectors of different lengths are fitted apart. A component along which nothing varies has a
    NULL ``whitened``; with no variance at all ``explained`` and ``identity_error`` are NULL too. A deviation
    beyond the long range is NULL. An empty table gives no rows. Other columns are not looked at.
    """
    vectors = cut(integer_vectors(df, id_column, vector_column))
    distinct = cut(vectors.select("x", "dim").distinct())
    models = fit(distinct, components)
    errors = identity_errors(distinct, models)
    shares = {d: [None if np.isnan(s) else float(s) for s in m.explained] for d, m in models.items()}
    records = [(d, shares[d], errors.get(d)) for d in models]
    model = df.sparkSession.createDataFrame(records, "dim int, explained array<double>, identity_error double")
    rows = whitened(vectors, models).select("id", "dim", "n", "deviation", F.posexplode("w").alias("at", "whitened"))
    return rows.join(F.broadcast(model), "dim").select(  # one record per vector length
        "id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )
