"""Toxic text by a small convolutional network.

Words are hashed to embeddings (a word's own plus its beginning's), filters of several widths slide over
the word sequence, each keeps its largest response, and a logistic layer reads those. Words are counted, the
network is trained and its thresholds are set over all labelled documents on the executors: in every round
each task goes over its documents from the same weights, and the weights are averaged. Only sums and weights,
bounded by the number of hashes, pass the driver. The decision threshold is calibrated per language and moved
to 0.5. At scoring time the language is read from the words of the text alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import keep_columns

HASHES = 1 << 20  # different word hashes: the most entries the network can have
DIMENSIONS, FILTERS, WIDTHS = 8, 6, (1, 2, 3)
PREFIX = 4  # letters of a word's beginning
LEAST_DOCUMENTS = 3  # training documents with an entry before it gets an embedding
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.02, 1e-4
ROUNDS, PASSES = 4, 2  # averages of the weights, and passes of a task over its documents before each
CHUNK = 1000  # documents a task trains on at a time
TASK_BYTES, LEAST_TASKS = 128 << 20, 6  # hashed words that one task counts and trains on; fewer only to have some tasks
BINS = 1000  # logits are told apart by a thousandth when thresholds are set
SEED = 20240603
_WORD = re.compile(r"[^\W_]+")


class Network(NamedTuple):
    """``keys``: sorted hashes with an embedding; row 0 of the tables stands for all others."""

    keys: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    filter_bias: list[np.ndarray]
    out: np.ndarray
    bias: float
    language: np.ndarray  # log odds of each language per entry
    offsets: np.ndarray  # logit threshold per language


def hashes(word: str) -> tuple[int, int]:
    raw = word.encode("utf-8", "replace")
    return zlib.crc32(raw) % HASHES, zlib.crc32(b"^" + word[:PREFIX].encode("utf-8", "replace")) % HASHES


def hash_words(texts: list[str | None], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number of every word, position of the word among the different ones, and their two hashes."""
    rows, sizes = [], []
    for text in texts:
        found = _WORD.findall(text.lower()) if text else []
        sizes.append(len(found))
        for w in found:
            if (at := cache.get(w)) is None:
                at = cache[w] = len(cache)
            rows.append(at)
    pairs = np.array([hashes(w) for w in cache], np.int64).reshape(-1, 2)
    return np.repeat(np.arange(len(texts)), sizes), np.array(rows, np.int64), pairs


def _entries(keys: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Table row of each hash, 0 if it has none."""
    if not len(keys):
        return np.zeros(hashed.shape, np.int64)
    at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
    return np.where(keys[at] == hashed, at + 1, 0)


def _starts(row: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n + 1))


def _responses(net: Network, vectors: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per width: largest response of each filter in each text, and where (-1: the text is too short)."""
    out = []
    for width, weights, bias in zip(WIDTHS, net.filters, net.filter_bias, strict=True):
        n = len(vectors) - width + 1
        best = np.zeros((len(starts) - 1, weights.shape[2]))
        where = np.full(best.shape, -1)
        if n > 0:
            response = sum(vectors[k : k + n] @ weights[k] for k in range(width)) + bias
            for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                if b - a >= width:
                    part = response[a : b - width + 1]
                    where[i] = part.argmax(axis=0) + a
                    best[i] = part.max(axis=0)
        out.append((np.maximum(best, 0), np.where(best > 0, where, -1)))
    return out


def logits(net: Network, entries: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``entries``: two table rows per word."""
    vectors = net.embedding[entries].sum(axis=1)
    pooled = np.concatenate([r[0] for r in _responses(net, vectors, starts)], axis=1)
    return pooled @ net.out + net.bias


def _languages(net: Network, entries: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    if net.language.shape[1] == 1:
        return np.zeros(n, np.int64)
    sums = [np.bincount(row, weights=net.language[entries[:, 0], k], minlength=n) for k in range(net.language.shape[1])]
    return np.argmax(sums, axis=0)


def _gradients(net: Network, entries: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradient of the weighted mean log loss for every parameter of ``_parameters``."""
    vectors = net.embedding[entries].sum(axis=1)
    responses = _responses(net, vectors, starts)
    pooled = np.concatenate([r[0] for r in responses], axis=1)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.bias, -30, 30)))
    error = (p - y) * weight / len(y)
    grads = [np.zeros_like(x) for x in _parameters(net)]
    grads[-2], grads[-1] = pooled.T @ error, np.array([error.sum()])
    back = error[:, None] * net.out
    for k, (width, (_, where)) in enumerate(zip(WIDTHS, responses, strict=True)):
        doc, f = np.nonzero(where >= 0)
        g, at = back[doc, k * FILTERS + f], where[doc, f]
        np.add.at(grads[1 + len(WIDTHS) + k], f, g)
        for j in range(width):
            np.add.at(grads[1 + k][j].T, f, g[:, None] * vectors[at + j])
            for side in (0, 1):
                np.add.at(grads[0], entries[at + j, side], g[:, None] * net.filters[k][j][:, f].T)
    grads[0][0] = 0  # words without an entry stay neutral
    return grads


def _parameters(net: Network) -> list[np.ndarray]:
    return [net.embedding, *net.filters, *net.filter_bias, net.out, np.array([net.bias])]


def _with_parameters(net: Network, state: list[np.ndarray]) -> Network:
    k = len(WIDTHS)
    return net._replace(embedding=state[0], filters=state[1 : 1 + k], filter_bias=state[1 + k : 1 + 2 * k],
                        out=state[-2], bias=float(state[-1][0]))


def train(texts: list[np.ndarray], labels: list[int], langs: list[str | None], seed: int = SEED, odds_start: bool = True) -> Network:
    """Fit on labelled texts, each an array of two hashes per word; every fourth text is left for the thresholds.

    Without texts, or with one class only, the network answers with the share of that class. With ``odds_start``
    one embedding dimension starts at the word's log odds, else all of them start at random.
    """
    y = np.array(labels, float)
    n = len(y)
    row = np.repeat(np.arange(n), [len(t) for t in texts])
    flat = np.concatenate([np.zeros((0, 2), np.uint32), *texts])
    random = np.random.default_rng(seed)
    fitted = np.ones(n, bool)
    fitted[random.permutation(n)[::4]] = False

    # entries by document frequency in the fitted texts, with smoothed log odds of the label as first guess
    seen = np.unique(np.concatenate([(flat[:, k].astype(np.int64) << 31) | row for k in (0, 1)]))
    seen_row = seen & (2**31 - 1)
    seen, seen_row = seen[fitted[seen_row]] >> 31, seen_row[fitted[seen_row]]
    keys, at, df = np.unique(seen, return_inverse=True, return_counts=True)
    positive = np.bincount(at, weights=y[seen_row], minlength=len(keys))
    often = df >= LEAST_DOCUMENTS
    n_pos, n_neg = max(y[fitted].sum(), 1), max((1 - y[fitted]).sum(), 1)
    odds = np.log((positive + 1) / (n_pos + 2)) - np.log((df - positive + 1) / (n_neg + 2))
    names = sorted({x for x in langs if x is not None}) or ["all"]
    lang = np.array([names.index(x) if x in names else -1 for x in langs])
    share = np.stack([np.bincount(at, weights=lang[seen_row] == k, minlength=len(keys)) for k in range(len(names))], 1) if len(keys) else np.zeros((0, len(names)))
    share = np.log((share + 0.5) / (np.array([(lang[fitted] == k).sum() for k in range(len(names))]) + len(names)))
    language = np.concatenate([np.zeros((1, len(names))), share[often] - share[often].mean(axis=1, keepdims=True)])
    keys, odds = keys[often], odds[often]

    embedding = random.normal(0, 0.05, (len(keys) + 1, DIMENSIONS))
    embedding[0] = 0
    filters = [random.normal(0, 0.2, (w, DIMENSIONS, FILTERS)) for w in WIDTHS]
    if odds_start:
        embedding[1:, 0] = np.clip(odds, -3, 3) / 3
        for f in filters:
            f[:, 0, ::2] += 0.7
    net = Network(keys, embedding, filters, [np.zeros(FILTERS) for _ in WIDTHS],
                  random.normal(0, 0.3, FILTERS * len(WIDTHS)), float(np.log(n_pos / n_neg)), language,
                  np.zeros(len(names)))
    if n == 0 or y.min() == y.max():
        return net._replace(out=net.out * 0, bias=float(np.log((y.sum() + 1) / (n - y.sum() + 1))))

    entries, starts = _entries(keys, flat).astype(np.int32), _starts(row, n)
    state = _parameters(net)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in state]
    weight = np.where(y == 1, n / (2 * n_pos), n / (2 * n_neg))
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(np.flatnonzero(fitted))
        for b in range(0, len(order), BATCH):
            chosen = order[b : b + BATCH]
            sizes = starts[chosen + 1] - starts[chosen]
            words = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            batch_starts = np.concatenate([[0], np.cumsum(sizes)])
            grads = _gradients(_with_parameters(net, state), entries[words], batch_starts, y[chosen], weight[chosen])
            step += 1
            for x, g, (m, v) in zip(state, grads, moments, strict=True):
                g += DECAY * x
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    net = _with_parameters(net, state)
    return net._replace(offsets=_thresholds(net, entries, row, starts, y, ~fitted))


def _best_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The logit between two scores that gives the best F1."""
    order = np.argsort(-z, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(z) + 1) + y.sum())
    i = int(np.argmax(f1))
    below = z[order[i + 1]] if i + 1 < len(z) else z[order[i]] - 2
    return float((z[order[i]] + below) / 2)


def _thresholds(net, entries, row, starts, y, calibrate) -> np.ndarray:
    z = logits(net, entries, starts)
    group = _languages(net, entries, row, len(y))
    if not 0 < y[calibrate].sum() < calibrate.sum():
        return net.offsets
    overall = _best_threshold(z[calibrate], y[calibrate])
    offsets = np.full(len(net.offsets), overall)
    for k in range(len(offsets)):
        part = calibrate & (group == k)
        if min(y[part].sum(), (1 - y[part]).sum()) >= 10:  # too few to set a threshold of their own otherwise
            offsets[k] = _best_threshold(z[part], y[part])
    return offsets


def score_texts(net: Network, texts: list[str | None]) -> np.ndarray:
    """Score per text; texts of a batch share the tables of their different words."""
    row, words, pairs = hash_words(texts, {})
    known = _entries(net.keys, pairs)
    # per different word and filter position the response once, then only sums of table rows per word
    vectors = net.embedding[known].sum(axis=1)
    starts = _starts(row, len(texts))
    pooled = []
    for width, weights, bias in zip(WIDTHS, net.filters, net.filter_bias, strict=True):
        n = len(words) - width + 1
        best = np.zeros((len(texts), weights.shape[2]), np.float32)
        if n > 0 and len(words):
            response = (vectors @ weights[0]).astype(np.float32)[words[:n]]
            for k in range(1, width):
                response += (vectors @ weights[k]).astype(np.float32)[words[k : k + n]]
            # windows that cross into the next text do not count
            if width > 1:
                response[row[:n] != row[width - 1 :]] = -np.inf
            full = np.flatnonzero(np.diff(starts) >= width)
            if len(full):
                best[full] = np.maximum.reduceat(response, starts[full], axis=0) + bias
        pooled.append(np.maximum(best, 0))
    z = np.concatenate(pooled, axis=1) @ net.out + net.bias
    language = _languages(net, known[words], row, len(texts)) if len(words) else np.zeros(len(texts), np.int64)
    return 1 / (1 + np.exp(-np.clip(z - net.offsets[language], -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, id_column: str = "doc_id", text_column: str = "text",
                    lang_column: str = "lang", label_column: str = "toxic") -> DataFrame:
    """``(id, text, lang, label)`` of every usable labelled document."""
    key = F.col(f"`{id_column}`").alias("id")
    clean = labels.select(key, F.col(f"`{label_column}`").cast("int").alias("label")).where(usable).dropna()
    one = clean.groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(key, F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang")).where(usable)
    return rows.join(one, "id").select("id", "text", "lang", "label")


def _hashed(sample: DataFrame) -> DataFrame:
    """``(id, lang, label, fitted, words)``: two hashes per word, every fourth document left for the thresholds."""

    def hash_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.iloc[at : at + CHUNK]
                row, words, pairs = hash_words(part["text"].tolist(), {})
                starts = _starts(row, len(part))
                flat = [pairs[words[a:b]].astype(np.uint32).tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield part[["id", "lang", "label"]].assign(words=flat)

    rows = sample.mapInPandas(hash_all, "id long, lang string, label int, words binary")
    return rows.withColumn("fitted", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) != 0)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Documents with the hashes of their words and the start of each."""
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            part = batch.iloc[at : at + CHUNK]
            texts = [np.frombuffer(bytes(x), np.uint32).reshape(-1, 2) for x in part["words"]]
            yield part, np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def _gathered(df: DataFrame) -> pd.DataFrame:
    """A bounded table on the driver; as Arrow whatever the session says, not as an object for every value."""
    return df.toArrow().to_pandas()


def _in_tasks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of ``size`` bytes of words in few tasks: each sends every weight it has moved, a chunk at a time is in memory."""
    return rows.coalesce(max(LEAST_TASKS, -(-size // TASK_BYTES)))


def _count(rows: DataFrame, names: list[str]) -> pd.DataFrame:
    """Per hash that enough documents hold: documents, toxic ones and those of each language."""
    kinds = ["df", "positive", *(f"l{k}" for k in range(len(names)))]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, flat, starts in _chunks(batches):
            row = np.repeat(np.arange(len(part)), np.diff(starts))
            seen = np.unique(np.concatenate([(flat[:, k].astype(np.int64) << 31) | row for k in (0, 1)]))
            seen, row = seen >> 31, seen & (2**31 - 1)
            key, at = np.unique(seen, return_inverse=True)
            lang, y = part["lang"].to_numpy(), part["label"].to_numpy()
            flags = [np.ones(len(row)), y[row], *((lang == n)[row] for n in names)]
            yield pd.DataFrame({"key": key, **{c: np.bincount(at, weights=f, minlength=len(key)).astype(np.int64) for c, f in zip(kinds, flags, strict=True)}})

    parts = rows.mapInPandas(count, "key long, " + ", ".join(f"{c} long" for c in kinds))
    total = parts.groupBy(F.col("key").cast("int").alias("key")).agg(*(F.sum(c).cast("int").alias(c) for c in kinds)).where(F.col("df") >= LEAST_DOCUMENTS)
    return _gathered(total).sort_values("key")


def _start(counts: pd.DataFrame, totals: pd.DataFrame, names: list[str], seed: int, odds_start: bool) -> Network:
    """The network before training, from the counts of all documents; ``totals``: documents per label and language."""
    random = np.random.default_rng(seed)
    n_pos, n_neg = (max(float(totals["n"][totals["label"] == y].sum()), 1.0) for y in (1, 0))
    df, positive = (counts[c].to_numpy(float) for c in ("df", "positive"))
    odds = np.log((positive + 1) / (n_pos + 2)) - np.log((df - positive + 1) / (n_neg + 2))
    groups = names or ["all"]
    share = counts[[f"l{k}" for k in range(len(names))]].to_numpy(float) if names else np.zeros((len(df), 1))
    of_lang = np.array([float(totals["n"][totals["lang"] == x].sum()) for x in groups])
    share = np.log((share + 0.5) / (of_lang + len(groups)))
    embedding = random.normal(0, 0.05, (len(df) + 1, DIMENSIONS))
    embedding[0] = 0
    filters = [random.normal(0, 0.2, (w, DIMENSIONS, FILTERS)) for w in WIDTHS]
    if odds_start:
        embedding[1:, 0] = np.clip(odds, -3, 3) / 3
        for f in filters:
            f[:, 0, ::2] += 0.7
    return Network(counts["key"].to_numpy(np.int64), embedding, filters, [np.zeros(FILTERS) for _ in WIDTHS],
                   random.normal(0, 0.3, FILTERS * len(WIDTHS)), float(np.log(n_pos / n_neg)),
                   np.concatenate([np.zeros((1, len(groups))), share - share.mean(axis=1, keepdims=True)]),
                   np.zeros(len(groups)))


def _steps(net: Network, hashed: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray, random, rate: float) -> tuple[Network, np.ndarray]:
    """``PASSES`` of Adam over some documents, and the entries that took part; others stay as they are."""
    table = np.zeros(HASHES, np.int32)
    table[net.keys] = np.arange(1, len(net.keys) + 1)
    entries = table[hashed]
    part = np.zeros(len(net.embedding), bool)
    part[entries] = part[0] = True
    used = np.flatnonzero(part)
    entries = (np.cumsum(part, dtype=np.int32) - 1)[entries]
    state = [net.embedding[used], *(x.copy() for x in _parameters(net)[1:])]
    moments, step = [(np.zeros_like(p), np.zeros_like(p)) for p in state], 0
    for _ in range(PASSES):
        order = random.permutation(len(y))
        for b in range(0, len(order), BATCH):
            chosen = order[b : b + BATCH]
            words = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            batch_starts = np.concatenate([[0], np.cumsum(starts[chosen + 1] - starts[chosen])])
            # a step costs what its documents hold: only their rows of the embedding move
            part = np.zeros(len(used), bool)
            part[entries[words]] = part[0] = True
            rows = np.flatnonzero(part)
            local = (np.cumsum(part, dtype=np.int32) - 1)[entries[words]]
            now = [state[0][rows], *state[1:]]
            grads = _gradients(_with_parameters(net, now), local, batch_starts, y[chosen], weight[chosen])
            step += 1
            kept = [tuple(x[rows] for x in moments[0]), *moments[1:]]
            for x, g, (m, v) in zip(now, grads, kept, strict=True):
                g += DECAY * x
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            state[0][rows], moments[0][0][rows], moments[0][1][rows] = now[0], *kept[0]
    net.embedding[used] = state[0]
    return _with_parameters(net, [net.embedding, *state[1:]]), used


def _dense(net: Network) -> np.ndarray:
    """All parameters but the embedding, in rows as wide as the embedding's."""
    flat = np.concatenate([x.ravel() for x in _parameters(net)[1:]])
    return np.append(flat, np.zeros(-len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)


def _with_dense(net: Network, embedding: np.ndarray, rows: np.ndarray) -> Network:
    shapes, flat = [x.shape for x in _parameters(net)[1:]], rows.ravel()
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    parts = [flat[b - int(np.prod(x)) : b].reshape(x).copy() for x, b in zip(shapes, ends, strict=True)]
    return _with_parameters(net, [embedding, *parts])


def _round(rows: DataFrame, net: Network, weights: tuple[float, float], seed: int, rate: float) -> Network:
    """Every task trains on its documents from ``net``; each weight becomes its mean over the tasks that moved it."""
    values = [f"d{k}" for k in range(DIMENSIONS)]  # moved as float, summed as double
    small = net._replace(embedding=net.embedding.astype(np.float32), language=np.zeros((1, 1)))  # no languages in training
    shared = rows.sparkSession.sparkContext.broadcast(tuple(small))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine, moved, n = None, [], 0
        for part, hashed, starts in _chunks(batches):
            if mine is None:
                mine = Network(*shared.value)
                mine = mine._replace(embedding=mine.embedding.astype(float))
            y = part["label"].to_numpy(float)
            mine, used = _steps(mine, hashed, starts, y, np.where(y == 1, *weights), np.random.default_rng([seed, n]), rate)
            moved, n = [np.unique(np.concatenate([*moved, used]))], n + len(part)
        if n:
            top = len(mine.embedding)
            dense = _dense(mine)
            at = np.concatenate([moved[0], np.arange(top, top + len(dense))])
            block = np.concatenate([mine.embedding[moved[0]], dense]).astype(np.float32)
            yield pd.DataFrame(block, columns=values).assign(at=at, n=float(n))

    parts = rows.mapInPandas(learn, ", ".join(f"{c} float" for c in values) + ", at long, n double")
    # a task gives a row once, so nothing is summed before the exchange and floats pass it as floats
    dealt = parts.withColumn("at", F.col("at").cast("int")).repartition("at")
    mean = _gathered(dealt.groupBy("at").agg(*((F.sum(F.col(c) * F.col("n")) / F.sum("n")).cast("float").alias(c) for c in values)))
    shared.destroy()
    at, found = mean.pop("at").to_numpy(), mean.to_numpy()
    top, embedding, dense = len(net.embedding), net.embedding.copy(), _dense(net)
    embedding[at[at < top]] = found[at < top]
    dense[at[at >= top] - top] = found[at >= top]
    return _with_dense(net, embedding, dense)


def _calibrate(rows: DataFrame, net: Network) -> Network:
    """Thresholds from the logits of all documents left for them, counted per language and thousandth."""
    shared = rows.sparkSession.sparkContext.broadcast(tuple(net))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Network(*shared.value)
        for part, hashed, starts in _chunks(batches):
            entries = _entries(model.keys, hashed)
            group = _languages(model, entries, np.repeat(np.arange(len(part)), np.diff(starts)), len(part))
            z = np.clip(logits(model, entries, starts), -500, 500)
            yield pd.DataFrame({"k": group, "bin": np.floor(z * BINS).astype(np.int64), "label": part["label"].to_numpy(np.int64)})

    placed = rows.mapInPandas(place, "k long, bin long, label long")
    found = _gathered(placed.groupBy("k", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("hit")))
    shared.destroy()

    def best(part: pd.DataFrame) -> float:
        part = part.groupby("bin")[["n", "hit"]].sum().sort_index(ascending=False)
        low, hit = part.index.to_numpy() / BINS, part["hit"].to_numpy().cumsum()
        i = int(np.argmax(2 * hit / (part["n"].to_numpy().cumsum() + part["hit"].sum())))
        return float((low[i] + (low[i + 1] + 1 / BINS if i + 1 < len(low) else low[i] - 2)) / 2)

    if not 0 < found["hit"].sum() < found["n"].sum():
        return net
    offsets = np.full(len(net.offsets), best(found))
    for k in range(len(offsets)):
        part = found[found["k"] == k]
        if min(part["hit"].sum(), (part["n"] - part["hit"]).sum()) >= 10:  # too few to set a threshold of their own otherwise
            offsets[k] = best(part)
    return net._replace(offsets=offsets)


def fit(sample: DataFrame, seed: int = SEED, odds_start: bool = True) -> Network:
    """Train on all rows of ``(id, text, lang, label)``, on the executors.

    Texts of any length are read whole. A document labelled more than once counts as toxic if any label says so.
    Without texts, or with one class only, the network answers with the share of that class.
    """
    # stored once in an order of their own, whatever the tasks that hashed them; every round reads the files
    dealt = _hashed(sample).repartition(F.xxhash64("id", F.lit(2)))
    rows = cut(dealt.sortWithinPartitions(F.xxhash64("id", F.lit(3)), "id", "words"))
    size = F.sum(F.octet_length("words")).alias("bytes")
    totals = _gathered(rows.groupBy("fitted", "label", "lang").agg(F.count("*").alias("n"), size))
    fitted, n = totals[totals["fitted"].astype(bool)], float(totals["n"].sum())
    n_pos, n_neg = (float(fitted["n"][fitted["label"] == y].sum()) for y in (1, 0))
    names = sorted(set(fitted["lang"].dropna()))
    learn = _in_tasks(rows.where("fitted"), int(fitted["bytes"].sum()))
    net = _start(_count(learn, names), fitted, names, seed, odds_start)
    if not n_pos or not n_neg:
        toxic = float(totals["n"][totals["label"] == 1].sum())
        return net._replace(out=net.out * 0, bias=float(np.log((toxic + 1) / (n - toxic + 1))))
    total = n_pos + n_neg
    for k in range(ROUNDS):
        net = _round(learn, net, (total / (2 * n_pos), total / (2 * n_neg)), seed + k, RATE / (k + 1))
    return _calibrate(rows.where("NOT fitted"), net)


def score(docs: DataFrame, net: Network, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced.

    Only the text is read, all of it. A NULL or empty text gets the score of no words. Repeated texts get
    equal scores; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(net))  # at most one entry per hash

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Network(*shared.value)
        for texts in parts:
            values = texts.tolist()
            yield pd.Series(np.concatenate([score_texts(model, values[i : i + 256]) for i in range(0, len(values), 256)])
                            if values else np.zeros(0))

    scored = docs.withColumn("_toxic", run(F.col(f"`{text_column}`")))
    return keep_columns(scored, {"score": F.col("_toxic"), "predicted": (F.col("_toxic") >= 0.5).cast("int")}).drop("_toxic")
