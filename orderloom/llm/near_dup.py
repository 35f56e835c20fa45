"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

SuperMinHash gives each shingle a random permutation of the signature's slots; a slot keeps the smallest
``rank + fraction`` over all shingles. Ranks are handed out level by level, and a document is finished once
every slot holds a value below the next level, for most texts after two or three of ``SLOTS`` levels.

Equal texts form one class and are hashed into buckets once. Classes that share a bucket may be linked:

1. Each class of a bucket is compared with the bucket's first class only: as many pairs as memberships.
2. Links are contracted to components. Buckets whose classes are now all in one component are settled.
3. In the others only classes of different components are compared: in small buckets pair by pair, in large
   ones in blocks of bounded size that report a spanning forest of the links they find.

So no bucket is expanded into all its pairs unless its members are all different, and none is cut short.
A pair at similarity 0.8 shares none of the buckets with a chance of 3e-6, at 0.85 of 7e-9. Signatures only
choose pairs; every link is confirmed on full shingle sets (64-bit hashes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import mix, same

SHINGLE = 5
SLOTS, ROWS = 160, 5  # 32 bands of 5 slots
SMALL = 64  # classes of a bucket that are compared pair by pair
BLOCK = 256
AT_ONCE = 1 << 16  # shingles whose permutations are in memory together
PERCENT = 80

_STEP = 0x9E3779B97F4A7C15


def _seed(k: int) -> np.uint64:
    return np.uint64(k * _STEP % 2**64)


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; of all words if there are fewer."""
    from xxhash import xxh3_64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += mix(h[k : k + n] + _seed(k + 1))
    return np.unique(mix(total))


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row per set: for each slot the bits of the smallest ``rank + fraction``."""
    out = np.full((len(sets), slots), np.inf)
    flat = out.reshape(-1)
    item = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots < 256 else np.uint16), (len(item), 1))
    for level in range(slots):
        if not len(item):
            break
        x = mix(item + _seed(level + 1))
        other = level + (mix(x + _seed(1)) % np.uint64(slots - level)).astype(np.int64)
        at = np.arange(len(item))
        slot = order[at, other].copy()
        order[at, other] = order[:, level]
        order[:, level] = slot
        np.minimum.at(flat, owner * slots + slot, level + (x >> np.uint64(11)) * 2.0**-53)
        finished = out.max(axis=1) < level + 1
        if finished.any():
            go_on = ~finished[owner]
            if not go_on.all():
                item, owner, order = item[go_on], owner[go_on], order[go_on]
    return out.view(np.uint64)


def band_buckets(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One bucket per band, as long integers; bands do not share buckets."""
    n, slots = signatures.shape
    bands = mix(signatures + np.arange(1, slots + 1, dtype=np.uint64) * _seed(1)).reshape(n, slots // rows, rows)
    return mix(bands.sum(axis=2, dtype=np.uint64) + np.arange(slots // rows, dtype=np.uint64)).view(np.int64)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from xxhash import xxh3_64_intdigest

    for batch in batches:
        start, sets, nodes, load = 0, [], [], 0
        for end, text in enumerate(batch["text"], 1):
            words = split_words(text)
            sets.append(shingles(words))
            nodes.append(xxh3_64_intdigest(b" ".join(words)))
            load += len(sets[-1])
            if load < AT_ONCE and end < len(batch):
                continue
            signatures = superminhash(sets)
            buckets = band_buckets(signatures)
            short = (mix(signatures) >> np.uint64(48)).astype(np.uint16)
            part = batch.iloc[start:end]
            yield pd.DataFrame({
                "id": part["id"], "row_key": part["row_key"], "node": np.array(nodes, np.uint64).view(np.int64),
                "n": [len(s) for s in sets],
                "sketch": [s.tobytes() for s in short],
                "buckets": [b if len(s) else b[:0] for b, s in zip(buckets, sets, strict=True)],
            })
            start, sets, nodes, load = end, [], [], 0


def signed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, row_key, node, n, sketch, buckets)`` per row; ``node`` is the class of equal word sequences."""
    id_, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`")
    rows = docs.select(id_.alias("id"), row_key(id_, text).alias("row_key"), text.alias("text"))
    return rows.mapInPandas(_sign, "id long, row_key long, node long, n long, sketch binary, buckets array<long>")


def row_key(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text)


def contract(edges: DataFrame) -> DataFrame:
    """``(node, root)``: union-find over ``(a, b)``, by rounds of contraction.

    In a round every node moves to the neighbour, or stays, whichever comes first in an order that is
    random for the round; edges are rewritten to the new nodes. Some nodes move wherever an edge is left,
    on average a fixed share of them, so the number of rounds grows with the logarithm of the longest chain.
    """
    edges = cut(edges.where("a <> b").select("a", "b").distinct())
    roots, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = both.select("a", F.struct(F.xxhash64(F.lit(turn), "b").alias("h"), "b").alias("m"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("b"))
        first = ranked.groupBy("a").agg(F.min("m").alias("m"))
        moves = cut(first.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("root")))
        to_a = moves.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = moves.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = cut(edges.join(to_a, "a").join(to_b, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        if roots is None:
            roots = moves
        else:
            step = moves.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = cut(roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        turn += 1
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def least_agreement(percent: int, slots: int = SLOTS) -> int:
    """Slots that a pair at the threshold shares but for 5.5 standard deviations."""
    t = percent / 100
    return int(slots * t - 5.5 * (slots * t * (1 - t)) ** 0.5)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches do not rule out a link."""
    least = least_agreement(percent)

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        left = np.frombuffer(b"".join(x), np.uint16).reshape(len(x), -1)
        return pd.Series((left == np.frombuffer(b"".join(y), np.uint16).reshape(len(x), -1)).sum(axis=1) >= least)

    a = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.where(agree("sa", "sb")).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with ``100 * intersection >= percent * union`` on full sets."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(a, "a").join(b, "b").where(linked("xa", "xb")).select("a", "b")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(node, shingles)`` for the classes ``(node, row_key)``."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(split_words(t)).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": sets})

    id_, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`")
    rows = docs.select(row_key(id_, text).alias("row_key"), text.alias("text")).join(wanted, "row_key")
    return rows.dropDuplicates(["row_key"]).select("node", "text").mapInPandas(make, "node long, shingles binary")


def _block_links(percent: int):
    """Links between the classes of one block, or of two: a spanning forest over what they had in common."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        n = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), n)
        _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = df[column] > 1
        owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [start, start + 4096])
            dense = np.zeros((len(sets), 4096), np.float32)
            dense[owner[a:b], column[a:b] - start] = 1
            both += dense @ dense.T
        both = both.astype(np.int64)
        comp, block = group["comp"].to_numpy(), group["block"].to_numpy()
        link = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (comp[:, None] != comp[None, :])
        if block.min() != block.max():
            link &= block[:, None] != block[None, :]
        parent: dict[int, int] = {}

        def find(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                c = up
            return c

        edges, node = [], group["node"].to_numpy()
        for i, j in zip(*np.nonzero(np.triu(link)), strict=True):
            x, y = find(comp[i]), find(comp[j])
            if x != y:
                parent[x] = y
                edges.append((node[i], node[j]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return run


def blocked_links(members: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links between components inside the buckets of ``(bucket, size, node, comp)``, block against block."""
    count = F.ceil(F.col("size") / block).cast("long")
    own = F.pmod(F.xxhash64("bucket", "node"), count)
    placed = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    placed = placed.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    full = placed.join(sets, "node").select("bucket", "lo", "hi", "block", "node", "comp", "shingles")
    return full.groupBy("bucket", "lo", "hi").applyInPandas(_block_links(percent), "a long, b long").distinct()


def _with_component(df: DataFrame, roots: DataFrame) -> DataFrame:
    return df.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")


def link_classes(classes: DataFrame, docs: DataFrame, id_column: str, text_column: str, percent: int) -> DataFrame:
    """``(node, root)`` for every class linked to another one."""
    entries = classes.select("node", F.explode("buckets").alias("bucket"))
    # sizes are stored before they are joined: then the join reads two exchanges, and adaptive execution can split
    # the members of a hot bucket over tasks
    shared = cut(entries.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1"))
    members = cut(entries.join(shared, "bucket"))
    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    candidates = classes.join(members.select("node").distinct(), "node").select("node", "n", "sketch", "row_key")
    candidates = cut(candidates)
    sets = cut(shingle_sets(docs, candidates.select("node", "row_key"), id_column, text_column))
    links = cut(verified(likely(stars, candidates, percent), sets, percent))
    roots = contract(links)

    placed = _with_component(members, roots)
    mixed = cut(placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi"))
    unsettled = cut(placed.where("size > 2").join(mixed.select("bucket"), "bucket", "left_semi"))
    left = unsettled.where(F.col("size") <= SMALL).select("bucket", F.col("node").alias("a"), F.col("comp").alias("ca"), "hub")
    right = unsettled.where(F.col("size") <= SMALL).select("bucket", F.col("node").alias("b"), F.col("comp").alias("cb"))
    pairs = left.join(right, "bucket").where("a < b AND ca <> cb AND a <> hub AND b <> hub").select("a", "b").distinct()
    more = verified(likely(pairs, candidates, percent), sets, percent)
    large = blocked_links(unsettled.where(F.col("size") > SMALL), sets, percent)
    found = cut(more.unionByName(large))
    return roots if found.isEmpty() else contract(links.unionByName(found))


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(id, row_key, n_shingles, component_id, kept, first)``, one row per row of ``docs``.

    Documents with ``100 * intersection >= percent * union`` of their distinct 5-word shingles are linked
    (fewer words: the whole sequence is the one shingle). ``component_id`` is the smallest id reachable over
    links; ``kept`` says that it is the row's own. A text without words, or NULL, is linked with nothing and
    kept. Ids should be unique: rows repeated with id and text are all kept or none, and ``first`` is true
    for one of them. NULL ids are passed over by the minimum; a group with no id at all has component NULL and keeps
    the rows. An empty table gives no rows. Other columns are not looked at.
    """
    rows = cut(signed(docs, id_column, text_column))
    classes = cut(
        rows.where("n > 0").groupBy("node")
        .agg(F.min("row_key").alias("row_key"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
             F.first("buckets").alias("buckets"))
    )
    roots = link_classes(classes, docs, id_column, text_column, percent)
    least = rows.where("n > 0").groupBy("node").agg(F.min_by(F.struct("id", "row_key"), F.struct(F.col("id").isNull(), "id", "row_key")).alias("least"),
                                                    F.min("id").alias("id"))
    placed = cut(_with_component(least, roots))
    whole = placed.groupBy("comp").agg(F.min("id").alias("component_id"), F.min_by("least", F.struct(F.col("least.id").isNull(), "least")).alias("keeper"))
    answer = placed.join(whole, "comp").select("node", "component_id", "keeper")
    out = rows.select("id", "row_key", "node", "n").join(answer, "node", "left")
    empty = F.col("n") == 0
    return out.select(
        "id", "row_key", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | same(F.col("id"), F.col("component_id"))).alias("kept"),
        (empty | ((F.col("row_key") == F.col("keeper.row_key")) & same(F.col("id"), F.col("keeper.id")))).alias("first"),
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group, with the columns of ``docs``; texts without words all stay."""
    judged = group(docs, id_column, text_column, percent)
    chosen = judged.where("first").groupBy("row_key").agg(F.max(F.col("n_shingles") == 0).alias("empty"), F.count("*").alias("rows"))
    # prefixed, the columns of the caller clash with none of ours
    plain = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    keyed = plain.withColumn("row_key", row_key(F.col(f"`in_{id_column}`").cast("long"), F.col(f"`in_{text_column}`")))
    joined = keyed.join(chosen, "row_key")
    repeated = joined.where("NOT empty AND rows > 1").dropDuplicates(["row_key"])
    kept = joined.where("empty OR rows = 1").unionByName(repeated)
    return kept.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])
