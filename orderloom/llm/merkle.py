"""A Merkle manifest of a table, and inclusion proofs for all rows by Octopus multiproofs.

Every group (language) has a tree over its rows in order of their ids, and a top tree stands over the groups'
roots. Eight consecutive nodes make one of the next level. A digest is the lowercase hex SHA-256 of what it
covers, digests entering as hex text.

Rows are hashed where they are read; after that only digests move. They are numbered in Spark's own range
partitions and dealt into blocks of at most 512 leaves of one tree. A block folds its own leaves, so only nodes
above blocks need to be looked up: each block lists the fewest nodes from which, with its own, all its proofs
follow (the siblings that it cannot derive), fetches them in one join, derives what its leaves share once, and
spells out the proof of every leaf. Equal rows travel as one with a count, so they cannot form a hot block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import order_globally
from ..session import cut

ARITY = 8
DEPTH = 3  # levels that a block folds by itself: it holds ARITY ** DEPTH nodes
TOP = 0  # number of the tree over the groups' roots; groups have 1, 2, ... in order


class Manifest(NamedTuple):
    leaves: DataFrame  # tree, width (leaves of the tree), start, n, id, leaf, changed: n equal rows from place start on
    nodes: DataFrame  # tree, level, place, hash: all nodes but leaves of groups
    groups: DataFrame  # group_key, tree, width
    n_groups: int
    root: str | None  # None for an empty table


def field(value: Column | str) -> Column:
    """``-`` for NULL, else byte count, colon, value as text."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column | str) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def widths(leaves: int) -> list[int]:
    """Nodes of each level, from the leaves to the single one on top."""
    out = [leaves]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def fold(hashes: list[str], levels: int) -> Iterator[list[str]]:
    """The next levels over nodes that begin at a multiple of ``ARITY ** levels``."""
    for _ in range(levels):
        hashes = [_hash("".join(hashes[k : k + ARITY])) for k in range(0, len(hashes), ARITY)]
        yield hashes


def missing(places: np.ndarray, level_widths: list[int]) -> list[tuple[int, np.ndarray]]:
    """Octopus: the fewest nodes, as level and places, that with the nodes at ``places`` of the lowest level prove
    each of these. What derives from nodes at hand is not among them."""
    out, own = [], np.unique(places)
    for level, width in enumerate(level_widths[:-1]):
        runs = np.unique(own // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        members = members[members < width]
        out.append((level, np.setdiff1d(members, own, assume_unique=True)))
        own = runs
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` ``(group_key, id, leaf, changed, n)`` with ``start``, the rows of the group before them.

    Rows are written once in ranges; one small record per range and group turns sums within ranges into sums
    over the group.
    """
    order = ["id", "leaf", "changed"]
    ranged = cut(rows.repartitionByRange("group_key", *order).withColumn("range", F.spark_partition_id()))
    parts = ranged.groupBy("group_key", "range").agg(F.sum("n").alias("rows"))
    earlier = Window.partitionBy("group_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")
    upto = Window.partitionBy("group_key", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumn("inside", F.sum("n").over(upto) - F.col("n"))
    return inside.join(bases, ["group_key", "range"]).withColumn("start", F.col("base") + F.col("inside")).drop(
        "base", "inside", "range"
    )


def _blocks(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Leaves cut at blocks: ``n`` equal rows from ``start`` on lie in one block each."""
    size = ARITY**depth
    spans = leaves.withColumnsRenamed({"start": "from", "n": "rows"}).withColumn("to", F.col("from") + F.col("rows"))
    touched = F.sequence(F.floor(F.col("from") / size), F.floor((F.col("to") - 1) / size))
    start = F.greatest(F.col("from"), F.col("block") * size)
    n = F.least(F.col("to"), (F.col("block") + 1) * size) - start
    return spans.withColumn("block", F.explode(touched)).withColumn("start", start).withColumn("n", n).drop("from", "to", "rows")


def _build(leaves: DataFrame, most: int) -> list[DataFrame]:
    """All nodes above leaves ``(tree, width, start, n, leaf)``; ``most`` leaves in the largest tree. Each round
    folds blocks of the level reached so far."""
    size = ARITY**DEPTH

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        tree, block, width = (int(rows[c].iloc[0]) for c in ("tree", "block", "width"))
        hashes = list(np.repeat(rows["leaf"].to_numpy(object), rows["n"].to_numpy()))
        out = []
        wide = len(widths(width)) - 1
        for k, level in enumerate(fold(hashes, min(DEPTH, wide)), 1):
            first = block * ARITY ** (DEPTH - k)
            out += [(tree, width, k, first + i, h) for i, h in enumerate(level)]
        return pd.DataFrame(out, columns=["tree", "width", "up", "place", "hash"])

    out, done = [], 0
    level = leaves.where("width > 1").select("tree", "width", "start", "n", "leaf")
    while most > 1:
        folded = cut(_blocks(level).groupBy("tree", "block").applyInPandas(run, "tree long, width long, up int, place long, hash string"))
        out.append(folded.select("tree", (F.col("up") + done).alias("level"), "place", "hash"))
        reached = folded.where(F.col("up") == DEPTH).select(
            "tree", F.ceil(F.col("width") / size).cast("long").alias("width"), F.col("place").alias("start"),
            F.lit(1).cast("long").alias("n"), F.col("hash").alias("leaf"),
        )
        level, most, done = reached.where("width > 1"), -(-most // size), done + DEPTH
    return out


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows ``(group, id, leaf, changed)``: ``leaf`` is the digest in the tree, ``changed`` a digest
    to be tested in its place. Groups are ordered by name, NULL first; leaves by id, NULL first, then digest."""
    key = F.when(F.col("group").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("group").cast("string")))
    hashed = cut(rows.groupBy(key.alias("group_key"), "id", "leaf", "changed").agg(F.count("*").alias("n")))
    sizes = cut(hashed.groupBy("group_key").agg(F.sum("n").alias("width")))
    groups = cut(order_globally(sizes, F.col("group_key"), "group_key").select(
        "group_key", F.col("position").alias("tree"), "width"))
    bounds = groups.agg(F.count("*").alias("n"), F.max("width").alias("most")).first()
    leaves = cut(_numbered(hashed).join(groups, "group_key").select("tree", "width", "start", "n", "id", "leaf", "changed"))
    nodes = _build(leaves, bounds.most or 0)
    # a group's root is its highest node, or its only leaf
    single = leaves.where("width = 1").select("tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("place"), F.col("leaf").alias("hash"))
    every = single
    for part in nodes:
        every = every.unionByName(part)
    roots = cut(every.groupBy("tree").agg(F.max_by("hash", "level").alias("hash")))
    top = roots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(bounds.n).alias("width"), (F.col("tree") - 1).alias("start"),
        F.lit(1).cast("long").alias("n"), F.col("hash").alias("leaf"),
    )
    above = _build(top, bounds.n)
    out = top.select("tree", F.lit(0).alias("level"), F.col("start").alias("place"), F.col("leaf").alias("hash"))
    for part in nodes + above:
        out = out.unionByName(part)
    found = out.where(F.col("tree") == TOP).agg(F.max_by("hash", "level").alias("root")).first()
    return Manifest(leaves, out, groups, bounds.n, found.root)


def _missing_of_blocks(blocks: DataFrame, n_groups: int) -> DataFrame:
    """``(tree, block, in_tree, level, place)``: what each block ``(tree, block, width, first, last)`` has to fetch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                own = missing(np.arange(r.first, r.last + 1), widths(r.width))
                above = missing(np.array([r.tree - 1]), widths(n_groups))
                for tree, parts in ((r.tree, own), (TOP, above)):
                    out += [(r.tree, r.block, tree, level, int(p)) for level, places in parts for p in places]
            yield pd.DataFrame(out, columns=["tree", "block", "in_tree", "level", "place"])

    return blocks.mapInPandas(run, "tree long, block long, in_tree long, level int, place long")


def _expand(leaves: list[str], first: int, width: int, tree: int, n_groups: int, fetched: dict[tuple[int, int, int], str]):
    """For neighbouring leaves: the siblings on the left and right of every node on their ways, level by level.

    Returns ``steps``, a list of levels, each a dict from place to ``(left, right)``, and group root and root.
    """
    steps: list[dict[int, tuple[str, str]]] = []
    own = dict(enumerate(leaves, first))
    subroot = None
    for name, level_widths in ((tree, widths(width)), (TOP, widths(n_groups))):
        for level, wide in enumerate(level_widths[:-1]):
            step, parents = {}, {}
            for run in sorted({p // ARITY for p in own}):
                members = range(run * ARITY, min((run + 1) * ARITY, wide))
                hashes = [own[p] if p in own else fetched[name, level, p] for p in members]
                for k, p in enumerate(members):
                    if p in own:
                        step[p] = "".join(hashes[:k]), "".join(hashes[k + 1 :])
                parents[run] = _hash("".join(hashes))
            steps.append(step)
            own = parents
        if name != TOP:
            (subroot,) = own.values()
            own = {tree - 1: subroot}
            steps.append({})  # from the group's root to its place in the top tree
    (root,) = own.values()
    return steps, subroot, root


def prove(m: Manifest) -> DataFrame:
    """``(id, leaf, changed, subroot, root, proof, folded_root)``, one row per row of the table.

    ``proof`` is the digest of all siblings of the leaf, level by level and from left to right; ``folded_root``
    comes from the leaf ``changed`` and these siblings. An empty table gives no rows.
    """
    blocks = _blocks(m.leaves)
    bounds = blocks.groupBy("tree", "block").agg(
        F.first("width").alias("width"), F.min("start").alias("first"), (F.max(F.col("start") + F.col("n")) - 1).alias("last")
    )
    wanted = _missing_of_blocks(bounds, m.n_groups)
    nodes = m.nodes.withColumnRenamed("tree", "in_tree")
    fetched = wanted.join(nodes, ["in_tree", "level", "place"])
    id_type, n_groups = m.leaves.schema["id"].dataType, m.n_groups

    def run(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        times = rows["n"].to_numpy()
        each = rows.loc[rows.index.repeat(times), ["id", "leaf", "changed"]].reset_index(drop=True)
        first, tree, width = (int(rows[c].iloc[0]) for c in ("start", "tree", "width"))
        have = dict(zip(zip(nodes["in_tree"], nodes["level"], nodes["place"], strict=True), nodes["hash"], strict=True))
        steps, subroot, root = _expand(list(each["leaf"]), first, width, tree, n_groups, have)
        levels = len(widths(width)) - 1
        # the ways from a node upwards, from the top down, so that what leaves share is put together once
        ways: dict[int, str] = {}
        for k in range(len(steps) - 1, -1, -1):
            if k == levels:  # the group's root becomes a leaf of the top tree
                ways = {0: ways.get(tree - 1, "")}
            else:
                ways = {p: left + right + ways.get(p // ARITY, "") for p, (left, right) in steps[k].items()}
        proofs, folded = [], []
        for place, leaf in enumerate(each["changed"], first):
            proofs.append(_hash(ways[place] if place in ways else ""))
            for k, step in enumerate(steps):
                if k == levels:
                    place = tree - 1
                    continue
                left, right = step[place]
                leaf = _hash(left + leaf + right)
                place //= ARITY
            folded.append(leaf)
        return each.assign(subroot=subroot, root=root, proof=proofs, folded_root=folded)

    schema = f"id {id_type.simpleString()}, leaf string, changed string, subroot string, root string, proof string, folded_root string"
    return blocks.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInPandas(run, schema)


def tampered(text: Column, id_: Column) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC of the id; elsewhere, and for a NULL id, as it is."""
    hit = F.coalesce(F.crc32(id_.cast("string")) % 3 == 0, F.lit(False))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate(text, letters, letters.lower())).otherwise(text)


def verify_documents(docs: DataFrame) -> DataFrame:
    """``(id, leaf, subroot, root, proof, folded_root, verified)`` of documents, a third of them tampered with.

    Leaves cover ``doc_id source lang n_chars text``, NULL being distinct from every value; other columns are
    not looked at. Every row is a leaf, also with a NULL or repeated id; equal ids are ordered by digest. Whole
    texts of any length are hashed where they are read. An empty table gives no rows.
    """
    columns = ["doc_id", "source", "lang", "n_chars"]
    rows = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("id"), leaf_hash(*columns, "text").alias("leaf"),
        leaf_hash(*columns, tampered(F.col("text"), F.col("doc_id"))).alias("changed"),
    )
    manifest = build(rows)
    proofs = prove(manifest)
    return proofs.select("id", "leaf", "subroot", "root", "proof", "folded_root",
                         (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))
