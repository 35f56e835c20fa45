"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every source gets a share of all words. A document of a source is taken ``target / words of the source``
times on average; the whole part is certain, the fraction is rounded. Fractions are not rounded one by
one: two documents exchange words until the fraction of one of them is 0 or 1, up or down at random with
odds that leave every expectation as it is. The words of the pair stay the same, so a source misses its
target by less than one document, whatever its size. Rows that share id, source and size are not rounded as
one: the whole copies of the group are certain, and only what is left of one row takes part.

Pairs are formed inside chunks of about ``FAN_IN`` documents. A chunk leaves at most one undecided
document; those of ``FAN_IN`` neighbouring chunks meet in the next level, until one is left per source.
A hot source only has more chunks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import order_globally
from ..session import cut
from .common import keep_columns, same, uniform, words

WEIGHTS = (5, 2, 1)
CAP = 3
FAN_IN = 64
SEED = 20240607


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, words, weight, target)`` from ``(source, words)`` with one row per source.

    Sources in code-point order, NULL last, take ``weights`` in turn. They share all words by weight; a
    target stops at ``cap`` times the source's words and the excess goes to the others by weight. The
    result of that resharing is ``min(cap * words, level * weight)`` with one level for all, found from
    running sums over the sources ordered by ``words / weight``. A source without words has target 0.
    """
    key = F.struct(F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"))
    named = sizes.withColumn("source_key", F.concat(F.col("source").isNull().cast("int"), F.coalesce("source", F.lit(""))))
    ranked = order_globally(named, key, "source_key", prefix="name_")
    weighted = ranked.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("name_position") - 1) % len(weights)).cast("int") + 1)
    ).select("source", "source_key", "words", "weight")
    ratio = F.col("words") / F.col("weight")
    filled = cut(order_globally(weighted, ratio, "source_key", prefix="fill_", amount=["words", "weight"]))
    total = filled.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight"))
    # before a source in this order, all are at their cap; the first whose share fits below its cap sets the level
    left = F.col("all_words") - cap * (F.col("fill_running_words") - F.col("words"))
    level = left / (F.col("all_weight") - F.col("fill_running_weight") + F.col("weight"))
    fits = level * F.col("weight") <= cap * F.col("words")
    levels = (
        filled.withColumn("all_words", total.select("words").scalar())
        .withColumn("all_weight", total.select("weight").scalar())
        .where(fits)
        .agg(F.min_by(level, F.struct("fill_position")).alias("level"))
    )
    share = F.least(cap * F.col("words").cast("double"), F.coalesce("level", F.lit(0.0)) * F.col("weight"))
    return filled.withColumn("level", levels.scalar()).select("source", "words", "weight", share.alias("target"))


def _fold(level: int, seed: int) -> Column:
    """One chunk, in hash order: decided units and the one that is left, if any."""

    def settle(state: Column, x: Column) -> Column:
        a = state["left"]
        up = F.least(a["mass"] * (1 - a["p"]), x["mass"] * x["p"])
        down = F.least(x["mass"] * (1 - x["p"]), a["mass"] * a["p"])
        rises = uniform(seed, level, a["h"], x["h"]) * (up + down) < down
        a_ends = F.when(rises, up == a["mass"] * (1 - a["p"])).otherwise(down == a["mass"] * a["p"])
        a_share = F.when(a_ends, rises.cast("double")).otherwise(
            F.when(rises, a["p"] + up / a["mass"]).otherwise(a["p"] - down / a["mass"]))
        x_share = F.when(~a_ends, (~rises).cast("double")).otherwise(
            F.when(rises, x["p"] - up / x["mass"]).otherwise(x["p"] + down / x["mass"]))
        new_a = a.withField("p", F.least(F.greatest(a_share, F.lit(0.0)), F.lit(1.0)))
        new_x = x.withField("p", F.least(F.greatest(x_share, F.lit(0.0)), F.lit(1.0)))
        return F.struct(
            F.when(a_ends, new_x).otherwise(new_a).alias("left"),
            F.concat(state["done"], F.array(F.when(a_ends, new_a).otherwise(new_x))).alias("done"),
        )

    units = F.array_sort("units")
    start = F.struct(F.element_at(units, 1).alias("left"), F.slice(units, 1, 0).alias("done"))
    return F.aggregate(F.slice(units, 2, F.size("units")), start, settle)


def round_dependently(units: DataFrame, seed: int = SEED) -> DataFrame:
    """``(id, source, size, n, whole, extra)``: ``extra`` is 0 or 1, with mean ``p``.

    ``units`` holds ``(id, source, size, n, whole, p)``, unique by the first three; NULL is a value. ``p`` is
    the fraction of one row of ``size`` words, whatever ``n``. Units of no words or without a fraction take no
    part in the exchange.
    """
    unit = [F.col(c) for c in ("id", "source", "size", "n", "whole", "p")]
    units = cut(units.select(*unit, F.xxhash64(F.lit(seed), "id", "source", "size").alias("h"),
                             F.col("size").cast("double").alias("mass")))
    alone = (F.col("p") <= 0) | (F.col("mass") <= 0)
    decided = [units.where(alone).withColumn("p", (uniform(seed, "alone", F.col("h")) < F.col("p")).cast("double"))]
    open_ = units.where(~alone)
    chunks = open_.groupBy("source").agg(F.ceil(F.count("*") / FAN_IN).cast("long").alias("chunks"))
    most = chunks.agg(F.max("chunks")).first()[0] or 0
    level_units = open_.join(chunks, same(open_["source"], chunks["source"])).select(
        open_["*"], F.pmod("h", F.col("chunks")).alias("chunk")
    )
    levels = 1 + math.ceil(math.log(max(most, 1), FAN_IN)) if most else 0
    record = F.struct("h", "id", "source", "size", "n", "whole", "p", "mass")
    for level in range(levels):
        folded = cut(
            level_units.groupBy("source", "chunk").agg(F.collect_list(record).alias("units"))
            .select("chunk", _fold(level, seed).alias("f"))
        )
        decided.append(folded.select(F.explode("f.done").alias("u")).select("u.*"))
        rest = folded.select(F.floor(F.col("chunk") / FAN_IN).alias("chunk"), "f.left.*")
        if level + 1 < levels:
            level_units = rest
        else:
            last = uniform(seed, "last", F.col("h")) < F.col("p")
            decided.append(rest.drop("chunk").withColumn("p", last.cast("double")))
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out.select("id", "source", "size", "n", "whole", F.col("p").cast("long").alias("extra"))


def copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED,
) -> DataFrame:
    """``(id, source, size, n, source_size, target, copies, more)``, one row per distinct id, source and size.

    ``size`` counts words (NULL text: 0), ``n`` the rows of ``docs`` that share the three values: ``more`` of
    them are taken ``copies + 1`` times, the others ``copies`` times, at most ``cap``. A NULL id or source is a
    value like any other; an empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    sized = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source"),
        F.size(words(F.col(f"`{text_column}`"))).cast("long").alias("size"),
    )
    units = cut(sized.groupBy("id", "source", "size").agg(F.count("*").alias("n")))
    per_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    targets = cut(source_targets(per_source, weights, cap))
    rate = F.when(targets["words"] > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    due = units["n"] * rate
    rated = units.join(targets, same(units["source"], targets["source"])).select(
        units["*"], F.floor(due).alias("whole"), (due - F.floor(due)).alias("p")
    )
    rounded = round_dependently(rated, seed)
    total = F.col("whole") + F.col("extra")
    return rounded.join(targets, same(rounded["source"], targets["source"])).select(
        "id", rounded["source"], "size", "n", F.col("words").alias("source_size"), "target",
        F.floor(total / F.col("n")).alias("copies"), (total % F.col("n")).alias("more"),
    )


def rows_taken(plan: DataFrame, at_once: int = 10_000) -> DataFrame:
    """``copies`` spelled out: one row per row of the mixed table's input, with its own ``copies``."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(at_once).cast("long")))
    blocks = plan.withColumn("first", first)
    count = F.least(F.col("n") - F.col("first"), F.lit(at_once)).cast("int")
    rows = blocks.select("*", F.posexplode(F.array_repeat(F.lit(1), count)).alias("at", "_one"))
    copies = F.col("copies") + (F.col("first") + F.col("at") < F.col("more")).cast("long")
    return rows.withColumn("copies", copies).drop("first", "at", "_one", "n", "more")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixed table: every row of ``docs``, with its columns, as often as the mix takes it.

    Of rows that share id, source and size, those whose text hashes lowest get the additional copies.
    """
    plan = cut(copies(docs, id_column, text_column, source_column, weights, cap, seed).select(
        F.col("id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"),
        F.col("copies").alias("_mix_copies"), F.col("more").alias("_mix_more"), F.col("n").alias("_mix_n"),
    ).where("_mix_copies > 0 OR _mix_more > 0"))
    sized = docs.withColumn("_mix_words", F.size(words(F.col(f"`{text_column}`"))).cast("long"))

    def planned(part: DataFrame) -> DataFrame:
        return sized.join(
            part,
            same(sized[f"`{id_column}`"], part["_mix_id"]) & same(sized[f"`{source_column}`"], part["_mix_source"])
            & (sized["_mix_words"] == part["_mix_size"]),
        )

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        each = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
        return rows.withColumn("_mix_time", each).select(*[F.col(f"`{c}`") for c in docs.columns])

    even = repeated(planned(plan.where("_mix_more = 0")), F.col("_mix_copies"))
    uneven = plan.where("_mix_more > 0")
    if uneven.isEmpty():
        return even
    # a group may be large, so its rows are numbered across tasks; the number before them is their rank
    order = F.struct(F.xxhash64(F.col(f"`{text_column}`")).alias("h"), F.monotonically_increasing_id().alias("i"))
    rows = cut(planned(uneven).withColumn("_mix_order", order))
    group = F.to_json(F.struct("_mix_id", "_mix_source", "_mix_size"))
    numbered = order_globally(rows, group, "_mix_order", prefix="_mix_")
    more = (F.col("_mix_position") - F.col("_mix_rank") < F.col("_mix_more")).cast("long")
    return even.unionByName(repeated(numbered, F.col("_mix_copies") + more))
