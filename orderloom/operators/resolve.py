"""Dealer resolution: by tax code, by similar name, else a new dealer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions.columns import code_order
from ..functions.ranking import order_globally
from ..functions.text import normalize_name
from ..session import cut

THRESHOLD = 92
# How a dealer is written who states no name, and the form of generated codes.
WALK_IN = "Khách lẻ"
CODE_FORMAT = "KH-%05d"
CODE_PATTERN = r"^KH-\d+$"
NEW_TIER = "STANDARD"

# Links that one task goes through in order of arrival; the names among them are held in its memory.
LINKS_PER_TASK = 200_000

_GRAM = 3
_SALTS = 8
_FOLLOWS, _LEADS, _OPEN = 0, 1, 2


def match_tax(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``orders`` with the code of the dealer owning the tax code; of several owners the highest code."""
    owners = (
        customer.where("tax_code IS NOT NULL AND tax_code <> ''")
        .groupBy("tax_code")
        .agg(F.max_by("customer_code", code_order("customer_code")).alias("customer_code"))
    )
    return orders.join(owners, "tax_code", "left")


@F.pandas_udf(IntegerType())
def common_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of each pair, all pairs of a batch in lock step."""
    n = len(a)
    if n == 0:
        return pd.Series([], dtype="int32")
    chars = []
    for side in (a, b):
        width = max(1, side.str.len().max())
        flat = "".join(side.str.pad(width, side="right", fillchar="\0")).encode("utf-32-le")
        chars.append(np.frombuffer(flat, dtype=np.uint32).reshape(n, width).T.copy())
    left, right = chars
    row = np.zeros((right.shape[0] + 1, n), dtype=np.int16)
    for ch in left:
        hits = (right == ch) & (ch != 0)
        diagonal = row[0].copy()
        for j in range(right.shape[0]):
            above = row[j + 1].copy()
            np.maximum(above, row[j], out=row[j + 1])
            np.maximum(row[j + 1], diagonal + hits[j], out=row[j + 1])
            diagonal = above
    return pd.Series(row[-1].astype("int32"))


def _words(name: str) -> Column:
    return F.array_sort(F.filter(F.array_distinct(F.split(F.col(name), " ")), lambda x: x != ""))


def score_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Similarity 0–100 of the names ``a`` and ``b`` as sets of words, pairs under ``threshold`` dropped.

    100 when one set holds the other. Otherwise the best of: shared words plus either rest compared with
    each other, and the shared words alone against either whole, each as ``1 - edits / total length`` where
    an edit inserts or deletes one character. Only the edits need Python, and only for pairs whose plain
    edit distance (never larger) is small enough.
    """
    text = lambda words: F.array_join(words, " ")
    parts = F.struct(
        text(F.array_except("_wa", "_wb")).alias("_ra"),
        text(F.array_except("_wb", "_wa")).alias("_rb"),
        F.length(text(F.array_intersect("_wa", "_wb"))).alias("_s"),
    )
    # inlined as a generated row, so that the filters below see finished columns and do not repeat the set work
    out = pairs.withColumns({"_wa": _words("a"), "_wb": _words("b")}).select("a", "b", F.inline(F.array(parts)))
    glue = F.when(F.col("_s") > 0, 1).otherwise(0)
    out = out.withColumn("_la", F.col("_s") + glue + F.length("_ra")).withColumn(
        "_lb", F.col("_s") + glue + F.length("_rb")
    )
    s, la, lb = F.col("_s"), F.col("_la"), F.col("_lb")
    inside = (s > 0) & ((F.col("_ra") == "") | (F.col("_rb") == ""))
    alone = F.when(s > 0, F.greatest(*[1 - (n - s) / (n + s) for n in (la, lb)])).otherwise(0.0)
    allowed = F.floor((la + lb) * (1 - threshold / 100) + 1e-9).cast("int")
    # an upper bound in whole edits, so that the built-in distance can stop early
    near = F.levenshtein("_ra", "_rb") <= allowed
    sure = F.when(inside, 1.0).otherwise(alone)
    scored = out.withColumn("_sure", sure).where((F.col("_sure") >= threshold / 100) | near)
    edits = F.length("_ra") + F.length("_rb") - 2 * common_length("_ra", "_rb")
    both = 1 - edits / (la + lb)
    score = 100 * F.when(F.col("_sure") == 1.0, 1.0).otherwise(F.greatest("_sure", both))
    return scored.select("a", "b", score.alias("score")).where(F.col("score") >= threshold - 1e-9)


def _sorted(side: DataFrame) -> DataFrame:
    """A side that grows with the names, for a sort-merge join.

    The planner measures a name by its compressed file and does not see that one becomes many grams, words or
    forms; it would pass them through the driver for a broadcast.
    """
    return side.hint("merge")


def _grams(names: DataFrame, name: str) -> DataFrame:
    """``(id, name, len, gram)``: distinct 3-grams of the words of a name, each word padded by one blank.

    ``len`` is the length of the distinct words written in one line.
    """
    words = _words(name)
    cut_word = lambda x: F.transform(
        F.sequence(F.lit(1), F.length(x) - (_GRAM - 1)), lambda i: F.substring(x, i, F.lit(_GRAM))
    )
    grams = F.flatten(F.transform(words, lambda x: cut_word(F.concat(F.lit(" "), x, F.lit(" ")))))
    # two names sharing an id only add candidates: names are joined back before scoring
    return names.select(
        F.xxhash64(name).alias(f"{name}_id"),
        name,
        F.length(F.array_join(words, " ")).alias("len"),
        F.explode(F.array_distinct(grams)).alias("gram"),
    )


def _by_rarity(grams: DataFrame, key: str, frequency: DataFrame) -> DataFrame:
    """Grams numbered per name, the rarest first; a name has no more grams than characters."""
    order = Window.partitionBy(key).orderBy(F.coalesce("df", F.lit(0)), "gram")
    return grams.join(_sorted(frequency), "gram", "left").withColumn("r", F.row_number().over(order)).drop("df")


def _whole_words(names: DataFrame, name: str) -> DataFrame:
    """``(id, name, len, word)``: distinct words of a name, ``len`` as for grams."""
    words = _words(name)
    return names.select(
        F.xxhash64(name).alias(f"{name}_id"),
        name,
        F.length(F.array_join(words, " ")).alias("len"),
        F.explode(words).alias("word"),
    )


def _nearly_contained(words: DataFrame, key: str, frequency: DataFrame, slack: float) -> DataFrame:
    """Words one of which every name holding nearly all words of this one must share, the rarest first.

    With ``x`` characters outside the shared words (each such word with one blank), ``x <= (1-t)(2n-x)``: words
    that together are longer than that cannot all be outside.
    """
    order = Window.partitionBy(key).orderBy(F.coalesce("df", F.lit(0)), "word")
    before = F.coalesce(F.sum(F.length("word") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    outside = F.floor(2 * F.col("len") * slack / (1 + slack) + 1e-9)
    return words.join(_sorted(frequency), "word", "left").withColumn("_before", before).where(F.col("_before") <= outside)


def _edits(n: Column | str, m: Column | str, slack: float) -> Column:
    """Most characters deleted or inserted between names of these lengths; deletions exceed insertions by ``n-m``."""
    edits = F.floor((F.col(n) + F.col(m)) * slack + 1e-9).cast("int")
    return edits - F.pmod(edits - (F.col(n) - F.col(m)), F.lit(2))


def _one_change(edits: Column) -> Column:
    """At most one character is deleted and at most one inserted; such pairs meet by ``_shortened``."""
    return (edits <= 2) & (F.abs(F.col("len") - F.col("other_len")) <= 1)


def _nearly_equal(ranked: DataFrame, slack: float) -> DataFrame:
    """Per length ``m`` of a partner: grams one of which a partner of that length must share.

    At most ``e = (1-t)(n+m)`` characters are deleted or inserted. A deletion spoils at most three grams of
    this name, an insertion at most two.
    """
    n, m = F.col("len"), F.col("other_len")
    reach = F.floor(2 * n * slack / (1 - slack) + 1e-9).cast("int")
    lengths = F.sequence(F.greatest(n - reach, F.lit(1)), n + reach)
    edits = _edits("len", "other_len", slack)
    spoiled = F.floor((3 * (edits + n - m) + 2 * (edits - n + m)) / 2)
    return ranked.withColumn("other_len", F.explode(lengths)).where(
        (edits >= F.abs(n - m)) & ~_one_change(edits) & (F.col("r") <= spoiled + 1)
    )


def _shortened(names: DataFrame, name: str, slack: float) -> DataFrame:
    """``(id, form)``: a name as it is and with any one character less, as a hash of its sorted words.

    Two names that differ by one deleted and one inserted character, or by one of them, share a form however
    alike all other names are: a form belongs to no more names than there are places and letters to insert.
    The blank between any two words may be the lost character, because which words lie side by side depends
    on the other name. Only names short enough for so few edits have forms; longer ones meet by grams.
    """
    w = _words(name)
    line = lambda words: F.array_join(F.array_sort(F.filter(words, lambda x: x != "")), " ")
    others = lambda x: F.array_except("_w", F.array(x))
    less = F.flatten(
        F.transform(
            "_w",
            lambda x: F.transform(
                F.sequence(F.lit(1), F.length(x)),
                lambda i: line(
                    F.concat(others(x), F.array(F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))
                ),
            ),
        )
    )
    glued = F.flatten(
        F.transform(
            "_w",
            lambda x: F.transform(
                F.filter("_w", lambda y: y > x),
                lambda y: line(F.concat(F.array_except("_w", F.array(x, y)), F.array(F.concat(x, y)))),
            ),
        )
    )
    short = (2 * F.length(F.array_join("_w", " ")) - 1) * slack < 4
    forms = F.array_distinct(F.concat(F.array(line(F.col("_w"))), less, glued))
    return (
        names.select(F.xxhash64(name).alias(f"{name}_id"), w.alias("_w"))
        .where(short & (F.size("_w") > 0))
        .select(f"{name}_id", F.explode(F.transform(forms, lambda x: F.xxhash64(x))).alias("form"))
    )


def _sharing(rare: DataFrame, every: DataFrame, other: str, on: list[str]) -> DataFrame:
    """Id pairs agreeing on ``on``. A gram held by very many names is split over ``_SALTS`` tasks."""
    tasks = int(rare.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*on, "salt"]
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    salted = rare.withColumn("salt", salts).repartition(tasks, *keys)
    spread = every.withColumn("salt", F.pmod(other, F.lit(_SALTS)).cast("int")).repartition(tasks, *keys)
    return salted.join(spread.hint("merge"), keys).select("a_id", "b_id")


def similar_names(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``(a, b, score)`` of distinct names scoring at least ``threshold``.

    ``left`` has column ``a``, ``right`` column ``b``. Candidates come in three ways, which together miss no
    pair: one holds nearly all words of the other (a rare whole word is shared), they differ by one character
    deleted and one inserted (a shortened form is shared), or by more (a rare gram is shared). How many of
    the rarest words or grams are needed follows from the threshold.
    """
    names_a, names_b = left.select("a").distinct(), right.select("b").distinct()
    slack = 1 - threshold / 100
    a, b = _grams(names_a, "a"), _grams(names_b, "b")
    frequency = b.groupBy("gram").agg(F.count("*").alias("df"))
    by_length = b.select("b_id", "gram", F.col("len").alias("other_len"))
    equal = _nearly_equal(_by_rarity(a, "a", frequency), slack).select("a_id", "gram", "other_len")
    words_a, words_b = _whole_words(names_a, "a"), _whole_words(names_b, "b")
    common = words_b.groupBy("word").agg(F.count("*").alias("df"))
    rare_a = _nearly_contained(words_a, "a", common, slack).select("a_id", "word")
    rare_b = _nearly_contained(words_b, "b", common, slack).select("b_id", "word")
    ids = (
        _sharing(equal, by_length, "b_id", ["gram", "other_len"])
        .union(_sharing(rare_a, words_b.select("b_id", "word"), "b_id", ["word"]))
        .union(_sharing(rare_b, words_a.select("a_id", "word"), "a_id", ["word"]))
        .union(_shortened(names_a, "a", slack).join(_sorted(_shortened(names_b, "b", slack)), "form").select("a_id", "b_id"))
        .distinct()
    )
    with_id = lambda names, k: names.select(F.xxhash64(k).alias(f"{k}_id"), k)
    pairs = ids.join(_sorted(with_id(names_a, "a")), "a_id").join(_sorted(with_id(names_b, "b")), "b_id")
    return score_pairs(pairs.select("a", "b"), threshold)


def best_matches(names: DataFrame, customer: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per normalised name ``a`` with a similar dealer: ``(a, customer_code, score, runner_up)``.

    Equal scores go to the smallest dealer code; of dealers with the same name the highest code stands.
    """
    known = (
        customer.select("customer_code", normalize_name(F.col("customer_name")).alias("b"))
        .where("b <> ''")
        .groupBy("b")
        .agg(F.max_by("customer_code", code_order("customer_code")).alias("code"), F.min("customer_code").alias("first_code"))
    )
    scored = similar_names(names.select("a").where("a <> ''"), known.select("b"), threshold).join(known, "b")
    by_score = Window.partitionBy("a").orderBy(F.desc("score"), "first_code")
    two = scored.withColumn("r", F.row_number().over(by_score)).where("r <= 2")
    return two.groupBy("a").agg(
        F.max(F.when(F.col("r") == 1, F.col("code"))).alias("customer_code"),
        F.max("score").alias("score"),
        F.max(F.when(F.col("r") == 2, F.col("score"))).alias("runner_up"),
    )


def match_fuzzy(orders: DataFrame, customer: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``orders`` (column ``clean_name``) with the best similar dealer, its score and the runner-up score.

    Names are compared once however often they occur.
    """
    asked = orders.withColumn("_a", normalize_name(F.col("clean_name")))
    best = best_matches(asked.select(F.col("_a").alias("a")), customer, threshold)
    return asked.join(best.withColumnRenamed("a", "_a"), "_a", "left").drop("_a")


def match_fuzzy(orders: DataFrame, customer: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``orders`` (column ``clean_name``) with the best similar dealer, its score and the runner-up score.

    Equal scores go to the smallest dealer code. Names are compared once however often they occur.
    """
    names = (
        customer.select("customer_code", normalize_name(F.col("customer_name")).alias("b"))
        .where("b <> ''")
        .groupBy("b")
        .agg(F.max_by("customer_code", code_order("customer_code")).alias("code"), F.min("customer_code").alias("first_code"))
    )
    asked = orders.withColumn("_a", normalize_name(F.col("clean_name")))
    pairs = similar_names(asked.select(F.col("_a").alias("a")).where("a <> ''"), names.select("b"), threshold)
    scored = pairs.join(names, "b")
    by_score = Window.partitionBy("a").orderBy(F.desc("score"), "first_code")
    two = scored.withColumn("r", F.row_number().over(by_score)).where("r <= 2")
    best = two.groupBy(F.col("a").alias("_a")).agg(
        F.max(F.when(F.col("r") == 1, F.col("code"))).alias("customer_code"),
        F.max("score").alias("score"),
        F.max(F.when(F.col("r") == 2, F.col("score"))).alias("runner_up"),
    )
    return asked.join(best, "_a", "left").drop("_a")


def max_code(customer: DataFrame) -> DataFrame:
    """Highest number among generated dealer codes, 0 without any."""
    number = F.substring("customer_code", 4, 18).cast("bigint")
    return customer.where(F.col("customer_code").rlike(CODE_PATTERN)).agg(
        F.coalesce(F.max(number), F.lit(0)).alias("max_code")
    )


def new_customers(unmatched: DataFrame, customer: DataFrame) -> DataFrame:
    """New dealers for unmatched orders ``(log_id, tax_code, clean_name, address)``.

    One dealer per tax code, or per normalised name where no tax code is stated; the first mail names it
    and codes follow the order of those mails.
    """
    name = F.coalesce("clean_name", F.lit(WALK_IN))
    keyed = unmatched.withColumn("name", name).withColumn("dealer_key", dealer_key())
    first = keyed.groupBy("dealer_key").agg(
        F.min("log_id").alias("log_id"),
        F.min_by(F.struct("name", "tax_code", "address"), "log_id").alias("d"),
    )
    numbered = order_globally(cut(first), F.col("log_id"), "dealer_key")
    start = max_code(customer).scalar()
    return numbered.select(
        F.format_string(CODE_FORMAT, start + F.col("position")).alias("customer_code"),
        F.col("d.name").alias("customer_name"),
        F.col("d.tax_code").alias("tax_code"),
        F.col("d.address").alias("address"),
        F.lit(NEW_TIER).alias("customer_tier"),
        F.lit(True).alias("is_active"),
        "dealer_key",
        F.col("log_id").alias("first_log_id"),
    )


def dealer_key():
    """What makes two unmatched orders the same dealer."""
    tax = F.nullif(F.col("tax_code"), F.lit(""))
    name = normalize_name(F.coalesce("clean_name", F.lit(WALK_IN)))
    return F.coalesce(F.concat(F.lit("tax:"), tax), F.concat(F.lit("name:"), name))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Names of one range in order of arrival: settled as far as the earlier names are known."""
    led: dict[str, int] = {}
    name, state = None, _FOLLOWS

    def settled() -> list[tuple[str, bool]]:
        if name is None or state == _OPEN:
            return []
        led[name] = _FOLLOWS if state == _LEADS else _LEADS
        return [(name, led[name] == _LEADS)]

    for batch in batches:
        out = []
        for this, earlier, known in zip(batch["name"], batch["earlier"], batch["leads"]):
            if this != name:
                out += settled()
                name, state = this, _FOLLOWS
            if state != _LEADS:
                # a leader among the earlier names decides, whatever the others turn out to be
                now = known if known != _OPEN else led.get(earlier, _OPEN)
                state = now if now != _FOLLOWS else state
        yield pd.DataFrame(out, columns=["name", "leads"])
    yield pd.DataFrame(settled(), columns=["name", "leads"])


def leading(links: DataFrame, links_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """Which names lead when names arrive one after another: ``(name, leads)`` for every ``name`` in ``links``.

    ``links`` are ``(name, seq, earlier)``: ``earlier`` came before ``name``, which came as number ``seq``. A name leads
    unless a leader is among its earlier names; a name without links leads and is not returned.

    The links lie in ranges of ``seq``, about ``links_per_task`` in a task. A task goes through its range in order
    and settles every name whose earlier names are settled, be it elsewhere before or just now in this range,
    or one of whose earlier names leads. What stays open goes into the next round. Earlier names lie in the
    same range or one before, so a round finishes at least the first open range: there are never more rounds
    than ranges, however long a chain of links is, and one round where the links fit into one range.
    """
    heads = links.select(F.col("name").alias("earlier")).distinct().withColumn("_waits", F.lit(True))
    state = F.when(F.col("_waits"), _OPEN).otherwise(_LEADS)
    rest = cut(links.join(heads, "earlier", "left").select("name", "seq", "earlier", state.alias("leads")))
    done = None
    while True:
        tasks = max(1, -(-rest.count() // links_per_task))
        ranges = rest.repartitionByRange(tasks, "seq", "name").sortWithinPartitions("seq", "name")
        swept = cut(ranges.mapInPandas(_sweep, "name string, leads boolean"))
        done = swept if done is None else done.unionByName(swept)
        if tasks == 1:
            return done
        now = swept.select(F.col("name").alias("earlier"), F.when(F.col("leads"), _LEADS).otherwise(_FOLLOWS).alias("_now"))
        rest = cut(
            rest.join(swept.select("name"), "name", "left_anti")
            .join(now, "earlier", "left")
            .select("name", "seq", "earlier", F.coalesce("_now", "leads").alias("leads"))
        )


def resolve_batch(
    orders: DataFrame, customer: DataFrame, threshold: float = THRESHOLD, links_per_task: int = LINKS_PER_TASK
) -> tuple[DataFrame, DataFrame]:
    """Resolve a batch ``(log_id, tax_code, clean_name, address)`` as if its orders came one after another.

    Returns the orders with ``customer_code`` and the dealers to add. An order without tax code goes to the most
    similar dealer there is when it comes, stored or created by an earlier order of the batch; equal scores go
    to stored dealers first, then to the one created first. It creates a dealer when none is similar enough.
    """
    named = orders.withColumn("clean_name", F.coalesce("clean_name", F.lit(WALK_IN)))
    has_tax = F.coalesce(F.col("tax_code") != "", F.lit(False))
    by_tax = match_tax(named, customer.select("customer_code", "tax_code"))
    hit_tax = by_tax.where(has_tax & F.col("customer_code").isNotNull())
    rest_tax = by_tax.where(has_tax & F.col("customer_code").isNull()).drop("customer_code")
    by_name = by_tax.where(~has_tax).drop("customer_code").withColumn("n", normalize_name(F.col("clean_name")))

    names = cut(by_name.groupBy("n").agg(F.min("log_id").alias("seq")))
    found = cut(best_matches(names.select(F.col("n").alias("a")), customer, threshold).withColumnRenamed("a", "n"))
    fresh = names.join(found, "n", "left_anti")
    # dealers created by tax code lead from the start; of several with one name the first stands for all
    tax_new = (
        rest_tax.select("tax_code", "log_id", normalize_name(F.col("clean_name")).alias("n"))
        .groupBy("tax_code")
        .agg(F.min_by("n", "log_id").alias("n"), F.min("log_id").alias("seq"))
        .groupBy("n")
        .agg(F.min_by(F.concat(F.lit("tax:"), "tax_code"), F.struct("seq", "tax_code")).alias("key"), F.min("seq").alias("seq"))
    )
    known = tax_new.unionByName(fresh.select("n", F.concat(F.lit("name:"), "n").alias("key"), "seq"))
    known = cut(known.select(F.col("n").alias("b"), F.col("key").alias("leader"), F.col("seq").alias("lead_seq")))
    pairs = similar_names(names.select(F.col("n").alias("a")).where("a <> ''"), known.select("b").where("b <> ''"), threshold)
    links = cut(pairs.join(known, "b").select(F.col("a").alias("n"), "score", "leader", "lead_seq"))
    before = links.join(fresh, "n").where("lead_seq < seq")
    state = leading(before.select(F.concat(F.lit("name:"), "n").alias("name"), "seq", F.col("leader").alias("earlier")), links_per_task)

    # per name one candidate for every score, so a list stays short however many dealers are similar
    created_ones = (
        links.join(state.where("NOT leads").select(F.col("name").alias("leader")), "leader", "left_anti")
        .groupBy("n", "score")
        .agg(F.min(F.struct("lead_seq", "leader")).alias("first"))
        .select("n", "score", "first.lead_seq", "first.leader", F.lit(None).cast("string").alias("code"))
    )
    stored_ones = found.select(
        "n", "score", F.lit(None).cast("bigint").alias("lead_seq"), F.lit(None).cast("string").alias("leader"),
        F.col("customer_code").alias("code"),
    )
    stored_first = F.when(F.col("code").isNotNull(), 1).otherwise(0)
    options = (
        created_ones.unionByName(stored_ones)
        .groupBy("n")
        .agg(F.collect_list(F.struct("score", stored_first.alias("stored"), (-F.col("lead_seq")).alias("age"), "leader", "code")).alias("options"))
    )
    there = F.filter("options", lambda x: (x["stored"] == 1) | (-x["age"] < F.col("log_id")))
    chosen = by_name.join(options, "n", "left").withColumn("pick", F.array_max(there)).withColumn("customer_code", F.col("pick.code"))
    hit_name = chosen.where("customer_code IS NOT NULL")
    rest_name = chosen.where("customer_code IS NULL").withColumn("leader", F.col("pick.leader"))

    raw = ["log_id", "tax_code", "clean_name", "address"]
    unmatched = rest_tax.withColumn("leader", F.lit(None).cast("string")).select(*raw, "leader").unionByName(rest_name.select(*raw, "leader"))
    settled = unmatched.withColumn("dealer_key", dealer_key()).withColumn("leader", F.coalesce("leader", "dealer_key"))
    creators = settled.where("leader = dealer_key").drop("leader", "dealer_key")
    created = new_customers(creators, customer)
    codes = created.select(F.col("dealer_key").alias("leader"), "customer_code")
    keep = [*raw, "customer_code"]
    resolved = (
        hit_tax.select(*keep)
        .unionByName(hit_name.select(*keep))
        .unionByName(settled.join(codes, "leader").select(*keep))
    )
    return resolved, created
