"""Line-first quality rules, in DataFrame functions only.

Each line is judged on its own words; failing lines go, and a document that loses too much goes whole.
All work is per row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_columns, words

SYMBOLS = "#*$%&|<>"
MARKS = "[#*$%&|<>]|!!$"  # a word that carries a symbol, or ends in repeated exclamation marks
SEPARATORS = ("|", "»", "›", "·")
# fixed values: phrases that mark a line as boilerplate
PHRASES = "(?i)all rights reserved|privacy policy|terms of use|cookie policy|subscribe to our newsletter"
MARKED_PERCENT = 20  # punctuation rule: words with marks
SEPARATOR_PERCENT = 20  # navigation rule: words that are separators
DISTINCT_PERCENT = 40  # boilerplate rule: fewer different words than that, from REPEAT_WORDS words on
REPEAT_WORDS = 10
WINDOW_WORDS = 200  # a longer line is judged window by window, as the share of different words falls with length
LOST_PERCENT = 30  # a document may lose that share of its words


def _few_distinct(w: Column) -> Column:
    return 100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * F.size(w)


def _repeats(w: Column) -> Column:
    """Whether most windows of the line have too few different words; the last window ends with the line."""
    n = F.size(w)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(WINDOW_WORDS))
    bad = F.filter(starts, lambda i: _few_distinct(F.slice(w, F.least(i, n - WINDOW_WORDS) + 1, WINDOW_WORDS)))
    return F.when(n <= WINDOW_WORDS, _few_distinct(w)).otherwise(2 * F.size(bad) > F.size(starts))


def fails(w: Column, line: Column) -> Column:
    """Whether a line with words ``w`` breaks the punctuation, navigation or boilerplate rule."""
    n = F.size(w)
    marked = F.size(F.filter(w, lambda x: x.rlike(MARKS)))
    separators = F.size(F.filter(w, lambda x: x.isin(*SEPARATORS)))
    return (
        (100 * marked > MARKED_PERCENT * n)
        | (100 * separators > SEPARATOR_PERCENT * n)
        | ((n >= REPEAT_WORDS) & _repeats(w))
        | line.rlike(PHRASES)
    )


def _shifted(array: str, width: int, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - (width - 1), F.lit(0)))


def repeated_window_words(df: DataFrame, words_column: str) -> DataFrame:
    """Adds ``_repeat``: words inside 3-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes of their words. Equal windows are neighbours after sorting; each
    repeated window covers its three words, overlaps counted once. Texts without a repeat are not sorted.
    """
    df = df.withColumn("_hashes", F.transform(words_column, lambda x: F.xxhash64(x)))
    triples = F.arrays_zip(*(_shifted("_hashes", 3, k).alias(c) for k, c in enumerate("abc")))
    df = df.withColumn("_windows", F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])))
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_ordered", F.array_sort(F.when(repeats, numbered).otherwise(F.slice(numbered, 1, 0))))
    pairs = F.arrays_zip(_shifted("_ordered", 2, 0).alias("x"), _shifted("_ordered", 2, 1).alias("y"))
    equal = F.filter(pairs, lambda p: p["x"]["h"] == p["y"]["h"])
    positions = F.array_distinct(F.flatten(F.transform(equal, lambda p: F.array(p["x"]["i"], p["y"]["i"]))))
    # each position adds 3 words, less what the position before it already covers
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        F.array_sort(positions), start,
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    return df.withColumn("_repeat", covered).drop("_hashes", "_windows", "_ordered")


def judge(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with base counts, ``base_failed``, ``kept``, ``n_failed_words`` and ``cleaned_text``.

    Added (an existing column of the name is replaced): ``n_words word_chars n_symbols n_dup_lines
    n_repeat_words n_failed_words`` (long), ``base_failed kept`` (boolean), ``cleaned_text`` (the text
    without its failing lines, unchanged if none fails). A NULL text counts as empty; an empty text has no
    words and fails the base rules. Every row is judged alone, so ties and repeated rows need no rule.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    line = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), words(x).alias("w")))
    df = docs.withColumn("_lines", line)
    df = df.withColumn("_judged", F.transform("_lines", lambda x: F.struct(
        x["line"].alias("line"), x["w"].alias("w"),
        ((F.size(x["w"]) > 0) & fails(x["w"], x["line"])).alias("bad"))))
    df = df.withColumn("_w", F.flatten(F.transform("_judged", lambda x: x["w"])))
    df = repeated_window_words(df, "_w").withColumn("_n", F.size("_w").cast("long"))
    df = df.withColumn("_failed", F.aggregate(
        "_judged", F.lit(0).cast("long"), lambda n, x: n + F.when(x["bad"], F.size(x["w"])).otherwise(0)))
    with_word = F.transform(F.filter("_lines", lambda x: F.size(x["w"]) > 0), lambda x: x["line"])
    df = df.withColumn("_full_lines", with_word)
    base_failed = (F.col("_n") < 50) | (100 * F.col("_repeat") > 50 * F.col("_n"))
    out = keep_columns(df, {
        "n_words": F.col("_n"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_full_lines") - F.size(F.array_distinct("_full_lines"))).cast("long"),
        "n_repeat_words": F.col("_repeat").cast("long"),
        "n_failed_words": F.col("_failed"),
        "base_failed": base_failed,
        "kept": ~base_failed & (100 * F.col("_failed") <= LOST_PERCENT * F.col("_n")),
        "cleaned_text": F.when(F.col("_failed") == 0, F.col(f"`{text_column}`")).otherwise(
            F.array_join(F.transform(F.filter("_judged", lambda x: ~x["bad"]), lambda x: x["line"]), "\n")),
    })
    return out.drop("_lines", "_judged", "_w", "_n", "_repeat", "_failed", "_full_lines")


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that pass, with the columns of ``docs`` and cleaned text."""
    judged = judge(docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns]), f"in_{text_column}")
    # a filter is not pushed below a row number; pushed down, it would work out all counts once per mention
    numbered = judged.withColumn("_row", F.monotonically_increasing_id())
    return numbered.where(F.col("kept") & (F.col("_row") >= 0)).select(
        *[F.col("cleaned_text" if c == text_column else f"`in_{c}`").alias(c) for c in docs.columns]
    )
