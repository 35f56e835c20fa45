"""Site-relative line deduplication, in DataFrame functions only.

A line is boilerplate of a host when it stands on more than a given share of the host's pages. Pages with the
same text count once, in the share's both parts, so a text cannot make its own lines boilerplate by being
copied. Lines are counted once per page as 128-bit hashes of their trimmed text, with map-side partial sums, so
one line, text or host that fills a third of the table is summed before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import same

# fixed values, by precision and recall on planted lines (tests/llm, README)
RATIO = 0.01  # a line on more than this share of the host's pages goes
LEAST_PAGES = 4  # but only if that many pages have it, which guards hosts of under 400 pages
BLANK = " \t\x0b\x0c\r"


def _hash(line: Column) -> Column:
    trimmed = F.trim(line, F.lit(BLANK))
    return F.struct(F.xxhash64(trimmed).alias("a"), F.xxhash64(F.lit(7), trimmed).alias("b"))


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def _hashes(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANK)) != "")
    return F.array_distinct(F.transform(lines, _hash))


def boilerplate(docs: DataFrame, text_column: str = "text", host_column: str = "source",
                ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(host, line, pages, host_pages)`` of the lines to drop; a NULL host is a host of its own, and NULL a text."""
    text = F.col(f"`{text_column}`")
    pages = docs.select(F.col(f"`{host_column}`").alias("host"), _key(text).alias("key"), _hashes(text).alias("lines"))
    pages = cut(pages.groupBy("host", "key").agg(F.first("lines").alias("lines")).drop("key"))
    lines = pages.select("host", F.explode("lines").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    hosts = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    return counts.join(hosts, same(counts["host"], hosts["host"])).where(F.col("pages") > ratio * F.col("host_pages")).select(
        counts["host"], "line", "pages", "host_pages"
    )


def drop_boilerplate(
    docs: DataFrame, text_column: str = "text", host_column: str = "source",
    ratio: float = RATIO, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``docs`` with ``n_lines n_dropped`` (long) and ``cleaned_text``; existing columns of these names go.

    Lines are split at line feeds and compared without white space at their ends; lines of white space
    only are neither counted nor dropped. A NULL text stays NULL with no lines; a text without boilerplate
    stays as it is; one that is all boilerplate becomes what is left, possibly empty. Rows with the same text
    count as one page of their host and get equal results. An empty table gives no rows.
    """
    names = docs.columns
    docs = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in names])
    text_column, host_column = f"in_{text_column}", f"in_{host_column}"
    text, host = F.col(f"`{text_column}`"), F.col(f"`{host_column}`")
    bad = cut(boilerplate(docs, text_column, host_column, ratio, least_pages)).select(
        F.col("host").alias("_bad_host"), F.col("line").alias("_bad_line")
    )
    # one row per distinct (host, text): its dropped lines
    keyed = docs.withColumn("_host", host).withColumn("_key", _key(text))
    lines = keyed.where(text.isNotNull()).select("_host", "_key", F.explode(_hashes(text)).alias("_line"))
    hit = lines.join(bad, same(lines["_host"], bad["_bad_host"]) & (lines["_line"] == bad["_bad_line"]))
    drops = hit.groupBy("_host", "_key").agg(F.collect_set("_line").alias("_drop")).select(
        F.col("_host").alias("_drop_host"), F.col("_key").alias("_drop_key"), "_drop"
    )
    df = keyed.join(drops, same(keyed["_host"], drops["_drop_host"]) & (keyed["_key"] == drops["_drop_key"]), "left")
    df = df.withColumn("_split", F.split(F.coalesce(text, F.lit("")), "\n"))
    df = df.withColumn("_left", F.when(F.col("_drop").isNull(), F.col("_split")).otherwise(
        F.filter("_split", lambda x: ~F.coalesce(F.array_contains(F.col("_drop"), _hash(x)), F.lit(False)))))
    new = {
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size("_split")).cast("long"),
        "n_dropped": (F.size("_split") - F.size("_left")).cast("long"),
        "cleaned_text": F.when(F.size("_split") == F.size("_left"), text).otherwise(F.array_join("_left", "\n")),
    }
    return df.select(*[F.col(f"`in_{c}`").alias(c) for c in names if c.lower() not in new], *[c.alias(n) for n, c in new.items()])


def without_boilerplate(docs: DataFrame, text_column: str = "text", host_column: str = "source") -> DataFrame:
    """``docs`` with its own columns and cleaned text."""
    plain = docs.select(*[F.col(f"`{c}`").alias(f"of_{c}") for c in docs.columns])
    cleaned = drop_boilerplate(plain, f"of_{text_column}", f"of_{host_column}")
    return cleaned.select(*[F.col("cleaned_text" if c == text_column else f"`of_{c}`").alias(c) for c in docs.columns])
