"""The operators of this subpackage as named queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    html_text, language_id, line_dedup, merkle, mixing, near_dup, packing, pieces, quality_rules, resampling, toxicity,
    vector_search, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(modulus: int, remainder: int):
    return (F.crc32(F.col("doc_id").cast("string")) % modulus == remainder).alias("held_out")


@query("op1_mix_sources")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.rows_taken(mixing.copies(table(spark, folder, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


# The word pattern, as a list of characters that both engines read alike.
_SPLIT = r"[ \t\n\x0b\x0c\r]+"
_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '" + _SPLIT + "'), lambda x : x <> '')"


_WINDOW = quality_rules.WINDOW_WORDS


@query("op2_quality_rules", f"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM documents),
worded AS (SELECT *, {_WORDS.format("line")} AS w FROM lines),
judged AS (
  SELECT *, len(w) AS n,
    len(w) > 0 AND (
      100 * len(list_filter(w, lambda x : regexp_matches(x, '{quality_rules.MARKS}'))) > {quality_rules.MARKED_PERCENT} * len(w)
      OR 100 * len(list_filter(w, lambda x : x IN ('|', '»', '›', '·'))) > {quality_rules.SEPARATOR_PERCENT} * len(w)
      OR (len(w) BETWEEN {quality_rules.REPEAT_WORDS} AND {_WINDOW} AND 100 * len(list_distinct(w)) < {quality_rules.DISTINCT_PERCENT} * len(w))
      OR (len(w) > {_WINDOW} AND 2 * len(list_filter(range(0, len(w), {_WINDOW}), lambda i : 100 * len(list_distinct(
        w[least(i, len(w) - {_WINDOW}) + 1 : least(i, len(w) - {_WINDOW}) + {_WINDOW}])) < {quality_rules.DISTINCT_PERCENT} * {_WINDOW}))
        > len(range(0, len(w), {_WINDOW})))
      OR regexp_matches(line, '{quality_rules.PHRASES}')) AS bad
  FROM worded),
sums AS (
  SELECT doc_id, any_value(text) AS text, sum(n) AS n_words, sum(CASE WHEN bad THEN n ELSE 0 END) AS n_failed_words,
    count(CASE WHEN n > 0 THEN line END) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_dup_lines
  FROM judged GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents)),
windows AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o) AS t
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(word, 2) OVER o IS NOT NULL),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id),
base AS (
  SELECT s.*, coalesce(c.n, 0) AS n_repeat_words,
    (n_words < 50 OR 100 * coalesce(c.n, 0) > 50 * n_words) AS base_failed
  FROM sums s LEFT JOIN covered c USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '{_SPLIT}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  CAST(n_failed_words AS BIGINT) AS n_failed_words, base_failed,
  NOT base_failed AND 100 * n_failed_words <= {quality_rules.LOST_PERCENT} * n_words AS kept
FROM base
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "n_failed_words", "base_failed", "kept")


@query("op6_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents),
trimmed AS (SELECT *, regexp_replace(line, '^[ \\t\\x0b\\x0c\\r]+|[ \\t\\x0b\\x0c\\r]+$', '', 'g') AS t FROM lines),
hosts AS (SELECT source, count(DISTINCT coalesce('+' || text, '-')) AS host_pages FROM documents GROUP BY source),
bad AS (
  SELECT c.source, t FROM
    (SELECT source, t, count(DISTINCT text) AS pages FROM trimmed WHERE t <> '' GROUP BY source, t) c
    JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE pages >= {line_dedup.LEAST_PAGES} AND pages > {line_dedup.RATIO} * host_pages),
marked AS (
  SELECT x.*, b.t IS NOT NULL AS dropped FROM trimmed x
  LEFT JOIN bad b ON x.source IS NOT DISTINCT FROM b.source AND x.t = b.t)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  md5(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT dropped), '')) AS text_md5
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_boilerplate(docs).select(
        "doc_id", "n_lines", "n_dropped", F.md5("cleaned_text").alias("text_md5"))


@query("op3_toxicity")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    usable = F.crc32(F.col("id").cast("string")) % 5 != 0
    net = toxicity.fit(toxicity.labelled_sample(docs, table(spark, folder, "labels"), usable))
    return toxicity.score(docs.select("doc_id", held_out(5, 0), "text"), net).select("doc_id", "held_out", "score", "predicted")


@query("op4_near_dup", f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE
    list_transform(range(1, len(w) - 3), lambda i : w[i : i + 4]) END) AS s
  FROM worded),
sized AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sized x ON a = x.doc_id JOIN sized y ON b = y.doc_id
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id,
  d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sized s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.group(table(spark, folder, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    seen = docs.select("text", "lang", held_out(4, 2)).where(~F.coalesce("held_out", F.lit(False)))
    judged = language_id.identify(docs.select("doc_id", "text"), seen)
    return judged.select("doc_id", held_out(4, 2), "lang_pred", "score")


@query("op7_html_text")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.render(table(spark, folder, "pages").select("page_id", "html")).select("page_id", "visible_text")


@query("op8_vector_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p : p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_search.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op9_quality_resampling")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    docs = resampling.marked_target(table(spark, folder, "documents").select("doc_id", "text"), good)
    return resampling.resample(docs, F.col("_target")).withColumnRenamed("id", "doc_id")


@query("op10_piece_sampling")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode_texts(docs, F.xxhash64("doc_id", "text"))
    back = pieces.decode_texts(encoded)
    return back.select("doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_pieces"),
                       F.xxhash64("token_ids").alias("pieces_hash"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op12_packing")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    pieces_ = packing.pack(table(spark, folder, "documents"))
    return pieces_.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                          "doc_tokens", "sequence_id", "offset")


def _merkle_sql(levels: int = 8, top_levels: int = 3) -> str:
    """The trees level by level: enough for 8 ** levels rows of a language and 8 ** top_levels languages."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    leaf = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}"))
    # CRC-32 bit by bit: each character's code, then eight steps marked -1
    steps = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c : [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = (f"xor(list_reduce(list_concat([4294967295], {steps}), lambda a, x : CASE WHEN x >= 0 THEN xor(a, x) "
           "ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)")  # fmt: skip
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"texts AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {lower} ELSE text END AS other FROM documents)",
        f"hashed AS (SELECT doc_id, lang, sha256({leaf.format('text')}) AS leaf, sha256({leaf.format('other')}) AS changed FROM texts)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, "
        "count(*) OVER (PARTITION BY lang) AS width FROM hashed)",
        "langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM hashed))",
        "leaves AS (SELECT p.*, g.tree FROM placed p JOIN langs g ON p.lang IS NOT DISTINCT FROM g.lang)",
        "n0 AS (SELECT tree, place, leaf AS h, width FROM leaves)",
    ]

    def tree(name: str, n: int) -> None:
        for k in range(n):
            parts.append(
                f"{name}s{k} AS (SELECT a.tree, a.place, any_value(a.width) AS width, "
                "coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l, "
                "coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r "
                f"FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.place // 8 = b.place // 8 GROUP BY 1, 2)")  # fmt: skip
            parts.append(
                f"{name}{k + 1} AS (SELECT tree, place // 8 AS place, CASE WHEN any_value(width) = 1 THEN any_value(h) "
                "ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h, (any_value(width) + 7) // 8 AS width "
                f"FROM {name}{k} GROUP BY 1, 2)")  # fmt: skip

    tree("n", levels)
    parts.append(f"t0 AS (SELECT 0 AS tree, tree AS place, h, (SELECT count(*) FROM langs) AS width FROM n{levels})")
    tree("t", top_levels)
    parts.append("f0 AS (SELECT doc_id, leaf, tree, place, changed AS h, '' AS siblings FROM leaves)")
    step = ("f{to} AS (SELECT f.doc_id, f.leaf, f.tree, f.place, CASE WHEN s.width = 1 THEN f.h ELSE sha256(s.l || f.h || s.r) END AS h, "
            "f.siblings || s.l || s.r AS siblings FROM f{at} f JOIN {name}s{k} s ON {on})")  # fmt: skip
    for k in range(levels):
        parts.append(step.format(to=k + 1, at=k, name="n", k=k, on=f"f.tree = s.tree AND f.place // {8**k} = s.place"))
    for k in range(top_levels):
        parts.append(step.format(to=levels + k + 1, at=levels + k, name="t", k=k, on=f"f.tree // {8**k} = s.place"))
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT f.doc_id, f.leaf, g.h AS subroot, r.h AS root, sha256(f.siblings) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM f{levels + top_levels} f JOIN n{levels} g ON f.tree = g.tree CROSS JOIN t{top_levels} r
""")


@query("op13_merkle_manifest", _merkle_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.verify_documents(table(spark, folder, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "proof": "proof_sha256"})
