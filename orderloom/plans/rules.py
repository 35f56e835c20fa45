"""Validation, mail log, dealer resolution and load plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import intake_log as il
from ..operators import load as ld
from ..operators import resolve as rs
from ..operators import validation as va
from ..sources.log_store import LogStore
from .documents import SLIP_SQL, slips
from .registry import Registry
from .star import LOG_SQL, Warehouse, run_folder, select_list

reg = Registry()

# ------------------------------------------------------------------------------- records with faults

RECORD = {
    "log_id": "doc_id",
    "so": "CASE WHEN order_key % 300 = 2 THEN NULL ELSE so_text END",
    "od": "CASE WHEN order_key % 300 = 3 THEN NULL ELSE order_date END",
    "has_lines": "order_key % 300 <> 5",
    "order_key": "order_key",
    "buyer": "buyer",
    "tax_code": "CASE WHEN order_key % 5 = 0 THEN NULL ELSE tax_code END",
    "address": "address",
    "c1": "code1",
    "c2": "code2",
    "q1": "CASE WHEN part_key % 200 = 4 THEN 0 ELSE qty1 END",
    "p1": "CASE WHEN part_key % 200 = 5 THEN -1 ELSE price1 END",
    "t1": "CASE WHEN part_key % 250 = 6 THEN total1 + 3 ELSE total1 END",
    "q2": "qty2",
    "p2": "price2",
    "t2": "total2",
    "ft": "CASE WHEN order_key % 11 = 0 THEN NULL WHEN order_key % 350 = 7 THEN footer + 150 ELSE footer END",
}
REC_SQL = f"{SLIP_SQL}, rec AS (SELECT {', '.join(select_list(RECORD))} FROM slip)"
WITH_REC = f"WITH {REC_SQL}"


def flat_records(w: Warehouse) -> DataFrame:
    return slips(w).selectExpr(*select_list(RECORD))


def line_struct(i: int):
    return F.struct(
        F.lit(str(i)).alias("stt"),
        F.col(f"c{i}").alias("product_code"),
        F.lit("hang").alias("product_name"),
        F.lit("Chiếc").alias("unit"),
        F.col(f"q{i}").cast("decimal(18,3)").alias("quantity"),
        F.col(f"p{i}").cast("bigint").alias("unit_price"),
        F.col(f"t{i}").cast("bigint").alias("line_total"),
    )


def records(w: Warehouse) -> DataFrame:
    lines = F.array(line_struct(1), line_struct(2))
    return flat_records(w).select(
        "log_id",
        F.struct(
            F.col("so").alias("so_number"), F.col("od").alias("order_date"), F.col("buyer").alias("customer_name"),
            "tax_code", "address",
        ).alias("header"),
        F.when(F.col("has_lines"), lines).otherwise(F.slice(lines, 1, 0)).alias("lines"),
        F.col("ft").alias("footer_total"),
    )


def loaded(w: Warehouse) -> DataFrame:
    return slips_heads(w).where("order_key % 400 = 1").select(F.col("so_text").alias("so_number"))


def slips_heads(w: Warehouse) -> DataFrame:
    from .documents import HEAD

    return w.table("orders").selectExpr(*select_list(HEAD))


def errors_only(df: DataFrame, rule) -> DataFrame:
    out = df.select("log_id", F.array_join(rule, "; ").alias("errors"))
    return out.where("errors <> ''")


V1 = "CASE WHEN so IS NULL THEN 'V1_NO_SO_NUMBER' END"
V2 = "CASE WHEN od IS NULL THEN 'V2_NO_ORDER_DATE' END"
EMPTY = "CASE WHEN NOT has_lines THEN 'LINES_EMPTY' END"
V7 = "CASE WHEN order_key % 400 = 1 AND so IS NOT NULL THEN concat('V7_DUPLICATE_SO:', so) END"
V4 = [
    f"CASE WHEN has_lines AND q{i} <= 0 THEN 'V4_QTY_NONPOSITIVE:line{i}' END, "
    f"CASE WHEN has_lines AND p{i} < 0 THEN 'V4_PRICE_NEGATIVE:line{i}' END"
    for i in (1, 2)
]
V5 = [
    f"CASE WHEN has_lines AND abs(t{i} - q{i} * p{i}) > 2 THEN "
    f"concat('V5_LINE_TOTAL_MISMATCH:line{i}:got=', t{i}, ',expected=', q{i} * p{i}) END"
    for i in (1, 2)
]


def joined(*parts: str) -> str:
    return f"SELECT * FROM (SELECT log_id, concat_ws('; ', {', '.join(parts)}) AS errors FROM rec) WHERE errors <> ''"


@reg.plan("val_01_rule_v1", f"{WITH_REC} {joined(V1)}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v1())


@reg.plan(
    "val_01_rule_v1_strict",
    f"""{WITH_REC} {joined("CASE WHEN so IS NULL THEN 'V1_NO_SO_NUMBER' WHEN so NOT LIKE 'BH00%' THEN 'V1_BAD_SO_NUMBER' END")}""",
)
def _(w: Warehouse):
    rule = va.rule_v1(strict=True, pattern=r"BH00\.\d{4}")
    return errors_only(records(w), rule)


@reg.plan("val_02_rule_v2", f"{WITH_REC} {joined(V2)}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v2())


@reg.plan(
    "val_02_rule_v2_window",
    f"""{WITH_REC} {joined("CASE WHEN od IS NULL THEN 'V2_NO_ORDER_DATE' WHEN od < DATE '1996-01-01' THEN 'V2_DATE_OUTSIDE' END")}""",
)
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v2(("1996-01-01", "2001-12-31")))


@reg.plan("val_03_rule_nonempty", f"{WITH_REC} {joined(EMPTY)}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_nonempty())


@reg.plan(
    "val_04_discover_products",
    f"""{WITH_REC}, c AS (SELECT c1 AS code FROM rec WHERE has_lines UNION SELECT c2 FROM rec WHERE has_lines),
 p AS (SELECT lpad(p_partkey::VARCHAR, 12, '0') AS code FROM part WHERE p_partkey % 400 <> 8)
 SELECT code AS product_code, concat('San pham moi T7 - ', code) AS product_name, 'Chiếc' AS unit, true AS is_active
 FROM c WHERE code NOT IN (SELECT code FROM p)""",
)
def _(w: Warehouse):
    codes = records(w).select(F.explode("lines.product_code").alias("product_code"))
    product = w.table("part").where("p_partkey % 400 <> 8").selectExpr("lpad(CAST(p_partkey AS STRING), 12, '0') AS product_code")
    return va.discover_products(codes, product, "T7")


@reg.plan("val_05_rule_v4", f"{WITH_REC} {joined(*V4)}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v4())


@reg.plan("val_06_rule_v5", f"{WITH_REC} {joined(*V5)}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v5())


@reg.plan("val_06_rule_v5_tolerance_200", f"{WITH_REC} {joined(*[v.replace('> 2', '> 200') for v in V5])}")
def _(w: Warehouse):
    return errors_only(records(w), va.rule_v5(200))


V6 = """CASE WHEN has_lines AND abs(t1 + t2 - ft) > 2
 THEN concat('V6_FOOTER_MISMATCH:sum=', t1 + t2, ',footer=', ft) END"""


@reg.plan("val_07_rule_v6", f"{WITH_REC} SELECT log_id, {V6} AS warning FROM rec WHERE {V6} IS NOT NULL")
def _(w: Warehouse):
    return records(w).select("log_id", va.rule_v6().alias("warning")).where("warning IS NOT NULL")


@reg.plan("val_08_rule_v7", f"{WITH_REC} {joined(V7)}")
def _(w: Warehouse):
    return errors_only(va.mark_duplicates(records(w), loaded(w)), F.col("v7"))


BATCH = """CASE WHEN order_key % 400 = 1 AND so IS NOT NULL THEN concat('V7_DUPLICATE_SO:', so)
 WHEN so IS NOT NULL AND log_id > min(log_id) OVER (PARTITION BY so) THEN concat('V7_DUPLICATE_IN_BATCH:', so) END"""


@reg.plan("val_08_rule_v7_in_batch", f"{WITH_REC} {joined(BATCH)}")
def _(w: Warehouse):
    return errors_only(va.mark_duplicates(records(w), loaded(w), in_batch=True), F.col("v7"))


ALL_ERRORS = [V1, V7, V2, EMPTY, V4[0], V5[0], V4[1], V5[1]]
VALIDATED_SQL = f"""validated AS (SELECT rec.*, nullif(concat_ws('; ', {", ".join(ALL_ERRORS)}), '') AS error_message,
 {V6} AS warning FROM rec)"""


def validated(w: Warehouse) -> DataFrame:
    return va.validate(records(w), loaded(w))


@reg.plan("val_09_validate", f"{WITH_REC}, {VALIDATED_SQL} SELECT log_id, so AS so_number, error_message, warning FROM validated")
def _(w: Warehouse):
    return validated(w).select("log_id", "header.so_number", "error_message", "warning")


@reg.plan(
    "val_10_split_valid",
    f"""{WITH_REC}, {VALIDATED_SQL} SELECT CASE WHEN error_message IS NULL THEN 'VALIDATED' ELSE 'FAILED' END AS outcome,
 count(*) AS n, count(warning) AS warnings FROM validated GROUP BY 1""",
)
def _(w: Warehouse):
    return va.outcome_counts(validated(w))


@reg.plan(
    "src_10_rejects",
    f"""{WITH_REC}, {VALIDATED_SQL} SELECT log_id, so AS so_number, error_message AS errors FROM validated
 WHERE error_message IS NOT NULL""",
)
def _(w: Warehouse):
    return va.rejected(validated(w))


# ------------------------------------------------------------------------------------------ mail log

INCOMING_SQL = """inc0 AS (SELECT event_id, CASE WHEN event_id % 10 = 5 THEN event_id + 100000000 ELSE event_id END AS k,
 user_id, event_type = 'error' AND event_id % 3 = 0 AS no_pdf FROM events WHERE event_id % 5 = 0),
inc AS (SELECT concat('<', k, '@mail>') AS message_id, concat('f', lpad(event_id::VARCHAR, 12, '0'), '-1') AS file_name,
 concat('old', user_id) AS from_address, NULL AS error FROM inc0 UNION ALL
 SELECT concat('<', k, '@mail>'), concat('f', lpad(event_id::VARCHAR, 12, '0'), '-2'), concat('new', user_id),
 CASE WHEN no_pdf THEN 'NO_PDF_ATTACHMENT' END FROM inc0)"""


# every mail, the odd ones under a new message id
ALL_INCOMING_SQL = INCOMING_SQL.replace("event_id % 10 = 5", "event_id % 2 = 1").replace(" WHERE event_id % 5 = 0", "")


def incoming(w: Warehouse) -> DataFrame:
    """Every fifth mail scanned twice, half of them with a new message id; the second copy counts."""
    return scanned(w.table("events").where("event_id % 5 = 0"), "event_id % 10 = 5")


def all_incoming(w: Warehouse) -> DataFrame:
    """Every mail scanned twice, half of them with a new message id; the second copy counts."""
    return scanned(w.table("events"), "event_id % 2 = 1")


def scanned(events: DataFrame, renamed: str) -> DataFrame:
    base = events.selectExpr(
        f"CASE WHEN {renamed} THEN event_id + 100000000 ELSE event_id END AS k", "event_id", "user_id",
        "event_type = 'error' AND event_id % 3 = 0 AS no_pdf", "explode(array(1, 2)) AS copy",
    )
    return base.selectExpr(
        "concat('<', k, '@mail>') AS message_id",
        "concat('f', lpad(CAST(event_id AS STRING), 12, '0'), '-', copy) AS file_name",
        "concat(CASE copy WHEN 1 THEN 'old' ELSE 'new' END, user_id) AS from_address",
        "CASE WHEN no_pdf AND copy = 2 THEN 'NO_PDF_ATTACHMENT' END AS error",
    )


def base_log(w: Warehouse) -> DataFrame:
    return w.email_log.select(
        "log_id", "message_id", "from_address", "processing_status",
        F.lit(None).cast("string").alias("error_stage"), F.lit(None).cast("string").alias("error_message"),
        F.col("processed_at"),
    )


def upsert_sql(status: str, mails: str = INCOMING_SQL) -> str:
    return f"""WITH {LOG_SQL}, {mails},
last AS (SELECT message_id, min(file_name) AS seen, arg_max(from_address, file_name) AS from_address,
 max(CASE WHEN file_name LIKE '%-2' THEN error END) AS error FROM inc GROUP BY message_id),
fresh AS (SELECT message_id, (SELECT max(log_id) FROM mail) + row_number() OVER (ORDER BY seen, message_id) AS log_id
 FROM last WHERE message_id NOT IN (SELECT message_id FROM mail)),
j AS (SELECT coalesce(m.message_id, l.message_id) AS message_id, coalesce(m.log_id, f.log_id) AS log_id,
 m.log_id IS NULL AS is_new, m.processing_status AS st, m.from_address AS old_from, l.*  EXCLUDE (message_id),
 l.message_id IS NOT NULL AND (m.log_id IS NULL OR m.processing_status IN ('PENDING', 'FAILED')) AS taken
 FROM mail m FULL JOIN last l ON m.message_id = l.message_id LEFT JOIN fresh f ON f.message_id = l.message_id)
SELECT log_id, message_id, CASE WHEN taken THEN from_address ELSE old_from END AS from_address,
 CASE WHEN is_new THEN CASE WHEN error IS NULL THEN 'PENDING' ELSE 'FAILED' END ELSE {status} END AS processing_status,
 CASE WHEN taken AND error IS NOT NULL THEN 'EXTRACT' END AS error_stage,
 CASE WHEN taken AND error IS NOT NULL THEN error END AS error_message FROM j"""


@reg.plan("ing_01_upsert_log", upsert_sql("st"))
def _(w: Warehouse):
    return il.upsert(base_log(w), incoming(w)).drop("processed_at")


RETRIED = "CASE WHEN taken AND st = 'FAILED' AND error IS NULL THEN 'PENDING' ELSE st END"


@reg.plan("ing_01_upsert_log_retry", upsert_sql(RETRIED))
def _(w: Warehouse):
    return il.upsert(base_log(w), incoming(w), retry=True).drop("processed_at")


@reg.plan("ing_01_upsert_log_all", upsert_sql("st", ALL_INCOMING_SQL))
def _(w: Warehouse):
    return il.upsert(base_log(w), all_incoming(w)).drop("processed_at")


@reg.plan("ing_01_upsert_log_retry_all", upsert_sql(RETRIED, ALL_INCOMING_SQL))
def _(w: Warehouse):
    return il.upsert(base_log(w), all_incoming(w), retry=True).drop("processed_at")


@reg.plan("ing_01_upsert_stored", upsert_sql(RETRIED, ALL_INCOMING_SQL))
def _(w: Warehouse):
    log = base_log(w)
    store = LogStore(w.spark, run_folder(w), log.schema, buckets=32)
    store.create(log)
    version = store.upsert(all_incoming(w), retry=True)
    if store.upsert(all_incoming(w)) != version:
        raise RuntimeError("a second scan of the same mails changed the log")
    return store.read().drop("processed_at")


def results(w: Warehouse) -> DataFrame:
    return w.email_log.where("log_id % 4 <> 0").selectExpr(
        "log_id", "CASE WHEN log_id % 4 = 1 THEN repeat('reason ', 100) END AS error"
    )


def advance_sql(before: str, after: str, stage: str) -> str:
    message = "left(repeat('reason ', 100), 500)" if stage == "LOAD" else "repeat('reason ', 100)"
    hit = f"processing_status = '{before}' AND log_id % 4"
    return f"""WITH {LOG_SQL} SELECT log_id, CASE WHEN {hit} = 1 THEN 'FAILED' WHEN {hit} > 1 THEN '{after}'
 ELSE processing_status END AS processing_status, CASE WHEN {hit} = 1 THEN '{stage}' WHEN {hit} > 1 AND '{stage}' = 'LOAD'
 THEN NULL ELSE 'OLD' END AS error_stage, CASE WHEN {hit} = 1 THEN {message} WHEN {hit} > 1 AND '{stage}' = 'LOAD'
 THEN NULL ELSE 'old message' END AS error_message FROM mail"""


def tagged_log(w: Warehouse) -> DataFrame:
    return base_log(w).withColumns({"error_stage": F.lit("OLD"), "error_message": F.lit("old message")})


for _stage, (_before, _after) in il.STAGES.items():

    @reg.plan(f"ing_02_advance_{_stage.lower()}_stored", advance_sql(_before, _after, _stage))
    def _(w: Warehouse, stage=_stage):
        log = tagged_log(w)
        store = LogStore(w.spark, run_folder(w), log.schema, buckets=32)
        store.create(log)
        outcome = results(w).join(log.select("log_id", "message_id"), "log_id")
        version = store.advance(outcome, stage, "2001-08-01 00:00:00")
        if store.advance(outcome, stage, "2001-08-01 00:00:00") != version:
            raise RuntimeError("a repeated stage changed the log")
        return store.read().drop("message_id", "from_address", "processed_at")

    @reg.plan(f"ing_02_advance_{_stage.lower()}", advance_sql(_before, _after, _stage))
    def _(w: Warehouse, stage=_stage):
        return il.advance(tagged_log(w), results(w), stage, "2001-08-01 00:00:00").drop(
            "message_id", "from_address", "processed_at"
        )


@reg.plan(
    "ing_03_tag_errors",
    f"WITH a AS ({advance_sql('VALIDATED', 'LOADED', 'LOAD')})"
    " SELECT error_stage, error_message, count(*) AS n FROM a GROUP BY ALL",
)
def _(w: Warehouse):
    moved = il.advance(tagged_log(w), results(w), "LOAD", "2001-08-01 00:00:00")
    return moved.groupBy("error_stage", "error_message").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------------------------- resolution

PREFIXED = """CASE c_custkey % 5 WHEN 0 THEN upper(c_name) WHEN 1 THEN concat('  ', c_name, '   Nam ')
 WHEN 2 THEN concat('Công ty TNHH ', c_name) WHEN 3 THEN concat('CÔNG TY CỔ PHẦN  cty ', c_name) ELSE c_name END"""
NORMAL = """CASE c_custkey % 5 WHEN 1 THEN concat(lower(c_name), ' nam') ELSE lower(c_name) END"""


@reg.plan("cus_01_normalize_name", f"SELECT c_custkey AS customer_code, {NORMAL} AS name FROM customer")
def _(w: Warehouse):
    from ..functions.text import normalize_name

    return w.table("customer").selectExpr("c_custkey AS customer_code", f"{PREFIXED} AS raw").select(
        "customer_code", normalize_name(F.col("raw")).alias("name")
    )


DEALER = {
    "customer_code": "printf('KH-%05d', c_custkey)",
    "customer_name": "c_name",
    "tax_code": "CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE lpad(CAST(c_custkey - c_custkey % 10 % 2 AS STRING), 10, '0') END",
}


def dealers(w: Warehouse) -> DataFrame:
    return w.table("customer").selectExpr(*select_list(DEALER))


DEALER_SQL = f"dealer AS (SELECT {', '.join(select_list(DEALER))} FROM customer)"


@reg.plan(
    "cus_02_match_tax",
    f"""WITH {DEALER_SQL}, o AS (SELECT o_orderkey AS log_id, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS tax_code FROM orders),
 t AS (SELECT tax_code, max(customer_code) AS customer_code FROM dealer WHERE tax_code IS NOT NULL GROUP BY tax_code)
 SELECT log_id, o.tax_code, customer_code FROM o LEFT JOIN t ON t.tax_code = o.tax_code""",
)
def _(w: Warehouse):
    orders = w.table("orders").selectExpr("o_orderkey AS log_id", "lpad(CAST(o_custkey AS STRING), 10, '0') AS tax_code")
    return rs.match_tax(orders, dealers(w))


def asked(w: Warehouse) -> DataFrame:
    """One order per customer with its name garbled: case, form, a lost letter, or unknown."""
    return w.table("customer").selectExpr(
        "c_custkey AS log_id",
        "CAST(NULL AS STRING) AS tax_code",
        "CASE c_custkey % 4 WHEN 0 THEN upper(c_name) WHEN 1 THEN concat('Công ty TNHH  ', c_name)"
        " WHEN 2 THEN concat(substr(c_name, 1, 3), substr(c_name, 5)) ELSE concat('Hop tac xa ', c_mktsegment, c_nationkey) END"
        " AS clean_name",
        "concat('So ', c_custkey) AS address",
    )


# Similarity has no SQL form here; rows whose true name is known must still find it.
@reg.plan("cus_03_match_fuzzy")
def _(w: Warehouse):
    return rs.match_fuzzy(asked(w), dealers(w)).select("log_id", "clean_name", "customer_code", "score", "runner_up")


@reg.plan(
    "cus_03_match_fuzzy_exact",
    f"""WITH {DEALER_SQL} SELECT c_custkey AS log_id, printf('KH-%05d', c_custkey) AS customer_code, 100::DOUBLE AS score
 FROM customer WHERE c_custkey % 4 < 2""",
)
def _(w: Warehouse):
    return rs.match_fuzzy(asked(w).where("log_id % 4 < 2"), dealers(w)).select("log_id", "customer_code", "score")


# by construction: case and form change nothing, a lost letter is one edit of both lengths, the rest is unknown
@reg.plan(
    "cus_03_match_fuzzy_all",
    """SELECT c_custkey AS log_id, CASE WHEN c_custkey % 4 < 3 THEN printf('KH-%05d', c_custkey) END AS customer_code,
 CASE WHEN c_custkey % 4 < 2 THEN 100::DOUBLE WHEN c_custkey % 4 = 2
 THEN 100::DOUBLE * (1 - 1::DOUBLE / (2 * length(c_name) - 1)) END AS score FROM customer""",
)
def _(w: Warehouse):
    return rs.match_fuzzy(asked(w), dealers(w)).select("log_id", "customer_code", "score")


NEW_SQL = f"""WITH {DEALER_SQL}, o AS (SELECT o_orderkey AS log_id,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '7') END AS tax_code,
 CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE concat('Cua hang ', o_custkey % 40) END
 ELSE concat('Dai ly ', o_custkey) END AS clean_name FROM orders),
k AS (SELECT *, coalesce('tax:' || tax_code, 'name:' || lower(coalesce(clean_name, 'Khách lẻ'))) AS dealer_key FROM o),
f AS (SELECT dealer_key, min(log_id) AS first_log_id, arg_min(coalesce(clean_name, 'Khách lẻ'), log_id) AS customer_name,
 min(tax_code) AS tax_code FROM k GROUP BY dealer_key)
SELECT printf('KH-%05d', (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY first_log_id))
 AS customer_code, customer_name, tax_code, dealer_key, first_log_id, 'STANDARD' AS customer_tier, true AS is_active FROM f"""


@reg.plan("cus_04_new_customers", NEW_SQL)
def _(w: Warehouse):
    unmatched = w.table("orders").selectExpr(
        "o_orderkey AS log_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS STRING), 10, '7') END AS tax_code",
        "CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE concat('Cua hang ', o_custkey % 40) END"
        " ELSE concat('Dai ly ', o_custkey) END AS clean_name",
        "CAST(NULL AS STRING) AS address",
    )
    return rs.new_customers(unmatched, dealers(w)).drop("address")


@reg.plan("cus_05_resolve_batch")
def _(w: Warehouse):
    orders = w.table("orders").selectExpr(
        "o_orderkey AS log_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS STRING), 10, '7') END AS tax_code",
        "CASE WHEN o_orderkey % 3 = 0 THEN concat('Cua hang xe ', o_custkey % 40, ' ', o_orderpriority)"
        " ELSE concat('Dai ly ', o_custkey) END AS clean_name",
        "CAST(NULL AS STRING) AS address",
    )
    resolved, _created = rs.resolve_batch(orders, dealers(w))
    return resolved.select("log_id", "tax_code", "clean_name", "customer_code")


# Names by construction: a third of the orders states no tax code and writes one of 997 unlike names in several
# ways, or the name of a stored dealer; every other order states a tax code nobody has.
PLANTED_NAME = (
    "CASE o_orderkey % 5 WHEN 0 THEN upper({h}) WHEN 1 THEN concat(substr({h}, 1, 9), substr({h}, 11))"
    " WHEN 2 THEN concat('Công ty TNHH ', {h}) WHEN 3 THEN concat({h}, 'z') ELSE {h} END"
).format(h="md5(CAST(o_custkey % 997 AS {text}))")
PLANTED_SQL = f"""o AS (SELECT o_orderkey AS log_id, o_custkey AS dealer,
 CASE WHEN o_orderkey % 3 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 10, '7') END AS tax_code,
 CASE WHEN o_orderkey % 3 <> 0 THEN concat('Dai ly ', o_custkey) WHEN o_custkey % 10 = 0 THEN upper(c_name)
 ELSE {PLANTED_NAME.format(text="VARCHAR")} END AS clean_name,
 CASE WHEN o_orderkey % 3 <> 0 THEN 'tax:' || lpad(CAST(o_custkey AS VARCHAR), 10, '7')
 WHEN o_custkey % 10 <> 0 THEN 'name:' || o_custkey % 997 END AS dealer_key
 FROM orders JOIN customer ON c_custkey = o_custkey),
f AS (SELECT dealer_key, row_number() OVER (ORDER BY min(log_id)) AS i FROM o WHERE dealer_key IS NOT NULL GROUP BY dealer_key)"""


@reg.plan(
    "cus_05_resolve_batch_planted",
    f"""WITH {PLANTED_SQL} SELECT log_id, tax_code, clean_name,
 printf('KH-%05d', CASE WHEN f.i IS NULL THEN dealer ELSE (SELECT max(c_custkey) FROM customer) + f.i END) AS customer_code
 FROM o LEFT JOIN f USING (dealer_key)""",
)
def _(w: Warehouse):
    names = w.table("customer").selectExpr("c_custkey AS o_custkey", "c_name")
    orders = w.table("orders").join(names, "o_custkey").selectExpr(
        "o_orderkey AS log_id",
        "CASE WHEN o_orderkey % 3 <> 0 THEN lpad(CAST(o_custkey AS STRING), 10, '7') END AS tax_code",
        "CASE WHEN o_orderkey % 3 <> 0 THEN concat('Dai ly ', o_custkey) WHEN o_custkey % 10 = 0 THEN upper(c_name)"
        f" ELSE {PLANTED_NAME.format(text='STRING')} END AS clean_name",
        "CAST(NULL AS STRING) AS address",
    )
    resolved, _created = rs.resolve_batch(orders, dealers(w))
    return resolved.select("log_id", "tax_code", "clean_name", "customer_code")


@reg.plan("cus_06_max_code", "SELECT coalesce(max(c_custkey), 0) AS max_code FROM customer WHERE c_custkey % 2 = 0")
def _(w: Warehouse):
    code = F.when(F.col("c_custkey") % 2 == 0, F.format_string("KH-%05d", "c_custkey")).otherwise(
        F.format_string("KH-%05dX", "c_custkey")
    )
    return rs.max_code(w.table("customer").select(code.alias("customer_code")))


# ---------------------------------------------------------------------------------------------- load


def accepted(w: Warehouse) -> DataFrame:
    return va.valid(validated(w)).withColumn("customer_code", F.col("header.tax_code"))


@reg.plan(
    "ld_01_build_orders",
    f"""{WITH_REC}, {VALIDATED_SQL} SELECT row_number() OVER (ORDER BY log_id) AS order_id, log_id, so AS so_number,
 NULL::VARCHAR AS invoice_symbol, NULL::VARCHAR AS invoice_number, strftime(od, '%Y-%m-%d') AS order_date,
 tax_code AS customer_code FROM validated WHERE error_message IS NULL""",
)
def _(w: Warehouse):
    return ld.build_orders(accepted(w))


@reg.plan(
    "ld_02_build_lines",
    f"""{WITH_REC}, {VALIDATED_SQL}, v AS (SELECT * FROM validated WHERE error_message IS NULL)
 SELECT log_id, so AS so_number, 1::BIGINT AS line_no, c1 AS product_code, q1::DOUBLE AS quantity, p1 AS unit_price,
 t1 AS line_total FROM v UNION ALL SELECT log_id, so, 2, c2, q2::DOUBLE, p2, t2 FROM v""",
)
def _(w: Warehouse):
    return ld.build_lines(accepted(w))


@reg.plan(
    "ld_03_order_totals",
    """SELECT o_orderkey AS order_id, coalesce(sum(l_extendedprice::DECIMAL(18,2)), 0)::DOUBLE AS total_amount,
 coalesce(sum(l_quantity::DECIMAL(18,3)), 0)::DOUBLE AS total_quantity, count(l_orderkey) AS line_count
 FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def _(w: Warehouse):
    return ld.order_totals(w.sales_order.select("order_id"), w.order_line)


@reg.plan(
    "ld_04_load_outcome",
    f"""{WITH_REC} SELECT log_id, so AS so_number, CASE WHEN so IS NULL THEN 'order number is missing'
 WHEN order_key % 400 = 1 THEN concat('order number exists: ', so)
 WHEN log_id <> min(log_id) OVER (PARTITION BY so) THEN concat('order number repeated: ', so) END AS error FROM rec""",
)
def _(w: Warehouse):
    return ld.load_outcome(records(w).select("log_id", "header.so_number"), loaded(w))


@reg.plan(
    "ld_05_unload",
    """SELECT 'fact_sales' AS name, count(*) AS n FROM orders WHERE NOT (year(o_orderdate) = 2001 AND month(o_orderdate) = 7)
 UNION ALL SELECT 'sales_order', count(*) FROM orders WHERE printf('BH%02d.%04d', o_orderkey // 10000, o_orderkey % 10000)
 NOT LIKE 'BH00.%' UNION ALL SELECT 'customer', count(*) FROM customer WHERE printf('KH-%05d', c_custkey) <= 'KH-00702'
 UNION ALL SELECT 'product', count(*) FROM part WHERE p_size < 25 UNION ALL SELECT 'email_log', 0""",
)
def _(w: Warehouse):
    heads = slips_heads(w).select(F.col("so_text").alias("so_number"), "order_date")
    from ..operators.fact import with_calendar

    tables = {
        "fact_sales": with_calendar(heads),
        "sales_order": heads,
        "customer": dealers(w),
        "product": w.table("part").selectExpr(
            "p_partkey", "CAST(date_add(DATE '2001-01-01', p_size) AS TIMESTAMP) AS created_at"
        ),
        "email_log": w.email_log,
    }
    left = ld.unload(tables, (2001, 7), "BH00.", "KH-00702", "2001-01-26")
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, df in left.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out



@reg.plan(
    "ld_05_unload_lines",
    """SELECT l_orderkey AS order_key, l_linenumber AS line_no, printf('BH%02d.%04d', l_orderkey // 10000, l_orderkey % 10000)
 AS so_number FROM lineitem WHERE l_orderkey // 10000 <> 0""",
)
def _(w: Warehouse):
    number = F.format_string("BH%02d.%04d", F.floor(F.col("l_orderkey") / 10000).cast("bigint"), F.col("l_orderkey") % 10000)
    lines = w.table("lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"), number.alias("so_number")
    )
    return ld.unload({"order_line": lines}, (2001, 7), "BH00.", "KH-00702", "2001-01-26")["order_line"]

