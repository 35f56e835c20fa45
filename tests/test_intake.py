import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import intake_log as il
from orderloom.operators import resolve as rs
from orderloom.operators import validation as va
from orderloom.plans.star import Warehouse

from __spark_entry__ import queries
from conftest import SMALL

RECORD = (
    "log_id long, header struct<so_number:string,order_date:date,customer_name:string,tax_code:string,address:string>,"
    "lines array<struct<stt:string,product_code:string,product_name:string,unit:string,quantity:decimal(18,3),"
    "unit_price:bigint,line_total:bigint>>, footer_total bigint"
)


def record(log_id, so="BH26.0001", date=True, lines=(("2", 10, 20),), footer=None):
    import datetime

    day = datetime.date(2026, 3, 1) if date else None
    items = [("1", "p", "n", "Chiếc", Decimal(q), p, t) for q, p, t in lines]
    return (log_id, (so, day, "x", None, None), items, footer)


def errors(spark, rows, loaded=(), **kw):
    df = spark.createDataFrame(rows, RECORD)
    known = spark.createDataFrame([(x,) for x in loaded], "so_number string")
    return {r.log_id: (r.error_message, r.warning) for r in va.validate(df, known, **kw).collect()}


def test_error_texts_in_rule_order(spark):
    got = errors(
        spark,
        [
            record(1, so=None, date=False, lines=()),
            record(2, lines=[("0", -1, 5), ("2.5", 3, 8), ("2.5", 3, 11)]),
            record(3, so="BH26.0009", footer=100),
            record(4, so="BH26.0007"),
        ],
        loaded=["BH26.0009"],
    )
    assert got[1][0] == "V1_NO_SO_NUMBER; V2_NO_ORDER_DATE; LINES_EMPTY"
    assert got[2][0] == (
        "V4_QTY_NONPOSITIVE:line1; V4_PRICE_NEGATIVE:line1; V5_LINE_TOTAL_MISMATCH:line1:got=5,expected=0; "
        "V5_LINE_TOTAL_MISMATCH:line3:got=11,expected=8"
    )
    assert got[3] == ("V7_DUPLICATE_SO:BH26.0009", "V6_FOOTER_MISMATCH:sum=20,footer=100")
    assert got[4] == (None, None)


def test_duplicates_inside_a_batch_are_optional(spark):
    rows = [record(1), record(2)]
    assert errors(spark, rows) == {1: (None, None), 2: (None, None)}
    assert errors(spark, rows, in_batch=True)[2][0] == "V7_DUPLICATE_IN_BATCH:BH26.0001"


def test_second_run_never_moves_a_loaded_mail(spark):
    log = spark.createDataFrame(
        [(1, "LOADED"), (2, "FAILED"), (3, "PENDING")], "log_id long, processing_status string"
    ).withColumns({c: F.lit(None).cast("string") for c in ("error_stage", "error_message", "processed_at")})
    results = spark.createDataFrame([(1, "late"), (2, None), (3, None)], "log_id long, error string")
    for stage in il.STAGES:
        log = il.advance(log, results, stage, "2026-04-01 00:00:00")
    got = {r.log_id: (r.processing_status, r.error_message) for r in log.collect()}
    assert got == {1: ("LOADED", None), 2: ("FAILED", None), 3: ("LOADED", None)}


def score(a, b):
    """Brute force: whole-table dynamic programming on the word rests."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = left & right
    ra, rb = " ".join(sorted(left - both)), " ".join(sorted(right - both))
    if both and (not ra or not rb):
        return 100.0
    t = [[0] * (len(rb) + 1) for _ in range(len(ra) + 1)]
    for i, x in enumerate(ra):
        for j, y in enumerate(rb):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    s = len(" ".join(sorted(both)))
    la, lb = (s + (s > 0) + len(r) for r in (ra, rb))
    best = 1 - (len(ra) + len(rb) - 2 * t[-1][-1]) / (la + lb)
    if s:
        best = max(best, 1 - (la - s) / (la + s), 1 - (lb - s) / (lb + s))
    return 100 * best


WORDS = ["xe", "dap", "cua", "hang", "minh", "tan", "long", "phu", "nam", "tien", "hoang", "quan", "binh", "an"]


def garbled(rnd, name):
    at = rnd.randrange(len(name))
    kind = rnd.randrange(4)
    if kind == 0:
        return name[:at] + name[at + 1 :]
    if kind == 1:
        return name[:at] + rnd.choice("abcdefgh ") + name[at:]
    if kind == 2:
        words = name.split()
        rnd.shuffle(words)
        return " ".join(words)
    return name + " " + rnd.choice(WORDS)


def test_similar_names_are_complete(spark):
    rnd = random.Random(7)
    right = sorted({" ".join(rnd.choices(WORDS, k=rnd.randint(1, 6))) for _ in range(150)})
    left = sorted({" ".join(garbled(rnd, rnd.choice(right)).split()) for _ in range(200)} - {""})
    a = spark.createDataFrame([(x,) for x in left], "a string")
    b = spark.createDataFrame([(x,) for x in right], "b string")
    for threshold in (92, 80):
        got = {(r.a, r.b): round(r.score, 6) for r in rs.similar_names(a, b, threshold).collect()}
        want = {(x, y): round(score(x, y), 6) for x in left for y in right if score(x, y) >= threshold - 1e-9}
        assert got == want


def test_match_prefers_the_smallest_code_and_reports_the_runner_up(spark):
    dealers = spark.createDataFrame(
        [("KH-00002", "Minh Tan"), ("KH-00001", "Minh Tan Phu"), ("KH-00003", "Hoang Long")],
        "customer_code string, customer_name string",
    )
    orders = spark.createDataFrame([(1, "cty MINH"), (2, "Hoang Lonng"), (3, "Ai Do")], "log_id long, clean_name string")
    got = {r.log_id: (r.customer_code, r.runner_up) for r in rs.match_fuzzy(orders, dealers).collect()}
    assert got == {1: ("KH-00001", 100.0), 2: ("KH-00003", None), 3: (None, None)}


def test_batch_resolution_equals_one_by_one(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.sample(WORDS, 3)) for _ in range(12)]
    dealers = [(f"KH-{i:05d}", base[i], f"{i:010d}") for i in range(4)]
    orders = []
    for i in range(60):
        tax = rnd.choice([None, None, f"{rnd.randrange(8):010d}"])
        name = rnd.choice(base) if rnd.random() < 0.5 else " ".join(garbled(rnd, rnd.choice(base)).split())
        orders.append((i, tax, name or None, None))

    by_tax = {t: c for c, _, t in dealers}
    names = [(n, c) for c, n, _ in dealers]
    nxt, want = 4, {}
    for i, tax, name, _ in orders:
        if tax and tax in by_tax:
            want[i] = by_tax[tax]
            continue
        if not tax:
            scored = [(-score(name, n), k) for k, (n, _) in enumerate(names)]
            top = min(scored)
            if -top[0] >= 92:
                want[i] = names[top[1]][1]
                continue
        code = f"KH-{nxt:05d}"
        nxt += 1
        names.append((name, code))
        if tax:
            by_tax[tax] = code
        want[i] = code

    c = spark.createDataFrame(dealers, "customer_code string, customer_name string, tax_code string")
    o = spark.createDataFrame(orders, "log_id long, tax_code string, clean_name string, address string")
    resolved, created = rs.resolve_batch(o, c)
    got = {r.log_id: r.customer_code for r in resolved.collect()}
    assert len(got) == 60 and created.count() == nxt - 4
    assert got == want


def test_digit_names_find_the_same_best_two_as_brute_force(spark):
    rnd = random.Random(5)
    right = [f"dai ly {rnd.randrange(10**4):06d}" for _ in range(120)] + [f"{rnd.randrange(10**3):05d}" for _ in range(60)]
    left = right[::3] + [x[:-1] for x in right[::4]] + [x[:3] + x[4:] + "7" for x in right[::5]]
    dealers = spark.createDataFrame([(f"KH-{i:05d}", x) for i, x in enumerate(right)], "customer_code string, customer_name string")
    names = spark.createDataFrame([(x,) for x in sorted(set(left))], "a string")
    got = {r.a: (round(r.score, 6), r.runner_up and round(r.runner_up, 6)) for r in rs.best_matches(names, dealers, 80).collect()}
    want = {}
    for x in set(left):
        top = sorted((round(score(x, y), 6) for y in set(right) if score(x, y) >= 80), reverse=True)[:2]
        if top:
            want[x] = (top[0], top[1] if len(top) > 1 else None)
    assert got == want


def leading_by_hand(links):
    earlier = {}
    for name, _, other in links:
        earlier.setdefault(name, []).append(other)
    led = {}
    for name in sorted(earlier):
        led[name] = not any(led.get(x, True) for x in earlier[name])
    return led


@pytest.mark.parametrize("per_task", [7, 100_000])
def test_leaders_equal_those_found_one_by_one(spark, per_task):
    rnd = random.Random(per_task)
    name = "n{:04d}".format
    links = [(name(i), i, name(j)) for i in range(1, 40) for j in rnd.sample(range(i), min(i, rnd.randint(0, 3)))]
    links += [(name(i), i, name(100)) for i in range(101, 130)] + [(name(i), i, name(129)) for i in range(130, 140)]
    got = rs.leading(spark.createDataFrame(links, "name string, seq long, earlier string"), per_task).collect()
    assert len(got) == len({x for x, _, _ in links})
    assert {r.name: r.leads for r in got} == leading_by_hand(links)


def test_a_long_chain_takes_few_jobs(spark):
    links = [(f"n{i:05d}", i, f"n{i - k:05d}") for i in range(1, 1001) for k in (1, 2) if i >= k]
    df = spark.createDataFrame(links, "name string, seq long, earlier string")
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        got = {r.name: r.leads for r in rs.leading(df).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == leading_by_hand(links)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) < 20


def test_no_links_and_no_orders(spark):
    assert rs.leading(spark.createDataFrame([], "name string, seq long, earlier string")).count() == 0
    c = spark.createDataFrame([], "customer_code string, customer_name string, tax_code string")
    o = spark.createDataFrame([], "log_id long, tax_code string, clean_name string, address string")
    resolved, created = rs.resolve_batch(o, c)
    assert resolved.count() == 0 and created.count() == 0


def test_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        from orderloom.functions.text import to_int

        to_int(F.lit("1"), "other")


def test_queries_over_all_names_and_mails(spark):
    w = Warehouse(spark, SMALL)
    for name in ("ing_01_upsert_log_all", "ing_01_upsert_log_retry_all"):
        new = queries()[name](spark, SMALL).join(w.email_log.select("message_id"), "message_id", "left_anti")
        assert new.count() == w.email_log.where("log_id % 2 = 1").count()
    matched = queries()["cus_03_match_fuzzy_all"](spark, SMALL)
    assert matched.count() == w.table("customer").count()
    assert matched.where("log_id % 4 = 2 AND customer_code IS NOT NULL").count() == w.table("customer").where("c_custkey % 4 = 2").count()


def test_names_are_never_broadcast(spark):
    # few bytes of names become many forms and grams, which must not pass the driver
    names = spark.range(50).select(F.format_string("dealer number %05d", "id").alias("a"))
    found = rs.similar_names(names, names.withColumnRenamed("a", "b"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("a = b").count() == 50


def test_documents_are_parsed_once(spark):
    from orderloom.operators.chain import run_intake
    from orderloom.plans.documents import NUMBER_PATTERN, OWN_TAX_CODE, rendered
    from orderloom.plans.flows import intake_star

    w = Warehouse(spark, SMALL)
    seen = spark.sparkContext.accumulator(0)
    read = F.udf(lambda text: (seen.add(1), text)[1])
    few = spark.createDataFrame(rendered(w).limit(50).collect(), rendered(w).schema)
    docs = few.select(F.col("doc_id").alias("log_id"), read("text").alias("text"), "tables", "parse_error", F.lit(None).cast("string").alias("mail_name"))
    intake = run_intake(docs, intake_star(w), OWN_TAX_CODE, pattern=NUMBER_PATTERN)
    assert intake.validated.count() == 50 and seen.value == 50


def test_a_pattern_is_searched_once_under_a_condition(spark):
    from orderloom.functions import text as tx

    rows = spark.createDataFrame([("a1", True), ("b", True), (None, True), ("a2", False)], "t string, c boolean")
    got = rows.select(F.when(F.col("c"), tx.found(F.col("t"), "a(.)")).alias("x"))
    assert [r.x for r in got.collect()] == ["1", None, None, None]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
