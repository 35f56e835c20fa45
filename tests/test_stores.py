"""The stored mail log and the intake that keeps its state."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.operators import intake_log as il
from orderloom.operators import run as run_module
from orderloom.operators.extraction import extract_orders
from orderloom.operators.fact import Star
from orderloom.operators.run import LOG, IntakeRun
from orderloom.session import settings
from orderloom.sources.log_store import LogStore


def log_rows(spark, n):
    states = F.element_at(F.array(*map(F.lit, il.STATES)), (F.col("id") % 6 + 1).cast("int"))
    return spark.range(1, n + 1).select(
        F.col("id").alias("log_id"), F.concat(F.lit("m"), "id").alias("message_id"), F.lit("a").alias("from_address"),
        F.lit(None).cast("string").alias("subject"), F.lit(None).cast("timestamp").alias("received_at"),
        F.lit(None).cast("string").alias("attachment_name"), F.concat(F.lit("BH"), "id").alias("so_number"),
        F.lit(None).cast("string").alias("customer_name_raw"), states.alias("processing_status"),
        F.lit(None).cast("string").alias("error_stage"), F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )


def scans(spark, ids):
    return spark.createDataFrame([(f"m{i}", f"f{i:09d}", "new", "N" if i % 5 == 0 else None) for i in ids],
                                 "message_id string, file_name string, from_address string, error string")


def content(root):
    return {p: p.read_bytes() for p in Path(root).rglob("*.parquet")}


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    log = log_rows(spark, 2000)
    store = LogStore(spark, str(tmp_path), LOG, buckets=64)
    assert store.create(log) == 1 and same(store.read(), log)
    before, (_, _, _, old) = content(tmp_path / "data"), store.state()
    batch = scans(spark, [*range(4, 2000, 180), 5, 10, 5000, 5001])
    assert store.upsert(batch) == 2
    assert same(store.read(), il.upsert(log, batch)) and same(store.read(version=1), log)
    _, _, top, new = store.state()
    touched = {b for b in new if new[b] != old.get(b)}
    assert 0 < len(touched) <= 16 and top == 2002
    assert {p: v for p, v in content(tmp_path / "data").items() if p in before} == before  # no stored file changes
    assert not any(f"bucket={b}/" in f"{p}" for p in set(content(tmp_path / "data")) - set(before) for b in set(new) - touched)
    assert store.upsert(batch) == 2  # nothing new
    assert store.upsert(batch, retry=True) == 3 and same(store.read(), il.upsert(il.upsert(log, batch), batch, retry=True))
    assert LogStore(spark, str(tmp_path), LOG, buckets=4).state()[1] == 64  # a stored log keeps its buckets
    assert store.upsert(batch.where("false")) == 3
    with pytest.raises(ValueError):
        store.create(log)


def test_a_dead_writer_leaves_the_version_before(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path), LOG, buckets=8)
    store.create(log_rows(spark, 100))
    half = log_rows(spark, 100).withColumn("from_address", F.lit("half"))
    half.withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(str(tmp_path / "data" / "2-dead"))
    assert same(store.read(), log_rows(spark, 100))
    assert store.upsert(scans(spark, [6, 12])) == 2


def test_advance_stamps_loaded_mails(spark, tmp_path):
    log = log_rows(spark, 60)
    store = LogStore(spark, str(tmp_path), LOG, buckets=8)
    store.create(log)
    results = log.select("message_id", "log_id", F.when(F.col("log_id") % 4 == 0, "bad").alias("error"))
    assert store.advance(results, "LOAD", "2001-08-01 00:00:00") == 2
    loaded = store.read().where("processed_at = timestamp'2001-08-01 00:00:00'")
    was = {r.log_id for r in log.where("processing_status = 'VALIDATED'").collect()}
    assert {r.log_id for r in loaded.collect()} == {i for i in was if i % 4} != set()
    assert all(r.processing_status == "LOADED" for r in loaded.collect())
    assert store.advance(results, "LOAD", "2001-08-02 00:00:00") == 2


MAIL = (
    "Message-ID: <{id}>\r\nFrom: x <x@e.com>\r\nSubject: Dat hang {so}\r\nDate: Mon, 02 Jul 2001 08:30:00 +0700\r\nMIME-Version: 1.0\r\n"
    'Content-Type: multipart/mixed; boundary="b1"\r\n\r\n--b1\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nhello\r\n'
    '--b1\r\nContent-Type: application/pdf; name="a.pdf"\r\nContent-Transfer-Encoding: base64\r\n'
    'Content-Disposition: attachment; filename="a.pdf"\r\n\r\neA==\r\n--b1--\r\n'
)
TEXT = "So don: {so}\nNgày: 2/7/2001\nĐại lý: Shop {n}   MST: {n:010d}\nĐịa chỉ: A\n"


def folder_of(spark, ids):
    mails = spark.createDataFrame([(f"/m/{i}.eml", MAIL.format(id=i, so=f"BH01.{i:04d}").encode()) for i in ids], "path string, content binary")
    table = [["STT", "Mã hàng", "Tên hàng", "ĐVT", "SL", "Đơn giá", "Thành tiền"], ["1", "000000000001", "xe dap", "Chiếc", "2", "1.000", "2.000"]]
    docs = [(f"BH01_{i:04d}.pdf", f"d{i}", TEXT.format(so=f"BH01.{i:04d}", n=i % 3 + 1), [table], None) for i in ids if i != 4]
    docs_schema = "file_name string, doc_id string, text string, tables array<array<array<string>>>, parse_error string"
    return mails, spark.createDataFrame(docs, docs_schema)


def new_run(spark, root):
    star = Star(
        spark.createDataFrame([], "line_id string"), spark.createDataFrame([("BH01.0002",)], "so_number string"),
        spark.createDataFrame([("KH-00001", "Shop 1", "0000000001", 1)], "customer_code string, customer_name string, tax_code string, province_id long"),
        spark.createDataFrame([(1, "P", "R")], "province_id long, province_name string, region string"),
        spark.createDataFrame([], "product_code string, product_name string, color string, line_id string, line_name string, group_code string, group_name string"),
    )
    return IntakeRun(spark, root, star, "0100000001", pattern=r"BH\d{2}\.\d{4}", buckets=4)


def states(run):
    return {r.so_number: (r.processing_status, r.error_stage) for r in run.log.read().collect()}


def test_run_resumes_and_repeats_without_change(spark, tmp_path, monkeypatch):
    run = new_run(spark, str(tmp_path / "run"))
    mails, docs = folder_of(spark, [1, 2, 3, 4])
    settle = IntakeRun._settle

    def dies(self, stage, now):  # after the ledger entry of LOAD, before the log
        if stage == "LOAD" and self.entries("LOAD"):
            raise OSError("lost")
        settle(self, stage, now)

    monkeypatch.setattr(IntakeRun, "_settle", dies)
    with pytest.raises(OSError):
        run.run(mails, docs, "2001-08-01 00:00:00")
    assert states(run)["BH01.0001"] == ("VALIDATED", None)
    monkeypatch.undo()
    run = new_run(spark, str(tmp_path / "run"))  # a new process
    assert run.run(mails, docs, "2001-08-01 00:00:00") == ["FACT"]
    want = {"BH01.0001": ("LOADED", None), "BH01.0002": ("FAILED", "VALIDATE"), "BH01.0003": ("LOADED", None), "BH01.0004": ("FAILED", "EXTRACT")}
    assert states(run) == want and len(run.entries("LOAD")) == 1
    assert sorted(r.so_number for r in run.facts().collect()) == ["BH01.0001", "BH01.0003"]
    assert [r.errors for r in run.rejects().collect()] == ["V7_DUPLICATE_SO:BH01.0002"]
    version = run.log.state()[0]
    assert run.run(mails, docs, "2001-08-02 00:00:00") == [] and run.log.state()[0] == version
    more, more_docs = folder_of(spark, [1, 3, 5, 6])
    assert run.run(more, more_docs, "2001-08-02 00:00:00") == ["SCAN", "EXTRACT", "VALIDATE", "LOAD", "FACT"]
    assert sorted((r.order_id, r.so_number) for r in run.facts().collect()) == [(1, "BH01.0001"), (2, "BH01.0003"), (3, "BH01.0005"), (4, "BH01.0006")]
    # the third shop's number came with order 3 and is not given twice
    assert len({r.customer_code for r in run.facts().collect()}) == 3
    assert {r.name: r.value for r in run.summary().collect()}["loaded_ok"] == 4


def test_a_document_named_by_many_mails_is_parsed_once(spark, tmp_path, monkeypatch):
    run = new_run(spark, str(tmp_path / "run"))
    _, docs = folder_of(spark, [1, 2])
    parsed = []
    monkeypatch.setattr(run_module, "extract_orders", lambda docs, *a: (parsed.append(docs.count()), extract_orders(docs, *a))[1])
    waiting = spark.range(1, 7).select(
        F.col("id").alias("log_id"), F.concat(F.lit("m"), "id").alias("message_id"), F.lit("BH01.0001").alias("so_number"),
        F.lit("a.pdf").alias("attachment_name"), F.lit(None).cast("string").alias("customer_name_raw"),
    )
    out = run._extract(waiting, docs)
    assert [r.header.so_number for r in out["records"].collect()] == ["BH01.0001"] * 6
    assert out["results"].where("error IS NULL").count() == 6 and parsed == [1]


def test_a_stage_deals_out_the_log_once(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path), LOG, buckets=8)
    store.create(log_rows(spark, 100))
    plans, commit = [], LogStore._commit
    monkeypatch.setattr(LogStore, "_commit", lambda self, rows, *a: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), commit(self, rows, *a))[1])
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        results = log_rows(spark, 100).select("message_id", "log_id", F.lit(None).cast("string").alias("error"))
        assert store.advance(results, "LOAD") == 2
    assert plans[0].count("Exchange hashpartitioning") == 2  # the log and the results, both by bucket
