from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from orderloom.functions.columns import of_month
from orderloom.operators import fact as fa
from orderloom.operators.fact import Star
from orderloom.plans import star as base
from orderloom.plans.star import Warehouse
from orderloom.session import settings
from orderloom.sources import sales_store
from orderloom.sources.sales_store import OPEN_FILES, PERIOD, SalesStore, write_by_month


def test_rows_do_not_depend_on_the_columns(spark):
    w = Warehouse(spark, SMALL)
    lost = {  # lines without order, without dealer, without product
        "sales_order": w.sales_order.where("order_id % 7 <> 0"),
        "customer": w.customer.where("customer_code NOT LIKE '%3'"),
        "product": w.product.where("product_code NOT LIKE '%5'"),
    }
    star = Star(**{**w.star.__dict__, **lost})
    want = fa.flatten(star).selectExpr("count(*)", "sum(line_total)").first()
    assert 0 < want[0] < w.order_line.count()
    for more in ([], ["quantity"], ["order_date"], ["customer_code"], ["region"], ["color"], ["group_name"], ["order_date", "color"]):
        got = fa.flatten(star, ["line_total", *more]).selectExpr("count(*)", "sum(line_total)").first()
        assert tuple(got) == tuple(want), more


def files_of(root):
    return {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in Path(root).rglob("*.parquet")}


def month_of_file(path):
    return tuple(int(part.split("=")[1]) for part in path.parts if part.startswith("fiscal_") and "HIVE" not in part)


def rows_of(df):
    return sorted(map(str, df.select(*fa.FACT_COLUMNS).collect()))


@pytest.fixture(scope="module")
def star(spark):
    return Warehouse(spark, SMALL).star


def test_stored_fact_equals_the_joins(spark, star, tmp_path):
    undated = star.sales_order.withColumn("order_date", F.when(F.col("order_id") % 50 != 1, F.col("order_date")))
    star = Star(**{**star.__dict__, "sales_order": undated})
    store = SalesStore(str(tmp_path / "s"), star).create()
    assert rows_of(store.fact()) == rows_of(fa.flatten(star))
    assert store.lines.count() == star.order_line.count() and store.orders.count() == star.sales_order.count()
    assert store.fact().where("order_date IS NULL AND fiscal_month IS NULL").count() > 0
    store.create()  # in place of what is there
    assert store.fact().count() == fa.flatten(star).count()
    empty = Star(**{**star.__dict__, "order_line": star.order_line.where("false")})
    assert SalesStore(str(tmp_path / "e"), empty).create().fact().collect() == []


def test_refresh_appends_what_is_missing_and_reads_its_months_only(spark, star, tmp_path):
    part = Star(**{**star.__dict__, "order_line": star.order_line.where("order_id % 3 <> 0")})
    store = SalesStore(str(tmp_path / "s"), part).create()
    before = files_of(tmp_path)
    july = star.sales_order.where("order_date >= '2001-07-01' AND order_date < '2001-08-01'")
    batch = Star(**{**star.__dict__, "sales_order": july})
    added = store.refresh(batch)
    assert added == fa.flatten(batch).where("order_id % 3 = 0").count() > 0
    new = set(files_of(tmp_path)) - set(before)
    assert new and {month_of_file(p) for p in new} == {(2001, 3, 7)}
    assert {p: v for p, v in files_of(tmp_path).items() if p in before} == before
    assert store.refresh(batch) == 0 and store.refresh(star) > 0 and store.refresh(star, across_months=True) == 0
    assert rows_of(store.fact()) == rows_of(fa.flatten(star))


def test_orders_that_change_month_are_found_across_months(spark, star, tmp_path):
    store = SalesStore(str(tmp_path / "s"), star).create()
    moved = Star(**{**star.__dict__, "sales_order": star.sales_order.where("order_id < 40").withColumn("order_date", F.lit("1990-01-01").cast("date"))})
    assert store.refresh(moved, across_months=True) == 0


def test_repair_rewrites_touched_months_only(spark, star, tmp_path):
    store = SalesStore(str(tmp_path / "s"), star).create()
    sold = store.fact("product_code", *PERIOD).distinct().collect()
    code = min({r.product_code for r in sold}, key=lambda c: sum(r.product_code == c for r in sold))
    months = {tuple(r)[1:] for r in sold if r.product_code == code}
    before, all_months = files_of(tmp_path / "s" / "fact"), {tuple(r)[1:] for r in sold}
    assert len(months) < len(all_months)
    fixed = star.product.withColumn("product_name", F.when(F.col("product_code") == code, F.lit("repaired")).otherwise(F.col("product_name")))
    assert set(store.repair_product(fixed, "product_name")) == months
    after = files_of(tmp_path / "s" / "fact")
    for path, state in before.items():
        assert (month_of_file(path) in months) == (after.get(path) != state)
    assert rows_of(store.fact()) == rows_of(fa.flatten(Star(**{**star.__dict__, "product": fixed})))
    assert store.repair_product(fixed, "product_name") == []


@pytest.mark.parametrize("name", [
    "ovw_02_kpi", "ovw_04_quarter_totals", "ovw_06_group_revenue", "geo_02_province_growth", "geo_08_coverage", "ops_03_daily", "dq_19_fact_in_step",
    "dq_22_plausibility", "dq_24_period_totals", "dq_25_top_period_dealers", "dq_27_mismatched_orders", "fc_08_sku_projection", "col_02_color_trend",
])
def test_period_queries_read_their_months_only(spark, name):
    plans = queries()
    plan = plans[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("PartitionFilters: [")[1:] if x.split("]")[0].strip()]
    assert any("fiscal_year" in x.split("]")[0] for x in filters), plan


def test_a_changed_table_gets_a_new_store(spark, tmp_path):
    for t in ("lineitem", "orders", "customer", "nation", "region", "part"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    first = Warehouse(spark, str(tmp_path))
    n = first.fact("line_total").count()
    assert Warehouse(spark, str(tmp_path)).store is first.store
    spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(10).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert Warehouse(spark, str(tmp_path)).fact("line_total").count() == n + 10


def test_months_without_calendar_columns_are_ranges_of_dates(spark):
    days = spark.createDataFrame([("2000-12-01",), ("2000-12-31",), ("2001-01-01",), (None,)], "d string").selectExpr("CAST(d AS DATE) AS order_date")
    assert of_month(days, 2000, 12).count() == 2 and of_month(days, 2001, 1).count() == 1


def test_facts_alone_store_no_orders_and_lines(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation", "region", "part"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(50).write.parquet(str(tmp_path / f"{name}.parquet"))
    w = Warehouse(spark, str(tmp_path))
    w.fact("line_total")
    kept = lambda: sorted(p.name for p in Path(w._stored.root).iterdir())
    assert kept() == ["fact"]
    assert w.store.lines.count() == 50 and kept() == ["fact", "order_line", "sales_order"]


def test_partitions_follow_the_base_files(spark, monkeypatch):
    monkeypatch.setattr(base, "BYTES_PER_PARTITION", 1000)
    w = Warehouse(spark, SMALL)
    assert w.partitions == w.state()[-1] // 1000 > int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("files", ["2", "16", "100"])
def test_many_months_in_one_task_are_all_written(spark, tmp_path, monkeypatch, files):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    monkeypatch.setitem(OPEN_FILES, key, files)
    before = spark.conf.get(key)
    days = spark.range(400).selectExpr("id", "CASE WHEN id % 9 > 0 THEN add_months(DATE '2000-01-15', CAST(id % 40 AS INT)) END AS order_date")
    rows = fa.with_calendar(days).drop("week_of_year").coalesce(1)
    write_by_month(rows, str(tmp_path))
    back = spark.read.schema(rows.schema).parquet(str(tmp_path)).select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and back.count() == 400 and spark.conf.get(key) == before


def test_line_columns_are_computed_after_the_joins(spark, tmp_path):
    w = Warehouse(spark, SMALL)
    lines = w.table("lineitem").withColumn("l_quantity", F.when(F.col("l_orderkey") % 9 != 1, F.col("l_quantity")))
    star = Star(**{**w.star.__dict__, "order_line": lines.selectExpr(*base.select_list(base.ORDER_LINE))})
    store = SalesStore(str(tmp_path / "s"), star, raw=(lines.selectExpr(*base.RAW_LINE), base.LATE_LINE))
    for name in ("fact", "order_line"):
        above, below = store.rows(name)._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)
        assert "concat_ws" in above and "concat_ws" not in below and "year(" not in below
    store.create()
    assert rows_of(store.fact()) == rows_of(fa.flatten(star))
    assert sorted(map(str, store.lines.collect())) == sorted(map(str, SalesStore._line_rows(star).select(*store.lines.columns).collect()))


def test_lines_of_an_order_are_joined_last_in_tasks_of_bounded_size(spark, tmp_path):
    w = Warehouse(spark, SMALL)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = fa.flatten(w.star)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "[order_id" in joins[0] and "[product_code" in joins[1]
    with SalesStore(str(tmp_path / "s"), w.star, partitions=9)._sized():
        assert spark.conf.get(name) == "32m" and spark.conf.get("spark.sql.shuffle.partitions") == "9"
    assert spark.conf.get(name) == before


def test_texts_are_parsed_once_in_tasks_that_follow_the_files(spark, monkeypatch):
    from orderloom.operators import extraction as ex
    from orderloom.plans.documents import slips

    docs = spark.createDataFrame([(1, "1 0000000001 xe dap Chiếc 2 3.000 6.000\n2 0000000002 xe Bộ 1 5 5"), (2, "x"), (3, None)], "doc_id int, text string")
    lines = ex.explode_lines(docs.select("doc_id", ex.text_to_lines(F.col("text")).alias("lines")), "doc_id")
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
    rows = sorted((r.doc_id, r.line_no, r.product_code, r.line_total) for r in lines.collect())
    assert rows == [(1, 1, "0000000001", 6000), (1, 2, "0000000002", 5)]
    monkeypatch.setattr(base, "BYTES_PER_PARTITION", 4096)
    w = Warehouse(spark, SMALL)
    assert w.partitions > 8 and f", {w.partitions}), REPARTITION" in slips(w)._jdf.queryExecution().executedPlan().toString()


def test_a_refresh_joins_fresh_lines_only_and_keeps_no_copy(spark, star, tmp_path, monkeypatch):
    part = Star(**{**star.__dict__, "order_line": star.order_line.where("order_id % 3 <> 0")})
    store, plans, write = SalesStore(str(tmp_path / "s"), part).create(), [], sales_store.write_by_month
    monkeypatch.setattr(sales_store, "write_by_month", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a, **k))[1])
    raw = star.order_line.drop("line_id").withColumnRenamed("so_number", "number"), {"line_id": "concat(number, '')", "so_number": "number"}
    lines = star.order_line.withColumn("line_id", F.col("so_number").cast("string"))
    like = Star(**{**star.__dict__, "order_line": lines})
    added = store.refresh(like, raw=raw)
    assert added == fa.flatten(like).count() > 0 and store.refresh(like) == 0 and store.refresh(like, raw=raw) == 0
    depth = lambda word: [len(x) - len(x.lstrip(" :+-")) for x in plans[0].splitlines() if word in x]
    assert min(depth("LeftAnti")) > min(depth("Join Inner")) and "RebalancePartitions" not in plans[0]
    assert not any("/kept/" in f for f in store.fact().inputFiles())
