from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.functions.ranking import order_globally, tile


def check(df, value, amount=None):
    plain = (
        df.withColumn("v", value)
        .withColumn("p", F.row_number().over(Window.orderBy("v", "k")))
        .withColumn("r", F.rank().over(Window.orderBy("v")))
        .withColumn("t", F.count("*").over(Window.partitionBy("v")))
        .withColumn("n", F.count("*").over(Window.partitionBy()))
        .withColumn("run", F.sum("x").over(Window.orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0)))
    )
    got = order_globally(df, value, "k", amount="x")
    a = plain.select("k", "p", "r", "t", "n", "run").collect()
    b = got.select("k", "position", "rank", "ties", "rows", "running").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_unique_values(spark):
    check(spark.range(1000).selectExpr("id AS k", "id * 7919 % 1000 AS x"), F.col("x"))


def test_one_value_holds_most_rows(spark):
    df = spark.range(2000).selectExpr("id AS k", "CASE WHEN id % 3 < 2 THEN 5 ELSE id % 11 END AS x")
    check(df, F.col("x"))


def test_all_equal_and_fewer_rows_than_ranges(spark):
    check(spark.range(300).selectExpr("id AS k", "1 AS x"), F.col("x"))
    check(spark.range(3).selectExpr("id AS k", "id AS x"), -F.col("x"))


def test_tile_equals_ntile(spark):
    for n in (1, 4, 5, 7, 23, 100):
        df = spark.range(n).selectExpr("id AS k")
        got = order_globally(df, F.col("k"), "k").withColumn("t", tile(F.col("position"), F.col("rows"), 5))
        want = df.withColumn("t", F.ntile(5).over(Window.orderBy("k")))
        assert sorted((r.k, r.t) for r in got.collect()) == sorted((r.k, r.t) for r in want.collect())


def test_rows_do_not_carry_the_records_of_all_ranges(spark):
    df = spark.range(500).selectExpr("id AS k", "id % 7 AS x")
    got = order_globally(df, F.col("x"), "k", amount="x", ranges=23)
    plain = order_globally(df, F.col("x"), "k", amount="x")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    windows = [x for x in plain._jdf.queryExecution().optimizedPlan().toString().split("Window ")[1:]]
    assert windows and all("scalar-subquery" not in x for x in windows)
