"""Exact global positions, ranks and running sums without a single-task window.

An unpartitioned window sorts every row in one task. Here rows are first written once in ordered ranges:
Spark's own range exchange chooses the borders, their number follows the session's shuffle partitions.
The borders only decide how even the ranges are, never the result. One small record per range (count,
sums, first and last value) then turns in-range windows into global ones. The order key ends in a unique
column, so borders may fall inside a run of equal values and one hot value is spread over several ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def _total(array: str, field: str, kind) -> Column:
    return F.aggregate(array, F.lit(0).cast(kind), lambda acc, x: (acc + x[field]).cast(kind))


def order_globally(
    df: DataFrame,
    value: Column,
    unique: str,
    *,
    prefix: str = "",
    amount: str | list[str] | None = None,
    totals: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add, for ascending ``(value, unique)``:

    ``{prefix}position``  1-based row number
    ``{prefix}rank``      SQL RANK over ``value``
    ``{prefix}ties``      rows sharing ``value``
    ``{prefix}rows``      number of rows
    ``{prefix}running``   running sum of ``amount`` (only when given); for a list of columns, one
                          ``{prefix}running_{column}`` each
    ``{prefix}total``     with ``totals``: the whole sum of every amount, named like its running sum

    ``value`` must not be NULL and ``unique`` must identify a row. The input is evaluated and stored once, in
    ``ranges`` ranges, the session's number of shuffle partitions unless given.
    Unused outputs cost nothing: the optimizer drops their windows.
    """
    p = f"_{prefix}"
    v, b, summary, before = f"{p}v", f"{p}b", f"{p}summary", f"{p}before"
    amounts = {f"{prefix}running": amount} if isinstance(amount, str) else {
        f"{prefix}running_{a}": a for a in amount or []
    }
    dealt = [ranges] if ranges else []
    keyed = cut(df.withColumn(v, value).repartitionByRange(*dealt, v, unique).withColumn(b, F.spark_partition_id()))

    per_value = keyed.groupBy(b, v).agg(
        F.count("*").alias("n"), *(F.sum(a).alias(f"s{i}") for i, a in enumerate(amounts.values()))
    )
    sums = [f"s{i}" for i in range(len(amounts))]
    per_bucket = per_value.groupBy(b).agg(
        F.sum("n").alias("n"),
        *(F.sum(s).alias(s) for s in sums),
        F.min(F.struct(v, "n")).alias("lo"),
        F.max(F.struct(v, "n")).alias("hi"),
    )
    records = per_bucket.select(
        F.struct(
            F.col(b).alias("b"),
            "n",
            *sums,
            F.col(f"lo.{v}").alias("lo"),
            F.col("lo.n").alias("lo_n"),
            F.col(f"hi.{v}").alias("hi"),
            F.col("hi.n").alias("hi_n"),
        ).alias("r")
    ).agg(F.array_sort(F.collect_list("r"), lambda x, y: x["b"] - y["b"]).alias("records"))

    in_bucket = Window.partitionBy(b).orderBy(v, unique)
    by_value = Window.partitionBy(b).orderBy(v)
    same_value = Window.partitionBy(b, v)
    zero = F.lit(0).cast("bigint")
    offset = F.aggregate(before, zero, lambda acc, x: acc + x["n"])

    # windows first: a row that carries the records through their exchange takes as many times its size as there are ranges
    inside = {f"{p}in{i}": F.sum(a).over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) for i, a in enumerate(amounts.values())}
    out = (keyed.repartition(ranges, b) if ranges else keyed).withColumns({
        f"{p}local": F.rank().over(by_value), f"{p}row": F.row_number().over(in_bucket), f"{p}same": F.count("*").over(same_value), **inside
    })
    out = out.withColumn(summary, records.scalar())
    out = out.withColumn(before, F.filter(summary, lambda x: x["b"] < F.col(b)))
    first_run = F.aggregate(
        before, zero, lambda acc, x: acc + x["n"] - F.when(x["hi"] == F.col(v), x["hi_n"]).otherwise(0)
    )
    elsewhere = F.aggregate(
        F.filter(summary, lambda x: x["b"] != F.col(b)),
        zero,
        lambda acc, x: acc
        + F.when(x["hi"] == F.col(v), x["hi_n"]).when(x["lo"] == F.col(v), x["lo_n"]).otherwise(0),
    )
    out = (
        out.withColumn(f"{prefix}position", offset + F.col(f"{p}row"))
        .withColumn(
            f"{prefix}rank",
            F.when(F.col(f"{p}local") == 1, first_run + 1).otherwise(offset + F.col(f"{p}local")),
        )
        .withColumn(f"{prefix}ties", F.col(f"{p}same") + elsewhere)
        .withColumn(f"{prefix}rows", F.aggregate(summary, zero, lambda acc, x: acc + x["n"]))
    )
    drop = [v, b, summary, before, f"{p}local", f"{p}row", f"{p}same", *inside]
    for s, name, part in zip(sums, amounts, inside, strict=True):
        kind = records.schema["records"].dataType.elementType[s].dataType
        carried = _total(before, s, kind)
        out = out.withColumn(name, (carried + F.col(part)).cast(kind))
        if totals:
            whole = prefix + name.removeprefix(prefix).replace("running", "total", 1)
            out = out.withColumn(whole, _total(summary, s, kind))
    return out.drop(*drop)


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a global position: the first ``rows % tiles`` tiles hold one row more."""
    base = F.floor(rows / tiles).cast("bigint")
    extra = rows % tiles
    wide = extra * (base + 1)
    return F.when(
        position <= wide, F.floor((position - 1) / (base + 1)).cast("bigint") + 1
    ).otherwise(
        extra + F.floor((position - 1 - wide) / F.greatest(base, F.lit(1))).cast("bigint") + 1
    ).cast("int")
