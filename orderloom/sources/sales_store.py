"""Orders, order lines and the flat fact table, stored by fiscal month.

Folders are ``fiscal_year=/fiscal_quarter=/fiscal_month=``, so a condition on a month or a quarter reads those
folders only. A line lies under the month of its order; lines and orders without a date have a folder of
their own. Every write is one Spark job that commits as a whole.
"""

from __future__ import annotations

from contextlib import AbstractContextManager, nullcontext
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.fact import FACT_COLUMNS, Star, flatten, with_calendar
from ..session import settings

TABLES = ("sales_order", "order_line", "fact")
# files a task keeps open at once; only a task with more months sorts its rows first
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "16"}
# shuffled bytes that adaptive execution merges into one task at most: a row takes ten times that while a task sorts it
MERGED = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"}
# rows that are not dealt out by month leave a file per task and month: few rows come in few tasks
FEW_FILES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "8m"}
PERIOD = ["fiscal_year", "fiscal_quarter", "fiscal_month"]


def write_by_month(df: DataFrame, path: str, mode: str = "append", deal: bool = True) -> None:
    """Write into one folder per month. ``overwrite`` replaces the months that occur in ``df`` and no others.

    Rows are dealt out by month; a month larger than a task's fair share is split by adaptive execution and
    small ones share a task, so neither a hot month nor a long history needs a number of writers. The few months
    of a task are written side by side, without sorting (and spilling) its rows. With ``deal=False`` every task
    sorts its share by month and writes the months it holds, for whole tables that come out of a join: one
    exchange of all rows less, and as many files per month as that join has tasks.
    """
    with settings(df.sparkSession, OPEN_FILES if deal else {}):
        (
            (df.hint("rebalance", *PERIOD) if deal else df)
            .write.mode(mode)
            .option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PERIOD)
            .parquet(path)
        )


def months_of(df: DataFrame) -> list[tuple]:
    """The months that occur: one record per month of history, whatever the rows."""
    return [tuple(r) for r in df.select(*PERIOD).distinct().collect()]


def in_months(months: list[tuple]) -> Column:
    """A condition on the folders only; NULL is the folder of undated rows."""
    same = [reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(PERIOD, m, strict=True))) for m in months]
    return reduce(or_, same, F.lit(False))


class SalesStore:
    """The three tables under ``root``; ``star`` gives their columns, and the rows of ``create``.

    ``partitions``: shuffle partitions of the jobs that write, the session's number unless given. Adaptive
    execution merges small ones, up to ``MERGED`` where it is given, so a number that follows the size of the tables only
    keeps sorts in memory.
    ``raw``: the star's lines before their columns are computed, and the SQL of those columns (see ``flatten``).
    """

    def __init__(
        self, root: str, star: Star, partitions: int | None = None, raw: tuple[DataFrame, dict[str, str]] | None = None
    ):
        self.root, self.star, self.partitions, self.raw = root.rstrip("/"), star, partitions, raw
        self._dated = with_calendar(star.sales_order).drop("week_of_year")
        self._made: set[str] = set()

    def _sized(self) -> AbstractContextManager:
        if not self.partitions:
            return nullcontext()
        return settings(self.star.order_line.sparkSession, {"spark.sql.shuffle.partitions": str(self.partitions), **MERGED})

    def create(self, *names: str) -> SalesStore:
        """Store all orders, lines and facts of the star (or only the tables named), in place of what is there."""
        with self._sized():
            for name in names or TABLES:
                write_by_month(self.rows(name), f"{self.root}/{name}", "overwrite", deal=name == "sales_order")
                self._made.add(name)
        return self

    def rows(self, name: str) -> DataFrame:
        """The rows ``create`` stores; the months of lines and facts come from the orders, one pass for each table."""
        if name == "sales_order":
            return self._dated
        if self.raw is None:
            return flatten(self.star) if name == "fact" else self._line_rows(self.star)
        star, late = Star(**{**self.star.__dict__, "order_line": self.raw[0]}), self.raw[1]
        if name == "fact":
            return flatten(star, late=late)
        like = self._line_rows(self.star).columns
        return self._line_rows(star).select(*[F.expr(late[c]).alias(c) if c in late else c for c in like])

    def ensure(self, *names: str) -> SalesStore:
        """Store those of the tables that this object has not stored yet, so nothing is written before it is read."""
        missing = [n for n in names or TABLES if n not in self._made]
        return self.create(*missing) if missing else self

    @staticmethod
    def _line_rows(star: Star) -> DataFrame:
        joined = star.order_line.join(star.sales_order.select("order_id", "order_date"), "order_id", "left")
        return with_calendar(joined).drop("order_date", "week_of_year")

    def _read(self, name: str, like: DataFrame) -> DataFrame:
        return like.sparkSession.read.schema(like.schema).parquet(f"{self.root}/{name}").select(*like.columns)

    @property
    def orders(self) -> DataFrame:
        return self._read("sales_order", self._dated)

    @property
    def lines(self) -> DataFrame:
        return self._read("order_line", self._line_rows(self.star))

    def fact(self, *columns: str) -> DataFrame:
        return self._read("fact", flatten(self.star)).select(*(columns or FACT_COLUMNS))

    def refresh(self, star: Star, across_months: bool = False, raw: tuple[DataFrame, dict[str, str]] | None = None) -> int:
        """Append the facts of the star's lines that are not stored yet; their number.

        Stored lines go before the joins. Stored keys are read from the months of the lines' orders only. A line
        whose order has moved to another month is told by ``across_months=True``, which reads the key column of every
        month. A NULL key blocks nothing. Files appear when all facts are compared and written, so a run that is
        repeated appends what the one before did not, and a second run nothing. ``raw``: as for the store.
        """
        lines, late = raw or (star.order_line, {})
        with self._sized(), settings(lines.sparkSession, FEW_FILES):
            stored = self.fact("line_id", *PERIOD)
            if not across_months:
                orders = star.sales_order.join(lines.select("order_id"), "order_id", "left_semi")
                stored = stored.where(in_months(months_of(with_calendar(orders))))
            fresh = lines.join(stored.select(F.col("line_id").alias("_known")), F.expr(late.get("line_id", "line_id")) == F.col("_known"), "left_anti")
            before = self.fact().count()
            write_by_month(flatten(Star(**{**star.__dict__, "order_line": fresh}), late=late), f"{self.root}/fact", deal=False)
            return self.fact().count() - before

    def repair_product(self, product: DataFrame, column: str, only_missing: bool = False) -> list[tuple]:
        """Carry a repaired product attribute into the stored facts; the months that were rewritten.

        Only months that hold a fact whose value changes are read in full and replaced; the files of all other
        months stay as they are.
        """
        fixed = product.select("product_code", F.col(column).alias("_fixed")).where("_fixed IS NOT NULL")
        differs = F.col(column).isNull() | (F.col(column) != F.col("_fixed"))
        if only_missing:
            differs = F.col(column).isNull() | (F.col(column) == "")
        with self._sized(), settings(product.sparkSession, FEW_FILES):
            hit = self.fact(*PERIOD, "product_code", column).join(fixed, "product_code").where(differs)
            months = months_of(hit)
            if months:
                rows = self.fact().where(in_months(months)).join(fixed, "product_code", "left")
                new = F.when(F.col("_fixed").isNotNull() & differs, F.col("_fixed")).otherwise(F.col(column))
                # new files are staged; the months are replaced when every task has read and written its rows
                write_by_month(rows.withColumn(column, new).select(*FACT_COLUMNS), f"{self.root}/fact", "overwrite", deal=False)
        return months
