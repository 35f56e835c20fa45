"""Collects named plans and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .star import Warehouse

Plan = Callable[[Warehouse], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Cast to the four types both engines share: string, bigint, double, boolean."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), "|", "")
        out.append(col.alias(field.name))
    return df.select(*out)


class Registry:
    def __init__(self) -> None:
        self.plans: dict[str, Plan] = {}
        self.sql: dict[str, str] = {}

    def plan(self, name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
        def keep(fn: Plan) -> Plan:
            if name in self.plans:
                raise ValueError(f"duplicate plan {name}")
            self.plans[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return keep

    def callables(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(fn: Plan) -> Callable[[SparkSession, str], DataFrame]:
            return lambda spark, folder: comparable(fn(Warehouse(spark, folder)))

        return {name: bind(fn) for name, fn in self.plans.items()}
