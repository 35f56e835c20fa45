"""Counting orders and dealers next to sums without multiplying the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_and_dealers(f: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: ``revenue, qty, total_lines, orders, dealers``.

    Two distinct counts in one aggregation would copy every line three times. Lines are instead summed per
    order, orders per dealer, dealers per key; each step shuffles less than the one before, and a key holding
    most of the rows is spread over its orders and dealers. An order belongs to one dealer.
    """
    orders = f.groupBy(*keys, "customer_code", "so_number").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("qty"), F.count("*").alias("total_lines")
    )
    dealers = orders.groupBy(*keys, "customer_code").agg(
        F.count("so_number").alias("orders"), *[F.sum(c).alias(c) for c in ("revenue", "qty", "total_lines")]
    )
    return dealers.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("revenue", "orders", "qty", "total_lines")],
        F.count("customer_code").alias("dealers"),
    )
