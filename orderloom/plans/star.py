"""The test tables seen as an order warehouse.

Column expressions are plain SQL that Spark and the checking engine both read, so the two sides start
from identical inputs. Planted faults (see ``faulty``) are written the same way.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fact import Star
from ..session import shared_folder
from ..sources.sales_store import SalesStore

AS_OF = "2001-08-01"
YEAR, MONTH, QUARTER = 2001, 7, 1
PREV_YEAR, PREV_MONTH = 2001, 6

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
QTY_INT = "CAST(l_quantity AS BIGINT)"
MICRO = f"CAST(floor(({CENTS} * 20000 + {QTY_INT}) / CAST(2 * {QTY_INT} AS DOUBLE)) AS BIGINT)"
LINE_KEY = (
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
    " CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING),"
    f" CAST({QTY_INT} AS STRING), CAST({CENTS} AS STRING))"
)

# role column -> expression, per table
ORDER_LINE = {
    "line_id": LINE_KEY,
    "order_id": "l_orderkey",
    "so_number": "l_orderkey",
    "product_code": "l_partkey",
    "quantity": "CAST(l_quantity AS DECIMAL(18,3))",
    "unit_price": f"CAST({MICRO} * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6))",
    "line_total": "CAST(l_extendedprice AS DECIMAL(18,2))",
}
# the same lines for joins: the keys and what the other columns are computed from
RAW_LINE = ["l_orderkey AS order_id", "l_partkey AS product_code", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
LATE_LINE = {c: e.replace("l_orderkey", "order_id").replace("l_partkey", "product_code") for c, e in ORDER_LINE.items()}
SALES_ORDER = {
    "order_id": "o_orderkey",
    "so_number": "o_orderkey",
    "order_date": "CAST(o_orderdate AS DATE)",
    "customer_code": "o_custkey",
    "total_amount": "CAST(o_totalprice AS DECIMAL(18,2))",
}
CUSTOMER = {
    "customer_code": "c_custkey",
    "customer_name": "c_name",
    "province_id": "c_nationkey",
    "customer_tier": "c_mktsegment",
}
PROVINCE = {"province_id": "n_nationkey", "province_name": "n_name", "region": "r_name"}
PRODUCT = {
    "product_code": "p_partkey",
    "product_name": "p_name",
    "color": "split_part(p_name, ' ', 1)",
    "line_id": "concat(p_brand, '|', p_type)",
    "line_name": "p_brand",
    "group_code": "p_type",
    "group_name": "p_type",
}
EMAIL_LOG = {
    "log_id": "event_id",
    "message_id": "concat('<', CAST(event_id AS STRING), '@mail>')",
    "from_address": "concat('user', CAST(user_id AS STRING))",
    "so_number": "event_id",
    "received_at": "ts",
    "processing_status": (
        "CASE event_type WHEN 'purchase' THEN 'LOADED' WHEN 'signup' THEN 'VALIDATED'"
        " WHEN 'click' THEN 'EXTRACTED' WHEN 'view' THEN 'PENDING' ELSE 'FAILED' END"
    ),
    "seconds": "value",
    "payload": "props",
}

# Planted faults: (table, column) -> expression over the same source table. Selectors are disjoint
# by design so the expected counts are known.
FAULTS = {
    "quantity": "CASE WHEN l_partkey % 200 = 4 THEN CAST(0 AS DECIMAL(18,3)) ELSE "
    + ORDER_LINE["quantity"]
    + " END",
    "unit_price": "CASE WHEN l_partkey % 200 = 5 THEN CAST(-1 AS DECIMAL(20,6)) "
    "WHEN l_partkey % 200 = 7 THEN CAST(0 AS DECIMAL(20,6)) ELSE " + ORDER_LINE["unit_price"] + " END",
    "line_total": "CASE WHEN l_partkey % 250 = 6 THEN CAST(" + ORDER_LINE["line_total"]
    + " + 3 AS DECIMAL(18,2)) ELSE " + ORDER_LINE["line_total"] + " END",
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def sql_select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(select_list(columns))} FROM {source}"


BYTES_PER_PARTITION = 4 << 20  # of the compressed base files; a row takes many times its stored size while it is sorted
_stores: dict[tuple, SalesStore] = {}


class Warehouse:
    """Lazy role-named views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, columns: dict[str, str], source: str) -> DataFrame:
        return self.table(source).selectExpr(*select_list(columns))

    @cached_property
    def order_line(self) -> DataFrame:
        return self.view(ORDER_LINE, "lineitem")

    @cached_property
    def sales_order(self) -> DataFrame:
        return self.view(SALES_ORDER, "orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self.view(CUSTOMER, "customer")

    @cached_property
    def province(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        return joined.selectExpr(*select_list(PROVINCE))

    @cached_property
    def product(self) -> DataFrame:
        return self.view(PRODUCT, "part")

    @cached_property
    def star(self) -> Star:
        return Star(self.order_line, self.sales_order, self.customer, self.province, self.product)

    @cached_property
    def snowflake(self) -> Star:
        """The star with product line and product group kept as their own tables."""
        lines = self.product.select("line_id", "line_name", "group_code").distinct()
        groups = self.product.select("group_code", "group_name").distinct()
        slim = self.product.drop("line_name", "group_code", "group_name")
        return Star(self.order_line, self.sales_order, self.customer, self.province, slim, lines, groups)

    def state(self) -> tuple:
        """This application's view of the base tables: a digest over name, size and time of every base file."""
        paths = [f"{self.folder}/{t}.parquet" for t in ("lineitem", "orders", "customer", "nation", "region", "part")]
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        found = files.agg(F.count("*").alias("n"), F.sum(one).alias("digest"), F.sum("length").alias("size")).first()
        return self.spark.sparkContext.applicationId, self.folder, found.n, found.digest, found.size

    @cached_property
    def _state(self) -> tuple:
        return self.state()

    @property
    def partitions(self) -> int:
        """Shuffle partitions for jobs over the base tables: the session's, more where the files are large."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self._state[-1] // BYTES_PER_PARTITION)

    @cached_property
    def raw(self) -> tuple[DataFrame, dict[str, str]]:
        """The lines before their columns are computed, and the SQL of those columns."""
        return self.table("lineitem").selectExpr(*RAW_LINE), LATE_LINE

    @property
    def _stored(self) -> SalesStore:
        if self._state not in _stores:
            path = f"{shared_folder(self.spark)}/sales/{uuid.uuid4().hex}"
            _stores[self._state] = SalesStore(path, self.star, self.partitions, self.raw)
        return _stores[self._state]

    @property
    def store(self) -> SalesStore:
        """Orders, lines and facts stored by month, once per state of the base tables; changed files get a new store."""
        return self._stored.ensure()

    def fact(self, *columns: str) -> DataFrame:
        """The stored fact table; the orders and lines are stored for those who read them."""
        return self._stored.ensure("fact").fact(*columns)

    @cached_property
    def email_log(self) -> DataFrame:
        log = self.view(EMAIL_LOG, "events")
        done = "CASE WHEN processing_status = 'LOADED' THEN received_at + make_dt_interval(0,0,0,seconds) END"
        return log.selectExpr("*", f"{done} AS processed_at").drop("seconds")

    @cached_property
    def faulty_lines(self) -> DataFrame:
        return self.view({**ORDER_LINE, **FAULTS}, "lineitem")


def run_folder(w: Warehouse) -> str:
    """A new folder on the shared storage for what one plan writes."""
    return f"{shared_folder(w.spark)}/orderloom-{uuid.uuid4().hex}"


FACT_SQL = f"""
line AS ({sql_select(ORDER_LINE, "lineitem")}),
so AS ({sql_select(SALES_ORDER, "orders")}),
cust AS ({sql_select(CUSTOMER, "customer")}),
prov AS ({sql_select(PROVINCE, "nation LEFT JOIN region ON n_regionkey = r_regionkey")}),
prod AS ({sql_select(PRODUCT, "part")}),
fact AS (
  SELECT so.order_date, year(so.order_date) AS fiscal_year, quarter(so.order_date) AS fiscal_quarter,
    month(so.order_date) AS fiscal_month, weekofyear(so.order_date) AS week_of_year,
    line.so_number, line.order_id, line.line_id,
    cust.customer_code, cust.customer_name, cust.province_id, prov.province_name, prov.region,
    prod.product_code, prod.product_name, prod.color, prod.line_id AS line_id_fk, prod.line_name,
    prod.group_code, prod.group_name, line.quantity, line.unit_price, line.line_total
  FROM line JOIN so ON so.order_id = line.order_id
  JOIN cust ON cust.customer_code = so.customer_code
  LEFT JOIN prov ON prov.province_id = cust.province_id
  JOIN prod ON prod.product_code = line.product_code
)"""
WITH_FACT = f"WITH {FACT_SQL}"
LOG_SQL = (
    f"mail0 AS ({sql_select(EMAIL_LOG, 'events')}), mail AS (SELECT *, CASE WHEN processing_status = 'LOADED' "
    "THEN received_at + to_microseconds(CAST(round(seconds * 1000000) AS BIGINT)) END AS processed_at FROM mail0)"
)
WITH_LOG = f"WITH {LOG_SQL}"
FAULTY_SQL = f"bad_line AS ({sql_select({**ORDER_LINE, **FAULTS}, 'lineitem')})"
