"""Map the driver's TPC-H-like tables onto the toolkit's data model.

* transactions (lake table / staging): orders with ``o_orderkey % 4 <> 1``
* existing target (final table): orders with ``o_orderkey % 5 <> 0``, with
  deliberate differences (amount +1, status forced to pending, NULL name)
* customers master: customer x nation with ``c_custkey % 17 <> 0`` (the
  rest become orphans of the left join)

All of it is column expressions over a Parquet scan (with pushed filters
and pruned columns); nothing is collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.expressions import LAKE_AMOUNT, NUMERIC

# Order status code -> transaction status.
STATUS_BY_CODE = {"F": "completed", "P": "pending", "O": "refunded"}

# Fixed values of the derived fixture (FIXTURES.md section B).
STAGING_EXCLUDE_MOD, STAGING_EXCLUDE_REM = 4, 1
TARGET_EXCLUDE_MOD = 5
TARGET_AMOUNT_BUMP_MOD = 11
TARGET_PENDING_MOD = 7
TARGET_NULL_NAME_MOD = 13
CUSTOMER_ORPHAN_MOD = 17
TARGET_LAST_UPDATED = dt.datetime(2024, 1, 1, 0, 0, 0)
MERGE_AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
CUSTOMER_UPDATED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)

TRANSACTION_COLUMNS = ["transaction_id", "customer_id", "amount", "transaction_date", "status"]
FINAL_COLUMNS = [
    "transaction_id",
    "customer_id",
    "customer_name",
    "country",
    "amount",
    "transaction_date",
    "status",
    "last_updated",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp literal (the driver's tables are zone-less)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def status_of(code: Column) -> Column:
    expr = None
    for k, v in STATUS_BY_CODE.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr


def _txn_id(orderkey: Column) -> Column:
    return F.concat(F.lit("TXN-"), orderkey.cast("string"))


def _cust_id(custkey: Column) -> Column:
    return F.concat(F.lit("CUST-"), custkey.cast("string"))


def staging(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """The transactions table as staged from the latest lake version.

    ``where`` further restricts the orders (for example to one half, to
    build two commits)."""
    o = table(spark, sf_dir, "orders")
    if where is not None:
        o = o.where(where)
    k = F.col("o_orderkey")
    cols = [
        _txn_id(k).alias("transaction_id"),
        _cust_id(F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").cast(LAKE_AMOUNT).alias("amount"),
        F.col("o_orderdate").cast("date").cast("string").alias("transaction_date"),
        status_of(F.col("o_orderstatus")).alias("status"),
    ]
    return o.select(*cols)


def merge_staging(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Staging for the merge queries, whose feature is a partial overlap with
    the target: some target orders have no staged row."""
    overlap = F.col("o_orderkey") % STAGING_EXCLUDE_MOD != STAGING_EXCLUDE_REM
    return staging(spark, sf_dir, overlap if where is None else overlap & where)


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master for the join queries, whose feature is orders without a
    customer: some customers are missing."""
    return customers(spark, sf_dir, F.col("c_custkey") % CUSTOMER_ORPHAN_MOD != 0)


def customers(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Customer master: id, name, email, country, updated_at."""
    c = table(spark, sf_dir, "customer")
    if where is not None:
        c = c.where(where)
    n = table(spark, sf_dir, "nation")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(
            _cust_id(F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lit("cust"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("country"),
            ts_literal(CUSTOMER_UPDATED_AT).alias("updated_at"),
        )
    )


def existing_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table before the merge, with deliberate differences."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("o_orderkey")
    base = o.where(k % TARGET_EXCLUDE_MOD != 0)
    amount = (
        F.col("o_totalprice").cast(LAKE_AMOUNT) + F.when(k % TARGET_AMOUNT_BUMP_MOD == 0, F.lit(1)).otherwise(F.lit(0))
    ).cast(NUMERIC)
    cols = [
        _txn_id(k).alias("transaction_id"),
        _cust_id(F.col("o_custkey")).alias("customer_id"),
        F.when(k % TARGET_NULL_NAME_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("customer_name"),
        F.col("n_name").alias("country"),
        amount.alias("amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.when(k % TARGET_PENDING_MOD == 0, F.lit("pending")).otherwise(status_of(F.col("o_orderstatus"))).alias("status"),
        ts_literal(TARGET_LAST_UPDATED).alias("last_updated"),
    ]
    return (
        base.join(c, base.o_custkey == c.c_custkey, "left")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(*cols)
    )
