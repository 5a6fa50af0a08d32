"""The reference's own inline rows (FIXTURES.md section A).

Fixed values: the rows below must equal the reference's for its expected
results (8 staged rows, 7 keys, the status totals of the first merge)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from keelson.schemas import CUSTOMERS as CUSTOMER_SCHEMA
from keelson.schemas import FINAL_TABLE as FINAL_SCHEMA  # noqa: F401

TXN_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

FIRST_COMMIT = [
    ("TXN-001", "CUST-A", Decimal("150.00"), "2024-01-15", "completed"),
    ("TXN-002", "CUST-B", Decimal("220.50"), "2024-01-16", "completed"),
    ("TXN-003", "CUST-A", Decimal("89.99"), "2024-01-17", "refunded"),
    ("TXN-004", "CUST-C", Decimal("310.00"), "2024-01-18", "completed"),
    ("TXN-005", "CUST-B", Decimal("45.75"), "2024-01-19", "pending"),
]
SECOND_COMMIT = [
    ("TXN-003", "CUST-A", Decimal("89.99"), "2024-01-17", "completed"),
    ("TXN-006", "CUST-D", Decimal("500.00"), "2024-01-20", "completed"),
    ("TXN-007", "CUST-C", Decimal("75.25"), "2024-01-21", "completed"),
]

SEED_TIME = dt.datetime(2024, 1, 10, 0, 0, 0)
CUSTOMERS = [
    ("CUST-A", "Alice Johnson", "alice@example.com", "Colombia", SEED_TIME),
    ("CUST-B", "Bob Smith", "bob@example.com", "Mexico", SEED_TIME),
    ("CUST-C", "Carlos Rivera", "carlos@example.com", "Colombia", SEED_TIME),
    ("CUST-D", "Diana Torres", "diana@example.com", "Peru", SEED_TIME),
]


def txn_df(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)


def customers_df(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else CUSTOMERS, CUSTOMER_SCHEMA)
