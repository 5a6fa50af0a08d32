"""Declared schemas of the data model's tables.

Fixed values: column names, types and required columns of the customer master
and of the merge target. Parquet tables don't enforce ``NOT NULL``, so the
writes take the required columns from here (:func:`required`).
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

FINAL_TABLE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DecimalType(38, 9)),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("last_updated", T.TimestampNTZType()),
    ]
)


def required(schema: T.StructType) -> list[str]:
    """The columns declared ``NOT NULL``."""
    return [f.name for f in schema.fields if not f.nullable]
