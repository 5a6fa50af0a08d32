"""Merge source: staging LEFT JOIN customers, with the type conversions.

Catalyst chooses the join: a broadcast hash join when the customer side's
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (or when
AQE measures it small at runtime), a sort-merge join otherwise. Duplicate
customer rows fan out, as a left join must.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expressions import to_date_strict, to_numeric


def enrich_left_join(staging: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """``t.*, c.customer_name, c.country`` for every staging row."""
    c = customers.select(F.col(key).alias("_c_key"), "customer_name", "country")
    return staging.join(c, staging[key] == c["_c_key"], "left").drop("_c_key")


def merge_source(
    staging: DataFrame,
    customers: DataFrame,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """The USING relation of the merge.

    ``as_of`` fixes the statement timestamp; by default it is the time of this
    call, a literal, so every job that evaluates the source sees one value.
    """
    if as_of is None:
        ts = F.lit(dt.datetime.now(dt.timezone.utc))
    elif isinstance(as_of, Column):
        ts = as_of
    else:
        ts = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    e = enrich_left_join(staging, customers)
    return e.select(
        "transaction_id",
        "customer_id",
        "customer_name",
        "country",
        to_numeric("amount").alias("amount"),
        to_date_strict("transaction_date").alias("transaction_date"),
        "status",
        ts.alias("last_updated"),
    )
