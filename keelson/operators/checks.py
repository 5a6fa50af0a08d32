"""Key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.expressions import assert_not_null


def not_null_rows(df: DataFrame, column: str) -> DataFrame:
    """``df`` unchanged; evaluating it raises if ``column`` is NULL anywhere.
    The assertion sits in a filter, so column pruning cannot drop it."""
    return df.where(assert_not_null(column, column))


def duplicate_keys(df: DataFrame, key: str, count_name: str = "n") -> DataFrame:
    """Keys that occur more than once (the declared, unenforced primary key):
    ``GROUP BY key HAVING count(*) > 1``. A partial aggregate, so a hot key
    costs one row per map task in the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)
