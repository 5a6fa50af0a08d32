"""Verification summaries, samples and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_summary(df: DataFrame) -> DataFrame:
    """``GROUP BY status``: count, total amount, latest update, by count desc (A1, O1)."""
    return (
        df.groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.sum("amount").alias("total_amount"),
            F.max("last_updated").alias("latest_update"),
        )
        .orderBy(F.col("total_records").desc(), F.col("status"))
    )


def status_totals(df: DataFrame) -> DataFrame:
    """``GROUP BY status``: count and total amount (A2)."""
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("total"), F.sum("amount").alias("total_amount"))


def row_count(df: DataFrame) -> int:
    """Global row count (A3)."""
    return df.count()


def sample_rows(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """``SELECT * ... LIMIT n`` (O2). With ``order_by`` it is a deterministic
    top-n (a per-partition top-n then a merge, no full sort)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)


def union_versions(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (``UNION ALL``), as an append does."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
