"""Committing to a versioned table (see :mod:`keelson.sources.versions`).

Single writer. The rows are written first, the one-row commit record last, so a
reader sees a commit whole or not at all; rows that a failed commit left behind
are replaced by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.sinks import fs
from keelson.sources import versions as V


def commit(df: DataFrame, path: str, kind: str) -> int:
    """Write ``df`` as the next version; returns its number. ``overwrite`` replaces
    the table's rows, ``append`` adds to them (a bag union: no key check)."""
    if kind not in ("overwrite", "append"):
        raise ValueError(kind)
    spark = df.sparkSession
    try:
        first, last = V.live_range(spark, path)
    except V.NoCommitsError:
        if kind == "append":
            raise
        last = -1
    if kind == "append":
        existing = V.schema_of(spark, path, first)
        if [(f.name, f.dataType) for f in existing.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
            raise ValueError(f"append schema {df.schema.simpleString()} differs from table schema {existing.simpleString()}")
    version = last + 1
    df.write.mode("overwrite").parquet(f"{V.rows_path(path)}/{V.VERSION}={version}")
    record = spark.range(1).coalesce(1).select(F.lit(kind).alias("kind"))
    record.write.mode("errorifexists").parquet(f"{V.commits_path(path)}/{V.VERSION}={version}")
    return version


def commit_overwrite(df: DataFrame, path: str) -> int:
    return commit(df, path, "overwrite")


def commit_append(df: DataFrame, path: str) -> int:
    return commit(df, path, "append")
