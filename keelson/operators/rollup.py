"""Grouped summaries kept up by version (A1, A2).

Each commit's rows are summed up once, to a partial aggregate per group written under
``<table>/summaries/commit_version=<n>/``. The summary of the latest version merges the partials of
the live commits, a few rows a commit, instead of reading the table. Counts and
sums add and maxima combine, so the result is that of a full recomputation; an
overwrite needs nothing undone, as its partials are the first that count. A commit
without rows has no partial. NULL is a group of its own; a NULL measure adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sinks import fs
from keelson.sources import versions as V


@dataclass(frozen=True)
class Rollup:
    """``name`` tells several rollups of one table apart."""

    name: str
    by: tuple[str, ...]
    sums: tuple[str, ...] = ()
    maxima: tuple[str, ...] = ()


def _folder(path: str, rollup: Rollup) -> str:
    return f"{path.rstrip('/')}/summaries/{rollup.name}"


def partials(rows: DataFrame, rollup: Rollup, *keys: str) -> DataFrame:
    """A row per group: ``total``, ``sum_<c>`` and ``max_<c>``."""
    sums = [F.sum(F.col(c).cast("decimal(38,9)") if isinstance(rows.schema[c].dataType, T.DecimalType) else F.col(c)).alias(f"sum_{c}") for c in rollup.sums]
    return rows.groupBy(*keys, *rollup.by).agg(F.count(F.lit(1)).alias("total"), *sums, *[F.max(c).alias(f"max_{c}") for c in rollup.maxima])


def merged(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """Partials of disjoint rows as one."""
    added = [F.sum(c).alias(c) for c in ("total", *[f"sum_{c}" for c in rollup.sums])]
    return parts.groupBy(*rollup.by).agg(*added, *[F.max(f"max_{c}").alias(f"max_{c}") for c in rollup.maxima])


def catch_up(spark: SparkSession, path: str, rollup: Rollup) -> list[int]:
    """Sum up the live commits that aren't yet, in one job over their partitions;
    returns their versions. Repeating it, or a run that failed half-way, is safe."""
    first, last = V.live_range(spark, path)
    done = {int(n.partition("=")[2]) for n in fs.entries(spark, _folder(path, rollup)) if n.startswith(f"{V.VERSION}=")}
    new = [v for v in range(first, last + 1) if v not in done]
    if new:
        rows = V.with_version(spark, path, first).where(F.col(V.VERSION).isin(new))
        writer = partials(rows, rollup, V.VERSION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(V.VERSION).parquet(_folder(path, rollup))
    return new


def summary(spark: SparkSession, path: str, rollup: Rollup) -> DataFrame:
    """The summary of the latest version, from the partials of its commits."""
    catch_up(spark, path, rollup)
    first, last = V.live_range(spark, path)
    schema = partials(V.with_version(spark, path, first), rollup, V.VERSION).schema
    parts = spark.read.schema(schema).parquet(_folder(path, rollup)) if fs.exists(spark, _folder(path, rollup)) else spark.createDataFrame([], schema)
    return merged(parts.where(F.col(V.VERSION).between(first, last)), rollup)
