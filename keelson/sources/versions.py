"""Reading a versioned table: plain Parquet, partitioned by version.

``<path>/rows/commit_version=<n>/`` holds the rows of commit ``n`` and
``<path>/commits/commit_version=<n>/`` one row saying whether it overwrote the
table or appended to it. A commit counts once its ``commits`` row exists; the latest
version is the rows of the last overwrite and of all commits after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sinks import fs

VERSION = "commit_version"
COMMIT_SCHEMA = f"kind string, {VERSION} long"


class NoCommitsError(ValueError):
    """The table has no commit."""


def rows_path(path: str) -> str:
    return f"{path.rstrip('/')}/rows"


def commits_path(path: str) -> str:
    return f"{path.rstrip('/')}/commits"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(kind, commit_version), a row per commit."""
    if not fs.exists(spark, commits_path(path)):
        raise NoCommitsError(f"no commit found under {path}")
    return spark.read.schema(COMMIT_SCHEMA).parquet(commits_path(path))


def live_range(spark: SparkSession, path: str) -> tuple[int, int]:
    """(version of the last overwrite, latest version), from one read."""
    first = F.max(F.when(F.col("kind") == "overwrite", F.col(VERSION)))
    row = commits(spark, path).agg(first.alias("first"), F.max(VERSION).alias("last")).first()
    if row["first"] is None:
        raise NoCommitsError(f"no commit found under {path}")
    return row["first"], row["last"]


def latest_version(spark: SparkSession, path: str) -> int:
    return live_range(spark, path)[1]


def schema_of(spark: SparkSession, path: str, version: int) -> T.StructType:
    return spark.read.parquet(f"{rows_path(path)}/{VERSION}={version}").schema


def with_version(spark: SparkSession, path: str, first: int) -> DataFrame:
    """Rows of all commits with their ``commit_version``, as the columns of version ``first``."""
    schema = schema_of(spark, path, first)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])).parquet(rows_path(path))


def versions(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Rows of the commits ``first`` to ``last``, by partition pruning."""
    rows = with_version(spark, path, first)
    return rows.where(F.col(VERSION).between(first, last)).drop(VERSION)


def snapshot_state(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The latest version's rows and its number."""
    first, last = live_range(spark, path)
    return versions(spark, path, first, last), last


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    return snapshot_state(spark, path)[0]
