"""Co-located tables: bucketed by their join key, so that joins need no exchange.

Tables bucketed by the same key into the same number of buckets are joined bucket by
bucket, and counted by key, without moving a row. Rows are written sorted within
a bucket, so the join needs no sort where a bucket is one file. Choose the number so that a bucket of
the largest table fits a task; all tables that are joined on the key share it.

Spark writes buckets only through the catalog, so a refresh or merge writes a
passing external table at the new folder, drops its name and points the table there;
readers of the replaced folder finish (see :mod:`keelson.sinks.retire`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.merge import ACTION, MergeSpec, plan_merge
from keelson.sinks import fs, tables
from keelson.sinks.labels import quote
from keelson.sinks.merge_into import action_metrics
from keelson.sinks.retire import KEEP_SECONDS, replaced


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a table, None if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    n = int(rows.get("Num Buckets") or 0)
    return (n, [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")]) if n else None


def create_bucketed_table(
    spark: SparkSession, name: str, schema: T.StructType, key: str, buckets: int, path: str | None = None, properties: dict[str, str] | None = None
) -> None:
    """``CREATE TABLE IF NOT EXISTS ... CLUSTERED BY (key) SORTED BY (key)`` (K5)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    props = ", ".join(f"'{quote(k)}' = '{quote(v)}'" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        + f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
        + (f" LOCATION '{path}'" if path else "")
        + (f" TBLPROPERTIES ({props})" if props else "")
    )


def replace_rows(df: DataFrame, name: str, metrics: Sequence = (), drop_column: str | None = None, keep_seconds: float = KEEP_SECONDS) -> dict:
    """Point the bucketed table ``name`` to the rows of ``df``, bucketed alike; returns the
    metrics observed during the write. ``df`` may read the table. Labels stay."""
    spark = df.sparkSession
    buckets = bucketing(spark, name)
    if buckets is None:
        raise ValueError(f"{name} has no buckets")
    n, keys = buckets
    fields = spark.table(name).schema.fields
    previous = tables.table_location(spark, name).rstrip("/")
    passing = f"{name}_{uuid.uuid4().hex[:12]}"
    folder = f"{previous.rsplit('/', 1)[0]}/{passing.rsplit('.', 1)[-1]}"
    obs = Observation(f"bucketed_{uuid.uuid4().hex[:8]}")
    rows = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    # each task has whole buckets, so a bucket is one file
    rows = rows.repartition(n, *keys)
    rows.write.format("parquet").option("path", folder).bucketBy(n, *keys).sortBy(*keys).saveAsTable(passing)
    spark.sql(f"DROP TABLE {passing}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {name}")
    tables.record_rows(spark, name, int(obs.get["rows"]))
    replaced(spark, previous, keep_seconds)
    return dict(obs.get)


def full_refresh_bucketed(df: DataFrame, name: str, key: str, buckets: int, keep_seconds: float = KEEP_SECONDS) -> int:
    """Truncate-and-load of a bucketed table, created if missing (K4); returns the row count."""
    create_bucketed_table(df.sparkSession, name, df.schema, key, buckets)
    return int(replace_rows(df, name, keep_seconds=keep_seconds)["rows"])


def merge_into_bucketed(spark: SparkSession, name: str, source: DataFrame, spec: MergeSpec, keep_seconds: float = KEEP_SECONDS) -> dict:
    """:func:`keelson.sinks.merge_into.merge_into` for a table bucketed by the merge key.

    A source that keeps its buckets (a bucketed staging table joined with a broadcast or
    with rows bucketed by the same key) meets the table without an exchange."""
    buckets = bucketing(spark, name)
    if buckets is None or buckets[1] != [spec.key]:
        raise ValueError(f"{name} isn't bucketed by {spec.key}")
    scratch: list[str] = []
    try:
        merged = plan_merge(spark.table(name), source, spec, scratch)
        out = replace_rows(merged, name, action_metrics(), ACTION, keep_seconds)
    finally:
        for path in scratch:
            fs.delete(spark, path)
    return {k: int(v or 0) for k, v in out.items()}
