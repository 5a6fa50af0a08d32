"""SQL-visible views over external data (S5, S6) and inline rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sinks import tables
from keelson.sources import versions


def lake_view(spark: SparkSession, name: str, table_path: str) -> DataFrame:
    """Create-or-replace a view over a versioned table (S5). It is SQL over the
    table's folders, so each query sees the version that is latest then; its
    columns are those at creation."""
    first, _ = versions.live_range(spark, table_path)
    columns = ", ".join(f"`{c}`" for c in versions.schema_of(spark, table_path, first).names)
    rows, commits = versions.rows_path(table_path), versions.commits_path(table_path)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM parquet.`{rows}` "
        f"WHERE {versions.VERSION} BETWEEN (SELECT max({versions.VERSION}) FROM parquet.`{commits}` WHERE kind = 'overwrite') "
        f"AND (SELECT max({versions.VERSION}) FROM parquet.`{commits}`)"
    )
    return spark.table(name)


def parquet_view(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Create-or-replace a temporary view over ``<folder>/*.parquet``."""
    glob = f"{folder.rstrip('/')}/*.parquet"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING parquet OPTIONS (path '{glob}')")
    return spark.table(name)


def parquet_external_table(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Catalog form of S6: replace a managed table of the same name (K8),
    then (re)create an external table over the folder. Spark has no
    ``CREATE OR REPLACE`` for Parquet tables, so an existing external
    table is dropped (metadata only) and created again."""
    tables.drop_if_managed(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder.rstrip('/')}'")
    return spark.table(name)


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """``SELECT * FROM UNNEST([STRUCT(a AS x, ...), STRUCT(...)])`` (S8): the
    field names of the first struct name the columns, later rows are
    positional. Values are literals of their Python type (a float is a
    double); a Column, such as ``F.current_timestamp()``, is taken as it is."""
    if not rows:
        raise ValueError("at least one row is needed to name the columns")
    if any(len(r) != len(names) for r in rows):
        raise ValueError("every row needs one value per column")
    structs = [
        F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def values_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """``VALUES (...), (...)`` with a declared schema."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)
