"""Table metadata as DataFrames: label options (S11) and table kind / row
count (S12). Metadata is a handful of rows per table; row counts are those noted
by the last write, or a distributed ``count()`` where the files are others since."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sinks import tables
from keelson.sinks.labels import current_labels

OPTIONS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("option_name", T.StringType()),
        T.StructField("option_value", T.StringType()),
    ]
)


def render_labels(labels: dict[str, str]) -> str:
    """Label list in the ``[STRUCT("k", "v"), ...]`` form, keys sorted."""
    return "[" + ", ".join(f'STRUCT("{k}", "{labels[k]}")' for k in sorted(labels)) + "]"


def table_options(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, option_name, option_value) rows; one ``labels`` row per labelled table."""
    rows = []
    for t in names:
        labels = current_labels(spark, t)
        if labels:
            rows.append((t.split(".")[-1], "labels", render_labels(labels)))
    return spark.createDataFrame(rows, OPTIONS_SCHEMA)


def label_lookup(spark: SparkSession, names: list[str], option_name: str = "labels") -> DataFrame:
    """``SELECT table_name, option_name, option_value FROM TABLE_OPTIONS WHERE option_name = 'labels'``."""
    return table_options(spark, names).where(F.col("option_name") == option_name)


def table_info(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, table_type, num_rows) per table."""
    out = None
    for t in names:
        kind = spark.catalog.getTable(t).tableType
        rows = tables.known_rows(spark, t) if kind in ("MANAGED", "EXTERNAL") else None
        counted = spark.range(1).select(F.lit(rows).cast("long").alias("num_rows"))
        if rows is None:
            counted = spark.table(t).agg(F.count(F.lit(1)).alias("num_rows"))
        part = counted.select(F.lit(t.split(".")[-1]).alias("table_name"), F.lit(kind).alias("table_type"), "num_rows")
        out = part if out is None else out.unionByName(part)
    return out
