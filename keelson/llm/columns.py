"""A table's own columns, whatever they are called, a hash of whole rows, and rows in the order of their files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.session import materialise


def named(name: str) -> Column:
    """A column by its name alone: dots and backticks in it mean nothing."""
    return F.col(f"`{name.replace('`', '``')}`")


def own_columns(df: DataFrame) -> list[Column]:
    return [df[f"`{c.replace('`', '``')}`"] for c in df.columns]


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _holds_map(kind.elementType))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns: orders rows that agree otherwise, the same way after a rerun.
    Rows with equal hashes are equal. Maps, which Spark doesn't hash, count as JSON."""
    return F.xxhash64(*[F.to_json(c) if _holds_map(f.dataType) else c for c, f in zip(own_columns(df), df.schema.fields)])


def in_file_order(docs: DataFrame) -> DataFrame:
    """(row, position): a row per row of ``docs``, its columns as a struct, with its position (from 0) in the Parquet
    files that ``docs`` was read from: files in ``part-`` order, rows in file order. Rows that
    don't come from Parquet files are written first."""
    spark = docs.sparkSession

    def located(df: DataFrame) -> DataFrame:
        file = df.metadataColumn("_metadata")
        return df.select(F.struct(*own_columns(df)).alias("row"), file["file_path"].alias("file"), file["file_name"].alias("name"), file["row_index"].alias("at"))

    try:
        rows = located(docs)
    except AnalysisException:
        rows = located(materialise(spark, docs, "file-order"))
    number = lambda pattern: F.regexp_extract("name", pattern, 1).try_cast("long")
    files = rows.groupBy("file", "name").agg((F.max("at") + 1).alias("n"))
    before = Window.partitionBy().orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)"), "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(spark, files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "file-starts")
    return rows.join(starts, "file").select("row", (F.col("start") + F.col("at")).alias("position"))
