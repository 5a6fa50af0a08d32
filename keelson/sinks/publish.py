"""Publishing a versioned table in the catalog: its live commits as partitions.

An overwrite starts a generation: a catalog table over the versions' folders whose
partitions are the commits since, each registered with its folder. A reader lists
these folders only, however many older versions lie beside them, and needs no commit
record. A view names the generation and its columns; it is replaced in one step when a
newer overwrite is published, so it follows the latest schema, and an append is one
added partition. A generation that is replaced loses its catalog entry; its files stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keelson.sinks.labels import quote
from keelson.sinks.tables import create_table_if_not_exists
from keelson.sources import versions as V


def _generations(spark: SparkSession, view: str) -> dict[int, str]:
    """First version and table name of the generations registered for a view."""
    database, _, name = view.rpartition(".")
    shown = spark.sql("SHOW TABLES" + (f" IN {database}" if database else "") + f" LIKE '{name}_from_*'").collect()
    out = {}
    for r in shown:
        first = r["tableName"].rpartition("_from_")[2]
        if first.isdigit() and r["tableName"] == f"{name}_from_{first}":
            out[int(first)] = f"{database}.{r['tableName']}" if database else r["tableName"]
    return out


def publish(spark: SparkSession, view: str, path: str) -> dict:
    """Bring the catalog up to the latest commit of the versioned table at ``path``;
    returns the version shown and the partitions added. Safe to repeat."""
    first, last = V.live_range(spark, path)
    known = _generations(spark, view)
    table = f"{view}_from_{first}"
    schema = V.schema_of(spark, path, first)
    if first not in known:
        columns = T.StructType([*schema.fields, T.StructField(V.VERSION, T.LongType())])
        create_table_if_not_exists(spark, table, columns, path=V.rows_path(path), partitioned_by=[V.VERSION])
    held = {int(r["partition"].rpartition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [v for v in range(first, last + 1) if v not in held]
    if new:
        folder = quote(V.rows_path(path))
        specs = " ".join(f"PARTITION (`{V.VERSION}` = {v}) LOCATION '{folder}/{V.VERSION}={v}'" for v in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    names = ", ".join(f"`{c}`" for c in schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {names} FROM {table}")
    for older, name in known.items():
        if older < first:
            spark.sql(f"DROP TABLE {name}")
    return {"view": view, "version": last, "partitions": len(new)}


def published(spark: SparkSession, view: str, path: str) -> DataFrame:
    publish(spark, view, path)
    return spark.table(view)
