"""Catalog-table writes.

Tables are Parquet tables in the session catalog: managed (in the
warehouse) when no path is given, external (``LOCATION``) otherwise.
Constraints of the data model are enforced in the write plans: NOT NULL
keys through an assertion in a filter (Parquet tables do not enforce it),
primary keys only reported (they are declared, not enforced).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.expressions import assert_not_null
from keelson.sinks import fs
from keelson.sinks.labels import quote
from keelson.sinks.retire import KEEP_SECONDS, replaced

log = logging.getLogger(__name__)


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )


def create_table_if_not_exists(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str | None = None,
    properties: dict[str, str] | None = None,
    partitioned_by: Sequence[str] = (),
) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` (K5). The unenforced
    primary key is not declarable on Parquet tables and is checked by
    :func:`keelson.operators.checks.duplicate_keys` instead."""
    loc = f" LOCATION '{path}'" if path else ""
    props = ""
    if properties:
        props = " TBLPROPERTIES (" + ", ".join(f"'{quote(k)}' = '{quote(v)}'" for k, v in properties.items()) + ")"
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(schema)}) USING parquet{parts}{loc}{props}")


def enforce_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df``; raises at write time if a listed column is NULL."""
    for c in columns:
        df = df.where(assert_not_null(c, c))
    return df


def full_refresh(df: DataFrame, name: str, path: str | None = None, keep_seconds: float = KEEP_SECONDS) -> int:
    """Truncate-and-load, creating the table if needed (K4); returns the row count.

    An existing table of the same columns keeps its properties (labels): the rows
    are written aside and the table is pointed to them in one step. The folder it had
    is kept for ``keep_seconds``, so that running readers finish, and removed by a later
    refresh. The count is observed during the write."""
    spark = df.sparkSession
    if path is None and spark.catalog.tableExists(name):
        columns = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
        if columns == [(f.name, f.dataType) for f in df.schema.fields]:
            previous = table_location(spark, name).rstrip("/")
            aside = f"{previous.rsplit('/', 1)[0]}/refresh-{uuid.uuid4().hex[:12]}"
            rows = write_observed_and_swap(df, None, name, aside, [])["rows"]
            replaced(spark, previous, keep_seconds)
            return int(rows)
    obs = Observation(f"refresh_{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    record_rows(spark, name, int(obs.get["rows"]))
    return int(obs.get["rows"])


# -- row counts kept with the table (S12, A3) -----------------------------------------
STATISTICS = "statistics"  # a table property: rows, files and bytes at the last write


def record_rows(spark: SparkSession, name: str, rows: int) -> None:
    """Note a row count observed by a write, with the files it was observed for."""
    files, size = fs.content(spark, table_location(spark, name))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{STATISTICS}' = '{rows},{files},{size}')")


def known_rows(spark: SparkSession, name: str) -> int | None:
    """The noted row count, or None if there is none or the table's files are others now."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if STATISTICS not in props:
        return None
    rows, files, size = map(int, props[STATISTICS].split(","))
    return rows if (files, size) == fs.content(spark, table_location(spark, name)) else None


def insert_append(df: DataFrame, name: str, not_null: Sequence[str] = ()) -> None:
    """Unconditional insert (K7): a rerun duplicates rows. A NULL in a
    ``not_null`` column fails the write. A known row count is carried on."""
    spark = df.sparkSession
    before = known_rows(spark, name)
    obs = Observation(f"insert_{uuid.uuid4().hex[:8]}")
    enforce_not_null(df, list(not_null)).observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(name, overwrite=False)
    if before is not None:
        record_rows(spark, name, before + int(obs.get["rows"]))


def seed_if_empty(spark: SparkSession, seed: DataFrame, name: str, columns: list[str], not_null: Sequence[str] = ()) -> None:
    """``INSERT INTO t (cols) SELECT ... WHERE NOT EXISTS (SELECT 1 FROM t LIMIT 1)`` (K6).

    One statement: the existence test is an uncorrelated one-row subquery of the
    insert. A NULL in a ``not_null`` column of the inserted rows fails the write."""
    rows = seed.select(*columns).where(~spark.table(name).limit(1).exists())
    enforce_not_null(rows, list(not_null)).write.insertInto(name, overwrite=False)


def export_snapshot(df: DataFrame, folder: str) -> None:
    """Replace the Parquet snapshot in ``folder`` (K3). Written in parallel
    (many part files), never funnelled into one task."""
    df.write.mode("overwrite").parquet(folder)


def export_sorted(df: DataFrame, folder: str, key: str, rows_per_file: int = 2_000_000) -> int:
    """Replace the Parquet snapshot in ``folder`` by files that hold a range of ``key``
    each, sorted by it, of about ``rows_per_file`` rows (K3); returns the rows written.

    Readers with a filter on the key skip files and row groups by their minima and
    maxima. A key with many rows spans several files: ranges are cut by key and a hash of the row."""
    rows = df.count()
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(max(1, -(-rows // rows_per_file)), *order).sortWithinPartitions(F.col(key).asc_nulls_first())
    ranged.write.mode("overwrite").option("maxRecordsPerFile", 2 * rows_per_file).parquet(folder)
    return rows


def table_type(spark: SparkSession, name: str) -> str | None:
    """MANAGED / EXTERNAL / VIEW / TEMPORARY, or None when absent."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.catalog.getTable(name).tableType


def drop_if_managed(spark: SparkSession, name: str) -> bool:
    """Drop ``name`` when it is a managed (native) table so an external
    table can take its place (K8); absent tables are fine."""
    if table_type(spark, name) == "MANAGED":
        log.warning("dropping managed table %s to replace it by an external one", name)
        spark.sql(f"DROP TABLE {name}")
        return True
    return False


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Location").collect()
    if not rows:
        raise ValueError(f"{name} has no location")
    return rows[0]["data_type"]


def write_observed_and_swap(df: DataFrame, drop_column: str | None, name: str, new_location: str, metrics: list) -> dict:
    """Write ``df`` (which may read ``name`` itself) to ``new_location``, then point
    the table there (``ALTER TABLE ... SET LOCATION``); returns the metrics observed on
    ``df`` before ``drop_column`` (for example a merge action column) is removed.

    Spark refuses to overwrite a table it is reading; writing aside and
    re-pointing also makes the switch atomic for later readers."""
    spark = df.sparkSession
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    if drop_column:
        observed = observed.drop(drop_column)
    observed.write.mode("errorifexists").parquet(new_location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_location}'")
    spark.sql(f"REFRESH TABLE {name}")
    record_rows(spark, name, int(obs.get["rows"]))
    return dict(obs.get)
