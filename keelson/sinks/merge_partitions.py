"""MERGE into a partitioned table, rewriting only the partitions that change (M1, M5).

An update never moves a row: the partition columns are not among the updated ones. But
rows match by key, so a source row may match in any partition, whatever its own date. So

1. one merge over the key, compare and partition columns alone counts the actions of each
   partition. That gives the partitions to rewrite (an insert or update), the partitions
   that hold matched rows, and the affected-row counts;
2. a second merge reads only these partitions of the target. Every target row that a source
   row matches is among them, so inserts come out as they would against the whole
   table; the rows of the partitions to rewrite are written, to a new folder;
3. the catalog's partitions are pointed to the new folders, one by one. The other partitions
   keep their files. Replaced folders are kept for a while, for running readers.

What the driver holds is a row a partition, as the catalog does. A partition's switch is atomic, that of
several partitions is not; a run that fails before step 3 changes nothing, and a
merge that finds nothing to change writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from keelson.operators.merge import ACTION, INSERT, KEEP, UPDATE, MergeSpec, key_facts, plan_merge
from keelson.sinks import fs, tables
from keelson.sinks.labels import quote
from keelson.sinks.merge_into import ACTIONS
from keelson.sinks.retire import KEEP_SECONDS, replaced


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partition_location(spark: SparkSession, table: str, spec: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _spec(columns: Sequence[str], row: Row) -> str:
    """A partition as SQL: values as strings, which the catalog casts."""
    return ", ".join(f"`{c}` = " + ("null" if row[c] is None else f"'{quote(str(row[c]))}'") for c in columns)


def _folder(spark: SparkSession, columns: Sequence[str], row: Row) -> str:
    """The folder that Spark's partitioned writer makes for a partition."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in columns)


def _within(columns: Sequence[str], rows: list[Row]) -> Column:
    """Whether a row lies in one of the partitions; literals, so that the scan prunes by it."""
    if len(columns) == 1:
        c = columns[0]
        values = [r[c] for r in rows if r[c] is not None]
        hit = F.col(c).isin(values) if values else F.lit(False)
        return F.coalesce(hit, F.lit(False)) | F.col(c).isNull() if len(values) < len(rows) else F.coalesce(hit, F.lit(False))
    hit = F.lit(False)
    for r in rows:
        same = F.lit(True)
        for c in columns:
            same = same & F.col(c).eqNullSafe(F.lit(r[c]))
        hit = hit | same
    return hit


def partition_actions(target: DataFrame, source: DataFrame, spec: MergeSpec, columns: Sequence[str], facts, scratch: list[str]) -> list[Row]:
    """Rows per action of each partition of the merged table."""
    narrow = list(dict.fromkeys([spec.key, *spec.compare, *columns]))
    merged = plan_merge(target.select(*narrow), source.select(*narrow), MergeSpec(spec.key, spec.compare, ()), scratch, facts)
    counts = [F.count(F.when(F.col(ACTION) == a, 1)).alias(a) for a in ACTIONS]
    return merged.groupBy(*columns).agg(*counts).collect()


def merge_into_partitions(spark: SparkSession, table: str, source: DataFrame, spec: MergeSpec, keep_seconds: float = KEEP_SECONDS) -> dict:
    """Merge ``source`` into the partitioned catalog table ``table``; returns the counts
    of :func:`keelson.sinks.merge_into.merge_into` but with ``rows`` for the rows written, and
    ``partitions``: how many were rewritten."""
    columns = partition_columns(spark, table)
    moved = set(columns) & set(spec.update)
    if not columns or moved:
        raise ValueError(f"{table}: an update can't move rows between partitions: {sorted(moved)}" if moved else f"{table} has no partitions")
    target = spark.table(table)
    fields = target.schema.fields
    typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    scratch: list[str] = []
    try:
        facts = key_facts(target, typed, spec.key)
        actions = partition_actions(target, typed, spec, columns, facts, scratch)
        counts = {a.lower(): sum(r[a] for r in actions) for a in ACTIONS}
        changed = [r for r in actions if r[INSERT] or r[UPDATE]]
        counts |= {"affected_rows": counts["insert"] + counts["update"], "partitions": len(changed), "rows": 0}
        if not changed:
            return counts
        read = [r for r in actions if any(r[a] for a in ACTIONS if a != KEEP)]
        merged = plan_merge(target.where(_within(columns, read)), typed, spec, scratch, facts)
        rows = merged.where(_within(columns, changed)).select(*[f.name for f in fields])
        aside = f"{tables.table_location(spark, table).rstrip('/')}-merged-{uuid.uuid4().hex[:12]}"
        # a partition's rows in few files, a large partition's in several tasks
        rows.hint("rebalance", *[F.col(c) for c in columns]).write.partitionBy(*columns).parquet(aside)
    finally:
        for path in scratch:
            fs.delete(spark, path)
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for row in changed:
        where, name = _spec(columns, row), _folder(spark, columns, row)
        if name in known:
            previous = partition_location(spark, table, where)
            spark.sql(f"ALTER TABLE {table} PARTITION ({where}) SET LOCATION '{quote(f'{aside}/{name}')}'")
            replaced(spark, previous, keep_seconds)
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({where}) LOCATION '{quote(f'{aside}/{name}')}'")
    spark.sql(f"REFRESH TABLE {table}")
    counts["rows"] = sum(sum(r[a] for a in ACTIONS) for r in changed)
    return counts
