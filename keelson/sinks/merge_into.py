"""``MERGE INTO <table> USING <source>`` for a Parquet catalog table.

The table is read, merged with :func:`keelson.operators.merge.merge_plan`,
conformed to the table's declared column types, written to a new folder
next to the table's current one and the table re-pointed to it (Spark
cannot overwrite a table it is reading, and re-pointing makes the switch
atomic for readers). Row counts per action are observed during the write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.merge import ACTION, INSERT, UPDATE, MergeSpec, plan_merge
from keelson.sinks import fs, tables
from keelson.sinks.retire import KEEP_SECONDS, replaced

ACTIONS = ("INSERT", "UPDATE", "NOOP", "KEEP")


def action_metrics() -> list:
    """``affected_rows`` (inserted and updated) and a count per action."""
    return [
        F.sum(F.when(F.col(ACTION).isin(INSERT, UPDATE), 1).otherwise(0)).alias("affected_rows"),
        *[F.sum(F.when(F.col(ACTION) == a, 1).otherwise(0)).alias(a.lower()) for a in ACTIONS],
    ]


def merge_into(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    spec: MergeSpec,
    location: str | None = None,
    remove_previous: bool = False,
    keep_seconds: float = KEEP_SECONDS,
) -> dict:
    """Merge ``source`` into the catalog table ``table``; returns the observed
    counts: ``rows`` written, ``affected_rows`` (inserted + updated) and one
    count per action. ``location`` is the folder for the new version
    (default: a new sibling of the table's current folder). The folder of the
    replaced version is kept for ``keep_seconds``, as running readers may still use it,
    and removed by a later merge; with ``remove_previous`` it is deleted at once."""
    fields = spark.table(table).schema.fields
    metrics = action_metrics()
    previous = tables.table_location(spark, table).rstrip("/")
    if location is None:
        location = f"{previous.rsplit('/', 1)[0]}/v-{uuid.uuid4().hex[:12]}"
    scratch: list[str] = []
    try:
        merged = plan_merge(spark.table(table), source, spec, scratch)
        conformed = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], ACTION)
        out = tables.write_observed_and_swap(conformed, ACTION, table, location, metrics)
    finally:
        for path in scratch:
            fs.delete(spark, path)
    replaced(spark, previous, 0 if remove_previous else keep_seconds)
    return {k: int(v or 0) for k, v in out.items()}
