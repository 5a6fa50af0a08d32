"""Composed jobs (B1-B4). Plain functions taking a session and locations;
every data step is a distributed Spark write or read."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson import schemas
from keelson.functions.expressions import azure_blob_uri
from keelson.operators.enrich import merge_source
from keelson.operators.merge import MergeSpec
from keelson.operators.rollup import Rollup
from keelson.operators.summary import status_summary
from keelson.sinks import labels as label_sink
from keelson.sinks import bucketed, tables
from keelson.sinks import versions as version_sink
from keelson.sinks.merge_into import merge_into
from keelson.sources import external, versions

FINAL_MERGE = MergeSpec(
    key="transaction_id",
    compare=("status", "customer_name", "amount"),
    update=("customer_name", "country", "amount", "status", "last_updated"),
)

STATUS_ROLLUP = Rollup("by_status", by=("status",), sums=("amount",))


# -- B1 ----------------------------------------------------------------------
def snapshot_folder_for(snapshot_root: str, version: int) -> str:
    """Where the Parquet snapshot of ``version`` is exported."""
    return f"{snapshot_root.rstrip('/')}/version={version}"


def write_lake_table(first: DataFrame, second: DataFrame, table_path: str, snapshot_root: str) -> dict:
    """Overwrite commit, append commit, read back the latest version, export
    a Parquet snapshot of it into a folder named after that version (so a
    view over the snapshot always knows which version it shows)."""
    v0 = version_sink.commit_overwrite(first, table_path)
    v1 = version_sink.commit_append(second, table_path)
    snap, version = versions.snapshot_state(first.sparkSession, table_path)
    tables.export_snapshot(snap, snapshot_folder_for(snapshot_root, version))
    return {"versions": (v0, v1), "version": version}


# -- B2 ----------------------------------------------------------------------
def publish_lake_view(spark: SparkSession, name: str, table_path: str, adls_uri: str | None = None, account: str | None = None) -> dict:
    """Expose the lake table to SQL under ``name``; optionally also report
    the object-store URI in the blob form (raises on a malformed URI)."""
    blob_uri = None
    if adls_uri is not None:
        blob_uri = spark.range(1).select(azure_blob_uri(F.lit(adls_uri), account or "").alias("u")).first()["u"]
    tables.drop_if_managed(spark, name)
    external.lake_view(spark, name, table_path)
    return {"view": name, "blob_uri": blob_uri}


# -- B3 ----------------------------------------------------------------------
def refresh_parquet_view(spark: SparkSession, name: str, table_path: str, snapshot_root: str) -> dict:
    """Find the latest committed version (raises when
    there is none), then (re)create the view over that version's Parquet
    snapshot. A snapshot that has not been exported yet raises instead of
    silently showing an older version."""
    from keelson.sinks import fs

    version = versions.latest_version(spark, table_path)
    folder = snapshot_folder_for(snapshot_root, version)
    if not fs.exists(spark, folder):
        raise FileNotFoundError(f"no snapshot exported for version {version} under {snapshot_root}")
    tables.drop_if_managed(spark, name)
    external.parquet_view(spark, name, folder)
    return {"view": name, "version": version, "folder": folder}


# -- B4 ----------------------------------------------------------------------
@dataclass
class Warehouse:
    """Names and locations of the job's catalog tables."""

    database: str
    root: str
    staging: str = "transactions_staging"
    customers: str = "customers"
    final: str = "final_table"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    @classmethod
    def create(cls, spark: SparkSession, root: str, database: str | None = None) -> "Warehouse":
        db = database or f"keelson_{uuid.uuid4().hex[:10]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}/{db}.db'")
        return cls(database=db, root=root.rstrip("/"))


def setup_tables(spark: SparkSession, wh: Warehouse, seed: DataFrame, env: str = "dev") -> None:
    """Create the master and the target as declared and labelled if missing;
    seed the master if empty."""
    labels = label_sink.label_properties(label_sink.standard_labels(env))
    tables.create_table_if_not_exists(spark, wh.name(wh.customers), schemas.CUSTOMERS, properties=labels)
    tables.seed_if_empty(spark, seed, wh.name(wh.customers), schemas.CUSTOMERS.names, schemas.required(schemas.CUSTOMERS))
    final_loc = f"{wh.root}/{wh.final}/v-{uuid.uuid4().hex[:12]}"
    tables.create_table_if_not_exists(spark, wh.name(wh.final), schemas.FINAL_TABLE, path=final_loc, properties=labels)


def stage_and_merge(
    spark: SparkSession,
    lake_path: str,
    wh: Warehouse,
    seed_customers: DataFrame,
    env: str = "dev",
    as_of: dt.datetime | None = None,
) -> dict:
    """S1 -> K4 -> K5 -> K6 -> J1 -> M1 -> K9."""
    snap, version = versions.snapshot_state(spark, lake_path)
    staged = tables.full_refresh(snap, wh.name(wh.staging))
    setup_tables(spark, wh, seed_customers, env)
    metrics = merge_into_final(spark, wh, as_of)
    done = label_sink.apply_labels(
        spark, [wh.name(t) for t in (wh.customers, wh.final, wh.staging)], label_sink.standard_labels(env)
    )
    return {"version": version, "staged_rows": staged, "merge": metrics, "labelled": done}


def merge_into_final(spark: SparkSession, wh: Warehouse, as_of: dt.datetime | None = None, spec: MergeSpec = FINAL_MERGE) -> dict:
    """The merge step of B4: ``MERGE final_table USING (staging LEFT JOIN
    customers)``; returns the counts observed while the merged table is
    written (affected rows = inserted + updated)."""
    staging = spark.table(wh.name(wh.staging))
    customers = spark.table(wh.name(wh.customers))
    source = merge_source(staging, customers, as_of)
    return merge_into(spark, wh.name(wh.final), source, spec, location=f"{wh.root}/{wh.final}/v-{uuid.uuid4().hex[:12]}")


# -- B4 over co-located tables -----------------------------------------------------
def stage_bucketed(spark: SparkSession, wh: Warehouse, staged: DataFrame, master: DataFrame, buckets: int = 8, env: str = "dev") -> int:
    """Staging and target bucketed by the merge key, the master by the key of its join;
    returns the rows staged. ``buckets`` is for the largest table (see
    :mod:`keelson.sinks.bucketed`)."""
    labels = label_sink.label_properties(label_sink.standard_labels(env))
    rows = bucketed.full_refresh_bucketed(staged, wh.name(wh.staging), FINAL_MERGE.key, buckets)
    bucketed.full_refresh_bucketed(master, wh.name(wh.customers), "customer_id", buckets)
    bucketed.create_bucketed_table(spark, wh.name(wh.final), schemas.FINAL_TABLE, FINAL_MERGE.key, buckets, f"{wh.root}/{wh.final}/v-{uuid.uuid4().hex[:12]}", labels)
    return rows


def merge_bucketed(spark: SparkSession, wh: Warehouse, as_of: dt.datetime | None = None) -> dict:
    """The merge step over bucketed tables: the staged rows keep their buckets where the
    master is broadcast, and meet the target without an exchange. A master
    too large for that is joined by its own buckets, and only the staged rows move."""
    source = merge_source(spark.table(wh.name(wh.staging)), spark.table(wh.name(wh.customers)), as_of)
    return bucketed.merge_into_bucketed(spark, wh.name(wh.final), source, FINAL_MERGE)


def final_summary(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The verification query over the final table (A1)."""
    return status_summary(spark.table(wh.name(wh.final)))
