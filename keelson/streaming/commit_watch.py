"""Run a job whenever new commits land in a versioned table.

The reference refreshes its external table on a schedule by looking for the
latest version. Here the table's commit records are a streaming source: each
micro-batch holds the records that appeared since the last batch, and
``foreachBatch`` hands the batch's highest version to a callback (for example
:func:`keelson.plans.jobs.refresh_parquet_view` or the stage-and-merge job).
Progress lives in the query's checkpoint under the shared checkpoint folder, so a
restarted or rescheduled watcher resumes where it stopped; ``availableNow`` gives
the "run on a schedule, process what is new, stop" behaviour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import work_dir
from keelson.sources.versions import COMMIT_SCHEMA, VERSION, commits_path


def commit_stream(spark: SparkSession, table_path: str) -> DataFrame:
    """Streaming DataFrame of commit records with their ``commit_version``."""
    return spark.readStream.schema(COMMIT_SCHEMA).parquet(commits_path(table_path))


def watch_commits(
    spark: SparkSession,
    table_path: str,
    on_new_version: Callable[[int], None],
    checkpoint_location: str | None = None,
    available_now: bool = True,
    interval: str = "1 hour",
):
    """Start the watcher; returns the ``StreamingQuery``.

    ``on_new_version(v)`` is called once per micro-batch that contains new
    commits, with the highest new version. With ``available_now`` the query
    processes everything new and stops (await it with
    ``awaitTermination()``); otherwise it polls every ``interval``."""
    location = checkpoint_location or work_dir(spark, "commit-watch")

    def handle(batch: DataFrame, _epoch: int) -> None:
        row = batch.agg(F.max(VERSION).alias("v")).first()
        if row is not None and row["v"] is not None:
            on_new_version(int(row["v"]))

    writer = commit_stream(spark, table_path).writeStream.foreachBatch(handle).option(
        "checkpointLocation", location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
