"""Retiring replaced folders: readers that opened them finish, age removes them.

A writer that replaces a folder leaves it in place and notes the time in an empty
marker, ``<parent>/_retired/<name>`` (readers of the parent skip names with an
underscore). Later writers, or a job of its own, remove what was retired long enough
ago. The time is the marker's, so it is the file system's clock, and retiring a folder
twice starts its time anew."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from keelson.sinks import fs

KEEP_SECONDS = 24 * 3600
MARKERS = "_retired"


def retire(spark: SparkSession, folder: str) -> None:
    parent, name = folder.rstrip("/").rsplit("/", 1)
    fs.touch(spark, f"{parent}/{MARKERS}/{name}")


def remove_retired(spark: SparkSession, parent: str, keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Delete the folders under ``parent`` retired at least ``keep_seconds`` ago; returns their names."""
    parent, removed = parent.rstrip("/"), []
    for name, since in fs.entries(spark, f"{parent}/{MARKERS}").items():
        if time.time() - since >= keep_seconds:
            fs.delete(spark, f"{parent}/{name}")
            fs.delete(spark, f"{parent}/{MARKERS}/{name}")
            removed.append(name)
    return sorted(removed)


def replaced(spark: SparkSession, folder: str, keep_seconds: float = KEEP_SECONDS) -> None:
    """Retire ``folder`` and remove what lies beside it and has had its time."""
    retire(spark, folder)
    remove_retired(spark, folder.rstrip("/").rsplit("/", 1)[0], keep_seconds)
