"""Governance labels on tables (K9), kept as table properties.

Each label ``k = v`` is stored as the property ``label.k``; the bare key
``owner`` is reserved by Spark, hence the prefix. Applying a label set
replaces the previous one. A failure on one table is logged as a warning
and does not stop the others.
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

LABEL_PREFIX = "label."

# The label set stamped on the three tables (environment is
# the job's argument).
LABEL_OWNER = "data-team"
LABEL_DOMAIN = "commerce"
LABEL_CLASSIFICATION = "internal"


def standard_labels(env: str) -> dict[str, str]:
    return {
        "environment": env,
        "owner": LABEL_OWNER,
        "domain": LABEL_DOMAIN,
        "classification": LABEL_CLASSIFICATION,
    }


def quote(v: str) -> str:
    return v.replace("\\", "\\\\").replace("'", "\\'")


def label_properties(labels: dict[str, str]) -> dict[str, str]:
    """Labels as table properties, for tables that get them at creation."""
    return {f"{LABEL_PREFIX}{k}": v for k, v in labels.items()}


def current_labels(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"][len(LABEL_PREFIX):]: r["value"] for r in rows if r["key"].startswith(LABEL_PREFIX)}


def set_labels(spark: SparkSession, table: str, labels: dict[str, str]) -> None:
    """Replace the label set of one table."""
    stale = [k for k in current_labels(spark, table) if k not in labels]
    if stale:
        keys = ", ".join(f"'{LABEL_PREFIX}{quote(k)}'" for k in stale)
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({keys})")
    if labels:
        props = ", ".join(f"'{LABEL_PREFIX}{quote(k)}' = '{quote(v)}'" for k, v in labels.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")


def apply_labels(spark: SparkSession, tables: list[str], labels: dict[str, str]) -> dict[str, bool]:
    """Stamp ``labels`` on each table; returns per table whether it worked."""
    done = {}
    for t in tables:
        try:
            set_labels(spark, t, labels)
            done[t] = True
        except Exception as exc:  # per-table failure is a warning only
            log.warning("could not label %s: %s", t, exc)
            done[t] = False
    return done
