"""keelson: a PySpark toolkit that keeps an enriched table in step with a
versioned source table.

Layout
------
sources/    readers: driver-table mapping, commit-log replay, views, catalog
sinks/      writers: commits, full refresh, seed-if-empty, labels, publish
functions/  column expressions (casts, path and URI helpers, change test)
operators/  relational building blocks (merge, enrichment, checks, summaries)
plans/      composed jobs and the registered query catalogue
streaming/  commit-log watcher that re-runs a job per new commit
"""

from keelson.session import build_session, work_dir  # noqa: F401
