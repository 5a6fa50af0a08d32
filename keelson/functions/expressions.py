"""Column expressions. All are built-in Catalyst expressions, so they stay
inside whole-stage code generation; no Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: the warehouse NUMERIC type and the lake
# table's amount type.
NUMERIC = "decimal(38,9)"
LAKE_AMOUNT = "decimal(18,2)"

# Fixed value: commit files are named by a 20-digit zero-padded version.
COMMIT_NAME_PATTERN = r"^(\d{20})\.json$"

# Fixed value: the object-store URI shapes of the external-table rewrite.
ADLS_URI_PATTERN = r"^abfss://([^@]+)@[^/]+/(.+)$"
BLOB_HOST_SUFFIX = ".blob.core.windows.net"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c: str | Column) -> Column:
    """CAST(x AS NUMERIC): decimal(38,9); overflow raises under ANSI mode."""
    return _c(c).cast(NUMERIC)


def to_lake_amount(c: str | Column) -> Column:
    return _c(c).cast(LAKE_AMOUNT)


def to_date_strict(c: str | Column) -> Column:
    """DATE(string): ``yyyy-MM-dd``; a malformed value raises (ANSI)."""
    return F.to_date(_c(c), "yyyy-MM-dd")


def changed(target: Sequence[Column], source: Sequence[Column]) -> Column:
    """Three-valued change test ``t1 != s1 OR t2 != s2 ...`` folded to a
    boolean: a NULL on either side is not a change by itself, and
    ``TRUE OR NULL`` is TRUE. Never null-safe."""
    terms = [t != s for t, s in zip(target, source, strict=True)]
    return F.coalesce(reduce(lambda a, b: a | b, terms), F.lit(False))


def path_basename(c: str | Column) -> Column:
    """Last element after splitting on '/'."""
    return F.element_at(F.split(_c(c), "/"), -1)


def trim_slashes(c: str | Column) -> Column:
    """Trim '/' from both ends."""
    return F.btrim(_c(c), F.lit("/"))


def rtrim_slashes(c: str | Column) -> Column:
    return F.rtrim(_c(c), F.lit("/"))


def version_from_name(name: str | Column) -> Column:
    """Commit version from a file name like ``00000000000000000012.json``;
    NULL when the name is not a commit file."""
    n = _c(name)
    digits = F.regexp_extract(n, COMMIT_NAME_PATTERN, 1)
    return F.when(n.rlike(COMMIT_NAME_PATTERN), digits.cast("bigint"))


def azure_blob_uri(adls_uri: str | Column, account: str | Column) -> Column:
    """``abfss://container@host/path`` -> ``azure://<account>.blob.../container/path/``.

    The account comes from the argument, not the URI. A URI that does not
    have the expected shape raises."""
    u = _c(adls_uri)
    acct = F.lit(account) if isinstance(account, str) else account
    container = F.regexp_extract(u, ADLS_URI_PATTERN, 1)
    base_path = rtrim_slashes(F.regexp_extract(u, ADLS_URI_PATTERN, 2))
    rewritten = F.concat(
        F.lit("azure://"), acct, F.lit(BLOB_HOST_SUFFIX + "/"), container, F.lit("/"), base_path, F.lit("/")
    )
    return F.when(u.rlike(ADLS_URI_PATTERN), rewritten).otherwise(
        F.raise_error(F.concat(F.lit("invalid ADLS URI: "), F.coalesce(u, F.lit("NULL"))))
    )


def assert_not_null(c: str | Column, what: str) -> Column:
    """A predicate that is TRUE for non-NULL values and raises otherwise.
    Use it inside ``where`` so the optimizer cannot prune it."""
    col = _c(c)
    return F.when(col.isNull(), F.raise_error(F.lit(f"NOT NULL constraint violated: {what}"))).otherwise(
        F.lit(True)
    )


def assert_that(cond: Column, message: str) -> Column:
    """Predicate form of an assertion (TRUE or raise) for use in ``where``."""
    return F.when(cond, F.lit(True)).otherwise(F.raise_error(F.lit(message)))
