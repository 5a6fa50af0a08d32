import pytest
from pyspark.sql import functions as F

from keelson.functions import expressions as X
from keelson.operators import checks


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_changed_is_three_valued(spark):
    rows = [
        ("a", "a", "n", "n"),  # equal
        ("a", "b", "n", "n"),  # differs
        (None, "b", "n", "n"),  # null vs value: not a change
        (None, "b", "n", "m"),  # null OR true -> true
        (None, None, None, None),
    ]
    got = _one(
        spark,
        X.changed([F.col("t1"), F.col("t2")], [F.col("s1"), F.col("s2")]),
        [(r[0], r[2], r[1], r[3]) for r in rows],
        "t1 string, t2 string, s1 string, s2 string",
    )
    assert got == [False, True, False, True, False]


def test_version_from_name(spark):
    names = ["00000000000000000012.json", "00000000000000000012.crc", "12.json", "0000000000000000001x.json", None]
    got = _one(spark, X.version_from_name("n"), [(n,) for n in names], "n string")
    assert got == [12, None, None, None, None]


def test_basename_and_trims(spark):
    data = [("a/b/c",), ("/a/b/",), ("c",), ("",), (None,)]
    assert _one(spark, X.path_basename("p"), data, "p string") == ["c", "", "c", "", None]
    assert _one(spark, X.trim_slashes("p"), data, "p string") == ["a/b/c", "a/b", "c", "", None]
    assert _one(spark, X.rtrim_slashes("p"), data, "p string") == ["a/b/c", "/a/b", "c", "", None]


def test_azure_uri_rewrite_and_error(spark):
    ok = [("abfss://lake@acct.dfs.core.windows.net/sales/tx",), ("abfss://c@h/p/q//",)]
    got = _one(spark, X.azure_blob_uri("u", "acc"), ok, "u string")
    assert got == [
        "azure://acc.blob.core.windows.net/lake/sales/tx/",
        "azure://acc.blob.core.windows.net/c/p/q/",
    ]
    with pytest.raises(Exception, match="invalid ADLS URI"):
        _one(spark, X.azure_blob_uri("u", "acc"), [("s3://bucket/x",)], "u string")


def test_numeric_cast_and_strict_date(spark):
    from decimal import Decimal

    got = _one(spark, X.to_numeric("a"), [(Decimal("89.99"),)], "a decimal(18,2)")
    assert got == [Decimal("89.990000000")]
    assert str(_one(spark, X.to_date_strict("d"), [("2024-01-17",)], "d string")[0]) == "2024-01-17"
    with pytest.raises(Exception):
        _one(spark, X.to_date_strict("d"), [("2024-02-30x",)], "d string")


def test_key_checks(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    dups = {r["k"]: r["n"] for r in checks.duplicate_keys(df, "k").collect()}
    assert dups == {"a": 2}
    with pytest.raises(Exception, match="NOT NULL"):
        checks.not_null_rows(df, "k").select(F.lit(1)).collect()
    assert checks.not_null_rows(df.where("k is not null"), "k").count() == 3
