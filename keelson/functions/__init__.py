from keelson.functions.expressions import (  # noqa: F401
    NUMERIC,
    assert_not_null,
    assert_that,
    azure_blob_uri,
    changed,
    path_basename,
    rtrim_slashes,
    to_date_strict,
    to_lake_amount,
    to_numeric,
    trim_slashes,
    version_from_name,
)
