import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="keelson-test-wh-")
    s = build_session(
        "local[8]",
        app_name="keelson-tests",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "8g"},
    )
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def own_temp_views(spark):
    """Drops the temporary views that a test made: SHOW TABLES lists them in every database."""
    views = lambda: {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = views()
    yield
    for name in views() - before:
        spark.catalog.dropTempView(name)
