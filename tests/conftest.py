import os
import sys
import tempfile
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lumenreg.session import get_session

    s = get_session("local[*]", app_name="lumenreg-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint dir only when the session has none
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lumenreg-test-ckpt-"))
    yield s


@contextmanager
def sql_conf(spark, settings):
    """Set SQL confs inside the block, then restore them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        yield spark
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="lumenreg-test-")


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations"]:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return connect
