import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from attrlake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()

    def run(sf_dir, sql):
        c = duckdb.connect()
        for t in ("events", "lineitem", "orders"):
            c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
        res = c.execute(sql)
        return [d[0] for d in res.description], res.fetchall()

    yield run
    con.close()
