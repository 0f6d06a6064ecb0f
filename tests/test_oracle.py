"""Every registered query equals its DuckDB twin (sf0.001; the driver's
check runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest

from conftest import SF_SMALL

from attrlake.plans import queries as Q

NAMES = sorted(Q.all_queries())


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cols, orows = duck(SF_SMALL, E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(cols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["event_date", "app_token", "tracker", "reporting_currency"]
