"""Every registered query against its SQL oracle (DuckDB) on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from ledgerline.plans.registry import REGISTRY  # noqa: E402
from oracle_check import canon, duck, type_mismatches  # noqa: E402

from conftest import SMALL  # noqa: E402

#: The library's own queries; those of removable subpackages are tested there.
NAMES = sorted(set(E.oracle_sql()) & set(REGISTRY))


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert type_mismatches(df, res) == []
    assert len(rows) == len(expected)
    assert canon(df.columns, rows) == canon(cols, expected)


def test_every_query_has_oracle_or_is_rows_only(spark):
    assert set(REGISTRY) - set(E.oracle_sql()) == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ship_to_city_cd", "order_hour_pst", "total_sales"]
    assert df.count() > 0
