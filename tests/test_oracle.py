"""Every registered query against its DuckDB SQL (the driver's gate), at sf0.001.

The full run at sf0.01 is `python tests/oracle_check.py /root/testdata/sf0.01`.
"""

import pytest

from conftest import SF001
from oracle_check import compare, duck

from __spark_entry__ import entry
from weblake import oracle
from weblake.queries import registered as queries


def oracle_sql():
    return {k: v for k, v in oracle.queries().items() if k in queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total > 0
    assert df.columns == ["total", "unique_ips", "avg_bytes", "server_error_rate", "client_error_rate"]


def test_every_query_has_oracle_or_is_documented():
    missing = set(queries()) - set(oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF001, name, queries()[name], oracle_sql().get(name), con)
    assert r["status"] in ("ok", "rows-only"), r
