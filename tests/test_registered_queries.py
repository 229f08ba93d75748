"""A few registered queries against their independent SQL; the driver compares all of them."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "supplier", "part", "orders", "lineitem", "customer")


def test_every_sql_belongs_to_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    own = {n for n in registry.queries() if n != "pipeline" and not re.match("op[0-9]", n)}  # the text operators are tested beside them
    assert own - set(registry.oracle_sql()) == {"gbt_forecast"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["quarantine", "daily_revenue", "recon_exceptions", "dq_results", "margin_features", "isolation_scores"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = registry.queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)
