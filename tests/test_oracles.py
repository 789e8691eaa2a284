"""Every query with SQL against DuckDB on the smallest sample."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect
from conftest import SMALL

from tripwell import catalog


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, SMALL)
    cursor = con.execute(catalog.oracle_sql()[name])
    problem = compare([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(),
                      [d[0] for d in cursor.description])
    assert problem is None, problem


def test_every_oracle_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


# Queries with samples, caps or rounds, which the smallest sample does not reach.
AT_SCALE = ("sample_capped", "sample_without_replacement_n", "limit_rows", "scan_csv_first_n", "lloyd_kmeans",
            "silhouette_euclid", "cluster_report", "filter_quantile_band", "actual_vs_predicted")


@pytest.mark.parametrize("name", AT_SCALE)
def test_query_equals_sql_on_a_larger_sample(spark, name):
    larger = "/root/testdata/sf0.01"
    df = catalog.queries()[name](spark, larger)
    cursor = connect(larger).execute(catalog.oracle_sql()[name])
    problem = compare([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(),
                      [d[0] for d in cursor.description])
    assert problem is None, problem
