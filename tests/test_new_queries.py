"""Every query of the newer modules against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from kgloom.plans import area_queries, causal_queries, clinical_queries, complex_queries, migration_queries, mitab_queries, ptm_queries, sequence_queries, trial_queries, variant_queries
from kgloom.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
MODULES = {m.__name__ for m in (area_queries, causal_queries, clinical_queries, complex_queries, migration_queries, mitab_queries, ptm_queries, sequence_queries, trial_queries, variant_queries)}
NAMES = sorted(n for n, f in QUERIES.items() if f.__module__ in MODULES)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    tell = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([tell(r[k]) for k in order] for r in values), key=str)


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    found = sql.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, map(tuple, df.collect())) == rows(columns, found.fetchall())


def test_every_query_has_sql():
    assert NAMES and set(QUERIES) == set(ORACLE_SQL)
