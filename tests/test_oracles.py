"""The correctness gate in miniature: every registered query vs its DuckDB oracle at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF001

# PLUME_ORACLE_SF=/root/testdata/sf0.1 runs the same gate at a larger scale
SF_DIR = os.environ.get("PLUME_ORACLE_SF", SF001)

TABLES = ("events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_DIR, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert len(srows) == len(orows)
    assert srows == orows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_query_has_a_name_and_entry_runs(spark):
    assert len(QUERIES) >= 60
    assert entry.entry(spark).count() == 6
