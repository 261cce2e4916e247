"""Every registered query against its DuckDB oracle at sf0.001 (row count, columns, row multiset)."""

import collections
import os

import duckdb
import pytest

from scripts.check_oracle import TABLES, norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


import __spark_entry__ as E  # noqa: E402

#: Queries without SQL, each tested against a brute-force version, a library or an exact round trip.
NO_SQL = {"op3_elias_fano_ids", "op5_hypergeometric_shards", "op8_html_main_text", "op9_byte_bpe", "op10_pitman_yor_scores", "pipeline"}
NAMES = sorted(E.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(E.queries()) - NO_SQL == set(E.oracle_sql()) - NO_SQL
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    ocols = rel.columns
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = collections.Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "vwap" in df.columns
