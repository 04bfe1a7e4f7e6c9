"""Driver contract: entry() and a mini version of the DuckDB correctness gate."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from panelforge.sources.tables import TABLES

SAMPLE = ["weekly_backtest", "collapse_periods", "policy_split", "asof_latest", "calibration_select",
          "merge_upsert", "parse_players", "validation_report", "dataset_fingerprint", "stream_event_rollup"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "top_k_hit_rate" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_duckdb_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    s = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    d = sorted(tuple(str(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert sorted(names) == cols
    assert s == d
