"""As-of / latest / dedup and the two-sample KS statistic vs brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from panelforge.operators import asof as ao
from panelforge.operators import drift as dr


def test_asof_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for p in range(6):
        for g in sorted(rnd.sample(range(1, 15), 6)):
            rows.append((p, g, float(rnd.randrange(100))))
    df = spark.createDataFrame(rows, "player_id int, gameweek_id int, v double")
    got = {(r.player_id, r.target_gameweek_id): (r.source_gameweek_id, r.v) for r in ao.asof_latest(df).collect()}
    lo, hi = min(g for _, g, _ in rows), max(g for _, g, _ in rows)
    want = {}
    for t in range(lo + 1, hi + 2):
        for p in range(6):
            cand = [(g, v) for pp, g, v in rows if pp == p and g <= t - 1]
            if cand:
                want[(p, t)] = max(cand)
    assert got == want


def test_latest_and_dedup(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "player_id int, gameweek_id int, x string")
    assert sorted((r.player_id, r.x) for r in ao.latest_per_entity(df).collect()) == [(1, "b"), (2, "c")]
    d = spark.createDataFrame([(1, 1, 5, "x"), (1, 1, 7, "y"), (1, 2, 1, "z")], "k1 int, k2 int, o int, v string")
    assert sorted(r.v for r in ao.dedup_latest(d, ["k1", "k2"], ["o"]).collect()) == ["y", "z"]


def _ks_numpy(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def test_ks_statistic_matches_brute_force(spark):
    rnd = np.random.default_rng(42)
    a = np.round(rnd.normal(0, 1, 300), 2)
    b = np.round(rnd.normal(0.3, 1.2, 200), 2)
    da = spark.createDataFrame([(float(x),) for x in a], "total_points double")
    db = spark.createDataFrame([(float(x),) for x in b], "total_points double")
    for buckets in (1, 8):
        r = dr.ks_two_sample(da, db, ["total_points"], buckets=buckets, with_p_value=True).collect()[0]
        assert abs(r.ks_stat - _ks_numpy(a, b)) < 1e-12
        assert 0.0 <= r.p_value <= 1.0
    dec = dr.drift_decision(dr.ks_two_sample(da, db, ["total_points"])).collect()[0]
    assert dec.breach_ratio == (1 / 3 if r.ks_stat > 0.2 else 0.0)
    forced = dr.drift_decision(dr.ks_two_sample(da, db, ["total_points"]), force_drift=True).collect()[0]
    assert forced.drift_triggered and F is not None
