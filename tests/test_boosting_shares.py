"""Large models in one task: rows in a file, shares of processes, borders of many views from one sort."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import boosting as bo


def model(n=6000, objective="squared"):
    rng = np.random.default_rng(9)
    bins = rng.integers(0, 64, (6, n)).astype(np.uint8)
    bins[4], bins[5] = bins[1], 1  # one cuts alike, one is the same everywhere
    y = bins[0] * 0.2 - bins[1] % 5 + rng.normal(size=n)
    return rng.integers(-2**62, 2**62, n), bins, (y > 3).astype(float) if objective == "logistic" else y, bo.Job("m", "all", "y", bo.BoostParams(n_estimators=5, max_depth=4), objective)


@pytest.mark.parametrize("objective", ["squared", "logistic"])
def test_processes_that_share_the_rows_grow_the_same_trees(monkeypatch, objective):
    key, bins, y, job = model(objective=objective)
    asked, together = [], bo.together
    monkeypatch.setattr(bo, "together", lambda workers, work: asked.append(workers) or together(workers, work))
    one, more = (bo.grow_forest(key, bins, y, job, 0.1, 2.0**20, workers) for workers in (1, 4))
    assert one == more and asked == [4] and any(f >= 0 for t in one for f in t.feature)
    few = slice(0, 3)  # a process without rows says so too
    assert bo.grow_forest(key[few], bins[:, few], y[few], job, 0.1, 2.0**20, 4) == bo.grow_forest(key[few], bins[:, few], y[few], job, 0.1, 2.0**20)


def test_a_process_that_fails_ends_the_model():
    def work(k, gather):
        if k == 2:
            raise ValueError("no more")
        return gather(b"a") and gather(b"b")

    with pytest.raises((EOFError, OSError)):
        bo.together(3, work)


def test_rows_of_a_model_lie_in_a_file_that_goes_with_them(monkeypatch, tmp_path):
    key, bins, y, job = model()
    monkeypatch.setattr(bo.tempfile, "tempdir", str(tmp_path))
    plain = bo.grow_forest(key, bins, y, job, 0.1, 2.0**20)
    monkeypatch.setattr(bo, "_IN_FILE", 0)
    held = bo.array_of(bins.shape, np.uint8)
    held[:] = bins
    assert not os.listdir(tmp_path) and str(tmp_path) in open("/proc/self/maps").read()
    assert bo.grow_forest(key, held, y, job, 0.1, 2.0**20) == plain
    del held
    assert str(tmp_path) not in open("/proc/self/maps").read()


def base_of(spark, n):
    df = spark.range(n, numPartitions=3).select((F.xxhash64("id") % 997).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 3).alias("c"))
    return df.select(F.array("a", "b").alias("x"), F.when(F.col("c") == 0, "0").when(F.col("c") == 1, "0,1").otherwise("1,2").alias("within"))


def test_borders_of_views_that_share_rows_are_their_quantiles(spark):
    base = base_of(spark, 3000)
    got = {(r.view, r.feature): r.cuts for r in bo.borders(base, 2).collect()}
    rows = base.collect()
    for view in range(3):
        for f in range(2):
            v = sorted(r.x[f] for r in rows if str(view) in r.within.split(","))
            assert got[view, f] == sorted({v[max(1, math.ceil(k / 64 * len(v))) - 1] for k in range(64)})


def test_borders_of_many_rows_are_near_their_quantiles(spark, monkeypatch):
    monkeypatch.setattr(bo, "_POINTS", 256)
    monkeypatch.setattr(bo, "_SORTED", 4000)
    base = spark.range(60_000, numPartitions=2).select(F.array((F.xxhash64("id") % 2**40).cast("double")).alias("x"), F.lit("0").alias("within"))
    cuts, v = bo.borders(base, 1).first().cuts, np.sort([r.x[0] for r in base.collect()])
    at = np.searchsorted(v, cuts, side="right")
    assert len(cuts) == 64 and at[0] == 1 and np.abs(at[1:] - np.arange(1, 64) / 64 * len(v)).max() <= len(v) / (2 * 256) + 1


def test_blocks_of_views_have_the_bins_of_their_own_borders():
    import pyarrow as pa

    rng, n = np.random.default_rng(2), 5000
    x = np.column_stack([rng.integers(0, 90, n), rng.normal(size=n)]).astype(float)
    within = np.array(["0", "0,1", "1"])[rng.integers(0, 3, n)]
    cuts = {0: [[0.0, 3.0, 50.0], [-1.0, 0.5], [0.0]], 1: [[3.0, 4.0, 89.0], [], [0.0]]}
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(x.tolist()), pa.array([[float(k)] for k in range(n)]), pa.array(within)], names=["key", "x", "y", "within"])
    seen = {0: 0, 1: 0}
    for out in bo._cut(cuts, 2)(iter([batch.slice(0, 2000), batch.slice(2000)])):
        for view, key, bins, y, _ in bo._blocks(out):
            seen[view] += len(key)
            assert (y[0] == key).all() and all(str(view) in w.split(",") for w in within[key]) and (bins[2] == 1).all()
            for f in range(2):
                assert (bins[f] == np.searchsorted(cuts[view][f], x[key, f], side="right")).all()
    assert seen == {v: sum(str(v) in w.split(",") for w in within) for v in seen}


def test_few_and_many_rows_get_the_same_borders(spark, monkeypatch):
    df = spark.range(3000, numPartitions=3).select(F.col("id").alias("k"), (F.xxhash64("id") % 997).cast("double").alias("a"), F.lit(0.0).alias("z"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 5).cast("double").alias("y"))
    views = {"all": F.lit(True), "odd": F.col("k") % 2 == 1, "none": F.lit(False)}
    jobs = [bo.Job(v, v, "y", bo.BoostParams(n_estimators=2, max_depth=3)) for v in views]
    taken, borders = [], bo.borders
    monkeypatch.setattr(bo, "borders", lambda *a: taken.append(1) or borders(*a))

    def forests(rows):
        monkeypatch.setattr(bo, "_FEW_ROWS", rows)
        return sorted(bo.fit_many(df, ["a", "z", "b"], jobs, views, {"y": F.col("y")}, key=["k"], zero=["z"]).collect())

    few = forests(10_000)
    assert not taken and few == forests(10) and taken == [1]
