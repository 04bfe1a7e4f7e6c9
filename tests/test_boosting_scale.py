"""Forms of the booster that let it grow: blocks, smaller sisters, trees walked by batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import boosting as bo
from test_boosting import FEATURES, fit, table


def test_rows_scored_in_batches_equal_the_expression_to_the_bit(spark):
    df, _ = table(spark)
    forests = fit(spark, df)
    df = df.withColumn("a", F.when(F.col("k") % 7 != 0, F.col("a"))).withColumn("b", F.when(F.col("k") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("b")))
    model = F.when(F.col("seg") == 1, "seg1").when(F.col("k") % 4 == 0, "odds").when(F.col("k") > 120, "gone").when(F.col("k") < 9, F.lit(None)).when(F.col("k") < 20, "none").otherwise("m0")
    rows = lambda score: {r.k: r.p for r in score(df, forests, FEATURES, model, "p").collect()}
    assert rows(bo.score_rows) == rows(bo.score_forests)


@pytest.mark.parametrize("flat", [256, 0])
def test_only_the_smaller_of_two_sisters_is_added_up(monkeypatch, flat):
    monkeypatch.setattr(bo, "_FLAT_NODES", flat)
    rng, n, seen, sums = np.random.default_rng(4), 5000, [], bo.sums
    bins = rng.integers(0, 64, (4, n)).astype(np.uint8)
    y = bins[0] * 0.3 - bins[1] % 7 + rng.normal(size=n)
    monkeypatch.setattr(bo, "sums", lambda bins, columns, slot, *rest: seen.append(int((slot >= 0).sum())) or sums(bins, columns, slot, *rest))
    params = bo.BoostParams(n_estimators=1, max_depth=4, subsample=1.0, colsample=1.0)
    tree, = bo.grow_forest(np.arange(n), bins, y, bo.Job("m", "all", "y", params), 0.0, 2.0**20)
    assert seen[0] == n and len(seen) == 4 and all(2 * s <= n for s in seen[1:])
    node = tree.nodes(bins)  # every leaf is the mean of its rows by the formula
    for k in np.unique(node):
        g = np.rint(-y[node == k] * 2.0**20).sum() / 2.0**20
        assert tree.value[k] == pytest.approx(float(bo.leaf(g, (node == k).sum(), params)) * 0.1, rel=1e-9)


def test_views_of_several_blocks_grow_the_same_trees_in_both_forms(spark):
    df = spark.range(40_000, numPartitions=3).select(F.col("id").alias("k"), *[(F.xxhash64("id", F.lit(i)) % 97).cast("double").alias(f) for i, f in enumerate(FEATURES)])
    df = df.withColumn("y", F.when(F.col("k") % 11 != 0, F.col("a") - F.col("b") * F.col("c") / 50))
    views = {"all": F.lit(True), "few": F.col("k") % 3 == 0}
    jobs = [bo.Job(v, v, "y", bo.BoostParams(n_estimators=2, max_depth=3)) for v in views]
    forests = [{r.model: r for r in bo.fit_many(df, FEATURES, jobs, views, {"y": F.col("y")}, key=["k"], rows_in_task=n).collect()} for n in (bo.ROWS_IN_TASK, 0)]
    assert forests[0] == forests[1] and all(any(c < float("inf") for c in t.cut) for r in forests[0].values() for t in r.trees)


def test_features_added_up_together_give_the_same_sums():
    rng = np.random.default_rng(3)
    bins = np.stack([rng.integers(0, w, 900) for w in (65, 1, 3, 64, 2, 65, 1, 40)]).astype(np.uint8)
    groups = bo.packed(bins)
    assert sorted(f for own, _, _ in groups for f in own) == list(range(8)) and len(groups) < 8
    columns, slot, g = np.array([0, 1, 2, 5, 7]), rng.integers(-1, 4, 900), rng.integers(-99, 99, 900).astype(float)
    for h in (8.0, rng.integers(1, 9, 900).astype(float)):
        assert (bo.sums(bins, columns, slot, g, h, 4, 65, groups) == bo.sums(bins, columns, slot, g, h, 4, 65)).all()


def test_rows_move_to_the_child_that_a_walk_gives():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 64, (6, 2000)).astype(np.uint8)
    for depth, kind in ((5, np.uint8), (9, np.int32)):
        tree, node, level = bo.Tree(), np.zeros(2000, kind), [0]
        for _ in range(depth):
            below = []
            for k in level:
                if rng.random() < 0.9:
                    child = len(tree.feature)
                    tree.feature[k], tree.bin[k], tree.child[k] = int(rng.integers(6)), int(rng.integers(64)), child
                    for column, v in ((tree.feature, -1), (tree.bin, 0), (tree.child, 0), (tree.value, 0.0), (tree.gain, 0.0)):
                        column += [v, v]
                    below += [child, child + 1]
            bo._stepped(node, bins, tree, level)
            level = below
        assert (node == tree._walked(bins)).all()


def test_features_that_cut_the_rows_alike_share_an_axis():
    rng = np.random.default_rng(6)
    one, other = rng.integers(1, 65, (2, 4000)).astype(np.uint8)
    bins = np.stack([one, other, one, np.ones(4000, np.uint8), other + np.uint8(1), one, np.zeros(4000, np.uint8)])
    groups = bo.packed(bins)
    assert len(groups) == 1 and sorted(groups[0][0]) == list(range(7))
    columns, slot, g = np.arange(7), rng.integers(-1, 5, 4000), rng.integers(-99, 99, 4000).astype(float)
    assert (bo.sums(bins, columns, slot, g, 8.0, 5, 66, groups) == bo.sums(bins, columns, slot, g, 8.0, 5, 66)).all()


@pytest.mark.parametrize("objective", ["squared", "logistic"])
def test_threads_give_the_same_trees(monkeypatch, objective):
    monkeypatch.setattr(bo, "_CHUNK", 900)
    rng, n = np.random.default_rng(7), 5003
    bins = rng.integers(0, 64, (5, n)).astype(np.uint8)
    y = (bins[0] + bins[1] % 7 > 40).astype(float)
    job = bo.Job("m", "all", "y", bo.BoostParams(n_estimators=4, max_depth=4), objective)
    one, more = (bo.grow_forest(np.arange(n), bins, y, job, 0.1, 2.0**20, threads) for threads in (1, 3))
    assert one == more and any(f >= 0 for t in one for f in t.feature)


def test_features_that_are_zero_everywhere_need_no_quantiles(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"), F.lit(0.0).alias("b"), (F.col("id") % 5).cast("double").alias("y"))
    job = [bo.Job("m", "all", "y", bo.BoostParams(n_estimators=3, max_depth=3))]
    passed, known = (bo.fit_many(df, ["a", "b"], job, {"all": F.lit(True)}, {"y": F.col("y")}, key=["k"], zero=zero).collect() for zero in ((), ["b"]))
    assert passed == known and passed[0]["splits"][0] > 0 == passed[0]["splits"][1]
