"""Boosters against a brute-force one in plain Python, and both forms against each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import boosting as bo

FEATURES = ["a", "b", "c"]


def table(spark, n=160, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(k, float(rng.integers(0, 9)), float(rng.normal()), float(rng.integers(0, 2)), k % 3) for k in range(n)]
    rows = [(*r, r[1] * 0.7 - 2 * r[3] + math.sin(3 * r[2]) + float(rng.normal()) * 0.1, int(r[2] > 0.2)) for r in rows]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, seg int, y double, z int").repartition(5), rows


def brute(rows, y, cuts, job, base, keys, scale):
    """(trees as nested tuples, predictions): every split of every node is tried by summing its rows."""
    p = job.params
    def leaf(g, h):
        w = -math.copysign(max(abs(g) - p.reg_alpha, 0.0), g) / (h + p.reg_lambda)
        return max(-p.max_delta_step, min(p.max_delta_step, w)) if p.max_delta_step else w
    def score(g, h):
        w = leaf(g, h)
        return -(2 * g * w + (h + p.reg_lambda) * w * w + 2 * p.reg_alpha * abs(w))
    pred, trees = [base] * len(rows), []
    for t in range(p.n_estimators):
        columns = bo.tree_columns(job, len(cuts), t)
        mine = bo.sampled(np.array(keys, np.int64), p, t)
        if job.objective == "logistic":
            q = [1 / (1 + math.exp(-m)) for m in pred]
            gh = [(round((a - b) * scale) / scale, round(a * (1 - a) * scale) / scale) for a, b in zip(q, y)]
        else:
            gh = [(round((a - b) * scale) / scale, 1.0) for a, b in zip(pred, y)]

        def node(own, depth, every):
            g, h = sum(gh[i][0] for i in own), sum(gh[i][1] for i in own)
            best = None
            if depth < p.max_depth:
                for f in columns:
                    for cut in cuts[f]:
                        left = [i for i in own if rows[i][f] < cut]
                        lg, lh = sum(gh[i][0] for i in left), sum(gh[i][1] for i in left)
                        if lh <= 0 or h - lh <= 0 or lh < p.min_child_weight or h - lh < p.min_child_weight:
                            continue
                        gain = score(lg, lh) + score(g - lg, h - lh) - score(g, h)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, int(f), cut)
            if best is None or best[0] <= 1e-6 or best[0] < p.gamma:
                for i in every:
                    pred[i] += leaf(g, h) * p.learning_rate
                return round(leaf(g, h) * p.learning_rate, 9)
            _, f, cut = best
            sides = [([i for i in s if rows[i][f] < cut], [i for i in s if rows[i][f] >= cut]) for s in (own, every)]
            return f, round(cut, 9), node(sides[0][0], depth + 1, sides[1][0]), node(sides[0][1], depth + 1, sides[1][1])

        trees.append(node([i for i in range(len(rows)) if mine[i]], 0, list(range(len(rows)))))
    return trees, pred


def nested(tree, k=0):
    inner = len(tree.feature)
    if k >= inner:
        return round(tree.value[k - inner], 9)
    if tree.cut[k] == math.inf:
        return nested(tree, 2 * k + 1)
    return tree.feature[k], round(tree.cut[k], 9), nested(tree, 2 * k + 1), nested(tree, 2 * k + 2)


PARAMS = [
    dict(),
    dict(subsample=1.0, colsample=1.0, reg_alpha=0.0, reg_lambda=0.0),
    dict(reg_alpha=5.0, reg_lambda=9.0, gamma=0.4, min_child_weight=12.0),
    dict(max_delta_step=0.2, reg_alpha=1.0, colsample=0.4, subsample=0.5, seed=7),
]


def jobs_of(n=5, depth=3):
    out = [bo.Job(f"m{i}", "all", "y", bo.BoostParams(n_estimators=n, max_depth=depth, **p)) for i, p in enumerate(PARAMS)]
    out.append(bo.Job("seg1", "one", "y", bo.BoostParams(n_estimators=n, max_depth=2), columns=(0, 2)))
    return out + [bo.Job("odds", "all", "z", bo.BoostParams(n_estimators=n, max_depth=depth, min_child_weight=0.5), "logistic"), bo.Job("none", "no", "y")]


def fit(spark, df, **kw):
    views = {"all": F.lit(True), "one": F.col("seg") == 1, "no": F.lit(False)}
    return bo.fit_many(df, FEATURES, jobs_of(), views, {"y": F.col("y"), "z": F.col("z")}, key=["k"], **kw)


def test_both_forms_equal_brute_force(spark):
    df, _ = table(spark)
    got = {r.model: r for r in fit(spark, df).collect()}
    level = {r.model: r for r in fit(spark, df, rows_in_task=0).collect()}
    assert got == level and got["none"].trees == [] and set(got) == {j.model for j in jobs_of()}
    rows = df.withColumn("h", F.xxhash64("k")).collect()
    for job in jobs_of()[:-1]:
        own = [r for r in rows if job.view == "all" or r.seg == 1]
        x = [(r.a, r.b, r.c) for r in own]
        cuts = [sorted(set(np.sort([v[f] for v in x])[[max(0, math.ceil(k / 64 * len(x)) - 1) for k in range(64)]])) for f in range(3)]
        y = [r[job.label] for r in own]
        mean = sum(y) / len(y)
        base = math.log(mean / (1 - mean)) if job.objective == "logistic" else mean
        assert math.isclose(base, got[job.model].base, rel_tol=1e-12)
        trees, pred = brute(x, y, cuts, job, got[job.model].base, [r.h for r in own], 2.0**30)
        for a, b in zip(trees, got[job.model].trees):
            assert repr_close(a, nested(b)), (job.model, a, nested(b))
        scored = bo.score_forests(df, spark.createDataFrame([got[job.model]], bo.FOREST), FEATURES, F.lit(job.model), "p")
        by_key = {r.k: r.p for r in scored.collect()}
        link = (lambda m: 1 / (1 + math.exp(-m))) if job.objective == "logistic" else float
        assert all(math.isclose(by_key[r.k], link(m), rel_tol=1e-6, abs_tol=1e-6) for r, m in zip(own, pred))


def repr_close(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return math.isclose(a, b, abs_tol=1e-6)
    return a[0] == b[0] and math.isclose(a[1], b[1], abs_tol=1e-9) and repr_close(a[2], b[2]) and repr_close(a[3], b[3])


def test_regularisation_changes_leaves_as_the_formula_says(spark):
    df, rows = table(spark)
    one = lambda **kw: bo.fit_many(df, FEATURES, [bo.Job("m", "all", "y", bo.BoostParams(n_estimators=1, max_depth=0, learning_rate=1.0, subsample=1.0, **kw))],
                                   {"all": F.col("seg") == 0}, {"y": F.col("y") + 3}, key=["k"]).first()
    y = [r[5] + 3 for r in rows if r[4] == 0]
    base = sum(y) / len(y)
    assert abs(one(reg_alpha=0.0, reg_lambda=0.0).trees[0].value[0]) < 1e-6  # the mean is right already
    p = bo.BoostParams(reg_alpha=2.0, reg_lambda=3.0)
    assert math.isclose(float(bo.leaf(-10.0, 5.0, p)), 1.0) and math.isclose(float(bo.leaf(1.5, 5.0, p)), 0.0)
    assert math.isclose(float(bo.leaf(-10.0, 5.0, bo.BoostParams(reg_alpha=2.0, reg_lambda=3.0, max_delta_step=0.25))), 0.25)
    assert math.isclose(float(bo.score(-10.0, 5.0, p)), 8.0**2 / 8.0)
    assert math.isclose(one().base, base, rel_tol=1e-12)


def test_rows_choose_their_model_in_one_scan(spark):
    df, _ = table(spark)
    forests = fit(spark, df)
    model = F.when(F.col("seg") == 1, "seg1").when(F.col("seg") == 2, "odds").when(F.col("k") > 100, "gone").otherwise("m0")
    out = bo.score_forests(df, forests, FEATURES, model, "p")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Union" not in plan and plan.count("FileScan") <= 1  # the forest table's
    each = {m: {r.k: r.p for r in bo.score_forests(df, forests, FEATURES, F.lit(m), "p").collect()} for m in ("seg1", "odds", "m0")}
    for r in out.withColumn("m", model).collect():
        assert r.p == (None if r.m == "gone" else each[r.m][r.k])


@pytest.mark.parametrize("rows_in_task", [bo.ROWS_IN_TASK, 0])
def test_null_labels_constant_features_and_empty_tables(spark, rows_in_task):
    rows = [(k, 1.0, float(k % 5), 0.0, None if k % 4 == 0 else float(k % 5)) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double")
    job = [bo.Job("m", "all", "y", bo.BoostParams(n_estimators=12, max_depth=2, subsample=1.0, colsample=1.0, learning_rate=0.5, reg_alpha=0.0))]
    forests = bo.fit_many(df, FEATURES, job, {"all": F.lit(True)}, {"y": F.col("y")}, key=["k"], rows_in_task=rows_in_task)
    errors = [abs(r.p - r.k % 5) for r in bo.score_forests(df, forests, FEATURES, F.lit("m"), "p").collect()]
    assert max(errors) < 0.3
    none = bo.fit_many(df.limit(0), FEATURES, job, {"all": F.lit(True)}, {"y": F.col("y")}, key=["k"], rows_in_task=rows_in_task)
    assert [(r.base, r.trees) for r in none.collect()] == [(0.0, [])]
