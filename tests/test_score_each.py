"""Scores of several models a row, and models that differ in their names alone."""

import numpy as np
from pyspark.sql import functions as F

from panelforge.operators import boosting as bo
from panelforge.operators import models as mo
from test_boosting import FEATURES, fit, table


def test_scores_of_several_models_a_row_equal_the_expression_to_the_bit(spark, monkeypatch):
    monkeypatch.setattr(bo, "_SCORED", 64)
    monkeypatch.setattr(bo, "_WALKED", 50)
    df, _ = table(spark)
    forests = fit(spark, df)
    df = df.withColumn("a", F.when(F.col("k") % 7 != 0, F.col("a"))).withColumn("b", F.when(F.col("k") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("b")))
    names = sorted(r.model for r in forests.collect())
    models = {f"p_{m}": F.lit(m) for m in names} | {"p_none": F.lit("none"), "p_mixed": F.when(F.col("k") % 2 == 0, names[0]).when(F.col("k") % 3 == 0, names[-1])}
    one = bo.score_each(df, forests, FEATURES, models)
    other = df
    for out, m in models.items():
        other = bo.score_forests(other, forests, FEATURES, m, out)
    rows = lambda d: sorted(tuple(r) for r in d.select("k", *models).na.fill(-1e300).collect())
    assert rows(one) == rows(other) and one.columns == other.columns


def test_leaves_of_deep_and_bare_trees_are_those_of_a_walk():
    rng = np.random.default_rng(8)
    x = np.where(rng.random((4, 3000)) < 0.05, np.nan, rng.normal(size=(4, 3000)))
    for depth in (1, 5, 9):
        inner = 2**depth - 1
        feature, cut = rng.integers(0, 4, inner).tolist(), np.where(rng.random(inner) < 0.2, np.inf, rng.normal(size=inner).round(1)).tolist()
        value = rng.normal(size=inner + 1)
        for k in range(inner):  # below a node without a cut both sides are the same
            if cut[k] == np.inf:
                lo, hi = 2 * k + 1, 2 * k + 2
                while lo < inner:
                    for a in range(lo, hi + 1):
                        cut[a] = np.inf
                    lo, hi = 2 * lo + 1, 2 * hi + 2
                value[lo - inner: hi - inner + 1] = value[lo - inner]
        cuts, ((root, values),) = bo._by_places([(feature, cut, value.tolist())])
        place = {f: np.searchsorted(c, x[f], side="right").astype(np.uint8) for f, c in cuts.items()}
        node = np.zeros(3000, int)
        for _ in range(depth):
            node = 2 * node + 2 - (x[np.array(feature)[node], np.arange(3000)] < np.array(cut)[node])
        got = values.take(bo._leaves(root, place)) if isinstance(root, tuple) else np.full(3000, values[root])
        assert (got == value[node - inner]).all()


def test_models_that_differ_in_their_names_alone_are_grown_once(spark, monkeypatch):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("y"))
    p, other = bo.BoostParams(n_estimators=2, max_depth=2), bo.BoostParams(n_estimators=3, max_depth=2)
    jobs = [bo.Job("m", "all", "y", p), bo.Job("n", "all", "y", p), bo.Job("o", "all", "y", other), bo.Job("gone", "none", "y", p), bo.Job("gone too", "none", "y", p)]
    grown, in_tasks = [], bo._in_tasks
    monkeypatch.setattr(bo, "_in_tasks", lambda blocks, plan, *rest: grown.append(len(plan)) or in_tasks(blocks, plan, *rest))
    rows = {r.model: r for r in bo.fit_many(df, ["a"], jobs, {"all": F.lit(True), "none": F.lit(False)}, {"y": F.col("y")}, key=["k"]).collect()}
    assert grown == [2] and sorted(rows) == sorted(j.model for j in jobs)
    assert rows["m"].trees == rows["n"].trees and len(rows["o"].trees) == 3 and rows["gone too"].trees == []


def test_variants_are_scored_before_their_rows_are_copied(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("player_id"), (F.col("id") % 9 + 1).cast("int").alias("gameweek_id"), (F.col("id") % 4 + 1).cast("int").alias("position_id"),
                                 (F.col("id") % 23).cast("double").alias("total_points"), (F.col("id") % 6).cast("double").alias(mo.TARGET), (F.col("id") % 91).cast("double").alias(mo.MINUTES_TARGET))
    variants = {v: ["total_points", "gameweek_id"] for v in ("shared_no_minute_bands", "per_position_models", "two_stage_minutes_points")}
    bundles, feats = mo.fit_variants(variants, df, bo.BoostParams(n_estimators=4, max_depth=2))
    seen, each = [], bo.score_each
    monkeypatch.setattr(bo, "score_each", lambda rows, *rest: seen.append(rows.count()) or each(rows, *rest))
    got = {(r.model, r.player_id): r.p for r in mo.predict_variants(bundles, df, feats, "p").collect()}
    assert seen == [400] and len(got) == 1200
    for v, bundle in bundles.items():
        for r in mo.predict_variant(bundle, df, feats, "p").collect():
            assert got[v, r.player_id] == r.p
