"""The model queries against a brute-force booster in plain Python (few trees, whole tables)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from panelforge.operators import boosting as bo
from panelforge.operators import features as fe
from panelforge.operators import models as mo
from panelforge.plans import q_models as q
from test_boosting import brute

FEW = mo.GBTParams(n_estimators=2, max_depth=2)
slog = lambda v: math.copysign(math.log1p(abs(v)), v)
sexp = lambda v: math.copysign(math.expm1(abs(v)), v)


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(q, "PARAMS", FEW)


def walk(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
    return tree


def fitted(rows, feats, y, objective="squared", columns=None):
    """A function from a row to the brute-force booster's margin."""
    x = [tuple(float(r[f] or 0.0) if f in r else 0.0 for f in feats) for r in rows]
    cuts = [sorted(set(np.sort([v[f] for v in x])[[max(0, math.ceil(k / 64 * len(x)) - 1) for k in range(64)]])) for f in range(len(feats))]
    mean = sum(y) / len(y)
    base = math.log(mean / (1 - mean)) if objective == "logistic" else mean
    trees, _ = brute(x, y, cuts, bo.Job("m", "v", "l", FEW, objective, columns), base, [r["h"] for r in rows], 2.0**36)
    return lambda r: base + sum(walk(t, tuple(float(r[f] or 0.0) if f in r else 0.0 for f in feats)) for t in trees)


def panel(spark):
    rows = [r.asDict() for r in q.model_panel(spark, SF001).withColumn("h", F.xxhash64("player_id", "gameweek_id")).collect()]
    return [r for r in rows if r["role"] == "train"], [r for r in rows if r["role"] == "holdout"]


def same(rows, holdout, score):
    got = {(r.player_id, r.gameweek_id): r.predicted_points for r in rows}
    assert len(got) == len(holdout)
    for r in holdout:
        assert math.isclose(got[r["player_id"], r["gameweek_id"]], score(r), rel_tol=1e-5, abs_tol=2e-6)


def test_train_shared(spark, few):
    train, holdout = panel(spark)
    model = fitted(train, fe.select_features("shared_no_minute_bands"), [slog(r[q.ACT]) for r in train])
    same(q.q_train_shared(spark, SF001).collect(), holdout, lambda r: sexp(model(r)))


def test_train_per_segment(spark, few):
    train, holdout = panel(spark)
    feats = fe.select_features("per_position_models")
    own = {s: [r for r in train if r["position_id"] == s] for s in {r["position_id"] for r in train}}
    models = {s: fitted(rows, feats, [slog(r[q.ACT]) for r in rows]) for s, rows in own.items()}
    same(q.q_train_per_segment(spark, SF001).collect(), holdout, lambda r: sexp(models[r["position_id"]](r)))


def test_train_two_stage(spark, few):
    train, holdout = panel(spark)
    feats = fe.select_features("two_stage_minutes_points")
    chance = fitted(train, feats, [float(r["target_next_gw_minutes"] >= 60) for r in train], "logistic")
    long = [r for r in train if r["target_next_gw_minutes"] >= 60]
    points = fitted(long, feats, [slog(r[q.ACT]) for r in long])
    same(q.q_train_two_stage(spark, SF001).collect(), holdout, lambda r: sexp(points(r)) / (1 + math.exp(-chance(r))))


def test_cv_mae(spark, few):
    train, _ = panel(spark)
    feats, weeks = fe.select_features(q.VARIANT), sorted({r["target_gameweek_id"] for r in train})
    size, maes = len(weeks) // 6, []
    rows = {r.fold: r for r in q.q_cv_mae(spark, SF001).collect()}
    for k in range(5):
        lo = len(weeks) - (5 - k) * size
        fit = [r for r in train if r["target_gameweek_id"] in weeks[:lo]]
        test = [r for r in train if r["target_gameweek_id"] in weeks[lo:lo + size]]
        model = fitted(fit, feats, [slog(r[q.ACT]) for r in fit])
        maes.append(sum(abs(r[q.ACT] - sexp(model(r))) for r in test) / len(test))
        assert rows[k].n == len(test) and math.isclose(rows[k].mae, maes[-1], abs_tol=1e-5)
    assert math.isclose(rows[0].cv_mae_mean, sum(maes) / 5, abs_tol=1e-5) and math.isclose(rows[0].cv_mae_std, float(np.std(maes)), abs_tol=1e-5)


def test_variants_scored_in_one_scan_equal_each_alone(spark, few):
    m = q.model_panel(spark, SF001)
    tr, ho = m.filter("role = 'train'"), m.filter("role = 'holdout'")
    bundles, feats = mo.fit_variants({v: fe.select_features(v) for v in fe.EXPERIMENT_VARIANTS}, tr, FEW)
    together = {(r.model, r.player_id, r.gameweek_id): r.predicted_points for r in mo.predict_variants(bundles, ho, feats).collect()}
    for v, bundle in bundles.items():
        for r in mo.predict_variant(bundle, ho, feats).collect():
            assert together[v, r.player_id, r.gameweek_id] == r.predicted_points
    assert len(together) == ho.count() * len(bundles)


def test_stored_text_segments_and_evaluation(spark, few, tmp_path):
    m = q.model_panel(spark, SF001).withColumn("position_id", F.concat(F.lit("line "), F.col("position_id").cast("string")))
    feats = fe.select_features("per_position_models")
    bundle = mo.fit_variant("per_position_models", m, feats, FEW)
    loaded, meta = mo.load_model(spark, mo.save_model(bundle, feats, str(tmp_path / "m"), {"note": 1}))
    assert meta["note"] == 1 and set(loaded[1]) == set(bundle[1])
    key = lambda df: sorted((r.player_id, r.gameweek_id, r.predicted_points) for r in df.collect())
    assert key(mo.predict_variant(loaded, m, feats)) == key(mo.predict_variant(bundle, m, feats))
    row = q.q_stored_model_eval(spark, SF001).first()
    assert row.n > 0 and row.rmse >= row.mae > 0 and row.ready in (True, False)


def test_point_in_time_models_see_only_earlier_targets(spark, few):
    rows = q.q_pit_backfill_model(spark, SF001).collect()
    assert all(r.backfill_trusted for r in rows)


def test_score_latest_builds_live_rows_once(spark, monkeypatch):
    built, rows_of = spark.sparkContext.accumulator(0), q.inference_rows

    @F.udf("boolean")
    def seen(_):
        built.add(1)
        return True

    monkeypatch.setattr(q, "PARAMS", mo.GBTParams(n_estimators=2))
    monkeypatch.setattr(q, "inference_rows", lambda *a: rows_of(*a).filter(seen("player_id")))
    assert q.q_score_latest(spark, SF001).collect()
    assert 0 < built.value <= q.tb.fixture_rows(spark, SF001).count()  # the condition moves down to the raw rows
