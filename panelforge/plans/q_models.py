"""Registered queries: model training / scoring (rows-only checks and brute-force
tests) and the point-in-time back-fill (oracle-checked with the heuristic predictor).

Fits use the library's defaults (200 trees).  All models of a query (segments,
stages, folds, variants, trials, targets) are jobs of one fit, rows name their
model and are scored in one scan, and evaluations group by the model.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.functions import signed_expm1
from panelforge.operators import asof as ao
from panelforge.operators import backtest as bt
from panelforge.operators import boosting as bo
from panelforge.operators import calibration as ca
from panelforge.operators import features as fe
from panelforge.operators import gates as gt
from panelforge.operators import metrics as me
from panelforge.operators import models as mo
from panelforge.operators import search as se
from panelforge.operators import split as sp
from panelforge.operators import squad as sq
from panelforge.operators.common import attach_row, materialize, round_doubles
from panelforge.plans.q_squad import squad_ctes
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.sources import tables as tb

PARAMS = mo.GBTParams()
TRIALS = 8
VARIANT = fe.DEFAULT_VARIANT
ACT = "target_next_gw_points"


def model_panel(spark, sf):
    """Engineered panel + train-stat z-scores + split; the panel is written before
    the split's bound and the statistics are taken, which would build it again."""
    p = materialize(fe.engineer_panel(tb.fixture_rows(spark, sf)))
    s = sp.temporal_split(p, 5)
    stats = fe.global_stats(s.filter(F.col("role") == "train"))
    return materialize(fe.zscore_apply(s, stats))


def _fit(spark, sf, variant=VARIANT):
    m = model_panel(spark, sf)
    feats = fe.select_features(variant)
    tr, ho = m.filter(F.col("role") == "train"), m.filter(F.col("role") == "holdout")
    bundle = mo.fit_variant(variant, tr, feats, PARAMS)
    return m, tr, ho, feats, bundle


def _pred_rows(pred):
    return round_doubles(pred.select("player_id", "gameweek_id", "target_gameweek_id", "position_id", "predicted_points", ACT))


@register("train_shared", "M1 M4")
def q_train_shared(spark, sf):
    _, _, ho, feats, bundle = _fit(spark, sf, "shared_no_minute_bands")
    return _pred_rows(mo.predict_variant(bundle, ho, feats))


@register("train_per_segment", "M2")
def q_train_per_segment(spark, sf):
    _, _, ho, feats, bundle = _fit(spark, sf, "per_position_models")
    return _pred_rows(mo.predict_variant(bundle, ho, feats))


@register("train_two_stage", "M3")
def q_train_two_stage(spark, sf):
    _, _, ho, feats, bundle = _fit(spark, sf, "two_stage_minutes_points")
    return _pred_rows(mo.predict_variant(bundle, ho, feats))


#: Trees of the fit that is grown level by level, some Spark jobs a tree.
LEVEL_PARAMS = bo.BoostParams(n_estimators=12, max_depth=4)


@register("train_by_levels", "M1 M5 (level-wise form)")
def q_train_by_levels(spark, sf):
    """The orders panel: a model of all but the last ten periods and one of all but the
    last twenty, grown together by (model, node, feature, bin); errors by period behind each."""
    rolled = fe.rolling_features(tb.panel_large(spark, sf), team=None)
    rows = materialize(fe.next_period_target(rolled, minutes="minutes_played"))
    last = rows.agg(F.max("target_gameweek_id")).first()[0] or 0  # one row
    feats = ["total_points", "three_week_players_roll_avg_points", "five_week_players_roll_avg_points", "gameweek_id"]
    before = {f"less_{k}": F.col("target_gameweek_id") <= last - k for k in (10, 20)}
    jobs = [bo.Job(v, v, "points", LEVEL_PARAMS) for v in before]
    forests = mo.fit_named(rows, feats, jobs, before, rows_in_task=0)
    named = rows.withColumn("model", F.explode(F.array(*map(F.lit, before))))
    named = named.filter(F.col("target_gameweek_id") > last - F.regexp_extract("model", r"\d+", 0).cast("int"))
    scored = bo.score_rows(mo.prepare(named, feats), forests, feats, F.col("model"), "__m").withColumn("predicted_points", signed_expm1("__m"))
    return round_doubles(mo.error_row(scored, by=["model", "target_gameweek_id"]))


@register("feature_importance", "A29")
def q_feature_importance(spark, sf):
    _, _, _, feats, bundle = _fit(spark, sf)
    return round_doubles(mo.feature_importance(bundle, feats, spark))


def inference_rows(spark, sf):
    """Every row with the model's features, the last one of each player too
    (training rows need a next target, scoring rows don't)."""
    rows = fe.rolling_features(fe.collapse_periods(tb.fixture_rows(spark, sf)))
    return fe.fill_numeric(fe.upside_features(fe.minutes_band(fe.segment_one_hot(rows))))


def live_rows(spark, sf):
    """Latest row of every player (periods > 3) and the period to be scored:
    the last one of the unfiltered data plus one."""
    live = ao.latest_per_entity(inference_rows(spark, sf).filter(F.col("gameweek_id") > 3))
    periods = tb.fixture_rows(spark, sf).filter(F.col("player_id").isNotNull())  # the collapse has the same ones
    return attach_row(live, periods.agg((F.max("gameweek_id") + 1).cast("int").alias("target_period")))


def evaluated(train, holdout, key: str = "model", strength=ca.CALIBRATION_STRENGTH, tolerance=ca.CALIBRATION_TOLERANCE):
    """Back-test summary, required-baseline comparison, selected calibration and
    publication gates of the predictions of each model that ``key`` names (M13, V3).

    ``train`` and ``holdout`` are scored rows (``predicted_points``); returns
    (summary, coefficients, selected calibration, gates), one row or set of rows a model."""
    by, rule = [key], gt.ModelRules().required_baseline
    # what is read below, not all features of each model's rows
    train = materialize(train.select(key, "position_id", ACT, "predicted_points"))
    holdout = materialize(holdout.select(key, "player_id", "position_id", "target_gameweek_id", "minutes_played", rule, ACT, "predicted_points"))
    coeffs = materialize(ca.fit_calibration(train, ACT, "predicted_points", strength=strength, by=by))
    long = ca.variant_long(holdout, ACT, "predicted_points", coeffs, by=by)
    selected = materialize(ca.select_variant(ca.calibration_report(long, by=by), tolerance, by=by))
    picked = holdout.join(selected.select(key, "selected_variant"), key)
    final = (ca.postprocess(picked, "predicted_points", "__final", variant=F.col("selected_variant"), coeffs=coeffs, by=by)
             .withColumn("predicted_points", F.col("__final")).drop("__final", "selected_variant"))
    both = final.withColumn("__who", F.explode(F.array(F.lit("m"), F.lit("b"))))  # the model's rows, and the baseline's
    both = materialize(both.withColumn("predicted_points", F.when(F.col("__who") == "m", F.col("predicted_points")).otherwise(F.coalesce(F.col(rule), F.lit(0.0)))))
    wk = bt.weekly_backtest(both, by=[key, "__who"], materialize_input=False)
    summ = materialize(bt.backtest_summary(both, wk, by=[key, "__who"]))
    own = summ.filter("__who = 'm'").drop("__who")
    side = lambda who: summ.filter(F.col("__who") == who).select(key, F.col("top_k_hit_rate_mean").alias(f"{who}_hit"), F.col("selected_xi_regret_mean").alias(f"{who}_regret"))
    better = (F.round("m_hit", 9) > F.round("b_hit", 9)) & (F.round("m_regret", 9) < F.round("b_regret", 9))
    baseline = side("m").join(side("b"), key).withColumn("baseline_gate_passed", better)
    gates = gt.publication_gates(own, baseline, selected.select(key, "selected_delta_mae", "selected_delta_rmse"), by=by)
    return own, coeffs, selected, gates


@register(
    "live_rows",
    "M11 W2 P10",
    rsql(
        with_panel()
        + """
SELECT player_id, web_name, position_id, team_id, COALESCE(now_cost, 0.0) AS now_cost, gameweek_id AS source_gameweek_id,
       CAST((SELECT max(gameweek_id) FROM collapsed) + 1 AS INTEGER) AS target_gameweek_id
FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id DESC) AS rn FROM collapsed WHERE gameweek_id > 3) x
WHERE rn = 1""",
        ["now_cost"],
    ),
)
def q_live_rows(spark, sf):
    """The rows that ``score_latest`` scores, without the prediction."""
    live = live_rows(spark, sf)
    return round_doubles(live.select("player_id", "web_name", "position_id", "team_id", "now_cost",
                                     F.col("gameweek_id").alias("source_gameweek_id"), F.col("target_period").alias("target_gameweek_id")))


@register("score_latest", "M11 M4 P25 W2 P10 X3")
def q_score_latest(spark, sf):
    """Live inference: the latest row of every player (periods > 3), z-scored
    with the training statistics and scored by the model with its selected
    calibration and the training caps; the heuristic forecast instead when
    the model does not pass the publication check."""
    m, tr, ho, feats, bundle = _fit(spark, sf)
    named = lambda df: mo.predict_variant(bundle, df, feats).withColumn("model", F.lit(VARIANT))
    _, coeffs, selected, gates = evaluated(named(tr), named(ho))
    live = materialize(live_rows(spark, sf))  # scoring asks for its partitions first, which would build these rows twice
    live = named(fe.zscore_apply(live, fe.global_stats(tr)))
    live = live.withColumn("__heuristic", fe.heuristic_forecast(live))
    verdict = selected.join(gates, "model").select("selected_variant", "ready")  # one row
    live = attach_row(attach_row(live, verdict), tr.agg(F.avg(ACT).alias("__lm")))
    out = ca.postprocess(live, "predicted_points", "__model", league_mean=F.col("__lm"), alpha=0.0, variant=F.col("selected_variant"),
                         coeffs=coeffs, caps=me.percentile_caps(tr, "position_id", ACT), by=["model"])
    return round_doubles(out.select("player_id", "web_name", "position_id", "team_id", "now_cost", F.col("target_period").alias("gameweek_id"),
                                    F.col("gameweek_id").alias("source_gameweek_id"), F.when(F.col("ready"), F.col("__model")).otherwise(F.col("__heuristic")).alias("expected_points_next_gw"),
                                    F.when(F.col("ready"), "model").otherwise("heuristic").alias("method")))


@register("cv_mae", "M5 W13")
def q_cv_mae(spark, sf):
    """All folds are grown and scored together: a fold's rows are a view, test rows name their fold."""
    tr = model_panel(spark, sf).filter(F.col("role") == "train")
    feats = fe.select_features(VARIANT)
    folds = materialize(sp.expanding_folds(tr))
    weeks = {}
    for r in folds.filter("role = 'train'").collect():  # folds x periods
        weeks.setdefault(r["fold"], []).append(r["week"])
    views = {f"fold {k}": F.col("target_gameweek_id").isin(w) for k, w in sorted(weeks.items())}
    forests = mo.fit_named(tr, feats, [bo.Job(v, v, "points", PARAMS) for v in views], views)
    test = folds.filter("role = 'test'").select("fold", F.col("week").alias("target_gameweek_id"))
    rows = mo.prepare(tr, feats).join(F.broadcast(test), "target_gameweek_id")  # folds x periods rows
    scored = bo.score_rows(rows, forests, feats, F.concat(F.lit("fold "), F.col("fold").cast("string")), "__m").withColumn("predicted_points", signed_expm1("__m"))
    w = Window.partitionBy()  # 5 fold rows
    return round_doubles(mo.error_row(scored, by=["fold"]).withColumns({"cv_mae_mean": F.avg("mae").over(w), "cv_mae_std": F.stddev_pop("mae").over(w)}))


def trial_results(m, params, feats):
    """Evaluation of every trial of ``params`` (iteration, param, value): all trials are grown in
    one fit, all rows scored in one scan, and the metrics group by the trial (X2, M6)."""
    tr, ho = m.filter(F.col("role") == "train"), m.filter(F.col("role") == "holdout")
    table = params.groupBy("iteration").agg(F.map_from_entries(F.collect_list(F.struct("param", "value"))).alias("p")).collect()  # trials x 12
    own = {r["iteration"]: mo.GBTParams.from_row(dict(r["p"])) for r in table}
    forests = mo.fit_named(tr, feats, [bo.Job(f"trial {i}", "all", "points", p) for i, p in own.items()], {"all": F.lit(True)})
    of = lambda name: F.create_map(*[x for i, p in own.items() for x in (F.lit(i), F.lit(float(getattr(p, name))))])[F.col("iteration")]
    league = tr.agg(F.avg(ACT).alias("__lm"))

    def scored(df):
        rows = bo.score_each(mo.prepare(df, feats), forests, feats, {f"__m{i}": F.lit(f"trial {i}") for i in own})
        each = F.inline(F.array(*[F.struct(F.lit(i).alias("iteration"), F.col(f"__m{i}").alias("__m")) for i in own]))
        rows = rows.select(*[c for c in rows.columns if c not in {f"__m{i}" for i in own}], each)
        shrunk = (1.0 - of("shrinkage_alpha")) * signed_expm1("__m") + of("shrinkage_alpha") * F.col("__lm")
        return attach_row(rows, league).withColumn("predicted_points", shrunk).drop("__m", "__lm")

    summ, _, selected, _ = evaluated(scored(tr), scored(ho), "iteration", strength=of("calibration_strength"))
    return summ.join(selected.select("iteration", "selected_variant"), "iteration")


@register("param_search", "M6 P34 A27 A28 F15 X2")
def q_param_search(spark, sf, trials: int = TRIALS, seed: int = 42):
    """Half of the trials are uniform draws; the others are proposed from their results."""
    m, feats, space = model_panel(spark, sf), fe.select_features(VARIANT), se.space_frame(spark)
    early = trials // 2
    params = materialize(se.first_proposals(space, early, seed))
    results = materialize(trial_results(m, params, feats))
    history = params.join(results.select("iteration", gt.balanced_score().alias("score")), "iteration")
    later = materialize(se.propose(history, space, trials - early, seed, first=early))
    results = materialize(results.unionByName(trial_results(m, later, feats)))
    lb = gt.leaderboard(results.drop("prediction_collapse_gameweeks"))
    rows = params.unionByName(later).groupBy("iteration").agg(*[F.max(F.when(F.col("param") == n, F.col("value"))).alias(n) for n, *_ in se.SEARCH_RANGES])
    return round_doubles(lb.select("iteration", "mae", "rmse", "bias", "top_k_hit_rate_mean", "rank_correlation_mean", "selected_xi_regret_mean",
                                   "selected_variant", "candidate_score", "is_best_priority", "is_best_score").join(rows, "iteration"))


@register("variant_sweep", "M8 M13 V3")
def q_variant_sweep(spark, sf):
    """All variants from one fit and one scan; the first in order whose gates pass is selected."""
    m = model_panel(spark, sf)
    tr, ho = m.filter(F.col("role") == "train"), m.filter(F.col("role") == "holdout")
    order = {v: i for i, v in enumerate(fe.EXPERIMENT_VARIANTS)}
    bundles, feats = mo.fit_variants({v: fe.select_features(v) for v in order}, tr, PARAMS)
    summ, _, selected, gates = evaluated(mo.predict_variants(bundles, tr, feats), mo.predict_variants(bundles, ho, feats))
    place = F.create_map(*[x for v, i in order.items() for x in (F.lit(v), F.lit(i))])[F.col("model")]
    out = materialize(summ.join(selected.select("model", "selected_variant"), "model").join(gates.select("model", "reasons"), "model")
                      .select(place.alias("order"), F.col("model").alias("variant"), "mae", "rmse", "bias", "top_k_hit_rate_mean", "rank_correlation_mean", "selected_xi_regret_mean",
                              "selected_variant", "reasons", (F.col("reasons") == "").alias("gates_passed")))
    first = out.filter("gates_passed").agg(F.min("order").alias("__first"))
    return round_doubles(attach_row(out, first).withColumn(
        "selected", F.coalesce(F.col("order") == F.col("__first"), F.lit(False))).drop("__first"))


# ------------------------------------------------------------------ point-in-time back-fill

def pit_candidates(spark, sf):
    """J12 + per-target train statistics: for every target t that any row can train, each
    player's latest row with period <= t-1, scored by the heuristic with
    z-stats of the rows whose target period < t (cumulative weekly sums)."""
    c = fe.collapse_periods(tb.fixture_rows(spark, sf))
    rolled = fe.rolling_features(c)
    tgt = fe.next_period_target(rolled)
    wk = tgt.groupBy(F.col("target_gameweek_id").alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_points").alias("s"),
        F.sum(F.col("total_points") * F.col("total_points")).alias("ss"),
        F.max("target_gameweek_id").alias("mx"),
    )
    w = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)  # one row per period
    cum = wk.select("t", F.sum("n").over(w).alias("N"), F.sum("s").over(w).alias("S"), F.sum("ss").over(w).alias("SS"),
                    F.max("mx").over(w).alias("train_max_target_gw")).filter(F.col("N") > 0)
    std = F.when(F.col("N") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("SS") - F.col("S") * F.col("S") / F.col("N")) / (F.col("N") - 1)))
    stats = cum.select("t", (F.col("S") / F.col("N")).alias("m"), F.when(std > 0, std).otherwise(F.lit(1.0)).alias("sd"),
                       "train_max_target_gw")
    asof = ao.asof_latest(rolled).withColumnRenamed("target_gameweek_id", "t")
    j = asof.join(F.broadcast(stats), "t")  # stats: one row per period (bounded by #periods)
    z = F.coalesce((F.col("total_points") - F.col("m")) / F.col("sd"), F.lit(0.0))
    score = F.greatest(F.lit(0.0), F.coalesce(F.col("three_week_players_roll_avg_points"), F.lit(2.0)) * 0.7 + z * 1.5 + 2.0)
    return j.select(F.col("t").alias("target_gameweek_id"), "player_id", "web_name", "position_id", "team_id", "now_cost",
                    score.alias("score"), F.col("gameweek_id").alias("source_gameweek_id"), "train_max_target_gw")


PIT_SQL = """,
tg AS (SELECT DISTINCT target_gameweek_id AS t FROM targeted),
st AS (SELECT tg.t, avg(x.total_points) AS m,
              CASE WHEN stddev_samp(x.total_points) > 0 THEN stddev_samp(x.total_points) ELSE 1.0 END AS sd,
              max(x.target_gameweek_id) AS train_max_target_gw
       FROM tg JOIN targeted x ON x.target_gameweek_id < tg.t GROUP BY tg.t),
pit_asof AS (SELECT * FROM (SELECT r.*, tg.t, row_number() OVER (PARTITION BY r.player_id, tg.t ORDER BY r.gameweek_id DESC) AS rn
                        FROM rolled r JOIN tg ON r.gameweek_id <= tg.t - 1) x WHERE rn = 1),
cand AS (SELECT a.t AS g, a.player_id, a.web_name, a.position_id, a.team_id, a.now_cost,
                greatest(0.0, COALESCE(a.three_week_players_roll_avg_points, 2.0) * 0.7
                              + COALESCE((a.total_points - s.m) / s.sd, 0.0) * 1.5 + 2.0) AS score,
                CAST(NULL AS DOUBLE) AS actual, a.gameweek_id AS source_gameweek_id, s.train_max_target_gw
         FROM pit_asof a JOIN st s ON s.t = a.t)"""


def pit_squads(spark, sf):
    c = materialize(pit_candidates(spark, sf))
    squad = sq.budgeted_squad(c, ["target_gameweek_id"], "score")
    return c, materialize(sq.best_xi(squad, ["target_gameweek_id"], "score"))


@register(
    "pit_backfill",
    "M9 K6 P29",
    rsql(
        with_panel(PIT_SQL.lstrip(",") + squad_ctes("score", "p_"))
        + """
SELECT CAST(x.g AS INTEGER) AS target_gameweek_id, x.player_id, x.is_starter, x.is_captain, x.is_vice_captain,
       x.score AS expected_points_next_gw, 'pit_heuristic' AS backfill_method
FROM p_xi x""",
        ["expected_points_next_gw"],
    ),
)
def q_pit_backfill(spark, sf):
    _, xi = pit_squads(spark, sf)
    return round_doubles(xi.select(F.col("target_gameweek_id").cast("int"), "player_id", "is_starter", "is_captain",
                                   "is_vice_captain", F.col("score").alias("expected_points_next_gw"),
                                   F.lit("pit_heuristic").alias("backfill_method")))


@register(
    "backfill_integrity",
    "M10 Q2",
    with_panel(PIT_SQL.lstrip(","))
    + """
SELECT CAST(g AS INTEGER) AS target_gameweek_id, CAST(max(train_max_target_gw) AS INTEGER) AS train_max_target_gw,
       CAST(max(source_gameweek_id) AS INTEGER) AS inference_max_source_gw,
       max(train_max_target_gw) < g AND max(source_gameweek_id) <= g - 1 AS backfill_trusted
FROM cand GROUP BY g""",
)
def q_backfill_integrity(spark, sf):
    """M10 (with the Q2 fix): checks the rows actually used for inference."""
    c = pit_candidates(spark, sf)
    g = F.col("target_gameweek_id")
    out = c.groupBy(g.cast("int").alias("target_gameweek_id")).agg(
        F.max("train_max_target_gw").cast("int").alias("train_max_target_gw"),
        F.max("source_gameweek_id").cast("int").alias("inference_max_source_gw"),
    )
    return out.withColumn(
        "backfill_trusted",
        (F.col("train_max_target_gw") < F.col("target_gameweek_id")) & (F.col("inference_max_source_gw") <= F.col("target_gameweek_id") - 1),
    )


@register("stored_model_eval", "K13 M12")
def q_stored_model_eval(spark, sf):
    """Save the fitted model with its whole post-processing payload, load it back and
    evaluate it on the holdout as it was stored: shrinkage, selected calibration, caps,
    weekly back-test, required-baseline comparison and publication gates."""
    from panelforge.session import scratch_path

    _, tr, ho, feats, bundle = _fit(spark, sf)
    named = lambda b, df, cols: mo.predict_variant(b, df, cols).withColumn("model", F.lit(VARIANT))
    _, coeffs, selected, _ = evaluated(named(bundle, tr, feats), named(bundle, ho, feats))
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  a row a segment
    payload = {"variant": VARIANT, "shrinkage_alpha": 0.0, "league_mean": tr.agg(F.avg(ACT)).first()[0], "calibration": rows(coeffs),
               "selected": rows(selected), "caps": rows(me.percentile_caps(tr, "position_id", ACT).select("position_id", "cap"))}
    path = mo.save_model(bundle, feats, scratch_path(spark, "model"), payload)
    return round_doubles(evaluate_stored(spark, path, ho))


def evaluate_stored(spark, path: str, holdout):
    """One row of errors, back-test summary and gates of a stored model on ``holdout``."""
    bundle, meta = mo.load_model(spark, path)
    pred = mo.predict_variant(bundle, holdout, meta["feature_cols"]).withColumn("model", F.lit(meta["variant"]))
    coeffs = spark.createDataFrame(meta["calibration"], "model string, scope string, position_id int, a double, b double, count long, fallback string")
    caps = spark.createDataFrame(meta["caps"], "position_id int, cap double")
    selected = meta["selected"][0]
    final = ca.postprocess(pred, "predicted_points", "__final", league_mean=meta["league_mean"], alpha=meta["shrinkage_alpha"],
                           variant=F.lit(selected["selected_variant"]), coeffs=coeffs, caps=caps, by=["model"])
    final = materialize(final.withColumn("predicted_points", F.col("__final")).drop("__final"))
    wk = bt.weekly_backtest(final, materialize_input=False)
    summ = bt.backtest_summary(final, wk)
    base = final.withColumn("predicted_points", F.coalesce(F.col(gt.ModelRules().required_baseline), F.lit(0.0)))
    other = bt.backtest_summary(base, bt.weekly_backtest(base, materialize_input=False))
    m = summ.select(F.col("top_k_hit_rate_mean").alias("m_hit"), F.col("selected_xi_regret_mean").alias("m_regret"))
    b = other.select(F.col("top_k_hit_rate_mean").alias("b_hit"), F.col("selected_xi_regret_mean").alias("b_regret"))
    better = (F.round("m_hit", 9) > F.round("b_hit", 9)) & (F.round("m_regret", 9) < F.round("b_regret", 9))
    deltas = spark.createDataFrame([(float(selected["selected_delta_mae"]), float(selected["selected_delta_rmse"]))], "selected_delta_mae double, selected_delta_rmse double")
    gates = gt.publication_gates(summ, attach_row(m, b).withColumn("baseline_gate_passed", better), deltas)
    n = final.agg(F.count(F.lit(1)).alias("n"))
    row = attach_row(attach_row(summ.drop("prediction_collapse_gameweeks"), n), attach_row(m, b).select("b_hit", "b_regret"))
    row = attach_row(row, gates.select("reasons", "ready"))
    return row.select(F.lit(meta["kind"]).alias("kind"), F.lit(selected["selected_variant"]).alias("selected_variant"), "*")


@register("pit_backfill_model", "M9 M10 J12 O3 O4 (model predictor)")
def q_pit_backfill_model(spark, sf):
    """Point-in-time back-fill with the trained model: for each target period t a
    model of the rows whose target period < t scores every player's as-of row
    (period <= t-1); squads are picked and the trust check is stamped.  All
    targets are grown in one fit, scored in one scan and picked in one plan.

    The z-scored columns are the raw ones here: trees don't change when a
    feature is shifted and scaled for training and scoring alike."""
    raw = {f"{c}_z_score": F.col(c) for c in fe.FEATURES_TO_SCALE}
    panel = materialize(fe.engineer_panel(tb.fixture_rows(spark, sf)).withColumns(raw))
    feats = fe.select_features(VARIANT)
    periods = sorted(r[0] for r in panel.select("target_gameweek_id").distinct().collect())[1:]  # nothing to train on before the first
    views = {f"target {t}": F.col("target_gameweek_id") < t for t in periods}
    forests = mo.fit_named(panel, feats, [bo.Job(v, v, "points", PARAMS) for v in views], views)
    # written first: scoring asks for its partitions, which would build these rows twice
    asof = materialize(ao.asof_latest(inference_rows(spark, sf).withColumns(raw), targets=periods))
    key = F.concat(F.lit("target "), F.col("target_gameweek_id").cast("string"))
    scored = bo.score_rows(mo.prepare(asof, feats), forests, feats, key, "__m").withColumn("score", signed_expm1("__m")).drop("__m")
    scored = materialize(scored)
    xi = sq.best_xi(sq.budgeted_squad(scored, ["target_gameweek_id"], "score"), ["target_gameweek_id"], "score")
    # What the models and the scored rows have seen, by target
    weeks = panel.groupBy(F.col("target_gameweek_id").alias("__week")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__week").rowsBetween(Window.unboundedPreceding, -1)  # one row per period
    seen = weeks.select(F.col("__week").alias("target_gameweek_id"), F.max("__week").over(before).alias("__train_max"))
    src = scored.groupBy("target_gameweek_id").agg(F.max("source_gameweek_id").alias("__src"))
    stamped = xi.join(seen, "target_gameweek_id", "left").join(src, "target_gameweek_id", "left").withColumn(
        "backfill_trusted", (F.col("__train_max") < F.col("target_gameweek_id")) & (F.col("__src") <= F.col("target_gameweek_id") - 1))
    return round_doubles(stamped.select(F.col("target_gameweek_id").cast("int"), "player_id", "is_starter", "is_captain", "is_vice_captain",
                                        F.col("score").alias("expected_points_next_gw"), F.lit("pit_model").alias("backfill_method"), "backfill_trusted"))
