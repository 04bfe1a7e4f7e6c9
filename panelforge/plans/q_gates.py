"""Registered queries: baseline comparison, ranking pieces, candidate scoring,
convergence and the three gate families."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import backtest as bt
from panelforge.operators import calibration as ca
from panelforge.operators import gates as gt
from panelforge.operators import split as sp
from panelforge.operators.common import attach_row, round_doubles
from panelforge.plans.q_model import ACT, CAL_SQL, CSEL_SQL, KS_SQL, _ks, scored
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import backtest_by_ctes, with_panel
from panelforge.sources import tables as tb
from panelforge.operators import drift as dr

PREDICTORS = (
    ("model", "predicted_points"),
    ("five_week_players_roll_avg_points", "five_week_players_roll_avg_points"),
    ("three_week_players_roll_avg_points", "three_week_players_roll_avg_points"),
    ("total_points_z_score", "total_points_z_score"),
)

LONG_SQL = """,
rh AS (SELECT * FROM scored WHERE role = 'holdout'),
rw AS (SELECT w FROM (SELECT DISTINCT target_gameweek_id AS w FROM rh) d ORDER BY w DESC LIMIT 5),
recent AS (SELECT * FROM rh WHERE target_gameweek_id IN (SELECT w FROM rw)),
plong AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{name}' AS predictor, player_id, target_gameweek_id, minutes_played, position_id, "
    f"CAST({ACT} AS DOUBLE) AS actual_points, "
    + (f"CAST({col} AS DOUBLE)" if name == "model" else f"COALESCE(CAST({col} AS DOUBLE), 0.0)")
    + " AS predicted_points FROM recent"
    for name, col in PREDICTORS
) + ")"

CMP_SQL = """
cmp AS (
  SELECT b.predictor AS baseline_name,
         m.top_k_hit_rate_mean AS m_hit, m.rank_correlation_mean AS m_corr, m.selected_xi_regret_mean AS m_regret,
         b.top_k_hit_rate_mean AS b_hit, b.rank_correlation_mean AS b_corr, b.selected_xi_regret_mean AS b_regret,
         m.top_k_hit_rate_mean - b.top_k_hit_rate_mean AS delta_top_k_hit_rate_mean,
         m.rank_correlation_mean - b.rank_correlation_mean AS delta_rank_correlation_mean,
         m.selected_xi_regret_mean - b.selected_xi_regret_mean AS delta_selected_xi_regret_mean,
         (round(m.top_k_hit_rate_mean, 9) > round(b.top_k_hit_rate_mean, 9)
          AND round(m.selected_xi_regret_mean, 9) < round(b.selected_xi_regret_mean, 9)) AS baseline_gate_passed
  FROM b_sum b, (SELECT * FROM b_sum WHERE predictor = 'model') m
  WHERE b.predictor <> 'model')"""

CMP_DOUBLES = ["m_hit", "m_corr", "m_regret", "b_hit", "b_corr", "b_regret", "delta_top_k_hit_rate_mean",
               "delta_rank_correlation_mean", "delta_selected_xi_regret_mean"]


def predictor_long(spark, sf):
    """W12 recent periods of the holdout, predictors unpivoted to long form."""
    h = scored(spark, sf).filter(F.col("role") == "holdout")
    recent = sp.recent_periods(h, 5)
    structs = [
        F.struct(
            F.lit(name).alias("predictor"),
            (F.col(col) if name == "model" else F.coalesce(F.col(col), F.lit(0.0))).cast("double").alias("p"),
        )
        for name, col in PREDICTORS
    ]
    return recent.select(
        "player_id", "target_gameweek_id", "minutes_played", "position_id",
        F.col(ACT).cast("double").alias("actual_points"), F.explode(F.array(*structs)).alias("kv"),
    ).select("kv.predictor", "player_id", "target_gameweek_id", "minutes_played", "position_id", "actual_points",
             F.col("kv.p").alias("predicted_points"))


def predictor_weekly(spark, sf):
    long = predictor_long(spark, sf)
    # ``long`` is an explode over the written scored panel (no shuffle upstream)
    return long, bt.weekly_backtest(long, actual="actual_points", by=["predictor"], materialize_input=False)


def comparison(spark, sf):
    """V6: model vs each baseline on the recent periods (strict > hit, < regret)."""
    long, wk = predictor_weekly(spark, sf)
    summ = bt.backtest_summary(long, wk, actual="actual_points", by=["predictor"])
    m = summ.filter(F.col("predictor") == "model").select(
        F.col("top_k_hit_rate_mean").alias("m_hit"), F.col("rank_correlation_mean").alias("m_corr"),
        F.col("selected_xi_regret_mean").alias("m_regret"),
    )
    b = summ.filter(F.col("predictor") != "model").select(
        F.col("predictor").alias("baseline_name"), F.col("top_k_hit_rate_mean").alias("b_hit"),
        F.col("rank_correlation_mean").alias("b_corr"), F.col("selected_xi_regret_mean").alias("b_regret"),
    )
    c = attach_row(b, m)
    return summ, c.select(
        "baseline_name", "m_hit", "m_corr", "m_regret", "b_hit", "b_corr", "b_regret",
        (F.col("m_hit") - F.col("b_hit")).alias("delta_top_k_hit_rate_mean"),
        (F.col("m_corr") - F.col("b_corr")).alias("delta_rank_correlation_mean"),
        (F.col("m_regret") - F.col("b_regret")).alias("delta_selected_xi_regret_mean"),
        # Strict comparisons at 1e-9 so exact ties are ties whatever the
        # summation order.
        ((F.round("m_hit", 9) > F.round("b_hit", 9)) & (F.round("m_regret", 9) < F.round("b_regret", 9))).alias(
            "baseline_gate_passed"
        ),
    )


@register(
    "baseline_comparison",
    "V6 J11 W12",
    rsql(with_panel(CAL_SQL + LONG_SQL, *backtest_by_ctes("plong"), CMP_SQL) + "\nSELECT * FROM cmp", CMP_DOUBLES),
)
def q_baseline_comparison(spark, sf):
    return round_doubles(comparison(spark, sf)[1])


def _wk_slice(cols, doubles):
    sql = rsql(
        with_panel(CAL_SQL + LONG_SQL, *backtest_by_ctes("plong"))
        + "\nSELECT predictor, gameweek_id, " + ", ".join(cols) + " FROM b_wk",
        doubles,
    )

    def fn(spark, sf):
        return round_doubles(predictor_weekly(spark, sf)[1].select("predictor", "gameweek_id", *cols))

    return sql, fn


_sql, _fn = _wk_slice(["top_k_hit_rate"], ["top_k_hit_rate"])
register("topk_hit_rate", "W4 J7 U3", _sql)(_fn)
_sql, _fn = _wk_slice(["selected_xi_actual_total", "oracle_xi_actual_total", "selected_xi_regret",
                       "selected_squad_predicted_total", "selected_squad_actual_total"],
                      ["selected_xi_actual_total", "oracle_xi_actual_total", "selected_xi_regret",
                       "selected_squad_predicted_total", "selected_squad_actual_total"])
register("xi_regret", "W5", _sql)(_fn)
_sql, _fn = _wk_slice(["rank_correlation"], ["rank_correlation"])
register("rank_correlation", "W6 C9 C10", _sql)(_fn)


@register(
    "publication_gates",
    "V3",
    with_panel(CAL_SQL, CSEL_SQL + LONG_SQL, *backtest_by_ctes("plong"), CMP_SQL)
    + """,
g AS (
  SELECT s.prediction_collapse_weeks <= 0 AS max_prediction_collapse_weeks,
         s.bias_flip_weeks <= 0 AS max_bias_flip_weeks,
         s.top_k_hit_rate_mean >= 0.25 AS min_top_k_hit_rate,
         s.rank_correlation_mean >= 0.0 AS min_rank_correlation,
         s.selected_xi_regret_mean <= 24.0 AS max_selected_xi_regret,
         s.prediction_to_actual_ratio_min >= 0.6 AS prediction_ratio_min,
         s.prediction_to_actual_ratio_max <= 1.6 AS prediction_ratio_max,
         COALESCE(round(c.m_hit, 9) > round(c.b_hit, 9), true) AS baseline_top_k_hit_rate,
         COALESCE(round(c.m_regret, 9) < round(c.b_regret, 9), true) AS baseline_selected_xi_regret,
         COALESCE(c.baseline_gate_passed, true) AS baseline_gate_passed,
         COALESCE(k.selected_delta_mae, 0.0) <= 0.0 AS calibration_safe_mae,
         COALESCE(k.selected_delta_rmse, 0.0) <= 0.0 AS calibration_safe_rmse
  FROM (SELECT * FROM b_sum WHERE predictor = 'model') s,
       (SELECT * FROM cmp WHERE baseline_name = 'five_week_players_roll_avg_points') c, csel k),
r AS (
  SELECT *, concat_ws(',',
      CASE WHEN NOT max_prediction_collapse_weeks THEN 'max_prediction_collapse_weeks' END,
      CASE WHEN NOT max_bias_flip_weeks THEN 'max_bias_flip_weeks' END,
      CASE WHEN NOT min_top_k_hit_rate THEN 'min_top_k_hit_rate' END,
      CASE WHEN NOT min_rank_correlation THEN 'min_rank_correlation' END,
      CASE WHEN NOT max_selected_xi_regret THEN 'max_selected_xi_regret' END,
      CASE WHEN NOT prediction_ratio_min THEN 'prediction_ratio_min' END,
      CASE WHEN NOT prediction_ratio_max THEN 'prediction_ratio_max' END,
      CASE WHEN NOT baseline_top_k_hit_rate THEN 'baseline_top_k_hit_rate' END,
      CASE WHEN NOT baseline_selected_xi_regret THEN 'baseline_selected_xi_regret' END,
      CASE WHEN NOT baseline_gate_passed THEN 'baseline_gate_passed' END,
      CASE WHEN NOT calibration_safe_mae THEN 'calibration_safe_mae' END,
      CASE WHEN NOT calibration_safe_rmse THEN 'calibration_safe_rmse' END) AS reasons
  FROM g)
SELECT *, true AS ready, true AS override_enabled, reasons <> '' AS override_forced_ready FROM r""",
)
def q_publication_gates(spark, sf):
    summ, cmp = comparison(spark, sf)
    s = summ.filter(F.col("predictor") == "model").drop("predictor")
    base = cmp.filter(F.col("baseline_name") == "five_week_players_roll_avg_points").select(
        "m_hit", "m_regret", "b_hit", "b_regret", "baseline_gate_passed"
    )
    sc = scored(spark, sf)
    tr, ho = sc.filter(F.col("role") == "train"), sc.filter(F.col("role") == "holdout")
    coeffs = ca.fit_calibration(tr, ACT, "predicted_points")
    sel = ca.select_variant(ca.calibration_report(ca.variant_long(ho, ACT, "predicted_points", coeffs)))
    return gt.publication_gates(s, base, sel.select("selected_delta_mae", "selected_delta_rmse"))


# ------------------------------------------------------------------ candidates

CANDS_SQL = """
cands AS (
  SELECT p_partkey AS iteration, p_retailprice / 1000.0 AS mae, p_retailprice / 800.0 AS rmse,
         (CAST(p_size AS DOUBLE) - 25.0) / 50.0 AS bias, CAST(p_size AS DOUBLE) / 50.0 AS top_k_hit_rate_mean,
         (CAST(p_size AS DOUBLE) - 20.0) / 60.0 AS rank_correlation_mean, CAST(p_size AS DOUBLE) * 1.5 AS selected_xi_regret_mean,
         CAST(p_size AS DOUBLE) / 4.0 AS squad_total_bias_abs_mean, CAST(p_size AS DOUBLE) / 20.0 AS max_position_bias_abs,
         CAST(p_size % 3 AS INTEGER) AS prediction_collapse_weeks, CAST(p_size % 2 AS INTEGER) AS bias_flip_weeks,
         (p_size % 7) / 50.0 AS position_exceed_rate, (p_size % 5) / 40.0 AS player_exceed_rate,
         (CAST(p_size AS DOUBLE) - 25.0) / 100.0 AS position_calibration_gain,
         0.5 + CAST(p_size AS DOUBLE) / 100.0 AS prediction_to_actual_ratio_min,
         1.0 + CAST(p_size AS DOUBLE) / 50.0 AS prediction_to_actual_ratio_max,
         p_size % 4 <> 0 AS baseline_gate_passed, p_size % 3 <> 0 AS gates_passed,
         (p_size % 10) / 2.0 AS actual_std
  FROM part),
scored_c AS (
  SELECT *, mae + 0.05 * squad_total_bias_abs_mean + 0.03 * selected_xi_regret_mean
            + 1.5 * greatest(0.0, 0.30 - top_k_hit_rate_mean) + 1.0 * greatest(0.0, 0.10 - rank_correlation_mean)
            + 2.0 * prediction_collapse_weeks AS candidate_score
  FROM cands)"""


@register(
    "candidate_leaderboard",
    "A27 A28",
    rsql(
        "WITH " + CANDS_SQL + """,
bp AS (SELECT iteration FROM scored_c
       ORDER BY selected_xi_regret_mean, -top_k_hit_rate_mean, -rank_correlation_mean, rmse, mae, iteration LIMIT 1),
bs AS (SELECT iteration FROM scored_c ORDER BY candidate_score, iteration LIMIT 1)
SELECT iteration, candidate_score, iteration = (SELECT iteration FROM bp) AS is_best_priority,
       iteration = (SELECT iteration FROM bs) AS is_best_score
FROM scored_c""",
        ["candidate_score"],
    ),
)
def q_leaderboard(spark, sf):
    lb = gt.leaderboard(tb.candidates(spark, sf))
    return round_doubles(lb.select("iteration", "candidate_score", "is_best_priority", "is_best_score"))


@register(
    "convergence_check",
    "A30",
    rsql(
        "WITH " + CANDS_SQL + """,
cut AS (SELECT min(iteration) AS c FROM (SELECT iteration FROM cands ORDER BY iteration DESC LIMIT 3) x)
SELECT *, n_experiments >= 4 AND best_recent IS NOT NULL AND best_before IS NOT NULL AND best_recent >= best_before AS stop
FROM (
SELECT 'all' AS variant, count(*) AS n_experiments,
       min(CASE WHEN iteration >= c THEN mae END) AS best_recent, min(CASE WHEN iteration < c THEN mae END) AS best_before
FROM cands, cut
UNION ALL
SELECT 'feasible', count(*), min(CASE WHEN iteration >= c AND gates_passed THEN mae END),
       min(CASE WHEN iteration < c AND gates_passed THEN mae END)
FROM cands, cut) u""",
        ["best_recent", "best_before"],
    ),
    # stop flag computed on the unrounded values inside
)
def q_convergence(spark, sf):
    c = tb.candidates(spark, sf)
    a = gt.convergence_check(c).select(F.lit("all").alias("variant"), "*")
    f = gt.convergence_check(c, feasible="gates_passed").select(F.lit("feasible").alias("variant"), "*")
    return round_doubles(a.unionByName(f))


@register(
    "best_so_far",
    "W15",
    rsql(
        "WITH " + CANDS_SQL + """
SELECT iteration, mae,
       min(mae) OVER (ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far,
       min(CASE WHEN gates_passed THEN mae END) OVER (ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS best_feasible_so_far
FROM cands""",
        ["mae", "best_so_far", "best_feasible_so_far"],
    ),
)
def q_best_so_far(spark, sf):
    c = tb.candidates(spark, sf).select("iteration", "mae", "gates_passed")
    a = gt.best_so_far(c)
    f = gt.best_so_far(c, feasible="gates_passed").select("iteration", F.col("best_so_far").alias("best_feasible_so_far"))
    return round_doubles(a.join(f, "iteration").select("iteration", "mae", "best_so_far", "best_feasible_so_far"))


def _bounds_sql() -> str:
    rows = ", ".join(f"('{n}', {float(lo)}, {float(hi)}, {str(i).lower()})" for n, lo, hi, i in gt.SEARCH_SPACE)
    return f"(VALUES {rows}) b(param, lo, hi, is_int)"


@register(
    "clamp_to_bounds",
    "P34 F4",
    rsql(
        f"""
WITH params AS (
  SELECT p_partkey AS iteration, 'n_estimators' AS param, CAST(p_size AS DOUBLE) * 25.0 + (p_partkey % 7) AS value FROM part
  UNION ALL SELECT p_partkey, 'max_depth', CAST(p_size AS DOUBLE) / 4.0 FROM part
  UNION ALL SELECT p_partkey, 'learning_rate', p_retailprice / 5000.0 FROM part
  UNION ALL SELECT p_partkey, 'subsample', 0.3 + CAST(p_size AS DOUBLE) / 50.0 FROM part
  UNION ALL SELECT p_partkey, 'reg_lambda', CAST((p_partkey % 13) AS DOUBLE) - 1.5 FROM part
  UNION ALL SELECT p_partkey, 'calibration_strength', CAST(p_size AS DOUBLE) / 40.0 FROM part)
SELECT p.iteration, p.param, p.value, b.lo, b.hi, b.is_int,
       CASE WHEN b.lo IS NULL THEN p.value
            ELSE greatest(b.lo, least(b.hi, CASE WHEN b.is_int THEN round_even(p.value, 0) ELSE p.value END)) END AS clamped
FROM params p LEFT JOIN {_bounds_sql()} ON b.param = p.param""",
        ["value", "lo", "hi", "clamped"],
    ),
)
def q_clamp(spark, sf):
    params = tb.candidate_params(spark, sf)
    out = gt.clamp_to_bounds(params, F.broadcast(gt.bounds_frame(spark)))
    return round_doubles(out.select("iteration", "param", "value", "lo", "hi", "is_int", "clamped"))


def _incumbent(c):
    """The active model: the first experiment (smallest iteration)."""
    c = c.withColumns({"candidate_score": gt.balanced_score(), "priority": gt.ranking_priority()})
    return c.agg(F.min_by(F.struct("mae", "rmse", "candidate_score", "priority"), F.col("iteration")).alias("i")).select(
        F.col("i.mae").alias("a_mae"), F.col("i.rmse").alias("a_rmse"), F.col("i.candidate_score").alias("a_score"),
        F.col("i.priority").alias("a_priority"),
    )


_V4 = ("drift_context_present max_mae max_rmse max_abs_bias position_exceed_cap player_exceed_cap max_squad_total_bias "
       "max_position_bias min_top_k_hit_rate min_rank_correlation max_selected_xi_regret max_prediction_collapse_weeks "
       "max_bias_flip_weeks prediction_ratio_min prediction_ratio_max position_calibration_gain mae_improves_active "
       "ranking_priority_improves_active baseline_gate_passed balanced_score_improves_active rmse_within_deterioration").split()
_V5 = ("bias_gate pos_cap_gate player_cap_gate rmse_gate mae_gate realism_gate position_bias_gate ranking_gate "
       "rank_corr_gate xi_regret_gate collapse_gate instability_gate baseline_gate priority_gate").split()
_PRIO = "(selected_xi_regret_mean, -top_k_hit_rate_mean, -rank_correlation_mean, rmse, mae)"
_INC_SQL = """
inc AS (SELECT mae AS a_mae, rmse AS a_rmse, candidate_score AS a_score, selected_xi_regret_mean AS a1,
               top_k_hit_rate_mean AS a2, rank_correlation_mean AS a3
        FROM scored_c ORDER BY iteration LIMIT 1)"""
# lexicographic (p1,p2,p3,p4,p5) < (a1..a5) written out for the oracle
_PRIO_LT = """(selected_xi_regret_mean < a1 OR (selected_xi_regret_mean = a1 AND (-top_k_hit_rate_mean < -a2
  OR (-top_k_hit_rate_mean = -a2 AND (-rank_correlation_mean < -a3 OR (-rank_correlation_mean = -a3
  AND (rmse < a_rmse OR (rmse = a_rmse AND mae < a_mae))))))))"""
_PRIO_LE = _PRIO_LT[:-1] + " OR (selected_xi_regret_mean = a1 AND top_k_hit_rate_mean = a2 AND rank_correlation_mean = a3 AND rmse = a_rmse AND mae = a_mae))"


def _failed_sql(names):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT COALESCE({n}, false) THEN '{n}' END" for n in names) + ")"


@register(
    "promotion_gates",
    "V4 F16",
    with_panel(KS_SQL)
    + ",\n" + CANDS_SQL + "," + _INC_SQL + """,
dd AS (SELECT count_if(ks_stat > 0.2) / 3.0 >= 0.34 AS drift_triggered FROM ks),
g AS (
  SELECT iteration,
    COALESCE(drift_triggered, false) AS drift_context_present, mae <= 6.0 AS max_mae, rmse <= 8.0 AS max_rmse,
    abs(bias) <= 1.0 AS max_abs_bias, position_exceed_rate <= 0.1 AS position_exceed_cap,
    player_exceed_rate <= 0.1 AS player_exceed_cap, squad_total_bias_abs_mean <= 16.0 AS max_squad_total_bias,
    max_position_bias_abs <= 2.5 AS max_position_bias, top_k_hit_rate_mean >= 0.25 AS min_top_k_hit_rate,
    rank_correlation_mean >= 0.0 AS min_rank_correlation, selected_xi_regret_mean <= 24.0 AS max_selected_xi_regret,
    prediction_collapse_weeks <= 0 AS max_prediction_collapse_weeks, bias_flip_weeks <= 0 AS max_bias_flip_weeks,
    prediction_to_actual_ratio_min >= 0.6 AS prediction_ratio_min, prediction_to_actual_ratio_max <= 1.6 AS prediction_ratio_max,
    COALESCE(position_calibration_gain, 0.0) >= 0.0 AS position_calibration_gain, mae < a_mae AS mae_improves_active,
    """ + _PRIO_LT + """ AS ranking_priority_improves_active,
    COALESCE(baseline_gate_passed, true) AS baseline_gate_passed, candidate_score < a_score AS balanced_score_improves_active,
    rmse <= a_rmse * (1.0 + 0.03) AS rmse_within_deterioration
  FROM scored_c, inc, dd)
SELECT *, """ + _failed_sql(_V4) + """ AS failed_gates, """ + _failed_sql(_V4) + """ = '' AS passed FROM g""",
)
def q_promotion(spark, sf):
    c = tb.candidates(spark, sf)
    drift = dr.drift_decision(_ks(spark, sf)).select("drift_triggered")
    g = gt.promotion_gates(c, _incumbent(c), drift)
    return g.select("iteration", *_V4, "failed_gates", "passed")


@register(
    "reviewer_gates",
    "V5",
    "WITH " + CANDS_SQL + "," + _INC_SQL + """,
g AS (
  SELECT iteration,
    CASE WHEN actual_std > 0 THEN abs(bias) <= 0.25 * actual_std ELSE true END AS bias_gate,
    COALESCE(position_exceed_rate <= 0.05, true) AS pos_cap_gate, COALESCE(player_exceed_rate <= 0.05, true) AS player_cap_gate,
    (a_rmse IS NULL OR rmse <= a_rmse * (1.0 + 0.05)) AS rmse_gate, (a_mae IS NULL OR mae <= a_mae * 1.01) AS mae_gate,
    squad_total_bias_abs_mean <= 16.0 AS realism_gate, max_position_bias_abs <= 2.5 AS position_bias_gate,
    top_k_hit_rate_mean >= 0.25 AS ranking_gate, rank_correlation_mean >= 0.0 AS rank_corr_gate,
    selected_xi_regret_mean <= 24.0 AS xi_regret_gate, prediction_collapse_weeks <= 0 AS collapse_gate,
    bias_flip_weeks <= 0 AS instability_gate, COALESCE(baseline_gate_passed, true) AS baseline_gate,
    COALESCE(""" + _PRIO_LE + """, true) AS priority_gate
  FROM scored_c, inc)
SELECT *, """ + _failed_sql(_V5) + """ AS failed_gates, """ + _failed_sql(_V5) + """ = '' AS passed FROM g""",
)
def q_reviewer(spark, sf):
    c = tb.candidates(spark, sf)
    g = gt.reviewer_gates(c, _incumbent(c))
    return g.select("iteration", *_V5, "failed_gates", "passed")


def _cycle_sql() -> str:
    from panelforge.plans.q_model import EXCEED_CTES, KS_BODY
    from panelforge.plans.q_sinks import VALID_CTES

    score = ("mae + 0.05 * squad_total_bias_abs_mean + 0.03 * selected_xi_regret_mean"
             " + 1.5 * greatest(0.0, 0.30 - top_k_hit_rate_mean) + 1.0 * greatest(0.0, 0.10 - rank_correlation_mean)"
             " + 2.0 * prediction_collapse_weeks")
    return rsql(
        with_panel(CAL_SQL, CSEL_SQL + LONG_SQL, *backtest_by_ctes("plong"), CMP_SQL, EXCEED_CTES, KS_BODY, VALID_CTES)
        + f""",
dd AS (SELECT count_if(ks_stat > 0.2) / 3.0 >= 0.34 AS drift_triggered, count_if(ks_stat > 0.2) / 3.0 AS breach_ratio FROM ks),
val AS (SELECT bool_and(ok) AS validation_ok FROM vrows),
cs AS (SELECT *, {score} AS candidate_score FROM b_sum WHERE predictor = 'model'),
inc AS (SELECT mae AS a_mae, rmse AS a_rmse, {score} AS a_score, selected_xi_regret_mean AS a1,
               top_k_hit_rate_mean AS a2, rank_correlation_mean AS a3
        FROM b_sum WHERE predictor = 'five_week_players_roll_avg_points'),
cc AS (SELECT cs.*, pe.position_exceed_rate, ye.player_exceed_rate, csel.position_calibration_gain, bg.baseline_gate_passed
       FROM cs, pe, ye, csel, (SELECT baseline_gate_passed FROM cmp WHERE baseline_name = 'five_week_players_roll_avg_points') bg),
g AS (
  SELECT cc.*, COALESCE(dd.drift_triggered, false) AS drift_context_present, mae <= 6.0 AS max_mae, rmse <= 8.0 AS max_rmse,
    abs(bias) <= 1.0 AS max_abs_bias, position_exceed_rate <= 0.1 AS position_exceed_cap,
    player_exceed_rate <= 0.1 AS player_exceed_cap, squad_total_bias_abs_mean <= 16.0 AS max_squad_total_bias,
    max_position_bias_abs <= 2.5 AS max_position_bias, top_k_hit_rate_mean >= 0.25 AS min_top_k_hit_rate,
    rank_correlation_mean >= 0.0 AS min_rank_correlation, selected_xi_regret_mean <= 24.0 AS max_selected_xi_regret,
    prediction_collapse_weeks <= 0 AS max_prediction_collapse_weeks, bias_flip_weeks <= 0 AS max_bias_flip_weeks,
    prediction_to_actual_ratio_min >= 0.6 AS prediction_ratio_min, prediction_to_actual_ratio_max <= 1.6 AS prediction_ratio_max,
    COALESCE(position_calibration_gain, 0.0) >= 0.0 AS position_calibration_gain_ok, mae < a_mae AS mae_improves_active,
    {_PRIO_LT} AS ranking_priority_improves_active,
    COALESCE(baseline_gate_passed, true) AS baseline_gate_ok, candidate_score < a_score AS balanced_score_improves_active,
    rmse <= a_rmse * (1.0 + 0.03) AS rmse_within_deterioration
  FROM cc, inc, dd),
r AS (SELECT *, concat_ws(',', {", ".join(f"CASE WHEN NOT {c} THEN '{n}' END" for n, c in [(x, {"position_calibration_gain": "position_calibration_gain_ok", "baseline_gate_passed": "baseline_gate_ok"}.get(x, x)) for x in _V4])}) AS failed_gates
      FROM g)
SELECT v.validation_ok, d.drift_triggered, d.breach_ratio, r.mae, r.rmse, r.bias, r.top_k_hit_rate_mean,
       r.selected_xi_regret_mean, r.candidate_score, r.failed_gates = '' AS passed, r.failed_gates,
       CASE WHEN NOT v.validation_ok THEN 'failed_validation' WHEN NOT d.drift_triggered THEN 'no_action'
            WHEN r.failed_gates = '' THEN 'promote' ELSE 'reject' END AS decision
FROM r, val v, dd d""",
        ["breach_ratio", "mae", "rmse", "bias", "top_k_hit_rate_mean", "selected_xi_regret_mean", "candidate_score"],
    )


@register("autonomous_cycle", "V1 V2 A18 A20 A27 A28 V4 V6 M7 (cycle)", _cycle_sql())
def q_autonomous_cycle(spark, sf):
    """The data stages of one autonomous cycle in one result row: validate
    the panel (V1), drift between train and holdout (A18/V2), evaluate the
    candidate (heuristic model) against the active model (the 5-appearance
    baseline) on the recent periods (A9-A11, V6, A20, M7, A27/A28), apply the
    promotion gates (V4) and decide promote / reject / no_action."""
    from panelforge.operators import drift as dr
    from panelforge.operators import metrics as me
    from panelforge.operators import quality as qu
    sc = scored(spark, sf)
    # the scored split holds every panel row: validate it without the added columns
    panel = sc.drop("role", "predicted_points", "total_points_z_score")
    val = qu.validation_report(panel).agg(F.bool_and("ok").alias("validation_ok"))
    tr, ho = sc.filter(F.col("role") == "train"), sc.filter(F.col("role") == "holdout")
    drift = dr.drift_decision(dr.ks_two_sample(tr, ho)).select("drift_triggered", "breach_ratio")
    summ, cmp = comparison(spark, sf)
    cand = summ.filter(F.col("predictor") == "model").drop("predictor", "prediction_collapse_gameweeks")
    base = summ.filter(F.col("predictor") == "five_week_players_roll_avg_points")
    inc = base.select(
        F.col("mae").alias("a_mae"), F.col("rmse").alias("a_rmse"), gt.balanced_score().alias("a_score"),
        gt.ranking_priority().alias("a_priority"),
    )
    sanity = me.sanity_metrics(tr, ho, ACT, "predicted_points").select("position_exceed_rate", "player_exceed_rate")
    coeffs = ca.fit_calibration(tr, ACT, "predicted_points")
    gain = ca.select_variant(ca.calibration_report(ca.variant_long(ho, ACT, "predicted_points", coeffs))).select(
        "position_calibration_gain")
    bgate = cmp.filter(F.col("baseline_name") == "five_week_players_roll_avg_points").select("baseline_gate_passed")
    row = attach_row(attach_row(attach_row(cand, sanity), gain), bgate)
    gates = gt.promotion_gates(row, inc, drift.select("drift_triggered"))
    out = attach_row(attach_row(gates, val), drift.select("breach_ratio"))
    decision = (
        F.when(~F.col("validation_ok"), F.lit("failed_validation"))
        .when(~F.col("drift_triggered"), F.lit("no_action"))
        .when(F.col("passed"), F.lit("promote"))
        .otherwise(F.lit("reject"))
    )
    return round_doubles(out.select(
        "validation_ok", "drift_triggered", "breach_ratio", "mae", "rmse", "bias", "top_k_hit_rate_mean",
        "selected_xi_regret_mean", "candidate_score", "passed", "failed_gates", decision.alias("decision"),
    ))
