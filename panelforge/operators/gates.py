"""Candidate scoring, convergence and gate operators (A27, A28, A30, W15,
V3, V4, V5, P34).

Gates are column expressions over one row per candidate (wide), so any number
of candidates is checked in one pass; an incumbent / summary row is attached
as a one-row broadcast.  ``stack_gates`` turns a wide gate row into
(gate, passed) rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row
from panelforge.operators.ranking import DEFAULT_BUCKETS, prefix_min, topk


@dataclass(frozen=True)
class ModelRules:
    # Fixed values of the reference's shipped model rules.
    max_mae: float = 6.0
    max_rmse: float = 8.0
    max_abs_bias: float = 1.0
    max_position_exceed_rate: float = 0.1
    max_player_exceed_rate: float = 0.1
    rmse_deterioration_pct: float = 0.03
    max_squad_total_bias: float = 16.0
    max_position_bias: float = 2.5
    min_top_k_hit_rate: float = 0.25
    min_rank_correlation: float = 0.0
    max_selected_xi_regret: float = 24.0
    max_prediction_collapse_weeks: int = 0
    max_bias_flip_weeks: int = 0
    instability_bias_abs_threshold: float = 10.0
    min_prediction_to_actual_ratio: float = 0.6
    max_prediction_to_actual_ratio: float = 1.6
    required_baseline: str = "five_week_players_roll_avg_points"
    allow_forward_publish_override: bool = True
    min_position_calibration_gain: float = 0.0


# Fixed values of the reference's hyper-parameter search space:
# (name, min, max, is_int).
SEARCH_SPACE = (
    ("n_estimators", 50, 1000, True),
    ("max_depth", 2, 10, True),
    ("learning_rate", 0.01, 0.3, False),
    ("subsample", 0.5, 1.0, False),
    ("colsample_bytree", 0.5, 1.0, False),
    ("reg_alpha", 0.0, 10.0, False),
    ("reg_lambda", 0.1, 10.0, False),
    ("min_child_weight", 0.1, 10.0, False),
    ("gamma", 0.0, 5.0, False),
    ("max_delta_step", 0.0, 10.0, False),
    ("shrinkage_alpha", 0.0, 0.5, False),
    ("calibration_strength", 0.0, 1.0, False),
)


def bounds_frame(spark) -> DataFrame:
    return spark.createDataFrame(
        [(n, float(lo), float(hi), bool(i)) for n, lo, hi, i in SEARCH_SPACE], "param string, lo double, hi double, is_int boolean"
    )


def balanced_score(mae: Column | str = "mae") -> Column:
    """Mae + .05 squad bias + .03 regret + 1.5 max(0,.30-hit) +
    max(0,.10-corr) + 2 collapse weeks (lower is better)."""
    m = F.col(mae) if isinstance(mae, str) else mae
    return (
        m
        + 0.05 * F.col("squad_total_bias_abs_mean")
        + 0.03 * F.col("selected_xi_regret_mean")
        + 1.5 * F.greatest(F.lit(0.0), 0.30 - F.col("top_k_hit_rate_mean"))
        + 1.0 * F.greatest(F.lit(0.0), 0.10 - F.col("rank_correlation_mean"))
        + 2.0 * F.col("prediction_collapse_weeks")
    )


def ranking_priority() -> Column:
    """Lexicographic (regret, -hit, -corr, rmse, mae); smaller is better."""
    return F.struct(
        F.col("selected_xi_regret_mean").alias("p1"),
        (-F.col("top_k_hit_rate_mean")).alias("p2"),
        (-F.col("rank_correlation_mean")).alias("p3"),
        F.col("rmse").alias("p4"),
        F.col("mae").alias("p5"),
    )


def leaderboard(cands: DataFrame, key: str = "iteration") -> DataFrame:
    """A27 + A28: per candidate score and priority, plus the best candidate by
    each (one global aggregate with map-side partial min, no global sort)."""
    c = cands.withColumns({"candidate_score": balanced_score(), "priority": ranking_priority()})
    best = c.agg(
        F.min_by(F.col(key), F.struct(F.col("priority"), F.col(key))).alias("__best_prio"),
        F.min_by(F.col(key), F.struct(F.col("candidate_score"), F.col(key))).alias("__best_score"),
    )
    out = attach_row(c, best)
    return out.withColumns(
        {
            "is_best_priority": F.col(key) == F.col("__best_prio"),
            "is_best_score": F.col(key) == F.col("__best_score"),
        }
    ).drop("__best_prio", "__best_score", "priority")


def convergence_check(exps: DataFrame, n_recent: int = 3, metric: str = "mae", order: str = "iteration",
                      feasible: str | None = None) -> DataFrame:
    """Stop when min(metric) of the last ``n_recent`` experiments is not
    better than the min of the earlier ones (needs more than ``n_recent``;
    ``feasible`` restricts both sides to feasible experiments).  The last-n
    cut is a top-k (partial limit per partition), not a global sort."""
    last = topk(exps.select(order), [], [F.col(order).desc()], n_recent).agg(
        F.min(order).alias("__cut"), F.count(F.lit(1)).alias("__k")
    )
    e = attach_row(exps, last)
    ok = F.col(feasible) if feasible else F.lit(True)
    recent = F.col(order) >= F.col("__cut")
    agg = e.agg(
        F.count(F.lit(1)).alias("n_experiments"),
        F.min(F.when(recent & ok, F.col(metric))).alias("best_recent"),
        F.min(F.when(~recent & ok, F.col(metric))).alias("best_before"),
    )
    enough = F.col("n_experiments") >= n_recent + 1
    both = F.col("best_recent").isNotNull() & F.col("best_before").isNotNull()
    return agg.withColumn("stop", enough & both & (F.col("best_recent") >= F.col("best_before")))


def best_so_far(exps: DataFrame, metric: str = "mae", order: str = "iteration", feasible: str | None = None,
                buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Running best (min) of ``metric`` over iterations (feasible only
    when given); bucketed so it does not run in one task."""
    v = F.when(F.col(feasible), F.col(metric)) if feasible else F.col(metric)
    return prefix_min(exps.withColumn("__v", v), [], order, "__v", "best_so_far", buckets).drop("__v")


def clamp_to_bounds(params: DataFrame, bounds: DataFrame) -> DataFrame:
    """Long-form params (candidate, param, value) clamped to
    [lo, hi] of ``bounds`` (param, lo, hi, is_int); ints rounded half-even."""
    j = params.join(bounds, "param", "left")
    v = F.when(F.col("is_int"), F.bround(F.col("value"), 0)).otherwise(F.col("value"))
    c = F.greatest(F.col("lo"), F.least(F.col("hi"), v))
    return j.withColumn("clamped", F.when(F.col("lo").isNotNull(), c).otherwise(F.col("value")))


def promotion_gates(cands: DataFrame, incumbent: DataFrame, drift: DataFrame, rules: ModelRules = ModelRules()) -> DataFrame:
    """V4: 21 checks per candidate against the rules and the active model
    (``incumbent``: one row with a_mae, a_rmse, a_score, a_priority)."""
    r = rules
    c = attach_row(attach_row(cands.withColumns({"candidate_score": balanced_score(), "priority": ranking_priority()}), incumbent), drift)
    g = {
        "drift_context_present": F.coalesce(F.col("drift_triggered"), F.lit(False)),
        "max_mae": F.col("mae") <= r.max_mae,
        "max_rmse": F.col("rmse") <= r.max_rmse,
        "max_abs_bias": F.abs("bias") <= r.max_abs_bias,
        "position_exceed_cap": F.col("position_exceed_rate") <= r.max_position_exceed_rate,
        "player_exceed_cap": F.col("player_exceed_rate") <= r.max_player_exceed_rate,
        "max_squad_total_bias": F.col("squad_total_bias_abs_mean") <= r.max_squad_total_bias,
        "max_position_bias": F.col("max_position_bias_abs") <= r.max_position_bias,
        "min_top_k_hit_rate": F.col("top_k_hit_rate_mean") >= r.min_top_k_hit_rate,
        "min_rank_correlation": F.col("rank_correlation_mean") >= r.min_rank_correlation,
        "max_selected_xi_regret": F.col("selected_xi_regret_mean") <= r.max_selected_xi_regret,
        "max_prediction_collapse_weeks": F.col("prediction_collapse_weeks") <= r.max_prediction_collapse_weeks,
        "max_bias_flip_weeks": F.col("bias_flip_weeks") <= r.max_bias_flip_weeks,
        "prediction_ratio_min": F.col("prediction_to_actual_ratio_min") >= r.min_prediction_to_actual_ratio,
        "prediction_ratio_max": F.col("prediction_to_actual_ratio_max") <= r.max_prediction_to_actual_ratio,
        "position_calibration_gain": F.coalesce(F.col("position_calibration_gain"), F.lit(0.0)) >= r.min_position_calibration_gain,
        "mae_improves_active": F.col("a_mae").isNull() | (F.col("mae") < F.col("a_mae")),
        "ranking_priority_improves_active": F.col("a_priority").isNull() | (F.col("priority") < F.col("a_priority")),
        "baseline_gate_passed": F.coalesce(F.col("baseline_gate_passed"), F.lit(True)),
        "balanced_score_improves_active": F.col("a_score").isNull() | (F.col("candidate_score") < F.col("a_score")),
        "rmse_within_deterioration": F.col("a_rmse").isNull() | (F.col("rmse") <= F.col("a_rmse") * (1.0 + r.rmse_deterioration_pct)),
    }
    return _finish(c, g)


def reviewer_gates(cands: DataFrame, incumbent: DataFrame, rules: ModelRules = ModelRules(),
                   bias_sd_mult: float = 0.25, pos_exceed_pct: float = 0.05, player_exceed_pct: float = 0.05,
                   rmse_worse_pct: float = 0.05) -> DataFrame:
    """V5: 14 checks per candidate against the rules and the best model so far
    (``incumbent``: a_mae, a_rmse, a_priority)."""
    r = rules
    c = attach_row(cands.withColumn("priority", ranking_priority()), incumbent)
    sd = F.col("actual_std")
    g = {
        "bias_gate": F.when(sd > 0, F.abs("bias") <= bias_sd_mult * sd).otherwise(F.lit(True)),
        "pos_cap_gate": F.coalesce(F.col("position_exceed_rate") <= pos_exceed_pct, F.lit(True)),
        "player_cap_gate": F.coalesce(F.col("player_exceed_rate") <= player_exceed_pct, F.lit(True)),
        "rmse_gate": F.col("a_rmse").isNull() | (F.col("rmse") <= F.col("a_rmse") * (1.0 + rmse_worse_pct)),
        "mae_gate": F.col("a_mae").isNull() | (F.col("mae") <= F.col("a_mae") * 1.01),
        "realism_gate": F.col("squad_total_bias_abs_mean") <= r.max_squad_total_bias,
        "position_bias_gate": F.col("max_position_bias_abs") <= r.max_position_bias,
        "ranking_gate": F.col("top_k_hit_rate_mean") >= r.min_top_k_hit_rate,
        "rank_corr_gate": F.col("rank_correlation_mean") >= r.min_rank_correlation,
        "xi_regret_gate": F.col("selected_xi_regret_mean") <= r.max_selected_xi_regret,
        "collapse_gate": F.col("prediction_collapse_weeks") <= r.max_prediction_collapse_weeks,
        "instability_gate": F.col("bias_flip_weeks") <= r.max_bias_flip_weeks,
        "baseline_gate": F.coalesce(F.col("baseline_gate_passed"), F.lit(True)),
        "priority_gate": F.col("a_priority").isNull() | (F.col("priority") <= F.col("a_priority")),
    }
    return _finish(c, g)


def _finish(c: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """A gate that can't be decided (NULL) is a failed one."""
    out = c.withColumns({n: F.coalesce(g, F.lit(False)) for n, g in gates.items()})
    names = list(gates)
    failed = F.filter(
        F.array(*[F.when(~F.col(n), F.lit(n)) for n in names]), lambda x: x.isNotNull()
    )
    return out.withColumns({"failed_gates": F.array_join(failed, ","), "passed": F.size(failed) == 0})


def stack_gates(wide: DataFrame, keys: Sequence[str], gates: Sequence[str]) -> DataFrame:
    """Wide gate columns -> (keys..., gate, passed) rows via ``stack``."""
    args = ", ".join(f"'{g}', `{g}`" for g in gates)
    return wide.select(*keys, F.expr(f"stack({len(gates)}, {args}) AS (gate, passed)"))


def publication_gates(summary: DataFrame, baseline: DataFrame, calib: DataFrame, rules: ModelRules = ModelRules(),
                      tolerance: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """V3: 12 publication gates from the back-test summary, the required-baseline
    comparison (b_hit, b_regret, gate) and the selected calibration deltas (one
    row each, or one for every ``by`` key); ready = all or override."""
    r, by = rules, list(by)
    row = summary.join(baseline, by, "left").join(calib, by, "left") if by else attach_row(attach_row(summary, baseline), calib)
    g = {
        "max_prediction_collapse_weeks": F.col("prediction_collapse_weeks") <= r.max_prediction_collapse_weeks,
        "max_bias_flip_weeks": F.col("bias_flip_weeks") <= r.max_bias_flip_weeks,
        "min_top_k_hit_rate": F.col("top_k_hit_rate_mean") >= r.min_top_k_hit_rate,
        "min_rank_correlation": F.col("rank_correlation_mean") >= r.min_rank_correlation,
        "max_selected_xi_regret": F.col("selected_xi_regret_mean") <= r.max_selected_xi_regret,
        "prediction_ratio_min": F.col("prediction_to_actual_ratio_min") >= r.min_prediction_to_actual_ratio,
        "prediction_ratio_max": F.col("prediction_to_actual_ratio_max") <= r.max_prediction_to_actual_ratio,
        "baseline_top_k_hit_rate": F.coalesce(F.round("m_hit", 9) > F.round("b_hit", 9), F.lit(True)),
        "baseline_selected_xi_regret": F.coalesce(F.round("m_regret", 9) < F.round("b_regret", 9), F.lit(True)),
        "baseline_gate_passed": F.coalesce(F.col("baseline_gate_passed"), F.lit(True)),
        "calibration_safe_mae": F.coalesce(F.col("selected_delta_mae"), F.lit(0.0)) <= tolerance,
        "calibration_safe_rmse": F.coalesce(F.col("selected_delta_rmse"), F.lit(0.0)) <= tolerance,
    }
    out = _finish(row.select("*"), g)
    raw = F.col("passed")
    return out.select(
        *by,
        *g.keys(),
        F.col("failed_gates").alias("reasons"),
        (raw | F.lit(r.allow_forward_publish_override)).alias("ready"),
        F.lit(r.allow_forward_publish_override).alias("override_enabled"),
        (F.lit(r.allow_forward_publish_override) & ~raw).alias("override_forced_ready"),
    )
