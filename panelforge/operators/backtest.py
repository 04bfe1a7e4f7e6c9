"""Weekly back-test: per-period error, ranking and squad metrics.

Shape of the plan (no driver loops, one row per period at the end):

* per-period error aggregates: one ``groupBy(period)`` with map-side partial
  aggregation;
* top-k sets (XI, squad, hit rate, misses): ``row_number() <= k`` windows that
  Spark limits map-side (``WindowGroupLimit``), so only k rows per period and
  partition are shuffled;
* Spearman: average ranks from bucketed prefix sums (see ``ranking``), so a
  period holding most rows is not a single task;
* everything joined on the period key (tiny tables).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row, materialize
from panelforge.operators.ranking import DEFAULT_BUCKETS, auto_buckets, average_rank, pearson, topk


@dataclass(frozen=True)
class BacktestRules:
    # Fixed defaults of the reference's model rules.
    min_ratio: float = 0.6
    max_ratio: float = 1.6
    instability_bias_abs_threshold: float = 10.0
    top_k: int = 11
    xi_size: int = 11
    squad_size: int = 15
    miss_count: int = 5
    likely_minutes: float = 60.0


def _prep(df: DataFrame, actual: str, pred: str) -> DataFrame:
    return df.withColumns(
        {
            "actual_points": F.col(actual).cast("double"),
            "predicted_points": F.col(pred).cast("double"),
        }
    ).withColumns(
        {
            "error_bias": F.col("actual_points") - F.col("predicted_points"),
            "abs_error": F.abs(F.col("actual_points") - F.col("predicted_points")),
        }
    )


def weekly_backtest(
    df: DataFrame,
    actual: str = "target_next_gw_points",
    pred: str = "predicted_points",
    period: str = "target_gameweek_id",
    entity: str = "player_id",
    minutes: str = "minutes_played",
    rules: BacktestRules = BacktestRules(),
    buckets: int = DEFAULT_BUCKETS,
    by: Sequence[str] = (),
    materialize_input: bool = True,
) -> DataFrame:
    """One row per period with totals, ratio, MAE/RMSE/bias, range ratio,
    top-15 squad totals, XI vs oracle XI regret, top-k hit rate, Spearman and
    the collapse flag.  Ties in every top-k: value desc, then entity asc.

    ``by`` adds grouping keys in front of the period (e.g. a predictor name
    on a long-form table), so several predictors are back-tested in one plan.

    The narrow prepared input (keys, entity, minutes, actual, prediction) is
    read by eight branches; ``materialize_input`` checkpoints it once so the
    upstream plan is not recomputed per branch.
    """
    by = list(by)
    keys = [*by, period]
    f = _prep(df, actual, pred)
    has_min = minutes in f.columns
    f = f.select(*keys, entity, *([minutes] if has_min else []), "actual_points", "predicted_points", "error_bias", "abs_error")
    if materialize_input:
        f = materialize(f)
    if buckets is None:
        buckets = auto_buckets(f)
    likely_cond = F.col(minutes) >= rules.likely_minutes if has_min else F.lit(True)

    base = f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("predicted_points"), F.lit(0.0)).alias("prediction_total"),
        F.coalesce(F.sum("actual_points"), F.lit(0.0)).alias("actual_total"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error_bias") * F.col("error_bias"))).alias("rmse"),
        F.avg("error_bias").alias("bias"),
        (F.max("actual_points") - F.min("actual_points")).alias("_act_range"),
        (F.max("predicted_points") - F.min("predicted_points")).alias("_pred_range"),
        F.count_if(likely_cond).alias("_n_likely"),
    )

    by_pred = [F.col("predicted_points").desc(), F.col(entity).asc()]
    by_act = [F.col("actual_points").desc(), F.col(entity).asc()]
    squad = (
        topk(f.filter(F.col("predicted_points").isNotNull()), keys, by_pred, rules.squad_size)
        .groupBy(*keys)
        .agg(
            F.sum("predicted_points").alias("selected_squad_predicted_total"),
            F.coalesce(F.sum("actual_points"), F.lit(0.0)).alias("selected_squad_actual_total"),
            F.coalesce(F.sum(F.when(F.col("rn") <= rules.xi_size, F.col("actual_points"))), F.lit(0.0)).alias(
                "selected_xi_actual_total"
            ),
        )
    )
    oracle = (
        topk(f.filter(F.col("actual_points").isNotNull()), keys, by_act, rules.xi_size)
        .groupBy(*keys)
        .agg(F.sum("actual_points").alias("oracle_xi_actual_total"))
    )
    likely = f.filter(likely_cond)
    tp = topk(likely.filter(F.col("predicted_points").isNotNull()), keys, by_pred, rules.top_k).select(*keys, entity)
    ta = topk(likely.filter(F.col("actual_points").isNotNull()), keys, by_act, rules.top_k).select(*keys, entity)
    hits = tp.join(ta, [*keys, entity]).groupBy(*keys).agg(F.count(F.lit(1)).alias("_hits"))

    ranked = average_rank(likely, keys, "predicted_points", "_rp", buckets)
    ranked = average_rank(ranked, keys, "actual_points", "_ra", buckets)
    corr = ranked.groupBy(*keys).agg(pearson("_rp", "_ra").alias("rank_correlation"))

    k = F.least(F.lit(rules.top_k), F.col("_n_likely"))
    ratio = F.col("prediction_total") / F.greatest(F.col("actual_total"), F.lit(1e-9))
    out = (
        base.join(squad, keys, "left")
        .join(oracle, keys, "left")
        .join(hits, keys, "left")
        .join(corr, keys, "left")
        .withColumns(
            {
                "prediction_to_actual_ratio": ratio,
                "prediction_range_ratio": F.col("_pred_range") / F.greatest(F.col("_act_range"), F.lit(1e-9)),
                "selected_squad_bias": F.col("selected_squad_actual_total") - F.col("selected_squad_predicted_total"),
                "selected_xi_regret": F.col("oracle_xi_actual_total") - F.col("selected_xi_actual_total"),
                "top_k_hit_rate": F.when(k > 0, F.coalesce(F.col("_hits"), F.lit(0)) / k),
                "rank_correlation": F.when(k > 0, F.col("rank_correlation")),
                "prediction_collapse": (ratio < rules.min_ratio) | (ratio > rules.max_ratio),
            }
        )
    )
    return out.select(
        *by,
        F.col(period).cast("int").alias("gameweek_id"),
        "n_rows",
        "prediction_total",
        "actual_total",
        "prediction_to_actual_ratio",
        "mae",
        "rmse",
        "bias",
        "prediction_range_ratio",
        "selected_squad_predicted_total",
        "selected_squad_actual_total",
        "selected_squad_bias",
        "selected_xi_actual_total",
        "oracle_xi_actual_total",
        "selected_xi_regret",
        "top_k_hit_rate",
        "rank_correlation",
        "prediction_collapse",
    )


def segment_totals(
    df: DataFrame,
    actual: str = "target_next_gw_points",
    pred: str = "predicted_points",
    period: str = "target_gameweek_id",
    segment: str = "position_id",
) -> DataFrame:
    """A10: per (period, segment) totals and bias, plus the all-weeks segment
    summary as the rows whose ``gameweek_id`` is NULL (one GROUPING SETS pass).
    """
    f = _prep(df, actual, pred)
    return (
        f.rollup(segment, period)  # (segment, period), (segment), ()
        .agg(
            F.grouping_id().alias("_gid"),
            F.count(F.lit(1)).alias("count"),
            F.sum("predicted_points").alias("predicted_points"),
            F.sum("actual_points").alias("actual_points"),
            F.avg("abs_error").alias("mae"),
            F.avg("error_bias").alias("mean_bias"),
        )
        .filter(F.col("_gid") < 3)
        .select(
            F.col(period).cast("int").alias("gameweek_id"),
            F.col(segment).cast("int").alias("position_id"),
            "count",
            "predicted_points",
            "actual_points",
            (F.col("actual_points") - F.col("predicted_points")).alias("bias"),
            "mae",
            "mean_bias",
        )
    )


def bias_flips(weekly: DataFrame, threshold: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Consecutive periods whose bias changes sign with both |bias| >= threshold.

    ``weekly`` is the per-period table (one row per period), so the
    un-partitioned window runs over #periods rows only.
    """
    w = Window.partitionBy(*by).orderBy("gameweek_id")
    prev = weekly.select(
        *by,
        F.lag("gameweek_id").over(w).alias("prev_gameweek_id"),
        F.col("gameweek_id"),
        F.lag("bias").over(w).alias("prev_bias"),
        F.col("bias"),
    )
    s0, s1 = F.signum("prev_bias"), F.signum("bias")
    cond = (
        F.col("prev_bias").isNotNull()
        & (s0 != 0)
        & (s1 != 0)
        & (s0 != s1)
        & (F.abs("prev_bias") >= threshold)
        & (F.abs("bias") >= threshold)
    )
    return prev.filter(cond).select(
        *by, F.col("prev_gameweek_id").cast("int"), F.col("gameweek_id").cast("int"), "prev_bias", "bias"
    )


def largest_misses(
    df: DataFrame,
    actual: str = "target_next_gw_points",
    pred: str = "predicted_points",
    period: str = "target_gameweek_id",
    entity: str = "player_id",
    n: int = 5,
    overall: bool = False,
) -> DataFrame:
    """Top-n absolute errors per period, or over all of them (ties: entity
    asc, then period asc)."""
    f = _prep(df, actual, pred).filter(F.col("abs_error").isNotNull())
    cols = [F.col(period).cast("int").alias("gameweek_id"), F.col("rn").cast("int").alias("miss_rank"), entity]
    if "web_name" in f.columns:
        cols.append("web_name")
    order = [F.col("abs_error").desc(), F.col(entity).asc(), F.col(period).asc()]
    if overall:
        worst = f.orderBy(*order).limit(n)  # TakeOrderedAndProject: n rows per task
        t = worst.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    else:
        t = topk(f, [period], order, n)
    return t.select(*cols, "actual_points", "predicted_points", "abs_error")


def largest_misses_nested(df: DataFrame, **kw) -> DataFrame:
    """W8 in report form: one row per period with an ordered array of structs."""
    flat = largest_misses(df, **kw)
    return flat.groupBy("gameweek_id").agg(
        F.sort_array(F.collect_list(F.struct("miss_rank", *[c for c in flat.columns if c not in ("gameweek_id", "miss_rank")]))).alias(
            "largest_player_misses"
        )
    )


def backtest_summary(
    df: DataFrame,
    weekly: DataFrame,
    actual: str = "target_next_gw_points",
    pred: str = "predicted_points",
    segment: str = "position_id",
    rules: BacktestRules = BacktestRules(),
    by: Sequence[str] = (),
) -> DataFrame:
    """One summary row (per ``by`` key) over the per-period table and the
    row-level frame."""
    by = list(by)
    f = _prep(df, actual, pred)

    def grouped(d: DataFrame):
        return d.groupBy(*by) if by else d.groupBy()

    rows = grouped(f).agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error_bias") * F.col("error_bias"))).alias("rmse"),
        F.avg("error_bias").alias("bias"),
    )
    if segment in f.columns:
        seg = grouped(f.groupBy(*by, segment).agg(F.avg("error_bias").alias("_b"))).agg(
            F.coalesce(F.max(F.abs("_b")), F.lit(0.0)).alias("max_position_bias_abs")
        )
    else:
        seg = grouped(f).agg(F.lit(0.0).alias("max_position_bias_abs"))
    flips = grouped(bias_flips(weekly, rules.instability_bias_abs_threshold, by)).agg(
        F.count(F.lit(1)).alias("bias_flip_weeks")
    )
    wk = grouped(weekly).agg(
        F.count(F.lit(1)).alias("weekly_count"),
        F.coalesce(F.avg("top_k_hit_rate"), F.lit(0.0)).alias("top_k_hit_rate_mean"),
        F.coalesce(F.avg("rank_correlation"), F.lit(0.0)).alias("rank_correlation_mean"),
        F.coalesce(F.avg("selected_xi_regret"), F.lit(0.0)).alias("selected_xi_regret_mean"),
        F.coalesce(F.avg("selected_xi_actual_total"), F.lit(0.0)).alias("selected_xi_actual_total_mean"),
        F.coalesce(F.avg("oracle_xi_actual_total"), F.lit(0.0)).alias("oracle_xi_actual_total_mean"),
        F.coalesce(F.avg(F.abs("selected_squad_bias")), F.lit(0.0)).alias("squad_total_bias_abs_mean"),
        F.coalesce(F.min("prediction_to_actual_ratio"), F.lit(1.0)).alias("prediction_to_actual_ratio_min"),
        F.coalesce(F.max("prediction_to_actual_ratio"), F.lit(1.0)).alias("prediction_to_actual_ratio_max"),
        F.count_if("prediction_collapse").alias("prediction_collapse_weeks"),
        F.sort_array(F.collect_list(F.when(F.col("prediction_collapse"), F.col("gameweek_id")))).alias(
            "prediction_collapse_gameweeks"
        ),
    )
    if not by:
        return attach_row(attach_row(attach_row(wk, rows), seg), flips)
    out = wk.join(rows, by, "left").join(seg, by, "left").join(flips, by, "left")
    return out.withColumn("bias_flip_weeks", F.coalesce(F.col("bias_flip_weeks"), F.lit(0).cast("bigint")))
