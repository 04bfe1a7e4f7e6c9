"""Error and distribution metrics.

All are grouped aggregates (partial aggregation map-side).  Exact percentiles
(linear interpolation, numpy's default) come from distributed running counts,
never from the approximate sketch and never by collecting a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row
from panelforge.operators.features import MINUTES_BANDS, minutes_band_expr
from panelforge.operators.ranking import exact_percentile


def _err(actual: str, pred: str) -> tuple[Column, Column]:
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return a - p, F.abs(a - p)


def error_metrics(df: DataFrame, actual: str, pred: str, group: Sequence[str] = ()) -> DataFrame:
    """A5 + A5b: MAE, RMSE, bias = mean(actual - pred), R^2 (NULL when the
    actual has no variance), n."""
    e, ae = _err(actual, pred)
    a = F.col(actual).cast("double")
    ss_tot = F.var_pop(a) * F.count(a)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(ae).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e).alias("bias"),
        F.when(ss_tot > 0, 1 - F.sum(e * e) / ss_tot).alias("r2"),
    ]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def group_bias(df: DataFrame, actual: str, pred: str, group: str) -> DataFrame:
    """Count, mean prediction, mean actual, MAE and bias per group value."""
    e, ae = _err(actual, pred)
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(F.col(pred).cast("double")).alias("avg_predicted_points"),
        F.avg(F.col(actual).cast("double")).alias("avg_actual_points"),
        F.avg(ae).alias("mae"),
        F.avg(e).alias("bias"),
    )


def band_bias(df: DataFrame, actual: str, pred: str, minutes: str = "minutes_played") -> DataFrame:
    """A6 by minutes band; empty bands are kept (count 0, NULL means) by a
    right join onto the fixed 3-row band dimension (broadcast, bounded)."""
    spark = df.sparkSession
    bands = spark.createDataFrame([(label, i) for i, (label, _, _) in enumerate(MINUTES_BANDS)], "minutes_band string, band_order int")
    b = group_bias(df.withColumn("minutes_band", minutes_band_expr(F.col(minutes))).filter(F.col("minutes_band").isNotNull()), actual, pred, "minutes_band")
    return F.broadcast(bands).join(b, "minutes_band", "left").withColumn(
        "count", F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    )


def focus_bias(df: DataFrame, actual: str, pred: str, segment: str = "position_id", focus: Sequence[int] = (1, 2)) -> DataFrame:
    """Mean over focus segments of |mean(actual - pred)|; 0.0 when none."""
    e, _ = _err(actual, pred)
    per = df.filter(F.col(segment).isin(list(focus))).groupBy(segment).agg(F.avg(e).alias("_b"))
    return per.agg(F.coalesce(F.avg(F.abs("_b")), F.lit(0.0)).alias("focus_abs_bias"))


def percentile_caps(df: DataFrame, group: str, target: str, min_count: int = 1, q: float = 0.95) -> DataFrame:
    """A4: exact p95 of the target per group (linear interpolation), groups with
    count >= min_count.  Computed from distributed running counts
    (``ranking.exact_percentile``), so a huge group is never collected into
    one task; rows with a NULL target do not count."""
    return exact_percentile(df, [group], target, q, "cap").filter(F.col("n") >= min_count)


def target_stats(df: DataFrame, target: str = "target_next_gw_points", source_period: str = "gameweek_id", target_period: str = "target_gameweek_id") -> DataFrame:
    """A3: target mean / sample std / min / max, league mean and training window."""
    t = F.col(target).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(t).alias("target_mean"),
        F.stddev_samp(t).alias("target_std"),
        F.min(t).alias("target_min"),
        F.max(t).alias("target_max"),
        F.avg(t).alias("league_mean"),
        F.min(source_period).cast("int").alias("train_min_gameweek"),
        F.max(source_period).cast("int").alias("train_max_gameweek"),
        F.max(target_period).cast("int").alias("train_max_target_gameweek"),
    )


def panel_profile(df: DataFrame, entity: str = "player_id", period: str = "gameweek_id") -> DataFrame:
    """Rows, distinct entities and periods, period range."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(entity).alias("n_entities"),
        F.countDistinct(period).alias("n_periods"),
        F.min(period).cast("int").alias("min_period"),
        F.max(period).cast("int").alias("max_period"),
    )


def cap_exceed_rate(holdout: DataFrame, pred: str, caps: DataFrame, key: str) -> DataFrame:
    """A21 + J6: share of predictions above their key's cap, over rows that have
    a cap (inner join); no caps -> (0.0, 0).  ``caps`` is one row per key; it
    is joined normally (AQE broadcasts it when small at run time)."""
    j = holdout.select(key, F.col(pred).cast("double").alias("_p")).join(caps.select(key, "cap"), key)
    return j.agg(
        F.coalesce(F.avg((F.col("_p") > F.col("cap")).cast("double")), F.lit(0.0)).alias("exceed_rate"),
        F.count(F.lit(1)).alias("exceed_n"),
    )


def sanity_metrics(train: DataFrame, holdout: DataFrame, actual: str, pred: str, min_player_history: int = 10) -> DataFrame:
    """Population mean/std/min/max of actual and prediction, segment and
    entity cap exceed rates (caps from train), in one row."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    stats = holdout.agg(
        F.avg(a).alias("actual_mean"), F.stddev_pop(a).alias("actual_std"), F.min(a).alias("actual_min"), F.max(a).alias("actual_max"),
        F.avg(p).alias("pred_mean"), F.stddev_pop(p).alias("pred_std"), F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
    )
    pos_caps = percentile_caps(train, "position_id", actual)
    ply_caps = percentile_caps(train, "player_id", actual, min_count=min_player_history)
    pos = cap_exceed_rate(holdout, pred, pos_caps, "position_id").select(
        F.col("exceed_rate").alias("position_exceed_rate"), F.col("exceed_n").alias("position_exceed_n")
    )
    ply = cap_exceed_rate(holdout, pred, ply_caps, "player_id").select(
        F.col("exceed_rate").alias("player_exceed_rate"), F.col("exceed_n").alias("player_exceed_n")
    )
    n_caps = ply_caps.agg(F.count(F.lit(1)).alias("player_caps_count"))
    return attach_row(attach_row(attach_row(stats, pos), ply), n_caps)
