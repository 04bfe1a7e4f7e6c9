"""Calibration fit / apply / report / selection and post-processing
(A12, A13, J4, J5, M7, P22-P25).

Coefficients live in a small long-form table ``(scope, position_id, a, b,
count, fallback)``; applying them is a join on the segment.  The table is
derived (one row per segment), so no eager size check is run on it (that
would recompute its whole lineage); AQE broadcasts it from its measured
run-time size.  Variant
metrics are computed on a long form ``(variant, actual, pred)`` in one grouped
pass instead of one pass per variant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row

# Fixed defaults of the reference's training script.
CALIBRATION_STRENGTH = 0.8
POSITION_MIN_SAMPLES = 25
CALIBRATION_TOLERANCE = 0.0
FOCUS_SEGMENTS = (1, 2)
VARIANT_PRIORITY = (("none", 0), ("global", 1), ("position_aware", 2))


def _coef(prefix: str, strength: float | Column) -> dict[str, Column]:
    # P24 clamp
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), strength)) if isinstance(strength, Column) else max(0.0, min(1.0, float(strength)))
    sp, st = F.col(f"{prefix}sp"), F.col(f"{prefix}st")
    a_raw = F.when(sp == 0, F.lit(1.0)).otherwise(st / sp)
    b_raw = F.when(sp == 0, F.lit(0.0)).otherwise(F.col(f"{prefix}mt") - a_raw * F.col(f"{prefix}mp"))
    return {"a": 1.0 + s * (a_raw - 1.0), "b": s * b_raw}


def _moments(actual: str, pred: str, prefix: str = "") -> list[Column]:
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    return [
        F.stddev_pop(a).alias(f"{prefix}st"),
        F.stddev_pop(p).alias(f"{prefix}sp"),
        F.avg(a).alias(f"{prefix}mt"),
        F.avg(p).alias(f"{prefix}mp"),
        F.count(F.lit(1)).alias(f"{prefix}n"),
    ]


def fit_calibration(
    df: DataFrame,
    actual: str,
    pred: str,
    segment: str = "position_id",
    strength: float | Column = CALIBRATION_STRENGTH,
    min_samples: int = POSITION_MIN_SAMPLES,
    by: Sequence[str] = (),
) -> DataFrame:
    """mean/std matching a = sd_true/sd_pred (population), b = mean_t - a mean_p,
    sd_pred = 0 -> (1, 0), blended toward identity by ``strength`` (a column of the
    ``by`` keys, too); per segment with fewer than ``min_samples`` rows -> the global coefficients.

    One rollup yields the global and the per-segment moments of every
    ``by`` key; the fallback is a window over that small result (#segments + 1 rows a key).
    """
    by = list(by)
    d = df.select(*by, F.col(segment).alias("__seg"), F.col(actual).alias("__a"), F.col(pred).alias("__p")).filter(
        F.col("__seg").isNotNull()
    )
    m = d.rollup(*by, "__seg").agg(F.grouping_id().alias("__gid"), *_moments("__a", "__p"))
    m = m.filter("__gid <= 1").withColumn("__g", F.col("__gid") == 1)  # segments and all of them, of each key
    c = _coef("", strength)
    m = m.select(*by, "__seg", "__g", c["a"].alias("a"), c["b"].alias("b"), "n")
    whole = Window.partitionBy(*by)
    is_g = F.col("__g")
    ga = F.max(F.when(is_g, F.col("a"))).over(whole)
    gb = F.max(F.when(is_g, F.col("b"))).over(whole)
    small = ~is_g & (F.col("n") < min_samples)
    return m.select(
        *by,
        F.when(is_g, F.lit("global")).otherwise(F.lit("position")).alias("scope"),
        F.when(is_g, F.lit(None)).otherwise(F.col("__seg")).cast("int").alias("position_id"),
        F.when(small, ga).otherwise(F.col("a")).alias("a"),
        F.when(small, gb).otherwise(F.col("b")).alias("b"),
        F.col("n").alias("count"),
        F.when(small, F.lit("global")).cast("string").alias("fallback"),
    )


def _with_global(df: DataFrame, coeffs: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with the global coefficients (of its ``by`` key) as __ga and __gb."""
    g = coeffs.filter(F.col("scope") == "global").select(*by, F.col("a").alias("__ga"), F.col("b").alias("__gb"))
    return df.join(g, list(by), "left") if by else attach_row(df, g)


def apply_global(df: DataFrame, pred: str, coeffs: DataFrame, out: str, by: Sequence[str] = ()) -> DataFrame:
    return _with_global(df, coeffs, by).withColumn(out, F.col("__ga") * F.col(pred) + F.col("__gb")).drop("__ga", "__gb")


def apply_position(df: DataFrame, pred: str, coeffs: DataFrame, out: str, segment: str = "position_id", by: Sequence[str] = ()) -> DataFrame:
    """Per-segment coefficients with the global row as fallback for
    segments without an entry."""
    by = list(by)
    s = coeffs.filter(F.col("scope") == "position").select(
        *[F.col(c).alias(f"__by_{c}") for c in by], F.col("position_id").alias("__seg"), F.col("a").alias("__sa"), F.col("b").alias("__sb")
    )
    # One row per segment (and key); AQE broadcasts it from its measured run-time size.
    on = F.col(segment) == F.col("__seg")
    for c in by:
        on = on & (F.col(c) == F.col(f"__by_{c}"))
    j = _with_global(df, coeffs, by).join(s, on, "left")
    a = F.coalesce(F.col("__sa"), F.col("__ga"))
    b = F.coalesce(F.col("__sb"), F.col("__gb"))
    return j.withColumn(out, a * F.col(pred) + b).drop("__ga", "__gb", "__seg", "__sa", "__sb", *[f"__by_{c}" for c in by])


def variant_long(holdout: DataFrame, actual: str, pred: str, train_coeffs: DataFrame, segment: str = "position_id", by: Sequence[str] = ()) -> DataFrame:
    """Holdout rows in long form (variant, actual, pred, segment) for none /
    global / position_aware."""
    base = holdout.select(*by, F.col(actual).cast("double").alias("actual"), F.col(pred).cast("double").alias("pred"), F.col(segment).alias("segment"))
    glob = apply_global(base, "pred", train_coeffs, "pred_global", by)
    both = apply_position(glob, "pred", train_coeffs, "pred_position", "segment", by)
    return both.select(
        *by,
        "actual",
        "segment",
        F.explode(
            F.array(
                F.struct(F.lit("none").alias("variant"), F.col("pred").alias("p")),
                F.struct(F.lit("global").alias("variant"), F.col("pred_global").alias("p")),
                F.struct(F.lit("position_aware").alias("variant"), F.col("pred_position").alias("p")),
            )
        ).alias("v"),
    ).select(*by, F.col("v.variant").alias("variant"), "actual", F.col("v.p").alias("pred"), "segment")


def calibration_report(long: DataFrame, focus: Sequence[int] = FOCUS_SEGMENTS, by: Sequence[str] = ()) -> DataFrame:
    """Per variant MAE / RMSE / bias, focus-segment abs bias, deltas vs none.

    One pass over the long form grouped by (variant, segment); the variant
    rows and deltas come from windows over that small table.
    """
    e = F.col("actual") - F.col("pred")
    per_seg = long.groupBy(*by, "variant", "segment").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.abs(e)).alias("_sae"),
        F.sum(e * e).alias("_sse"),
        F.sum(e).alias("_se"),
        F.avg(e).alias("_b"),
    )
    is_focus = F.col("segment").isin(list(focus))
    rep = per_seg.groupBy(*by, "variant").agg(
        (F.sum("_sae") / F.sum("_n")).alias("mae"),
        F.sqrt(F.sum("_sse") / F.sum("_n")).alias("rmse"),
        (F.sum("_se") / F.sum("_n")).alias("bias"),
        F.coalesce(F.avg(F.when(is_focus, F.abs("_b"))), F.lit(0.0)).alias("focus_abs_bias"),
    )
    whole = Window.partitionBy(*by)
    base = {k: F.max(F.when(F.col("variant") == "none", F.col(k))).over(whole) for k in ("mae", "rmse", "bias")}
    return rep.select(
        *by, "variant", "mae", "rmse", "bias", "focus_abs_bias",
        (F.col("mae") - base["mae"]).alias("delta_mae"),
        (F.col("rmse") - base["rmse"]).alias("delta_rmse"),
        (F.col("bias") - base["bias"]).alias("delta_bias"),
    )


def select_variant(report: DataFrame, tolerance: float = CALIBRATION_TOLERANCE, strength: float | Column = CALIBRATION_STRENGTH,
                   by: Sequence[str] = ()) -> DataFrame:
    """M7: candidates = none + each variant not worse than none on MAE and RMSE
    (beyond ``tolerance``); winner = min (mae, rmse, |bias|, focus bias)
    (focus bias counts 0 for none), ties -> earlier variant.  One aggregate
    over the (3-row) report."""
    prio = F.create_map(*[x for v, p in VARIANT_PRIORITY for x in (F.lit(v), F.lit(p))])
    ok = (F.col("variant") == "none") | (
        (F.col("delta_mae") <= tolerance) & (F.col("delta_rmse") <= tolerance) & (strength > 0 if isinstance(strength, Column) else F.lit(strength > 0))
    )
    focus = F.when(F.col("variant") == "none", F.lit(0.0)).otherwise(F.col("focus_abs_bias"))
    score = F.when(ok, F.struct(F.col("mae"), F.col("rmse"), F.abs("bias"), focus, prio[F.col("variant")]))
    row = F.struct("variant", "delta_mae", "delta_rmse", "delta_bias")
    out = report.groupBy(*by).agg(
        F.min_by(row, score).alias("__sel"),
        F.max(F.when(F.col("variant") == "global", F.col("focus_abs_bias"))).alias("gk_def_abs_bias_global"),
        F.max(F.when(F.col("variant") == "position_aware", F.col("focus_abs_bias"))).alias("gk_def_abs_bias_position"),
    )
    return out.select(
        *by,
        F.col("__sel.variant").alias("selected_variant"),
        "gk_def_abs_bias_global",
        "gk_def_abs_bias_position",
        F.col("__sel.delta_mae").alias("selected_delta_mae"),
        F.col("__sel.delta_rmse").alias("selected_delta_rmse"),
        F.col("__sel.delta_bias").alias("selected_delta_bias"),
        (F.col("gk_def_abs_bias_global") - F.col("gk_def_abs_bias_position")).alias("position_calibration_gain"),
    )


def postprocess(
    df: DataFrame,
    pred: str,
    out: str,
    league_mean: Column | float | None = None,
    alpha: float | Column = 0.0,
    variant: str | Column = "none",
    coeffs: DataFrame | None = None,
    caps: DataFrame | None = None,
    segment: str = "position_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """P25: shrink toward the league mean (P22) -> selected calibration (P23 /
    J5) -> floor at 0 -> per-segment cap (J4, no cap -> +inf).  ``alpha`` and
    ``variant`` can be columns, so models named by ``by`` each take their own."""
    cur = df.withColumn("__p", F.col(pred).cast("double"))
    if league_mean is not None:
        lm = league_mean if isinstance(league_mean, Column) else F.lit(float(league_mean))
        cur = cur.withColumn("__p", (1.0 - alpha) * F.col("__p") + alpha * lm)
    if coeffs is not None and isinstance(variant, Column):
        cur = cur.withColumn("__variant", variant)
        cur = apply_position(apply_global(cur, "__p", coeffs, "__glob", by), "__p", coeffs, "__pos", segment, by)
        chosen = F.when(F.col("__variant") == "global", F.col("__glob")).when(F.col("__variant") == "position_aware", F.col("__pos"))
        cur = cur.withColumn("__p", chosen.otherwise(F.col("__p"))).drop("__variant", "__glob", "__pos")
    elif variant == "position_aware" and coeffs is not None:
        cur = apply_position(cur, "__p", coeffs, "__p", segment, by)
    elif variant == "global" and coeffs is not None:
        cur = apply_global(cur, "__p", coeffs, "__p", by)
    cur = cur.withColumn("__p", F.greatest(F.col("__p"), F.lit(0.0)))
    if caps is not None:
        c = caps.select(F.col(segment).alias("__cseg"), F.col("cap").alias("__cap"))
        cur = cur.join(c, F.col(segment) == F.col("__cseg"), "left")
        cur = cur.withColumn("__p", F.least(F.col("__p"), F.coalesce(F.col("__cap"), F.lit(float("inf"))))).drop(
            "__cseg", "__cap"
        )
    return cur.withColumnRenamed("__p", out)
