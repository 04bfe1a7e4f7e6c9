"""Hyper-parameter proposals from the trial history.

Two tables in, one out: the search space (param, lo, hi, is_int) and the
history (iteration, param, value, score; a lower score is better) give
proposals (iteration, param, value).  The first trials are uniform draws.  Later
ones are drawn, a parameter at a time, from a kernel density over the good
trials (the best ``GOOD`` share), and of several draws the one with the largest ratio of the good
trials' density to the other trials' density is proposed.  Densities are kernel sums: an
aggregate over draws joined with the history on the parameter.

Draws are hashes of (seed, trial, draw, parameter), so a table of
proposals is the same whatever its partitions, and every proposal lies within its bounds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.operators.gates import clamp_to_bounds

# Fixed ranges that the reference's search draws from (the clamp's bounds are wider).
SEARCH_RANGES = (
    ("n_estimators", 100, 500, True),
    ("max_depth", 3, 8, True),
    ("learning_rate", 0.01, 0.2, False),
    ("subsample", 0.6, 1.0, False),
    ("colsample_bytree", 0.6, 1.0, False),
    ("reg_alpha", 0.0, 2.0, False),
    ("reg_lambda", 0.1, 3.0, False),
    ("min_child_weight", 0.1, 5.0, False),
    ("gamma", 0.0, 2.0, False),
    ("max_delta_step", 0.0, 5.0, False),
    ("shrinkage_alpha", 0.0, 0.5, False),
    ("calibration_strength", 0.0, 1.0, False),
)
#: Share of the trials that count as good, draws a proposal, and the kernels' least width (share of the range).
GOOD, DRAWS, LEAST_WIDTH = 0.25, 24, 0.06


def space_frame(spark: SparkSession, ranges=SEARCH_RANGES) -> DataFrame:
    return spark.createDataFrame([(n, float(lo), float(hi), bool(i)) for n, lo, hi, i in ranges], "param string, lo double, hi double, is_int boolean")


def uniform(*what) -> Column:
    """A number in [0, 1) from the hash of columns and literals."""
    bits = F.shiftrightunsigned(F.xxhash64(*[w if isinstance(w, Column) else F.lit(w) for w in what]), 11)
    return bits.cast("double") / float(2**53)


def _clamped(drawn: DataFrame, space: DataFrame) -> DataFrame:
    return clamp_to_bounds(drawn.select("iteration", "param", "value"), F.broadcast(space)).select("iteration", "param", F.col("clamped").alias("value"))


def first_proposals(space: DataFrame, trials: int, seed: int = 42, first: int = 0) -> DataFrame:
    """Uniform draws for trials ``first`` to ``first + trials - 1``."""
    drawn = space.withColumn("iteration", F.explode(F.sequence(F.lit(first), F.lit(first + trials - 1))))
    value = F.col("lo") + uniform(seed, F.col("iteration"), F.col("param")) * (F.col("hi") - F.col("lo"))
    return _clamped(drawn.withColumn("value", value), space)


def propose(history: DataFrame, space: DataFrame, trials: int, seed: int = 42, first: int | None = None, good: float = GOOD, draws: int = DRAWS) -> DataFrame:
    """Proposals for ``trials`` further trials, numbered from ``first`` (default: behind the
    history).  Without a history, or for a parameter that it doesn't have, uniform draws."""
    seen = history.select("iteration", "score").where(F.col("score").isNotNull() & ~F.isnan("score")).distinct()
    count, last = seen.agg(F.count(F.lit(1)), F.max("iteration")).first()  # one row
    start = first if first is not None else (0 if last is None else last + 1)
    if not count:
        return first_proposals(space, trials, seed, start)
    best = max(1, math.ceil(good * count))
    rank = F.row_number().over(Window.orderBy("score", "iteration"))  # one row a trial
    sides = seen.withColumn("is_good", rank <= best).select("iteration", "is_good")
    points = history.select("iteration", "param", "value").join(sides, "iteration").join(F.broadcast(space), "param").withColumn(
        "at", (F.col("value") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-300)))
    kernels = points.groupBy("param").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_good"), F.struct("iteration", "at")))).alias("good"),  # a trial each
        F.count_if("is_good").alias("n_good"), F.count_if(~F.col("is_good")).alias("n_bad"))

    def width(n: Column) -> Column:
        return F.greatest(F.lit(LEAST_WIDTH), 0.5 / F.sqrt(n + 1.0))

    # draws in [0, 1] of the range: from a good trial's kernel, or uniform with the prior's share
    cand = space.join(F.broadcast(kernels), "param", "left").withColumn("iteration", F.explode(F.sequence(F.lit(start), F.lit(start + trials - 1)))).withColumn(
        "draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    u = lambda k: uniform(seed, F.col("iteration"), F.col("draw"), F.col("param"), k)
    which = F.floor(u(1) * (F.coalesce(F.col("n_good"), F.lit(0)) + 1)).cast("int")
    normal = F.sqrt(-2.0 * F.log(1.0 - u(2))) * F.cos(2.0 * math.pi * u(3))
    centre = F.get("good", which)["at"]
    cand = cand.withColumn("at", F.when(centre.isNull(), u(4)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), centre + normal * width(F.col("n_good"))))))

    # kernel sums of every draw over the history of its parameter, with a uniform prior on both sides
    near = cand.select("iteration", "draw", "param", F.col("at").alias("x"), "n_good", "n_bad").join(points.select("param", "at", "is_good"), "param", "left")
    w = F.when(F.col("is_good"), width(F.col("n_good"))).otherwise(width(F.col("n_bad")))
    kernel = F.exp(-0.5 * F.pow((F.col("x") - F.col("at")) / w, 2)) / (w * math.sqrt(2 * math.pi))
    sums = near.groupBy("iteration", "draw", "param", "x").agg(
        F.coalesce(F.sum(F.when(F.col("is_good"), kernel)), F.lit(0.0)).alias("good"), F.coalesce(F.sum(F.when(~F.col("is_good"), kernel)), F.lit(0.0)).alias("bad"),
        F.coalesce(F.max("n_good"), F.lit(0)).alias("n_good"), F.coalesce(F.max("n_bad"), F.lit(0)).alias("n_bad"))
    ratio = F.log((F.col("good") + 1.0) / (F.col("n_good") + 1.0)) - F.log((F.col("bad") + 1.0) / (F.col("n_bad") + 1.0))
    chosen = sums.groupBy("iteration", "param").agg(F.max_by("x", F.struct(F.round(ratio, 9), -F.col("draw"))).alias("x"))
    value = F.col("lo") + F.col("x") * (F.col("hi") - F.col("lo"))
    return _clamped(chosen.join(F.broadcast(space), "param").withColumn("value", value), space)
