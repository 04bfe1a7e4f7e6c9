"""Ranking building blocks that stay parallel when a group is huge.

* ``topk`` - ``row_number() <= k`` directly over a window: Spark plans a
  partial ``WindowGroupLimit`` on the map side, so only k rows per group and
  input partition cross the shuffle, whatever the group size.
* ``prefix_sums`` - exact cumulative sums over an ordered value inside a
  group, computed on the distinct-value aggregate and split at quantiles of
  the group: split totals -> offsets (small) -> a window per (group, split).
  A group holding a third of all rows is spread over ``buckets`` tasks instead
  of one.
* ``average_rank`` - pandas ``rank(method="average")`` from those prefix sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = None  # None -> one split for ROWS_PER_BUCKET input rows
ROWS_PER_BUCKET = 2_000_000


def auto_buckets(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Splits for the running sums: one per ``rows_per_bucket`` input rows,
    without a bound.  It only sets how many tasks share one group's running
    sum.  Call it on a materialised (cheap to count) input."""
    return max(1, -(-df.count() // rows_per_bucket))


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys equal each other."""
    other = b.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return a.join(other, on).drop(*[f"__k{i}" for i in range(len(keys))])


def _split(df: DataFrame, group: Sequence[str], value: str, n: int) -> DataFrame:
    """``df`` with ``__b``: which of ``n`` splits of its group a row falls in.

    The splits are bounded by quantiles of the group, so they hold about
    equally many rows however the values are spread.  Equal values share a
    split; NULLs are in the first and NaNs in the last, as a window orders them.
    """
    if n <= 1:
        return df.withColumn("__b", F.lit(0))
    v = F.col(value).cast("double")
    q = F.percentile_approx(v, [k / n for k in range(1, n)], max(10_000, 20 * n)).alias("__q")
    if group:
        b = _null_safe(df, df.groupBy(*group).agg(q), group)
    else:
        from panelforge.operators.common import attach_row

        b = attach_row(df, df.agg(q))
    below = F.size(F.filter(F.coalesce(F.col("__q"), F.array().cast("array<double>")), lambda x: x < v))
    return b.withColumn("__b", F.when(v.isNull(), 0).otherwise(below)).drop("__q")


def topk(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..k per group (ties broken by the caller's total order)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    sums: Sequence[str],
    buckets: int = DEFAULT_BUCKETS,
    suffix: str = "_cum",
) -> DataFrame:
    """Inclusive running sums of ``sums`` ordered by ``value`` within ``group``.

    ``df`` must hold one row per (group, value) (aggregate first).  Values are
    numeric; NULL groups are a group, NULL values come first, NaN last.  The
    result does not depend on ``buckets``.
    """
    group = list(group)
    if buckets is None:
        buckets = auto_buckets(df)
    b = _split(df, group, value, buckets)
    wi = Window.partitionBy(*group, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.withColumns({f"{s}{suffix}": F.sum(s).over(wi) for s in sums})
    if buckets <= 1:
        return inner.drop("__b")
    totals = b.groupBy(*group, "__b").agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    wo = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "__b", *[F.sum(f"__t_{s}").over(wo).alias(f"__o_{s}") for s in sums])
    out = _null_safe(inner, offsets, [*group, "__b"])
    return out.withColumns({f"{s}{suffix}": _plus(F.col(f"{s}{suffix}"), F.col(f"__o_{s}")) for s in sums}).drop(
        "__b", *[f"__o_{s}" for s in sums])


def _plus(a: Column, b: Column) -> Column:
    """Sum of two partial sums: NULL only where both are (sums skip NULLs)."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def value_ranks(df: DataFrame, group: Sequence[str], value: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """One row per (group, value) with the pandas average rank of that value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    if buckets is None:
        buckets = auto_buckets(df)
    cum = prefix_sums(counts, group, value, ["__n"], buckets)
    return cum.select(
        *group, value, (F.col("__n_cum") - F.col("__n") + (F.col("__n") + 1) / 2.0).alias("avg_rank")
    )


def average_rank(
    df: DataFrame, group: Sequence[str], value: str, out: str, buckets: int = DEFAULT_BUCKETS
) -> DataFrame:
    """Adds ``out`` = average rank of ``value`` within ``group`` (NULL stays NULL)."""
    ranks = value_ranks(df, group, value, buckets).withColumnRenamed("avg_rank", out)
    return df.join(ranks, [*group, value], "left")


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that is NULL (not an ANSI error) for n<2 or zero variance."""
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.when((F.count(xs) >= 2) & (den > 0), F.try_divide(F.covar_pop(xs, ys), den))


def prefix_min(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    value: str,
    out: str,
    buckets: int = DEFAULT_BUCKETS,
    exclusive: bool = False,
) -> DataFrame:
    """Running minimum of ``value`` in ``order`` within ``group`` (inclusive of
    the current row unless ``exclusive``); ``order`` must be unique per group.

    Same shape as ``prefix_sums``: minima of the splits -> prefix over splits
    (small) -> window inside each (group, split).  With no group the work is
    still shared by ``buckets`` tasks.
    """
    group = list(group)
    end = -1 if exclusive else 0
    if buckets is None:
        buckets = auto_buckets(df)
    b = _split(df, group, order, buckets)
    wi = Window.partitionBy(*group, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    inner = b.withColumn(out, F.min(value).over(wi))
    if buckets <= 1:
        return inner.drop("__b")
    mins = b.groupBy(*group, "__b").agg(F.min(value).alias("__bm"))
    wo = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = mins.select(*group, "__b", F.min("__bm").over(wo).alias("__off"))
    return _null_safe(inner, offsets, [*group, "__b"]).withColumn(out, F.least(out, "__off")).drop("__b", "__off")


def exact_percentile(df: DataFrame, group: Sequence[str], value: str, q: float, out: str = "percentile",
                     buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Exact percentile with linear interpolation (numpy default, SQL
    ``percentile`` / ``quantile_cont``) per group, without collecting a
    group's values into one task: distinct-value counts -> bucketed running
    counts -> the values at 0-based ranks floor(h) and floor(h)+1, h = (n-1) q.
    Returns one row per group: (group..., out, n).
    """
    group = list(group)
    v = F.col(value).cast("double")
    counts = df.filter(v.isNotNull()).groupBy(*group, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    if buckets is None:
        buckets = auto_buckets(counts)
    cum = prefix_sums(counts, group, "__v", ["__c"], buckets)
    n = counts.groupBy(*group).agg(F.sum("__c").alias("__n"))
    j = cum.join(n, group) if group else _attach(cum, n)
    h = (F.col("__n") - 1) * float(q)
    lo = F.floor(h)
    agg = (j.groupBy(*group) if group else j.groupBy()).agg(
        F.min(F.when(F.col("__c_cum") > lo, F.col("__v"))).alias("__vlo"),
        F.min(F.when(F.col("__c_cum") > lo + 1, F.col("__v"))).alias("__vhi"),
        F.first(h).alias("__h"),
        F.first("__n").alias("n"),
    )
    frac = F.col("__h") - F.floor(F.col("__h"))
    hi = F.coalesce(F.col("__vhi"), F.col("__vlo"))
    return agg.select(*group, (F.col("__vlo") + frac * (hi - F.col("__vlo"))).alias(out), "n")


def _attach(df: DataFrame, one: DataFrame) -> DataFrame:
    from panelforge.operators.common import attach_row

    return attach_row(df, one)
