"""Two-sample drift: Kolmogorov-Smirnov per feature and the retrain decision
(A18, A18b, V2).

Spark ML only ships the one-sample test, so the statistic is composed:
long form (feature, value, sample) -> counts per distinct value -> running
sums over value order (bucketed prefix sums, see ``ranking``) ->
max |F_train - F_holdout| per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.ranking import DEFAULT_BUCKETS, auto_buckets, prefix_sums

# Fixed defaults of the reference's drift rules.
DRIFT_COLUMNS = ("total_points", "minutes_played", "ict_index")
KS_THRESHOLD = 0.2
BREACH_RATIO = 0.34


def ks_two_sample(
    a: DataFrame,
    b: DataFrame,
    columns: Sequence[str] = DRIFT_COLUMNS,
    threshold: float = KS_THRESHOLD,
    buckets: int = DEFAULT_BUCKETS,
    with_p_value: bool = False,
) -> DataFrame:
    """(feature, ks_stat, n_a, n_b, breach).  NULLs count as 0; columns
    absent from either side are skipped."""
    cols = [c for c in columns if c in a.columns and c in b.columns]
    if not cols:
        return a.sparkSession.createDataFrame([], "feature string, ks_stat double, n_a bigint, n_b bigint, breach boolean")

    def longf(df: DataFrame, side: int) -> DataFrame:
        return df.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for c in cols])
            ).alias("kv")
        ).select("kv.feature", "kv.value", F.lit(side).alias("side"))

    long = longf(a, 0).unionByName(longf(b, 1))
    if buckets is None:
        buckets = max(auto_buckets(a), auto_buckets(b))
    counts = long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("c_a"), F.count_if(F.col("side") == 1).alias("c_b")
    )
    tot = counts.groupBy("feature").agg(F.sum("c_a").alias("n_a"), F.sum("c_b").alias("n_b"))
    cum = prefix_sums(counts, ["feature"], "value", ["c_a", "c_b"], buckets)
    d = (
        cum.join(tot, "feature")
        .withColumn("gap", F.abs(F.try_divide(F.col("c_a_cum"), F.col("n_a")) - F.try_divide(F.col("c_b_cum"), F.col("n_b"))))
        .groupBy("feature", "n_a", "n_b")
        .agg(F.max("gap").alias("ks_stat"))
    )
    out = d.withColumn("breach", F.col("ks_stat") > threshold)
    if with_p_value:
        out = out.withColumns({"p_value": ks_p_value(F.col("ks_stat"), F.col("n_a"), F.col("n_b")), "p_value_method": ks_method(F.col("n_a"), F.col("n_b"))})
    return out.select("feature", "ks_stat", "n_a", "n_b", "breach", *(["p_value", "p_value_method"] if with_p_value else []))


#: Samples whose sizes multiply to at most this have an exact p-value.
EXACT_PATHS = 10_000


def ks_method(n_a, n_b):
    return F.when(n_a * n_b <= EXACT_PATHS, "exact").otherwise("asymptotic")


def ks_p_value(d, n_a, n_b):
    """P(D >= d) of two samples without ties: exact up to ``EXACT_PATHS``, asymptotic beyond."""
    return F.when(n_a * n_b <= EXACT_PATHS, ks_exact(d, n_a, n_b)).otherwise(ks_asymptotic(d, n_a, n_b))


def ks_asymptotic(d, n_a, n_b, terms: int = 100):
    """Kolmogorov's series with the usual small-sample correction."""
    en = F.sqrt(n_a * n_b / (n_a + n_b))
    lam = (en + 0.12 + 0.11 / en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series))


def ks_exact(d, n_a, n_b):
    """Share of the lattice paths from (0, 0) to (n_a, n_b) that get as far as ``d`` from the
    diagonal: a fold over the rows of the lattice, in each a fold along the row.  A cell
    holds the share of the paths to it that have stayed nearer."""
    both = (n_a * n_b).cast("double")
    near = (F.floor(d * both - 1e-7) + 0.5) / both  # distances are whole multiples of 1 / (n_a n_b)

    def cell(i, j, below, left):
        steps = (i + j).cast("double")
        share = F.when(steps == 0, F.lit(1.0)).otherwise(
            F.when(i > 0, below * i / F.greatest(steps, F.lit(1.0))).otherwise(0.0) + F.when(j > 0, left * j / F.greatest(steps, F.lit(1.0))).otherwise(0.0))
        return F.when(F.abs(i / n_a - j / n_b) > near, F.lit(0.0)).otherwise(share)

    def row(before, i):
        return F.aggregate(F.sequence(F.lit(0), n_b.cast("int")), F.array().cast("array<double>"),
                           lambda out, j: F.concat(out, F.array(cell(i, j, F.coalesce(F.get(before, j), F.lit(0.0)), F.coalesce(F.get(out, j - 1), F.lit(0.0))))))

    last = F.aggregate(F.sequence(F.lit(0), n_a.cast("int")), F.array().cast("array<double>"), row)
    return F.when((n_a > 0) & (n_b > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - F.element_at(last, -1))))


def drift_decision(
    ks: DataFrame,
    n_configured: int = len(DRIFT_COLUMNS),
    breach_ratio: float = BREACH_RATIO,
    force_drift: bool = False,
    force_no_drift: bool = False,
) -> DataFrame:
    """V2: breached / len(configured columns) >= ratio -> retrain.  The
    denominator counts configured columns even when absent from the data."""
    total = max(n_configured, 1)
    agg = ks.agg(F.count_if("breach").alias("breached"))
    if force_no_drift:
        agg = agg.select(F.lit(0).cast("bigint").alias("breached"))
    elif force_drift:
        agg = agg.select(F.lit(n_configured).cast("bigint").alias("breached"))
    ratio = F.col("breached") / float(total)
    return agg.select(
        "breached",
        ratio.alias("breach_ratio"),
        F.lit(float(breach_ratio)).alias("trigger_threshold"),
        (ratio >= breach_ratio).alias("drift_triggered"),
    )
