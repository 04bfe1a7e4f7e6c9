"""Period policy, temporal splits and CV folds.

The policy is a handful of period lists; it becomes a tiny DataFrame that is
broadcast (its size is bounded by the number of configured periods).  The
distinct-period table is bounded by the number of periods, so the global
windows over it are cheap; row-level work is joins against it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row

LIST_NAMES = (
    "excluded_gameweeks",
    "backfilled_but_untrusted_gameweeks",
    "trusted_backfilled_gameweeks",
    "eligible_training_gameweeks",
    "eligible_holdout_backtest_gameweeks",
)


def normalise_weeks(values: Iterable | None) -> list[int]:
    """Positive ints, de-duplicated and sorted; anything else is an error."""
    if values is None:
        return []
    if not isinstance(values, (list, tuple)):
        raise ValueError("period policy lists must be arrays of integers")
    out = set()
    for v in values:
        w = int(v)
        if w <= 0:
            raise ValueError(f"invalid period id in policy: {v}")
        out.add(w)
    return sorted(out)


@dataclass(frozen=True)
class PeriodPolicy:
    policy_version: str = "unknown"
    excluded_gameweeks: tuple[int, ...] = ()
    backfilled_but_untrusted_gameweeks: tuple[int, ...] = ()
    trusted_backfilled_gameweeks: tuple[int, ...] = ()
    eligible_training_gameweeks: tuple[int, ...] = ()
    eligible_holdout_backtest_gameweeks: tuple[int, ...] = ()
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_dict(cls, raw: dict | None) -> "PeriodPolicy":
        raw = raw or {}
        return cls(
            policy_version=str(raw.get("policy_version") or "unknown"),
            **{n: tuple(normalise_weeks(raw.get(n))) for n in LIST_NAMES},
        )

    @classmethod
    def from_yaml(cls, path: str) -> "PeriodPolicy":
        import yaml

        with open(path, encoding="utf-8") as fh:
            raw = yaml.safe_load(fh) or {}
        q = dict(raw.get("gameweek_quality") or {})
        q.setdefault("policy_version", raw.get("version"))
        return cls.from_dict(q)

    def effective_excluded(self) -> list[int]:
        """Excluded | (untrusted - trusted)."""
        return sorted(
            set(self.excluded_gameweeks)
            | (set(self.backfilled_but_untrusted_gameweeks) - set(self.trusted_backfilled_gameweeks))
        )


def policy_frame(spark: SparkSession, policy: PeriodPolicy) -> DataFrame:
    """Long form (week, list_name), one row per membership."""
    rows = [(int(w), n) for n in LIST_NAMES for w in getattr(policy, n)]
    return spark.createDataFrame(rows, "week int, list_name string")


def effective_exclusions_frame(spark: SparkSession, policy: PeriodPolicy) -> DataFrame:
    """U2 as a set expression on the policy table: excluded U (untrusted EXCEPT trusted)."""
    p = policy_frame(spark, policy)
    pick = lambda n: p.filter(F.col("list_name") == n).select("week")
    return pick("excluded_gameweeks").union(
        pick("backfilled_but_untrusted_gameweeks").exceptAll(pick("trusted_backfilled_gameweeks"))
    ).distinct()


def classify_periods(df: DataFrame, policy: PeriodPolicy, period: str = "gameweek_id") -> DataFrame:
    """Status excluded / backfilled_untrusted / trusted and the trusted flag."""
    excl = list(policy.excluded_gameweeks)
    eff = policy.effective_excluded()
    p = F.col(period)
    status = (
        F.when(p.isin(excl), F.lit("excluded"))
        .when(p.isin(eff), F.lit("backfilled_untrusted"))
        .otherwise(F.lit("trusted"))
    )
    return df.withColumns({"status": status, "trusted": status == "trusted"})


def _weeks(df: DataFrame, period: str) -> DataFrame:
    return df.select(F.col(period).cast("int").alias("__week")).filter(F.col("__week").isNotNull()).distinct()


def _holdout_weeks(weeks: DataFrame, n: int, what: str) -> DataFrame:
    """Last ``n`` of the candidate weeks; fails (lazily) when there are not more
    than ``n`` candidates.  ``weeks`` has one row per period."""
    w_all = Window.partitionBy()
    ranked = weeks.withColumns(
        {
            "__rank_desc": F.row_number().over(Window.orderBy(F.col("__week").desc())),
            "__n": F.count(F.lit(1)).over(w_all),
        }
    )
    checked = ranked.withColumn(
        "__ok",
        F.when(F.col("__n") <= n, F.raise_error(F.lit(f"Not enough {what} to create holdout set"))).otherwise(
            F.lit(True)
        ),
    )
    return checked.filter(F.col("__ok") & (F.col("__rank_desc") <= n)).select("__week")


def temporal_split(df: DataFrame, holdout: int = 5, period: str = "target_gameweek_id") -> DataFrame:
    """Rows get ``role`` = holdout for the last ``holdout`` distinct periods,
    train otherwise."""
    hw = _holdout_weeks(_weeks(df, period), holdout, "periods").withColumn("__h", F.lit(True))
    out = df.join(F.broadcast(hw), F.col(period).cast("int") == F.col("__week"), "left")
    return out.withColumn("role", F.when(F.col("__h"), "holdout").otherwise("train")).drop("__week", "__h")


def policy_split(
    df: DataFrame,
    policy: PeriodPolicy,
    holdout: int = 5,
    period: str = "target_gameweek_id",
    strict_temporal: bool = False,
) -> DataFrame:
    """W11 + J10: drop effective-excluded periods (anti join), choose the last
    ``holdout`` eligible periods, keep train rows in the eligible-training list
    (when set).  Rows outside both sides are dropped; ``role`` is train/holdout.

    The reference keeps later non-eligible weeks in train (training can hold
    weeks after the holdout); ``strict_temporal=True`` drops train rows later
    than the first holdout week.
    """
    spark = df.sparkSession
    eff = policy.effective_excluded()
    wk = F.col(period).cast("int")
    filtered = df
    if eff:
        ex = spark.createDataFrame([(w,) for w in eff], "__week int")
        filtered = df.join(F.broadcast(ex), wk == F.col("__week"), "left_anti")
    cand = _weeks(filtered, period)
    if policy.eligible_holdout_backtest_gameweeks:
        elig = spark.createDataFrame([(w,) for w in policy.eligible_holdout_backtest_gameweeks], "__week int")
        cand = cand.join(F.broadcast(elig), "__week", "left_semi")
    hw = _holdout_weeks(cand, holdout, "eligible periods").withColumn("__h", F.lit(True))
    out = filtered.join(F.broadcast(hw), wk == F.col("__week"), "left").drop("__week")
    is_h = F.col("__h").isNotNull()
    train_ok = F.lit(True)
    if policy.eligible_training_gameweeks:
        train_ok = wk.isin(list(policy.eligible_training_gameweeks))
    if strict_temporal:
        # first holdout period from the small holdout-week table (a scalar), not a
        # window over all rows
        first = hw.agg(F.min("__week").alias("__first_h"))
        out = attach_row(out, first)
        train_ok = train_ok & (wk < F.col("__first_h"))
    role = F.when(is_h, F.lit("holdout")).when(train_ok, F.lit("train"))
    return out.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__h", "__first_h")


def require_both_sides(split: DataFrame) -> DataFrame:
    """``split`` itself, or an error if the policy has left no train or no
    holdout rows (W11)."""
    roles = {r[0] for r in split.select("role").distinct().collect()}  # at most two values
    for role in ("train", "holdout"):
        if role not in roles:
            raise ValueError("no rows left after exclusion" if not roles else f"the policy leaves no {role} rows")
    return split


def split_metadata(split: DataFrame, policy: PeriodPolicy, period: str = "target_gameweek_id") -> DataFrame:
    """W11 metadata: one row with sorted week lists per role."""
    wk = F.col(period).cast("int")
    return split.agg(
        F.lit(policy.policy_version).alias("policy_version"),
        F.sort_array(F.collect_set(F.when(F.col("role") == "holdout", wk))).alias("holdout_gameweeks"),
        F.sort_array(F.collect_set(F.when(F.col("role") == "train", wk))).alias("train_gameweeks"),
    ).withColumn(
        "effective_excluded_gameweeks", F.array(*[F.lit(w) for w in policy.effective_excluded()]).cast("array<int>")
    )


def expanding_folds(df: DataFrame, n_splits: int = 5, period: str = "target_gameweek_id") -> DataFrame:
    """Expanding-window folds on distinct periods (not on row index):
    P periods, test size P // (n_splits+1); fold i tests the periods at
    positions [P-(n_splits-i)*ts, +ts) and trains on everything before.
    Returns (fold, week, role) - join it to the rows to materialise a fold.
    """
    weeks = _weeks(df, period).withColumns(
        {
            "__idx": F.row_number().over(Window.orderBy("__week")) - 1,
            "__p": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )
    ts = F.floor(F.col("__p") / (n_splits + 1))
    folds = weeks.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("__p") - (F.lit(n_splits) - F.col("fold")) * ts
    role = F.when(F.col("__idx") < start, F.lit("train")).when(F.col("__idx") < start + ts, F.lit("test"))
    return (
        folds.withColumn("role", role)
        .filter(F.col("role").isNotNull() & (ts > 0))
        .select(F.col("fold").cast("int"), F.col("__week").alias("week"), "role")
    )


def recent_periods(df: DataFrame, n: int = 5, period: str = "target_gameweek_id") -> DataFrame:
    """Rows of the last ``min(n, #periods)`` distinct periods (no error
    when there are fewer)."""
    top = _weeks(df, period).withColumn("__r", F.row_number().over(Window.orderBy(F.col("__week").desc())))
    keep = top.filter(F.col("__r") <= n).select("__week")
    return df.join(F.broadcast(keep), F.col(period).cast("int") == F.col("__week"), "left_semi")
