"""Latest-row, de-duplication and point-in-time (as-of) operators.

All three are aggregates with map-side combine (``max_by`` over a struct)
rather than whole-entity windows, so an entity holding a third of all rows is
pre-reduced in every input partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (NULLs lose)."""
    others = [c for c in df.columns if c not in keys]
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*ords)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in others])


def latest_per_entity(df: DataFrame, entity: str = "player_id", period: str = "gameweek_id") -> DataFrame:
    """The latest period's row per entity (sort by period, tail(1))."""
    return _latest(df, [entity], [period])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``QUALIFY row_number() over (partition by keys order by order desc) = 1``.

    Remaining ties are broken by every other column (descending), so the
    result is deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    return _latest(df, keys, [*order, *rest])


def asof_latest(
    df: DataFrame,
    targets: Sequence[int] | None = None,
    entity: str = "player_id",
    period: str = "gameweek_id",
    lag: int = 1,
) -> DataFrame:
    """For every target period t, each entity's latest row with
    ``period <= t - lag``.

    Each row is valid for the targets in (period + lag - 1, next_period + lag - 1];
    the row is exploded over exactly that interval (``sequence``), so the output
    is (entity x target) with no range join and no pairs.  ``targets`` limits
    the output (default: every period present, plus one after the last).
    Input: one row per (entity, period) (collapse first), so the entity window
    holds at most #periods rows.
    """
    w = Window.partitionBy(entity).orderBy(period)
    bounds = df.agg(F.min(period).alias("__lo"), F.max(period).alias("__hi"))
    nxt = F.lead(period, 1).over(w)
    rows = df.withColumn("__next", nxt)
    rows = attach_row(rows, bounds)
    first = F.col(period) + lag
    last = F.coalesce(F.col("__next") + lag - 1, F.col("__hi") + lag)
    out = rows.withColumn("target_gameweek_id", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    if targets is not None:
        out = out.filter(F.col("target_gameweek_id").isin([int(t) for t in targets]))
    return out.drop("__next", "__lo", "__hi").withColumn("source_gameweek_id", F.col(period))
