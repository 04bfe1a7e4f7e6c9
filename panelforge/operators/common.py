"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (global statistics, coefficients,
    an incumbent's metrics) to every row of ``df``.

    The one-row table becomes an uncorrelated scalar subquery (a struct):
    Spark evaluates it once and inlines the value, so there is no join (and
    no cross product) in the plan.  An empty table attaches NULLs, a
    table of several rows is an error.
    """
    cols = one_row.columns
    st = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("__st")).scalar()
    return df.withColumn("__st", st).select("*", *[F.col(f"__st.{c}").alias(c) for c in cols]).drop("__st")


# Output convention of checked queries: doubles rounded to 6 decimals after a
# 1e-9 nudge, so values sitting exactly on a rounding tie (common with means
# of short decimals) round the same way whatever the summation order.
ROUND_NUDGE = 1e-9


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (output convention of checked queries)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double") + ROUND_NUDGE, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def maybe_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    The check is a bounded count (``limit(max_rows + 1)``), so it stops early on
    a large input; above the bound the plain (shuffle) join is used and AQE may
    still pick a broadcast from run-time statistics.  Use it on scans of
    source tables; on a derived table the count would recompute its lineage,
    so joins on derived small tables are left to AQE instead.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate that many branches consume.

    The rows are written once as a parquet table in the shared folder named
    by ``spark.checkpoint.dir`` (never a machine-local folder) and read back:
    later stages scan columnar files with exact size statistics (so AQE can
    pick broadcasts), and a lost executor never forces recomputing the
    upstream lineage.  (An RDD checkpoint would compute the rows twice.)
    """
    from panelforge.session import scratch_path

    path = scratch_path(df.sparkSession, "mat")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are task slots, for work that
    costs much more than moving its rows; larger inputs are left as they are."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)
