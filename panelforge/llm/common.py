"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.common import maybe_broadcast

#: Ids that are broadcast at most for a semi join (8 bytes each); beyond it the plain join runs.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows, so that a Python worker never
    holds more than a few megabytes of text beside one long document."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text, whatever other columns there are."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def only_ids(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    """Rows of ``df`` whose id is among ``ids`` (one column ``on``)."""
    return df.join(maybe_broadcast(ids, BROADCAST_IDS), on, "left_semi")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
