"""Structured Streaming re-aims of the two incremental batch behaviours
(ST1, ST2).

* ``stream_upsert`` (ST1): period files arrive in a landing folder; in
  ``foreachBatch`` each batch is merged into the current-state table.  The row
  with the greatest (period, version) of an entity wins; the version is a
  column of the documents or else the time its file was written, so a
  corrected document of a live period replaces the first one, a late document
  never overwrites a newer period but does add entities that have no newer
  row, and replays change nothing.  The state is partitioned by entity hash
  bucket and a batch rewrites only the buckets it touches.
* ``stream_event_rollup`` (ST2): JSON event-log files -> hourly windows per
  node.  Each batch writes its own partial counts (a replayed batch replaces
  them); the result is their sum, so events count whenever they arrive.

* ``stream_documents`` (ST1, keyed state): documents are taken once, whatever their
  copies and files; the keys seen within the watermark are the state.
* ``stream_event_windows`` (ST2, event time): windows in update mode; a
  window closes and its state goes when the watermark passes its end.  Rows
  behind the watermark are late: they are left out and counted.

Checkpoint and output of these two can be named, so that a stopped run goes on
where it was; a batch that is run again replaces its own output.

The first two run with ``trigger(availableNow=True)`` and a fresh checkpoint folder
below the shared checkpoint directory, and the result equals the batch
computation on the same input, in whatever order the files come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import scratch_path


#: Rows that a state bucket is meant to hold.
ROWS_PER_BUCKET = 2_000_000


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The current-state table (all buckets), or None before the first batch."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(root).drop("__bucket", "__version")
    except AnalysisException:
        return None


def stream_upsert(spark: SparkSession, landing: str, schema: T.StructType, entity: str = "player_id",
                  period: str = "gameweek_id", version: str | None = None, buckets: int | None = None,
                  files_per_trigger: int = 50) -> str:
    """ST1: run the incremental upsert to completion; returns the state root.

    ``version`` names the column that tells a correction from what it corrects
    (default: the file's modification time).  The state table is partitioned by
    ``pmod(xxhash64(entity), buckets)``, by default one bucket for
    ``ROWS_PER_BUCKET`` rows of the first batch's size times the files to come.
    """
    from panelforge.operators.asof import _latest
    from panelforge.operators.common import materialize

    state_root = scratch_path(spark, "stream_state")
    ckpt = scratch_path(spark, "stream_ckpt")
    stamp = F.col(version).cast("string") if version else F.date_format(F.col("_metadata.file_modification_time"), "yyyyMMddHHmmssSSS")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
           .select(*schema.fieldNames(), stamp.alias("__version")))
    fixed = [buckets]

    def upsert(batch: DataFrame, batch_id: int) -> None:
        b = materialize(batch)
        if fixed[0] is None:
            fixed[0] = max(1, -(-b.count() * max(1, files_per_trigger) // ROWS_PER_BUCKET))
        bucket = F.pmod(F.xxhash64(F.col(entity)), F.lit(fixed[0])).cast("int")
        rows = b.withColumn("__bucket", bucket)
        touched = [r[0] for r in rows.select("__bucket").distinct().collect()]  # at most `buckets` ids
        if not touched:
            return
        if read_state(spark, state_root) is not None:
            rows = spark.read.parquet(state_root).filter(F.col("__bucket").isin(touched)).unionByName(rows)
        # written to a scratch table first: never overwrite the folder being read
        merged = materialize(_latest(rows, [entity], [period, "__version"]))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__bucket").parquet(state_root)

    q = src.writeStream.foreachBatch(upsert).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return state_root


def land_files(df: DataFrame, landing: str, by: str, fmt: str = "parquet") -> None:
    """Test-input helper: one write that lands the rows as separate folders by
    the value of ``by``."""
    df.withColumn("landed", F.col(by)).write.mode("append").partitionBy("landed").format(fmt).save(landing)


def stream_event_rollup(spark: SparkSession, landing: str, schema: T.StructType, window: str = "1 hour",
                        files_per_trigger: int = 50) -> DataFrame:
    """ST2: hourly per-node counts, failures and durations over the event log."""
    out_root = scratch_path(spark, "rollup_out")
    ckpt = scratch_path(spark, "rollup_ckpt")
    tz = F.lit(spark.conf.get("spark.sql.session.timeZone"))
    # Windows are whole hours of the zone-less wall clock, whatever the session zone.
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(landing).withColumn(
        "event_ts", F.convert_timezone(F.lit("UTC"), tz, F.col("ts")).cast("timestamp"))

    def wall(c):  # instant -> zone-less UTC wall clock
        return F.convert_timezone(tz, F.lit("UTC"), F.col(c).cast("timestamp_ntz"))

    def partial(batch: DataFrame, batch_id: int) -> None:
        agg = batch.groupBy(F.window("event_ts", window).alias("w"), "node").agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(F.col("status") == "failed").alias("n_failed"),
            F.sum("duration_ms").alias("total_duration_ms"),
        )
        rows = agg.select(wall("w.start").alias("window_start"), wall("w.end").alias("window_end"), "node", "n_events", "n_failed",
                          "total_duration_ms")
        rows.write.mode("overwrite").parquet(f"{out_root}/batch={batch_id}")

    q = ev.writeStream.foreachBatch(partial).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out_root).groupBy("window_start", "window_end", "node").agg(
        F.sum("n_events").alias("n_events"), F.sum("n_failed").alias("n_failed"), F.sum("total_duration_ms").alias("total_duration_ms"))


def _finished(query) -> dict:
    """What a run has read, left out as late, and kept as state (its largest and last size)."""
    query.awaitTermination()
    progress = query.recentProgress
    state = [o for p in progress for o in p["stateOperators"]]
    return {"rows": sum(p["numInputRows"] for p in progress), "late": sum(o["numRowsDroppedByWatermark"] for o in state),
            "most_state": max((o["numRowsTotal"] for o in state), default=0), "last_state": state[-1]["numRowsTotal"] if state else 0,
            "watermark": progress[-1]["eventTime"].get("watermark") if progress else None}


def _instant(spark: SparkSession, column: str):
    """A zone-less UTC wall clock as an instant, whatever the session zone."""
    tz = F.lit(spark.conf.get("spark.sql.session.timeZone"))
    return F.convert_timezone(F.lit("UTC"), tz, F.col(column)).cast("timestamp")


def stream_documents(spark: SparkSession, landing: str, schema: T.StructType, keys: list[str], event_time: str = "fetched_at", delay: str = "7 days",
                     out_root: str | None = None, checkpoint: str | None = None, files_per_trigger: int = 50, fmt: str = "parquet") -> tuple[DataFrame, dict]:
    """ST1: the landed documents without repeats of ``keys``; returns (documents, figures of the run).

    A document is a repeat if its keys came within ``delay`` of event time before;
    documents older than the watermark are late, as are rows without an event time
    once the watermark has moved.  The sink writes every document exactly once."""
    out_root, checkpoint = out_root or scratch_path(spark, "stream_docs"), checkpoint or scratch_path(spark, "stream_ckpt")
    docs = (spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(landing)
            .withColumn("__at", _instant(spark, event_time)).withWatermark("__at", delay).dropDuplicatesWithinWatermark(keys).drop("__at"))
    query = docs.writeStream.format("parquet").option("path", out_root).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    figures = _finished(query)
    return spark.read.schema(schema).parquet(out_root), figures


def stream_event_windows(spark: SparkSession, landing: str, schema: T.StructType, window: str = "1 hour", delay: str = "2 hours",
                         out_root: str | None = None, checkpoint: str | None = None, files_per_trigger: int = 50) -> tuple[DataFrame, dict]:
    """ST2: counts, failures and durations by window and node; returns (windows, figures of the run).

    Every batch writes the windows that it changed, under its own number; a window's
    row is the one of its last batch.  ``closed`` says that the watermark has passed it."""
    out_root, checkpoint = out_root or scratch_path(spark, "windows_out"), checkpoint or scratch_path(spark, "windows_ckpt")
    tz = F.lit(spark.conf.get("spark.sql.session.timeZone"))
    wall = lambda c: F.convert_timezone(tz, F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
    events = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(landing)
              .withColumn("__at", _instant(spark, "ts")).withWatermark("__at", delay))
    counts = events.groupBy(F.window("__at", window).alias("w"), "node").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("status") == "failed").alias("n_failed"), F.sum("duration_ms").alias("total_duration_ms"))

    def changed(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(wall("w.start").alias("window_start"), wall("w.end").alias("window_end"), "node", "n_events", "n_failed", "total_duration_ms")
        rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_root}/{batch_id}")

    query = counts.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    figures = _finished(query)
    shape = T.StructType.fromDDL("window_start timestamp_ntz, window_end timestamp_ntz, node string, n_events long, n_failed long, total_duration_ms double, batch int")
    last = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(out_root).groupBy("window_start", "window_end", "node").agg(
        F.max_by(F.struct("n_events", "n_failed", "total_duration_ms"), "batch").alias("r")).select("window_start", "window_end", "node", "r.*")
    mark = figures["watermark"]
    closed = F.col("window_end") <= F.to_timestamp_ntz(F.lit(mark[:19]), F.lit("yyyy-MM-dd'T'HH:mm:ss")) if mark else F.lit(False)
    return last.withColumn("closed", closed), figures
