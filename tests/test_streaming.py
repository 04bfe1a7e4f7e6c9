"""Streaming jobs equal their batch twins, also under a non-UTC session zone."""

from pyspark.sql import functions as F

from conftest import SF001
from panelforge.session import scratch_path
from panelforge.sources import tables as tb
from panelforge.streaming import jobs


def _batch_rollup(log):
    h = F.date_trunc("hour", F.col("ts"))
    return log.groupBy(h.cast("timestamp_ntz").alias("window_start"), "node").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("status") == "failed").alias("n_failed")
    )


def test_rollup_equals_batch_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            log = tb.event_log(spark, SF001).filter(F.dayofmonth("ts") <= 3)
            landing = scratch_path(spark, "t_ev")
            jobs.land_files(log.withColumn("day", F.dayofmonth("ts")), landing, "day", "json")
            got = jobs.stream_event_rollup(spark, landing, log.schema, files_per_trigger=2).select("window_start", "node", "n_events", "n_failed")
            want = _batch_rollup(log)
            assert sorted(got.collect()) == sorted(want.collect()), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stream_upsert_equals_latest_rows(spark):
    from panelforge.operators import asof, features as fe

    rows = fe.collapse_periods(tb.fixture_rows(spark, SF001)).select("player_id", "gameweek_id", "total_points")
    landing = scratch_path(spark, "t_periods")
    jobs.land_files(rows, landing, "gameweek_id")
    state = jobs.read_state(spark, jobs.stream_upsert(spark, landing, rows.schema, buckets=4))
    assert sorted(state.collect()) == sorted(asof.latest_per_entity(rows).collect())


def test_corrections_replace_and_late_files_add(spark):
    landing, schema = scratch_path(spark, "t_fix"), "player_id long, gameweek_id int, total_points double"
    files = [[(1, 20, 10.0), (2, 20, 1.0)], [(1, 21, 5.0)], [(1, 21, 99.0)], [(3, 6, 7.0), (1, 6, 0.0)], [(2, 20, 4.0)], [(2, 19, 8.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame([(*r, i) for r in rows], schema + ", doc int").coalesce(1).write.mode("append").parquet(landing)
    shape = spark.createDataFrame([], schema + ", doc int").schema
    for version, per in (("doc", 1), (None, 1), ("doc", 100)):
        state = jobs.read_state(spark, jobs.stream_upsert(spark, landing, shape, version=version, files_per_trigger=per))
        assert sorted(tuple(r)[:3] for r in state.collect()) == [(1, 21, 99.0), (2, 20, 4.0), (3, 6, 7.0)]


def test_late_events_are_counted(spark):
    landing = scratch_path(spark, "t_late")
    shape = "node string, ts timestamp_ntz, duration_ms double, status string"
    for hour in (9, 10, 11, 2, 9):
        spark.sql(f"SELECT 'n' AS node, TIMESTAMP_NTZ '2024-01-05 {hour:02d}:30:00' AS ts, 1.5D AS duration_ms, 'failed' AS status").write.mode("append").json(landing)
    got = jobs.stream_event_rollup(spark, landing, spark.createDataFrame([], shape).schema, files_per_trigger=1).collect()
    assert sorted((r.window_start.hour, r.n_events, r.n_failed, r.total_duration_ms) for r in got) == [(2, 1, 1, 1.5), (9, 2, 2, 3.0), (10, 1, 1, 1.5), (11, 1, 1, 1.5)]
