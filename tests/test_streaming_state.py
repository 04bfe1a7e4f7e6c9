"""Event time, keyed state, restarts and late rows of the two stateful jobs."""

from datetime import datetime

from panelforge.session import scratch_path
from panelforge.streaming import jobs

EVENT = "node string, ts timestamp_ntz, duration_ms double, status string"
DOC = "id long, fetched_at timestamp_ntz, body string"


def at(day, hour):
    return datetime(2024, 1, day, hour, 30)


def land(spark, path, rows, schema, fmt):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").format(fmt).save(path)


def windows(df):
    return sorted((r.window_start.day, r.window_start.hour, r.node, r.n_events, r.n_failed, r.total_duration_ms) for r in df.collect())


def test_windows_close_late_events_are_counted_and_a_restart_goes_on(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("w_in", "w_out", "w_ckpt"))
    shape = spark.createDataFrame([], EVENT).schema
    go = lambda: jobs.stream_event_windows(spark, landing, shape, out_root=out, checkpoint=ckpt, files_per_trigger=1)
    land(spark, landing, [("a", at(1, 1), 1.0, "ok"), ("a", at(1, 1), 2.0, "failed"), ("b", at(1, 2), 1.0, "ok")], EVENT, "json")
    first, figures = go()
    assert windows(first) == [(1, 1, "a", 2, 1, 3.0), (1, 2, "b", 1, 0, 1.0)] and figures["late"] == 0
    land(spark, landing, [("a", at(1, 2), 5.0, "ok"), ("a", at(1, 9), 1.0, "ok")], EVENT, "json")  # within the delay, then the watermark moves to 7:30
    second, _ = go()
    land(spark, landing, [("a", at(1, 1), 7.0, "ok"), ("a", at(1, 9), 1.0, "failed")], EVENT, "json")  # the first one is late
    third, figures = go()
    assert windows(third) == [(1, 1, "a", 2, 1, 3.0), (1, 2, "a", 1, 0, 5.0), (1, 2, "b", 1, 0, 1.0), (1, 9, "a", 2, 1, 2.0)]
    assert figures["rows"] == 2 and figures["late"] == 1 and figures["last_state"] <= 1
    assert {(r.window_start.hour, r.closed) for r in third.collect()} == {(1, True), (2, True), (9, False)}
    fourth, figures = go()  # nothing new
    assert windows(fourth) == windows(third) and figures["rows"] == 0


def test_a_batch_that_runs_again_replaces_its_output(spark):
    landing, out = scratch_path(spark, "w_in"), scratch_path(spark, "w_out")
    shape = spark.createDataFrame([], EVENT).schema
    for h in (3, 1, 2):
        land(spark, landing, [("a", at(1, h), 1.0, "ok")] * 3, EVENT, "json")
    one, _ = jobs.stream_event_windows(spark, landing, shape, delay="1 day", out_root=out)
    again, _ = jobs.stream_event_windows(spark, landing, shape, delay="1 day", out_root=out)  # the same batches, a fresh checkpoint
    assert windows(again) == [(1, h, "a", 3, 0, 3.0) for h in (1, 2, 3)]


def test_documents_once_across_files_and_restarts(spark):
    landing, out, ckpt = (scratch_path(spark, n) for n in ("d_in", "d_out", "d_ckpt"))
    shape = spark.createDataFrame([], DOC).schema
    go = lambda: jobs.stream_documents(spark, landing, shape, ["id"], delay="2 days", out_root=out, checkpoint=ckpt, files_per_trigger=1)
    land(spark, landing, [(1, at(5, 1), "x"), (1, at(5, 1), "x"), (2, at(4, 1), "y")], DOC, "parquet")
    land(spark, landing, [(2, at(5, 2), "y"), (3, at(5, 3), "z")], DOC, "parquet")
    docs, figures = go()
    assert sorted(r.id for r in docs.collect()) == [1, 2, 3] and figures["late"] == 0
    land(spark, landing, [(3, at(5, 4), "again"), (4, at(20, 1), "new")], DOC, "parquet")
    docs, _ = go()
    land(spark, landing, [(5, at(6, 1), "late"), (6, at(20, 2), "w")], DOC, "parquet")
    docs, figures = go()
    assert sorted(r.id for r in docs.collect()) == [1, 2, 3, 4, 6] and figures["late"] == 1
    assert figures["last_state"] <= 2  # keys of the first days are gone
