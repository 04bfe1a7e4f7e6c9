"""Table maintenance, JSON parsing, redaction, fingerprints, snapshots."""

import json

from pyspark.sql import functions as F

from panelforge.operators import quality as qu
from panelforge.operators import squad as sq
from panelforge.session import scratch_path
from panelforge.sources import json_docs as jd
from panelforge.sources import sinks as sk
from panelforge.sources import snapshot as sn


def test_merge_upsert_semantics_and_idempotence(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    src = spark.createDataFrame([(2, "B", None), (3, "c", 3.0), (3, "c2", 4.0)], "k int, s string, v double")
    once = sk.merge_upsert(tgt, src, ["k"], order="v")
    rows = {r.k: (r.s, r.v, r.merge_action) for r in once.collect()}
    assert rows == {1: ("a", 1.0, "untouched"), 2: ("B", None, "updated"), 3: ("c2", 4.0, "inserted")}
    twice = sk.merge_upsert(once.drop("merge_action"), src, ["k"], order="v").drop("merge_action")
    assert sorted(twice.collect()) == sorted(once.drop("merge_action").collect())


def test_typed_schema_and_pk_filter(spark):
    s = sk.table_schema("players")
    assert s["player_id"].nullable is False and sk.primary_key("players") == "player_id"
    df = spark.createDataFrame([(1, "x"), (None, "y")], "player_id long, web_name string")
    out = sk.conform(df, "players", load_ts=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert out.count() == 1 and len(out.columns) == len(s.fields)
    assert sk.primary_key("players_gameweek_snapshot") == "snapshot_id"


def test_replace_period_and_evolution(spark):
    path = scratch_path(spark, "t_hist")
    df = spark.createDataFrame([(1, 10, 1), (2, 20, 1), (1, 11, 2)], "player_id int, total_points int, gameweek_fetched int")
    df.write.partitionBy("gameweek_fetched").parquet(path)
    redo = spark.createDataFrame([(9, 99, 2)], "player_id int, total_points int, gameweek_fetched int")
    sk.replace_periods(redo, path)
    got = sorted((r.gameweek_fetched, r.player_id) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (1, 2), (2, 9)]
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2, "m")], "id int, backfill_method string")
    assert sorted(sk.evolve_union(a, b).collect()) == sorted([(1, None), (2, "m")])


def test_redaction_nested_golden(spark):
    payload = {"API_TOKEN": "abc", "nested": {"private_key": "xyz", "safe": 1,
                                              "items": [{"SECRET": "value"}, {"normal": "ok"}]}}
    df = spark.createDataFrame([(json.dumps(payload),)], "j string")
    shallow = json.loads(df.select(jd.redact_json_text(F.col("j")).alias("r")).collect()[0].r)
    deep = json.loads(df.select(jd.redact_json_deep(F.col("j")).alias("r")).collect()[0].r)
    for out in (shallow, deep):
        assert out["API_TOKEN"] == "[REDACTED]" and out["nested"]["private_key"] == "[REDACTED]"
        assert out["nested"]["items"][0]["SECRET"] == "[REDACTED]" and out["nested"]["items"][1]["normal"] == "ok"
    obj = spark.createDataFrame([(json.dumps({"secret_block": {"a": 1}, "x": 2}),)], "j string")
    assert json.loads(obj.select(jd.redact_json_deep(F.col("j")).alias("r")).collect()[0].r)["secret_block"] == "[REDACTED]"


def test_recommendation_key_format(spark):
    df = spark.createDataFrame([(1, 3, 4.0, True, True, False)],
                               "player_id int, gw int, score double, is_starter boolean, is_captain boolean, is_vice_captain boolean")
    r = sq.recommendation_rows(df, F.lit("2026-01-19T00:00:00"), "gw", "score").collect()[0]
    assert r.recommendation_key == "1_2026-01-19T00:00:00" and r.expected_points_5_gw == 20.0


def test_fingerprint_order_independent_and_snapshot_acceptance(spark):
    df = spark.createDataFrame([(1, 2, 1.5, 3.0, 4.0, 5.0, 6.0), (2, 3, 2.5, 1.0, 2.0, 3.0, 4.0)],
                               "player_id long, gameweek_id int, total_points double, minutes_played double, ict_index double, now_cost double, position_id double")
    df = df.withColumn("position_id", F.col("position_id").cast("int"))
    h1 = qu.dataset_fingerprint(df).collect()[0].content_hash
    h2 = qu.dataset_fingerprint(df.orderBy(F.col("player_id").desc()).repartition(3)).collect()[0].content_hash
    assert h1 == h2
    root = scratch_path(spark, "t_snap")
    path, m = sn.write_snapshot(df, root, created_at="2024-02-01T06:00:00Z", source="t", query_text="q", run_id="r")
    data = spark.read.parquet(path)
    ok = sn.accept_snapshot(data, m, "2024-02-02 06:00:00").collect()[0]
    assert ok.accepted and ok.code is None
    stale = sn.accept_snapshot(data, m, "2024-03-02 06:00:00").collect()[0]
    assert stale.code == "SNAPSHOT_STALE" and stale.allow_fallback
    bad = sn.accept_snapshot(data.filter("player_id = 1"), m, "2024-02-02 06:00:00").collect()[0]
    assert bad.code == "SNAPSHOT_HASH_MISMATCH"
    plan = sn.retention_plan(spark.createDataFrame([(f"v{i}", f"2024-01-0{i}") for i in range(1, 4)], "version string, created_at_utc string"),
                             keep=2, preserve="v1")
    assert sorted(r.version for r in plan.filter("keep").collect()) == ["v1", "v2", "v3"]
    plan2 = sn.retention_plan(spark.createDataFrame([(f"v{i}", f"2024-01-0{i}") for i in range(1, 4)], "version string, created_at_utc string"), keep=2)
    assert sorted(r.version for r in plan2.filter("keep").collect()) == ["v2", "v3"]


def test_validation_report_flags_duplicates(spark):
    df = spark.createDataFrame([(1, 1, 2, 1.0), (1, 1, 2, 2.0), (2, 3, 2, None)],
                               "player_id long, gameweek_id int, target_gameweek_id int, target_next_gw_points double")
    rep = {(r.check, r.column_name): r for r in qu.validation_report(df).collect()}
    assert not rep[("duplicate_ratio", "player_id,gameweek_id")].ok
    assert not rep[("temporal_leakage", "gameweek_id->target_gameweek_id")].ok  # 2 < 3
    assert not rep[("null_ratio", "target_next_gw_points")].ok
    assert not rep[("required", "ict_index")].ok


def test_source_selection_fallback_rules(spark):
    df = spark.createDataFrame([(1, 2, 3, 1.0, 2.0, 3.0, 4.0)],
                               "player_id long, gameweek_id int, position_id int, total_points double, minutes_played double, ict_index double, now_cost double")
    root = scratch_path(spark, "t_sel")
    sn.write_snapshot(df, root, created_at="2024-02-01T06:00:00Z", source="t", query_text="q", run_id="r")
    got, meta = sn.load_training_frame(spark, source="local", local_root=root, now="2024-02-02 00:00:00")
    assert meta["data_source_selected"] == "local" and got.count() == 1
    remote = lambda: df.limit(0)
    got, meta = sn.load_training_frame(spark, source="local", local_root=root, now="2024-03-02 00:00:00",
                                       remote_loader=remote, policy="LOCAL_THEN_REMOTE")
    assert meta["fallback_taken"] and meta["fallback_reason"] == "SNAPSHOT_STALE"
    import pytest
    with pytest.raises(RuntimeError):
        sn.load_training_frame(spark, source="local", local_root=root, now="2024-03-02 00:00:00")
    log = scratch_path(spark, "t_log")
    sk.append_event_log(spark.createDataFrame([("r1", "ingest", '{"API_KEY": "x", "rows": 3}')], "run_id string, node string, detail string"), log)
    txt = spark.read.json(log).first()["detail"]
    assert "[REDACTED]" in txt and '"x"' not in txt


def test_fingerprints_tell_apart_what_looks_alike(spark):
    rows = [("a|b", "c", 1.0), ("a", "b|c", 1.0), ("a", "b|c", 1.0 + 1e-9), ("a", "b|c", 1e300), ("a", None, 1.0), ("a", "-", 1.0), (None, "a", float("nan"))]
    frames = [spark.createDataFrame([r], "x string, y string, z double") for r in rows]
    assert len({qu.dataset_fingerprint(f).first().content_hash for f in frames}) == len(rows)
    assert len({qu.dataset_fingerprint(f, digits=6).first().content_hash for f in frames}) == len(rows) - 1
    two = spark.createDataFrame(rows[:2], frames[0].schema)
    assert qu.dataset_fingerprint(two).first() == qu.dataset_fingerprint(two.orderBy(F.desc("x")).repartition(2)).first()


def test_redaction_of_objects_lists_and_broken_text(spark):
    texts = ['{"api_key":{"a":"s3cr"},"tokens":["t1"],"x":1}', '{"api_key": "s3cr', None]
    df = spark.createDataFrame([(t,) for t in texts], "detail string")
    path = scratch_path(spark, "events")
    sk.append_event_log(df, path)
    kept = [r.value for r in spark.read.text(path).collect()]
    assert len(kept) == 3 and not any("s3cr" in v or "t1" in v for v in kept)
