"""Rows that are scored come from a written table: scoring asks for their partitions, which would build them twice."""

import pytest
from pyspark.sql import functions as F

from panelforge.plans import q_models as q


class Stop(Exception):
    pass


def events(spark, path):
    e = spark.range(600).select(F.col("id").alias("event_id"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 6 as int))").cast("timestamp_ntz").alias("ts"), (F.col("id") % 20).alias("user_id"),
                                F.lit("click").alias("event_type"), (F.col("id") % 37).cast("double").alias("value"), F.lit('{"k": 3}').alias("props"))
    e.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_as_of_rows_are_written_before_they_are_scored(spark, monkeypatch, tmp_path):
    plans = []

    def score(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise Stop

    monkeypatch.setattr(q.mo, "fit_named", lambda *a, **k: None)
    monkeypatch.setattr(q.bo, "score_rows", score)
    with pytest.raises(Stop):
        q.q_pit_backfill_model(spark, events(spark, tmp_path))
    assert "Window" not in plans[0] and "Aggregate" not in plans[0] and "Relation" in plans[0]


def test_the_evaluation_is_written_without_the_features(spark, monkeypatch):
    written, write = [], q.materialize
    monkeypatch.setattr(q, "materialize", lambda df: written.append(set(df.columns)) or write(df))
    rows = spark.range(200).select(F.lit("m").alias("model"), (F.col("id") % 20).alias("player_id"), (F.col("id") % 4 + 1).cast("int").alias("position_id"), (F.col("id") % 5 + 1).cast("int").alias("target_gameweek_id"),
                                   (F.col("id") % 91).cast("double").alias("minutes_played"), (F.col("id") % 7).cast("double").alias("five_week_players_roll_avg_points"),
                                   (F.col("id") % 9).cast("double").alias(q.ACT), (F.col("id") % 8).cast("double").alias("predicted_points"), F.lit(1.0).alias("threat"), F.lit("x").alias("web_name"))
    own, coeffs, selected, gates = q.evaluated(rows, rows)
    assert own.first()["mae"] is not None and gates.count() == 1
    assert not any({"threat", "web_name"} & columns for columns in written) and written[0] == {"model", "position_id", q.ACT, "predicted_points"}
