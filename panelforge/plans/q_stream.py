"""Registered queries: streaming re-aims (equal to their batch twins) and the
table freshness monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import features as fe
from panelforge.operators.common import round_doubles
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.session import scratch_path
from panelforge.sources import tables as tb
from panelforge.streaming import jobs


@register(
    "stream_upsert",
    "ST1 K4 K5",
    rsql(
        with_panel()
        + """
SELECT player_id, gameweek_id, total_points, position_id, team_id FROM (
  SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id DESC) AS rn FROM collapsed) x WHERE rn = 1""",
        ["total_points"],
    ),
)
def q_stream_upsert(spark, sf):
    rows = fe.collapse_periods(tb.fixture_rows(spark, sf)).select(
        "player_id", "gameweek_id", "total_points", "position_id", "team_id"
    )
    landing = scratch_path(spark, "landing_periods")
    jobs.land_files(rows, landing, "gameweek_id")
    root = jobs.stream_upsert(spark, landing, rows.schema)
    state = jobs.read_state(spark, root)
    return round_doubles(state.select("player_id", "gameweek_id", "total_points", "position_id", "team_id"))


@register(
    "stream_event_rollup",
    "ST2 D12",
    rsql("""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type AS node, count(*) AS n_events, CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed,
       sum(value) AS total_duration_ms
FROM events GROUP BY 1, 2, 3""", ["total_duration_ms"]),
)
def q_stream_rollup(spark, sf):
    log = tb.event_log(spark, sf).withColumn("day", F.dayofmonth("ts"))
    landing = scratch_path(spark, "landing_events")
    jobs.land_files(log, landing, "day", "json")
    schema = log.drop("day").schema
    out = jobs.stream_event_rollup(spark, landing, schema)
    return round_doubles(out)


@register(
    "stream_documents",
    "ST1 K3",
    with_panel()
    + """
SELECT gameweek_id, count(*) AS documents, CAST(0 AS BIGINT) AS late FROM collapsed GROUP BY gameweek_id""",
)
def q_stream_documents(spark, sf):
    """Every (player, period) document lands twice, the copies in files of their own: taken once."""
    rows = fe.collapse_periods(tb.fixture_rows(spark, sf)).select(
        "player_id", "gameweek_id", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("gameweek_id"), F.lit(6), F.lit(0), F.lit(0)).alias("fetched_at"))
    landing = scratch_path(spark, "landing_docs")
    for _ in range(2):
        jobs.land_files(rows, landing, "gameweek_id")
    docs, figures = jobs.stream_documents(spark, landing, rows.schema, ["player_id", "gameweek_id"], delay="60 days")
    return docs.groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("documents")).withColumn("late", F.lit(figures["late"]).cast("long"))


@register(
    "stream_event_windows",
    "ST2 D12",
    rsql("""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type AS node, count(*) AS n_events, CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed,
       sum(value) AS total_duration_ms
FROM events GROUP BY 1, 2, 3""", ["total_duration_ms"]),
)
def q_stream_windows(spark, sf):
    log = tb.event_log(spark, sf).withColumn("day", F.dayofmonth("ts"))
    landing = scratch_path(spark, "landing_windows")
    jobs.land_files(log, landing, "day", "json")
    out, _ = jobs.stream_event_windows(spark, landing, log.drop("day").schema, delay="60 days")  # files are read in any order
    return round_doubles(out.drop("closed"))


@register(
    "freshness_report",
    "A23 U1 F10",
    """
SELECT 'events' AS table_name, count(*) AS row_count, max(ts) AS latest FROM events
UNION ALL SELECT 'orders', count(*), max(o_orderdate) FROM orders
UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem""",
)
def q_freshness(spark, sf):
    def mon(name, col):
        t = tb.read_table(spark, sf, name)
        return t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                     F.max(F.col(col).cast("timestamp_ntz")).alias("latest"))

    return mon("events", "ts").unionByName(mon("orders", "o_orderdate")).unionByName(mon("lineitem", "l_shipdate"))
