"""Registered queries: landed JSON documents, typed parsing, reporting SQL.

Each query lands the API-like documents derived from the tables (see
``sources.landing``), scans them back and parses them; the DuckDB oracle
derives the same rows straight from the tables, so a match proves the round
trip table -> JSON -> landed text -> VARIANT -> typed rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import safe_float, safe_timestamp
from panelforge.operators import features as fe
from panelforge.operators.common import attach_row, round_doubles
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.sources import json_docs as jd
from panelforge.sources import tables as tb
from panelforge.sources.landing import ALL_KINDS, land_raw_documents


def env(spark, sf, kinds=ALL_KINDS, malformed=False):
    """Land (only the needed document kinds) and scan the envelopes."""
    return jd.envelope_scan(spark, land_raw_documents(spark, sf, kinds=tuple(kinds), malformed=malformed))


# Documents that the three quarantine queries land truncated are not these.
VALID_ELEMENTS = "NOT (gameweek_id % 7 = 0 AND floor(player_id / 500) = 0)"

MATCHES_SQL = """
matches AS (
  SELECT o.o_orderkey AS fixture_id, o.o_orderdate AS kickoff_time, c.c_nationkey AS team_h,
         s.s_nationkey AS team_a, o.o_orderstatus = 'F' AS finished, o.o_custkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN (SELECT l_orderkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON s.s_suppkey = l.s_suppkey)"""


@register(
    "json_envelope_scan",
    "S1 D1 F11",
    with_panel(MATCHES_SQL)
    + f""",
boot AS (SELECT DISTINCT gameweek_id AS e, CAST(floor(player_id / 500) AS BIGINT) AS c FROM collapsed)
SELECT CASE WHEN bad THEN NULL ELSE 'bootstrap-static' END AS endpoint_name,
       CASE WHEN bad THEN NULL ELSE 'https://api.example.invalid/bootstrap-static/' || CAST(e AS VARCHAR) || '-' || CAST(c AS VARCHAR) END AS url,
       CASE WHEN bad THEN NULL ELSE 200 END AS status_code,
       CASE WHEN bad THEN NULL ELSE '2024-02-01T06:00:' || lpad(CAST(e % 60 AS VARCHAR), 2, '0') || 'Z' END AS fetch_timestamp,
       NOT bad AS is_valid
FROM (SELECT *, e % 7 = 0 AND c = 0 AS bad FROM boot) b
UNION ALL SELECT 'bootstrap-static', 'https://api.example.invalid/bootstrap-static/teams', 200, '2024-02-01T06:00:00Z', true
UNION ALL SELECT 'bootstrap-static', 'https://api.example.invalid/bootstrap-static/events', 200, '2024-02-01T06:00:00Z', true
UNION ALL SELECT DISTINCT 'fixtures', 'https://api.example.invalid/fixtures/' || CAST(CAST(floor(fixture_id / 1000) AS BIGINT) AS VARCHAR),
       200, '2024-02-01T06:00:00Z', true FROM matches
UNION ALL SELECT DISTINCT 'element-summary', 'https://api.example.invalid/element-summary/' || CAST(player_id AS VARCHAR),
       200, '2024-02-01T06:00:00Z', true FROM collapsed""",
)
def q_envelope_scan(spark, sf):
    e = env(spark, sf, malformed=True)
    return e.select("endpoint_name", "url", "status_code", "fetch_timestamp", "is_valid")


@register(
    "batch_ingest_stats",
    "S2 A31 T6",
    with_panel(MATCHES_SQL)
    + f"""
SELECT 'bootstrap-static' AS endpoint_name,
       (SELECT count(*) FROM (SELECT DISTINCT gameweek_id, floor(player_id / 500) FROM collapsed WHERE {VALID_ELEMENTS}) x) + 2
         AS total,
       (SELECT count(*) FROM (SELECT DISTINCT gameweek_id, floor(player_id / 500) FROM collapsed WHERE {VALID_ELEMENTS}) x) + 2
         AS success,
       CAST(0 AS BIGINT) AS failed
UNION ALL
SELECT '<unparsed>', count(*), 0, count(*)
FROM (SELECT DISTINCT gameweek_id FROM collapsed WHERE NOT ({VALID_ELEMENTS})) x
UNION ALL
SELECT 'fixtures', count(DISTINCT floor(fixture_id / 1000)), count(DISTINCT floor(fixture_id / 1000)), 0 FROM matches
UNION ALL
SELECT 'element-summary', count(DISTINCT player_id), count(DISTINCT player_id), 0 FROM collapsed""",
)
def q_ingest_stats(spark, sf):
    return jd.ingest_stats(env(spark, sf, malformed=True)).drop("bytes")


PLAYER_SQL = """
SELECT player_id, web_name, team_id, position_id, CAST(round(now_cost * 10) AS INTEGER) AS now_cost,
       CASE WHEN (player_id + gameweek_id) % 9 = 0 THEN NULL ELSE CAST(goals_scored + assists AS DOUBLE) + 0.5 END AS form,
       CAST(round(total_points) AS INTEGER) AS total_points, CAST(minutes_played AS INTEGER) AS minutes,
       goals_scored, assists, clean_sheets, bonus, gameweek_id AS gameweek_fetched,
       'F' || CAST(player_id AS VARCHAR) AS first_name, 'S' || CAST(player_id AS VARCHAR) AS second_name,
       CASE WHEN player_id % 7 <> 0 THEN CAST(player_id % 100 AS DOUBLE) + 0.5 END AS selected_by_percent,
       CAST(player_id % 13 AS DOUBLE) + 0.25 AS value_season,
       CASE WHEN player_id % 11 <> 0 THEN CAST(player_id % 5 AS DOUBLE) + 0.75 END AS value_form,
       CAST(minutes_played AS INTEGER) % 4 AS goals_conceded, CAST(minutes_played AS INTEGER) * 2 + gameweek_id AS bps,
       CASE WHEN player_id % 5 = 0 THEN 'i' ELSE 'a' END AS status,
       CASE WHEN player_id % 3 <> 0 THEN CAST(player_id % 4 AS INTEGER) * 25 END AS chance_of_playing_next_round
FROM collapsed"""


@register("parse_players", "P1 P5", with_panel() + PLAYER_SQL)
def q_parse_players(spark, sf):
    return jd.parse_players(env(spark, sf, ("elements",)))


@register(
    "parse_teams",
    "P2",
    """
SELECT n_nationkey AS team_id, n_name AS name, substr(n_name, 1, 3) AS short_name, n_regionkey AS strength,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_regionkey AS DOUBLE) END AS form,
       n_nationkey * 3 AS points, n_nationkey + 1 AS position,
       n_nationkey + 1000 AS strength_overall_home, n_nationkey * 2 + 1000 AS strength_overall_away,
       n_nationkey * 3 + 1000 AS strength_attack_home, n_nationkey * 4 + 1000 AS strength_attack_away,
       n_nationkey * 5 + 1000 AS strength_defence_home, n_nationkey * 6 + 1000 AS strength_defence_away
FROM nation""",
)
def q_parse_teams(spark, sf):
    return jd.parse_teams(env(spark, sf, ("teams",)))


@register(
    "parse_gameweeks",
    "P3 P6",
    """
WITH d AS (SELECT CAST(day(ts) AS INTEGER) AS gw, min(ts) AS first_ts FROM events GROUP BY 1),
m AS (SELECT max(gw) AS mx FROM d)
SELECT gw AS gameweek_id, 'Gameweek ' || CAST(gw AS VARCHAR) AS name, date_trunc('second', first_ts) AS deadline_time,
       gw < mx - 3 AS finished, gw = mx - 3 AS is_current, gw = mx - 2 AS is_next, gw = mx - 4 AS is_previous,
       gw * 7 AS highest_score, CASE WHEN gw < mx - 3 THEN gw * 3 END AS average_entry_score,
       gw * 11 AS most_selected, gw * 12 AS most_transferred_in, gw * 13 AS most_captained, gw * 14 AS most_vice_captained
FROM d, m""",
)
def q_parse_gameweeks(spark, sf):
    return jd.parse_gameweeks(env(spark, sf, ("events",)))


@register(
    "parse_fixtures",
    "P4",
    "WITH " + MATCHES_SQL + """
SELECT fixture_id, CAST((year(kickoff_time) - 1995) * 12 + month(kickoff_time) AS INTEGER) AS gameweek_id,
       date_trunc('second', kickoff_time) AS kickoff_time, team_h, team_a,
       CAST(fixture_id % 5 AS INTEGER) AS team_h_score, CAST(o_custkey % 4 AS INTEGER) AS team_a_score,
       finished, true AS started
FROM matches""",
)
def q_parse_fixtures(spark, sf):
    return jd.parse_fixtures(env(spark, sf, ("fixtures",)))


@register(
    "safe_float",
    "P5 C14",
    """
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN 'n/a'
                                  ELSE CAST(p_retailprice AS VARCHAR) END AS raw_value FROM part)
SELECT p_partkey, TRY_CAST(NULLIF(trim(raw_value), '') AS DOUBLE) AS value FROM s""",
)
def q_safe_float(spark, sf):
    s = tb.string_nums(spark, sf)
    return s.select("p_partkey", safe_float("raw_value").alias("value"))


@register(
    "safe_timestamp",
    "P6",
    """
SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 13 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed
FROM events""",
)
def q_safe_timestamp(spark, sf):
    ev = tb.read_table(spark, sf, "events")
    raw = (
        F.when(F.col("event_id") % 10 == 0, F.lit(""))
        .when(F.col("event_id") % 13 == 0, F.lit("not a date"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return ev.select("event_id", safe_timestamp(raw).alias("parsed"))


@register("extract_ids", "P7", with_panel() + "\nSELECT DISTINCT player_id FROM collapsed")
def q_extract_ids(spark, sf):
    return jd.extract_ids(env(spark, sf, ("elements",)))


@register(
    "current_period",
    "P8",
    "SELECT CAST(max(day(ts)) - 3 AS INTEGER) AS current_gameweek_id FROM events",
)
def q_current_period(spark, sf):
    return jd.current_period(env(spark, sf, ("events",)))


@register(
    "flatten_history",
    "F12",
    with_panel()
    + """
SELECT player_id, gameweek_id, CAST(round(total_points) AS INTEGER) AS total_points,
       CAST(minutes_played AS INTEGER) AS minutes FROM collapsed""",
)
def q_flatten_history(spark, sf):
    return jd.flatten_history(env(spark, sf, ("history",)))


@register(
    "raw_json_profile",
    "A24",
    with_panel()
    + """
SELECT count(DISTINCT player_id) AS distinct_players, count(*) AS element_rows,
       TIMESTAMP '2024-02-01 06:00:00' + to_seconds(CAST(max(gameweek_id % 60) AS BIGINT)) AS latest_fetch
FROM collapsed""",
)
def q_raw_json_profile(spark, sf):
    return jd.raw_json_profile(env(spark, sf, ("elements",)))


@register(
    "redact_keys",
    "P31 F6",
    with_panel(MATCHES_SQL)
    + """
SELECT 'bootstrap-static' AS endpoint_name,
       2 * (SELECT count(*) FROM (SELECT DISTINCT gameweek_id, floor(player_id / 500) FROM collapsed) x) + 4 AS redacted_values,
       CAST(0 AS BIGINT) AS leaked
UNION ALL SELECT 'element-summary', 2 * count(DISTINCT player_id), 0 FROM collapsed
UNION ALL SELECT 'fixtures', 0, 0""",
)
def q_redact(spark, sf):
    """Every envelope holds a scalar secret and an object of secrets; both go
    as a whole, whatever is nested in them."""
    e = env(spark, sf)
    red = e.withColumn("red", jd.redact_json_deep(F.col("line")))
    ep = F.coalesce(F.col("endpoint_name"), F.lit("<unparsed>"))
    n_red = F.size(F.split(F.col("red"), F.lit(r"\[REDACTED\]"))) - 1
    return red.groupBy(ep.alias("endpoint_name")).agg(
        F.sum(n_red).cast("bigint").alias("redacted_values"),
        F.count_if(F.col("red").rlike("k-[0-9a-z]|s3cr")).alias("leaked"),
    )


@register(
    "raw_append_counts",
    "K3 K2",
    with_panel(MATCHES_SQL)
    + f""",
d AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT gameweek_id, floor(player_id / 500) FROM collapsed) x) + 2
             + (SELECT count(DISTINCT floor(fixture_id / 1000)) FROM matches)
             + (SELECT count(DISTINCT player_id) FROM collapsed) AS total,
             (SELECT count(*) FROM (SELECT DISTINCT gameweek_id FROM collapsed WHERE NOT ({VALID_ELEMENTS})) x) AS failed)
SELECT total, total - failed AS success, failed FROM d""",
)
def q_raw_append(spark, sf):
    from panelforge.sources.sinks import append_raw_documents

    return append_raw_documents(env(spark, sf, malformed=True))


# ------------------------------------------------------------------ reporting SQL of the reference

def season(spark, sf):
    c = fe.collapse_periods(tb.fixture_rows(spark, sf))
    return c.groupBy("player_id").agg(
        F.max_by("web_name", "gameweek_id").alias("web_name"),
        F.max_by("team_id", "gameweek_id").alias("team_id"),
        F.round(F.sum("total_points"), 6).alias("total_points"),
        F.sum("minutes_played").alias("minutes"),
        F.round(F.max_by("now_cost", "gameweek_id") * 10).cast("int").alias("now_cost"),
    )


SEASON_SQL = """,
season AS (
  SELECT player_id, arg_max(web_name, gameweek_id) AS web_name, arg_max(team_id, gameweek_id) AS team_id,
         round(sum(total_points), 6) AS total_points, sum(minutes_played) AS minutes,
         CAST(round(arg_max(now_cost, gameweek_id) * 10) AS INTEGER) AS now_cost
  FROM collapsed GROUP BY player_id)"""


@register(
    "top_scorers",
    "T1",
    rsql(with_panel() + SEASON_SQL + """
SELECT player_id, web_name, total_points FROM season ORDER BY total_points DESC, player_id LIMIT 10""", ["total_points"]),
)
def q_top_scorers(spark, sf):
    s = season(spark, sf)
    return round_doubles(s.orderBy(F.col("total_points").desc(), "player_id").limit(10).select("player_id", "web_name", "total_points"))


@register(
    "best_value_topn",
    "T2 P30",
    rsql(with_panel() + SEASON_SQL + """
SELECT player_id, web_name, now_cost / 10.0 AS price, total_points / (now_cost / 10.0) AS value_ratio
FROM season WHERE minutes > 500 ORDER BY value_ratio DESC, player_id LIMIT 10""", ["price", "value_ratio"]),
)
def q_best_value(spark, sf):
    s = season(spark, sf).filter(F.col("minutes") > 500)
    out = s.select("player_id", "web_name", (F.col("now_cost") / 10.0).alias("price"),
                   (F.col("total_points") / (F.col("now_cost") / 10.0)).alias("value_ratio"))
    return round_doubles(out.orderBy(F.col("value_ratio").desc(), "player_id").limit(10))


@register(
    "standings",
    "T3",
    rsql(with_panel() + """
SELECT team_id, round(sum(total_points), 6) AS points,
       CAST(rank() OVER (ORDER BY round(sum(total_points), 6) DESC, team_id) AS INTEGER) AS position
FROM collapsed GROUP BY team_id""", ["points"]),
)
def q_standings(spark, sf):
    from pyspark.sql import Window

    t = fe.collapse_periods(tb.fixture_rows(spark, sf)).groupBy("team_id").agg(F.round(F.sum("total_points"), 6).alias("points"))
    # one row per team: the ordering window runs over #teams rows only
    return round_doubles(t.withColumn("position", F.rank().over(Window.orderBy(F.col("points").desc(), "team_id"))))


@register(
    "upcoming_fixtures",
    "J2",
    "WITH " + MATCHES_SQL + """
SELECT m.fixture_id, m.kickoff_time, h.n_name AS home_team, a.n_name AS away_team
FROM matches m JOIN nation h ON h.n_nationkey = m.team_h JOIN nation a ON a.n_nationkey = m.team_a
WHERE NOT m.finished""",
)
def q_upcoming(spark, sf):
    m = tb.matches(spark, sf).filter(~F.col("finished"))
    t = tb.team_dim(spark, sf)
    h = t.select(F.col("team_id").alias("th"), F.col("name").alias("home_team"))
    a = t.select(F.col("team_id").alias("ta"), F.col("name").alias("away_team"))
    # the team table is the 25-row nation table: a bounded broadcast
    j = m.join(F.broadcast(h), m.team_h == h.th).join(F.broadcast(a), m.team_a == a.ta)
    return j.select("fixture_id", "kickoff_time", "home_team", "away_team")


@register(
    "forecast_vs_actual",
    "J13 A25",
    rsql(
        with_panel()
        + """,
zs AS (SELECT avg(total_points) AS m1, CASE WHEN stddev_samp(total_points) > 0 THEN stddev_samp(total_points) ELSE 1.0 END AS s1
       FROM targeted),
pred AS (SELECT player_id, target_gameweek_id,
                greatest(0.0, COALESCE(three_week_players_roll_avg_points, 2.0) * 0.7
                              + COALESCE((total_points - m1) / s1, 0.0) * 1.5 + 2.0) AS predicted_points
         FROM targeted, zs),
j AS (SELECT p.*, c.total_points AS actual_points FROM pred p JOIN collapsed c
        ON c.player_id = p.player_id AND c.gameweek_id = p.target_gameweek_id),
w AS (SELECT * FROM j WHERE target_gameweek_id >= (SELECT max(target_gameweek_id) FROM j) - 9)
SELECT count(*) AS n, avg(abs(actual_points - predicted_points)) AS mae, avg(actual_points - predicted_points) AS bias,
       CAST(min(target_gameweek_id) AS INTEGER) AS from_gameweek, CAST(max(target_gameweek_id) AS INTEGER) AS to_gameweek
FROM w""",
        ["mae", "bias"],
    ),
)
def q_forecast_vs_actual(spark, sf):
    c = fe.collapse_periods(tb.fixture_rows(spark, sf))
    t = fe.next_period_target(fe.rolling_features(c))
    z = fe.zscore_self(t, ["total_points"])
    pred = z.select("player_id", "target_gameweek_id", fe.heuristic_forecast(z).alias("predicted_points"))
    act = c.select("player_id", F.col("gameweek_id").alias("target_gameweek_id"), F.col("total_points").alias("actual_points"))
    j = pred.join(act, ["player_id", "target_gameweek_id"])
    mx = j.agg((F.max("target_gameweek_id") - 9).alias("__from"))
    w = attach_row(j, mx).filter(F.col("target_gameweek_id") >= F.col("__from"))
    return round_doubles(
        w.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(F.col("actual_points") - F.col("predicted_points"))).alias("mae"),
            F.avg(F.col("actual_points") - F.col("predicted_points")).alias("bias"),
            F.min("target_gameweek_id").cast("int").alias("from_gameweek"),
            F.max("target_gameweek_id").cast("int").alias("to_gameweek"),
        )
    )
