"""Registered query: the weekly flow end to end in one plan (landed JSON ->
typed players -> features from their history -> inference filter -> latest
row per player -> heuristic score -> budgeted squad, XI and captain for the
next period -> recommendation rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import asof as ao
from panelforge.operators import features as fe
from panelforge.operators import squad as sq
from panelforge.operators.common import attach_row, materialize, round_doubles
from panelforge.plans.q_ingest import PLAYER_SQL, env
from panelforge.plans.q_squad import squad_ctes
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.sources import json_docs as jd

FLOW_SQL = f""",
pp AS ({PLAYER_SQL}),
hist AS (SELECT *, avg(CAST(total_points AS DOUBLE)) OVER (PARTITION BY player_id ORDER BY gameweek_fetched
                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three_week_players_roll_avg_points
         FROM pp),
inf AS (SELECT * FROM hist WHERE gameweek_fetched > 3),
zs AS (SELECT avg(CAST(total_points AS DOUBLE)) AS m1,
              CASE WHEN stddev_samp(CAST(total_points AS DOUBLE)) > 0 THEN stddev_samp(CAST(total_points AS DOUBLE)) ELSE 1.0 END AS s1
       FROM inf),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY gameweek_fetched DESC) AS rn FROM inf) x
           WHERE rn = 1),
cand AS (SELECT (SELECT max(gameweek_fetched) FROM inf) + 1 AS g, l.player_id, l.web_name, l.position_id, l.team_id,
                l.now_cost / 10.0 AS now_cost,
                greatest(0.0, COALESCE(l.three_week_players_roll_avg_points, 2.0) * 0.7
                              + COALESCE((CAST(l.total_points AS DOUBLE) - z.m1) / z.s1, 0.0) * 1.5 + 2.0) AS score,
                CAST(NULL AS DOUBLE) AS actual
         FROM latest l, zs z)"""


@register(
    "weekly_flow",
    "S1 P1 K5 W9 P10 P20 P21 W2 O3 O4 O5 P29 (weekly orchestration)",
    rsql(
        with_panel(FLOW_SQL.lstrip(",") + squad_ctes("score", "p_"))
        + """
SELECT CAST(player_id AS VARCHAR) || '_' || '2024-02-01T06:00:00' AS recommendation_key, CAST(player_id AS INTEGER) AS player_id,
       CAST(g AS INTEGER) AS gameweek_id, web_name, position_id, team_id, now_cost, score AS expected_points_next_gw,
       score * 5.0 AS expected_points_5_gw, is_starter, is_captain, is_vice_captain, formation
FROM p_xi""",
        ["now_cost", "expected_points_next_gw", "expected_points_5_gw"],
    ),
)
def q_weekly_flow(spark, sf):
    players = jd.parse_players(env(spark, sf, ("elements",)))
    hist = fe.rolling_features(players.withColumn("total_points", F.col("total_points").cast("double")),
                               period="gameweek_fetched", team=None)
    inf = fe.training_filter(hist, period="gameweek_fetched", minutes="__none__")  # P10: periods > 3
    inf = materialize(inf)  # read by the statistics, the latest-row pick and the target period
    z = fe.zscore_apply(inf, fe.global_stats(inf, ["total_points"]), ["total_points"])
    scored = z.withColumn("score", fe.heuristic_forecast(z))
    latest = ao.latest_per_entity(
        scored.select("player_id", "gameweek_fetched", "web_name", "position_id", "team_id",
                      (F.col("now_cost") / 10.0).alias("now_cost"), "score"),
        period="gameweek_fetched",
    )
    tgt = inf.agg((F.max("gameweek_fetched") + 1).cast("int").alias("gameweek_id"))
    cand = attach_row(latest, tgt)
    squad = sq.budgeted_squad(cand, ["gameweek_id"], "score")
    xi = sq.best_xi(squad, ["gameweek_id"], "score")
    out = xi.select(
        F.concat_ws("_", F.col("player_id").cast("string"), F.lit("2024-02-01T06:00:00")).alias("recommendation_key"),
        F.col("player_id").cast("int").alias("player_id"), "gameweek_id", "web_name", "position_id", "team_id", "now_cost",
        F.col("score").alias("expected_points_next_gw"), (F.col("score") * 5.0).alias("expected_points_5_gw"),
        "is_starter", "is_captain", "is_vice_captain", "formation",
    )
    return round_doubles(out)
