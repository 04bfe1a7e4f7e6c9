"""Registered queries: squad selection for every period at once (O1-O8, J8,
J9, T4, T5, A26, P29), on the scored panel (heuristic prediction) with the
next-period actual as the oracle score."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import squad as sq
from panelforge.operators.joint_squad import joint_squad
from panelforge.operators.common import materialize, round_doubles
from panelforge.plans.q_model import ACT, SCORED_SQL, scored
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel

G = "target_gameweek_id"
RULES = sq.SquadRules()


def candidates(spark, sf):
    s = scored(spark, sf)
    return s.select(G, "player_id", "web_name", "position_id", "team_id", "now_cost",
                    F.col("predicted_points").alias("score"), F.col(ACT).alias("actual"))


def picked(spark, sf, score="score", c=None):
    """Budgeted squad + XI + captain per period (materialised: many consumers)."""
    c = candidates(spark, sf) if c is None else c
    squad = sq.budgeted_squad(c, [G], score)
    return materialize(sq.best_xi(squad, [G], score))


def _lam_sql() -> str:
    return "[" + ", ".join(repr(float(x)) for x in sq.LAMBDA_GRID) + "]::DOUBLE[]"


_QUOTA = "CASE position_id WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 5 WHEN 4 THEN 3 ELSE 0 END"


def squad_ctes(score: str, p: str) -> str:
    """DuckDB pipeline for one score column; final CTE ``{p}xi``."""
    forms = ", ".join(f"({a}, {b}, {c}, {d})" for a, b, c, d in sq.formations(RULES))
    cs = ",\n         ".join(
        f"sum(CASE WHEN position_id = {s} AND k <= {k} THEN {score} ELSE 0.0 END) AS c{s}_{k}"
        for s in (1, 2, 3, 4) for k in range(1, 6)
    )

    def pick(s):
        return "CASE " + " ".join(f"WHEN f.n{s} = {k} THEN c{s}_{k}" for k in range(1, 6)) + " ELSE 0.0 END"

    return f""",
{p}adj AS (SELECT c.*, l.lam, c.{score} - l.lam * c.now_cost AS adj FROM cand c, (SELECT unnest({_lam_sql()}) AS lam) l),
{p}tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, lam, team_id ORDER BY adj DESC, player_id) AS rt
                        FROM {p}adj) x WHERE rt <= 3),
{p}q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, lam, position_id ORDER BY adj DESC, player_id) AS rs
                       FROM {p}tc) x WHERE rs <= {_QUOTA}),
{p}per AS (SELECT g, lam, count(*) AS n, sum(now_cost) AS cost, sum({score}) AS total FROM {p}q GROUP BY g, lam),
{p}best AS (SELECT g, lam FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round(total, 9) DESC, lam) AS r
                               FROM {p}per WHERE n = 15 AND cost <= 100.0 + 1e-9) x WHERE r = 1),
{p}sq AS (SELECT q.* EXCLUDE (rt, rs) FROM {p}q q JOIN {p}best b ON b.g = q.g AND b.lam = q.lam),
{p}rk AS (SELECT *, row_number() OVER (PARTITION BY g, position_id ORDER BY {score} DESC, player_id) AS k FROM {p}sq),
{p}cs AS (SELECT g, {cs} FROM {p}rk GROUP BY g),
{p}form AS (SELECT g, n1, n2, n3, n4 FROM (
    SELECT cs.g, f.n1, f.n2, f.n3, f.n4,
           row_number() OVER (PARTITION BY cs.g ORDER BY {pick(1)} + {pick(2)} + {pick(3)} + {pick(4)} DESC,
                                                      f.n1, f.n4 DESC, f.n3 DESC) AS r
    FROM {p}cs cs, (VALUES {forms}) f(n1, n2, n3, n4)) x WHERE r = 1),
{p}st AS (SELECT rk.*, rk.k <= CASE rk.position_id WHEN 1 THEN f.n1 WHEN 2 THEN f.n2 WHEN 3 THEN f.n3 ELSE f.n4 END AS is_starter,
                 CAST(f.n2 AS VARCHAR) || '-' || CAST(f.n3 AS VARCHAR) || '-' || CAST(f.n4 AS VARCHAR) AS formation
          FROM {p}rk rk JOIN {p}form f ON f.g = rk.g),
{p}xi AS (SELECT * EXCLUDE (cr), is_starter AND cr = 1 AS is_captain, is_starter AND cr = 2 AS is_vice_captain
          FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY is_starter DESC, {score} DESC, player_id) AS cr
                FROM {p}st) x)"""


BASE = SCORED_SQL + f""",
cand AS (SELECT target_gameweek_id AS g, player_id, web_name, position_id, team_id, now_cost,
                predicted_points AS score, {ACT} AS actual FROM scored)"""


def sql(*extra: str) -> str:
    return with_panel(BASE + squad_ctes("score", "p_") + "".join(extra))


@register(
    "quota_topk",
    "O2",
    with_panel(BASE)
    + f""",
tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, team_id ORDER BY score DESC, player_id) AS rt FROM cand) x
       WHERE rt <= 3)
SELECT CAST(g AS INTEGER) AS {G}, player_id, position_id, team_id FROM (
  SELECT *, row_number() OVER (PARTITION BY g, position_id ORDER BY score DESC, player_id) AS rs FROM tc) x
WHERE rs <= {_QUOTA}""",
)
def q_quota(spark, sf):
    return sq.quota_topk(candidates(spark, sf), [G], "score").select(G, "player_id", "position_id", "team_id")


@register(
    "budgeted_squad",
    "O3",
    rsql(sql() + f"\nSELECT CAST(g AS INTEGER) AS {G}, player_id, position_id, team_id, now_cost, score, lam FROM p_sq",
         ["now_cost", "score", "lam"]),
)
def q_budgeted(spark, sf):
    s = sq.budgeted_squad(candidates(spark, sf), [G], "score")
    return round_doubles(s.select(G, "player_id", "position_id", "team_id", "now_cost", "score", "lam"))


@register(
    "best_xi",
    "O4 Q6",
    sql() + f"\nSELECT CAST(g AS INTEGER) AS {G}, player_id, is_starter, formation FROM p_xi",
)
def q_best_xi(spark, sf):
    return picked(spark, sf).select(G, "player_id", "is_starter", "formation")


@register(
    "captain_choice",
    "O5",
    sql() + f"""
SELECT CAST(g AS INTEGER) AS {G}, max(CASE WHEN is_captain THEN player_id END) AS captain_id,
       max(CASE WHEN is_vice_captain THEN player_id END) AS vice_captain_id FROM p_xi GROUP BY g""",
)
def q_captain(spark, sf):
    p = picked(spark, sf)
    return p.groupBy(G).agg(
        F.max(F.when(F.col("is_captain"), F.col("player_id"))).alias("captain_id"),
        F.max(F.when(F.col("is_vice_captain"), F.col("player_id"))).alias("vice_captain_id"),
    )


@register(
    "bench_order",
    "O6 J8 T4",
    sql() + f"""
SELECT CAST(g AS INTEGER) AS {G}, player_id,
       CAST(row_number() OVER (PARTITION BY g ORDER BY score DESC, player_id) AS INTEGER) AS bench_order
FROM (SELECT * FROM p_xi x WHERE NOT EXISTS (SELECT 1 FROM p_xi s WHERE s.is_starter AND s.g = x.g AND s.player_id = x.player_id)) b""",
)
def q_bench(spark, sf):
    return sq.bench_order(picked(spark, sf), [G], "score").select(G, "player_id", "bench_order")


@register(
    "squad_feasibility",
    "O1",
    rsql(
        sql()
        + f""",
pt AS (SELECT g, max(n) AS max_per_team FROM (SELECT g, team_id, count(*) AS n FROM p_xi GROUP BY g, team_id) x GROUP BY g),
a AS (SELECT g, count(*) AS squad_size, sum(now_cost) AS squad_cost, count_if(is_starter) AS xi_size,
             count_if(is_captain) AS n_captain, count_if(is_vice_captain) AS n_vice,
             count_if(is_captain AND is_vice_captain) AS both_, count_if((is_captain OR is_vice_captain) AND NOT is_starter) AS bc,
             count_if(position_id = 1) AS q1, count_if(position_id = 2) AS q2, count_if(position_id = 3) AS q3,
             count_if(position_id = 4) AS q4, count_if(position_id = 1 AND is_starter) AS x1,
             count_if(position_id = 2 AND is_starter) AS x2, count_if(position_id = 3 AND is_starter) AS x3,
             count_if(position_id = 4 AND is_starter) AS x4
      FROM p_xi GROUP BY g),
c AS (SELECT a.*, pt.max_per_team, squad_size = 15 AS size_ok, q1 = 2 AND q2 = 5 AND q3 = 5 AND q4 = 3 AS quota_ok,
             pt.max_per_team <= 3 AS team_cap_ok, squad_cost <= 100.0 + 1e-9 AS budget_ok, xi_size = 11 AS xi_size_ok,
             x1 >= 1 AND x2 >= 3 AND x3 >= 2 AND x4 >= 1 AS formation_ok,
             n_captain = 1 AND n_vice = 1 AND both_ = 0 AND bc = 0 AS captain_ok
      FROM a JOIN pt ON pt.g = a.g)
SELECT CAST(g AS INTEGER) AS {G}, CAST(squad_size AS BIGINT) AS squad_size, squad_cost, CAST(xi_size AS BIGINT) AS xi_size,
       CAST(n_captain AS BIGINT) AS n_captain, CAST(n_vice AS BIGINT) AS n_vice, CAST(max_per_team AS BIGINT) AS max_per_team,
       size_ok, quota_ok, team_cap_ok, budget_ok, xi_size_ok, formation_ok, captain_ok,
       size_ok AND quota_ok AND team_cap_ok AND budget_ok AND xi_size_ok AND formation_ok AND captain_ok AS feasible
FROM c""",
        ["squad_cost"],
    ),
)
def q_feasibility(spark, sf):
    return round_doubles(sq.squad_checks(picked(spark, sf), [G]))


@register(
    "transfer_cost",
    "O7 J9",
    rsql(
        sql()
        + f""",
prev AS (SELECT g + 1 AS g, player_id FROM p_xi),
cur AS (SELECT g, player_id FROM p_xi),
j AS (SELECT COALESCE(c.g, p.g) AS g, abs(CASE WHEN c.player_id IS NULL THEN 0 ELSE 1 END
                                        - CASE WHEN p.player_id IS NULL THEN 0 ELSE 1 END) AS d
      FROM cur c FULL OUTER JOIN prev p ON c.g = p.g AND c.player_id = p.player_id)
SELECT CAST(g AS INTEGER) AS {G}, sum(d) / 2.0 AS transfers, sum(d) / 2.0 * 4.0 AS transfer_penalty,
       sum(d) / 2.0 <= 15 AS within_limit
FROM j WHERE g IN (SELECT g FROM cur) AND g - 1 IN (SELECT g FROM cur) GROUP BY g""",
        ["transfers", "transfer_penalty"],
    ),
)
def q_transfers(spark, sf):
    p = picked(spark, sf).select(G, "player_id")
    prev = p.select((F.col(G) + 1).alias(G), "player_id")
    periods = p.select(G).distinct()
    both = periods.join(periods.select((F.col(G) + 1).alias(G)), G, "left_semi")  # periods whose previous period exists
    t = sq.transfer_cost(p, prev, [G]).join(both, G, "left_semi")
    return round_doubles(t.select(F.col(G).cast("int").alias(G), "transfers", "transfer_penalty", "within_limit"))


@register(
    "squad_regret",
    "O8",
    rsql(
        with_panel(BASE + squad_ctes("score", "p_") + squad_ctes("actual", "o_"))
        + f""",
sel AS (SELECT g, sum(CASE WHEN is_starter THEN actual ELSE 0 END) + sum(CASE WHEN is_captain THEN actual ELSE 0 END) AS selected_actual,
               sum(CASE WHEN is_starter THEN score ELSE 0 END) + sum(CASE WHEN is_captain THEN score ELSE 0 END) AS selected_predicted
        FROM p_xi GROUP BY g),
orc AS (SELECT g, sum(CASE WHEN is_starter THEN actual ELSE 0 END) + sum(CASE WHEN is_captain THEN actual ELSE 0 END) AS oracle_actual
        FROM o_xi GROUP BY g)
SELECT CAST(s.g AS INTEGER) AS {G}, s.selected_predicted, s.selected_actual, o.oracle_actual,
       o.oracle_actual - s.selected_actual AS regret
FROM sel s JOIN orc o ON o.g = s.g""",
        ["selected_predicted", "selected_actual", "oracle_actual", "regret"],
    ),
)
def q_regret(spark, sf):
    c = materialize(candidates(spark, sf))
    sel = picked(spark, sf, "score", c)
    orc = picked(spark, sf, "actual", c)

    def tot(df, col):
        return F.sum(F.when(F.col("is_starter"), F.col(col)).otherwise(0.0)) + F.sum(
            F.when(F.col("is_captain"), F.col(col)).otherwise(0.0)
        )

    s = sel.groupBy(G).agg(tot(sel, "score").alias("selected_predicted"), tot(sel, "actual").alias("selected_actual"))
    o = orc.groupBy(G).agg(tot(orc, "actual").alias("oracle_actual"))
    out = s.join(o, G).withColumn("regret", F.col("oracle_actual") - F.col("selected_actual"))
    return round_doubles(out.select(F.col(G).cast("int").alias(G), "selected_predicted", "selected_actual", "oracle_actual", "regret"))


@register(
    "squad_summary",
    "A26 T5 F8",
    rsql(
        sql()
        + f"""
SELECT CAST(g AS INTEGER) AS {G}, position_id,
       array_to_string(list_sort(list(printf('%s (£%.1fm)', web_name, now_cost))), ', ') AS players,
       count(*) AS n_players, sum(now_cost) AS segment_cost
FROM p_xi GROUP BY g, position_id""",
        ["segment_cost"],
    ),
)
def q_summary(spark, sf):
    return round_doubles(sq.squad_summary(picked(spark, sf), [G]))


@register(
    "recommendation_rows",
    "P29",
    rsql(
        sql()
        + f"""
SELECT CAST(player_id AS VARCHAR) || '_' || '2024-01-' || lpad(CAST(g AS VARCHAR), 2, '0') || 'T00:00:00' AS recommendation_key,
       CAST('2024-01-' || lpad(CAST(g AS VARCHAR), 2, '0') || ' 00:00:00' AS TIMESTAMP) AS recommended_at,
       CAST(player_id AS INTEGER) AS player_id, CAST(g AS INTEGER) AS gameweek_id, score AS expected_points_next_gw,
       score * 5.0 AS expected_points_5_gw, true AS is_in_squad, is_starter, is_captain, is_vice_captain,
       substr('trusted: train<' || CAST(g AS VARCHAR) || ' ' || repeat('x', 600), 1, 500) AS backfill_validation_details
FROM p_xi""",
        ["expected_points_next_gw", "expected_points_5_gw"],
    ),
)
def q_recommendation(spark, sf):
    p = picked(spark, sf)
    at = F.concat(F.lit("2024-01-"), F.lpad(F.col(G).cast("string"), 2, "0"), F.lit("T00:00:00"))
    details = F.concat(F.lit("trusted: train<"), F.col(G).cast("string"), F.lit(" "), F.repeat(F.lit("x"), 600))
    return round_doubles(sq.recommendation_rows(p, at, G, "score", details))


@register("joint_squad", "O3 O4 O5 O7 O8")
def q_joint_squad(spark, sf):
    """The exact squad of every period: starters, captain and bench chosen together (the budgeted
    squad maximises all fifteen first), with its certificate."""
    best = joint_squad(candidates(spark, sf), [G], "score")
    return round_doubles(best.select(F.col(G).cast("int").alias(G), "player_id", "is_starter", "is_captain", "is_vice_captain", "score", "objective", "gap"))
