"""Registered queries: panel features, z-scores, splits, policy and as-of."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import signed_expm1, signed_log1p
from panelforge.operators import asof as ao
from panelforge.operators import features as fe
from panelforge.operators import metrics as me
from panelforge.operators import split as sp
from panelforge.operators.common import materialize, maybe_broadcast, round_doubles
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.sources import tables as tb

# Demo policy used by the policy queries (configuration, not data).
DEMO_POLICY = sp.PeriodPolicy.from_dict(
    {
        "policy_version": "demo-1",
        "excluded_gameweeks": [2, 9],
        "backfilled_but_untrusted_gameweeks": [5, 12, 27],
        "trusted_backfilled_gameweeks": [27, 28],
        "eligible_training_gameweeks": list(range(1, 25)),
        "eligible_holdout_backtest_gameweeks": [18, 20, 22, 24, 26, 28, 30],
    }
)


def _ints(xs) -> str:
    return ", ".join(str(int(x)) for x in xs) or "NULL"


def _values(xs) -> str:
    return "(VALUES " + ", ".join(f"({int(x)})" for x in xs) + ")" if xs else "(SELECT NULL::INTEGER WHERE false)"


def collapsed(spark, sf, null_cost=False):
    return fe.collapse_periods(tb.fixture_rows(spark, sf, null_cost=null_cost))


def rolled(spark, sf):
    return fe.rolling_features(collapsed(spark, sf))


def targeted(spark, sf, null_cost=False):
    """The targeted panel, written once: splits and statistics read it several
    times (distinct periods, the split join, train statistics)."""
    return materialize(fe.base_panel(tb.fixture_rows(spark, sf, null_cost=null_cost)))


def split5(spark, sf):
    return sp.temporal_split(targeted(spark, sf), holdout=5)


SPLIT5_SQL = """
hw AS (SELECT w FROM (SELECT DISTINCT target_gameweek_id AS w FROM targeted) d ORDER BY w DESC LIMIT 5),
split AS (SELECT t.*, CASE WHEN t.target_gameweek_id IN (SELECT w FROM hw) THEN 'holdout' ELSE 'train' END AS role
          FROM targeted t)"""


# ------------------------------------------------------------------ filters / joins

@register(
    "training_filter",
    "P9",
    rsql(with_panel() + "\nSELECT * FROM collapsed WHERE gameweek_id > 3 AND minutes_played > 0",
         ["total_points", "minutes_played", "ict_index", "now_cost"]),
)
def q_training_filter(spark, sf):
    return round_doubles(fe.training_filter(collapsed(spark, sf)))


@register(
    "feature_enrich_join",
    "J1 P11",
    rsql(
        with_panel(null_cost=True)
        + """,
pdim AS (SELECT c_custkey AS player_id, 4.0 + CAST(c_custkey % 90 AS DOUBLE) / 10.0 AS current_value
         FROM customer)
SELECT f.* EXCLUDE (now_cost), COALESCE(f.now_cost, p.current_value) AS now_cost
FROM fr f LEFT JOIN pdim p ON f.player_id = p.player_id""",
        ["total_points", "minutes_played", "ict_index", "now_cost"],
    ),
)
def q_feature_enrich_join(spark, sf):
    f = tb.fixture_rows(spark, sf, null_cost=True)
    dim = tb.player_dim(spark, sf).select("player_id", "current_value")
    j = f.join(maybe_broadcast(dim, 1_000_000), "player_id", "left")  # 2 narrow columns: <= ~16 MB
    out = j.select(*[c for c in f.columns if c != "now_cost"], F.coalesce(F.col("now_cost"), F.col("current_value")).alias("now_cost"))
    return round_doubles(out)


@register(
    "segment_one_hot",
    "P12",
    with_panel()
    + """
SELECT player_id, gameweek_id, position_id,
       CAST(COALESCE(position_id = 1, false) AS INTEGER) AS is_gk, CAST(COALESCE(position_id = 2, false) AS INTEGER) AS is_def,
       CAST(COALESCE(position_id = 3, false) AS INTEGER) AS is_mid, CAST(COALESCE(position_id = 4, false) AS INTEGER) AS is_fwd
FROM collapsed""",
)
def q_segment_one_hot(spark, sf):
    return fe.segment_one_hot(collapsed(spark, sf)).select(
        "player_id", "gameweek_id", "position_id", "is_gk", "is_def", "is_mid", "is_fwd"
    )


_BAND_SQL = """CASE WHEN {m} > -1 AND {m} <= 30 THEN '0_30' WHEN {m} > 30 AND {m} <= 60 THEN '31_60'
                    WHEN {m} > 60 AND {m} <= 1000000 THEN '61_90' END"""


@register(
    "minutes_band",
    "P13",
    rsql(
        with_panel()
        + f""",
mb AS (SELECT player_id, gameweek_id,
              CASE WHEN (player_id + gameweek_id) % 13 = 0 THEN NULL ELSE minutes_played END AS minutes_played
       FROM collapsed),
bands AS (SELECT *, {_BAND_SQL.format(m='minutes_played')} AS minutes_band,
                 {_BAND_SQL.format(m='COALESCE(minutes_played, 0.0)')} AS minutes_band_inference
          FROM mb)
SELECT *, CAST(COALESCE(minutes_band = '0_30', false) AS INTEGER) AS minutes_band_0_30,
          CAST(COALESCE(minutes_band = '31_60', false) AS INTEGER) AS minutes_band_31_60,
          CAST(COALESCE(minutes_band = '61_90', false) AS INTEGER) AS minutes_band_61_90
FROM bands""",
        ["minutes_played"],
    ),
)
def q_minutes_band(spark, sf):
    c = collapsed(spark, sf).select(
        "player_id",
        "gameweek_id",
        F.when((F.col("player_id") + F.col("gameweek_id")) % 13 != 0, F.col("minutes_played")).alias("minutes_played"),
    )
    out = fe.minutes_band(c).withColumn(
        "minutes_band_inference", fe.minutes_band_expr(F.coalesce(F.col("minutes_played"), F.lit(0.0)))
    )
    return round_doubles(out)


@register(
    "upside_features",
    "P14",
    rsql(
        with_panel()
        + """
SELECT player_id, gameweek_id,
       CAST(COALESCE(goals_scored, 0) AS DOUBLE) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS goals_scored_per90,
       CAST(COALESCE(assists, 0) AS DOUBLE) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS assists_per90,
       COALESCE(ict_index, 0.0) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS ict_index_per90,
       COALESCE(three_week_players_roll_avg_points, 0.0) - COALESCE(five_week_players_roll_avg_points, 0.0)
         AS player_points_roll_delta_3v5
FROM targeted""",
        ["goals_scored_per90", "assists_per90", "ict_index_per90", "player_points_roll_delta_3v5"],
    ),
)
def q_upside(spark, sf):
    u = fe.upside_features(targeted(spark, sf))
    return round_doubles(
        u.select("player_id", "gameweek_id", "goals_scored_per90", "assists_per90", "ict_index_per90", "player_points_roll_delta_3v5")
    )


@register(
    "signed_log_roundtrip",
    "P15 F1",
    rsql(
        with_panel()
        + """,
y AS (SELECT player_id, gameweek_id, target_next_gw_points - 3.0 AS y FROM targeted),
t AS (SELECT *, sign(y) * ln(1 + abs(y)) AS y_log FROM y)
SELECT *, sign(y_log) * (exp(abs(y_log)) - 1) AS y_back FROM t""",
        ["y", "y_log", "y_back"],
    ),
)
def q_signed_log(spark, sf):
    t = targeted(spark, sf).select("player_id", "gameweek_id", (F.col("target_next_gw_points") - 3.0).alias("y"))
    t = t.withColumn("y_log", signed_log1p("y")).withColumn("y_back", signed_expm1("y_log"))
    return round_doubles(t)


PANEL_FEATURE_DOUBLES = [
    "total_points", "minutes_played", "ict_index", "now_cost", "three_week_players_roll_avg_points",
    "five_week_players_roll_avg_points", "team_roll_avg_goals_scored", "target_next_gw_points",
    "target_next_gw_minutes", "goals_scored_per90", "assists_per90", "ict_index_per90",
    "player_points_roll_delta_3v5",
]


@register(
    "panel_features",
    "P16 P12 P13 P14 W1 A1 W9 F5",
    rsql(
        with_panel(null_cost=True)
        + f""",
eng AS (
  SELECT *,
    CAST(COALESCE(position_id = 1, false) AS INTEGER) AS is_gk, CAST(COALESCE(position_id = 2, false) AS INTEGER) AS is_def,
    CAST(COALESCE(position_id = 3, false) AS INTEGER) AS is_mid, CAST(COALESCE(position_id = 4, false) AS INTEGER) AS is_fwd,
    {_BAND_SQL.format(m='minutes_played')} AS minutes_band,
    CAST(COALESCE(goals_scored, 0) AS DOUBLE) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS goals_scored_per90,
    CAST(COALESCE(assists, 0) AS DOUBLE) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS assists_per90,
    COALESCE(ict_index, 0.0) / (greatest(COALESCE(minutes_played, 0.0), 1.0) / 90.0) AS ict_index_per90,
    COALESCE(three_week_players_roll_avg_points, 0.0) - COALESCE(five_week_players_roll_avg_points, 0.0)
      AS player_points_roll_delta_3v5
  FROM targeted)
SELECT * REPLACE (COALESCE(now_cost, 0.0) AS now_cost, COALESCE(fixture_id, 0) AS fixture_id,
                  COALESCE(team_roll_avg_goals_scored, 0.0) AS team_roll_avg_goals_scored),
       CAST(COALESCE(minutes_band = '0_30', false) AS INTEGER) AS minutes_band_0_30,
       CAST(COALESCE(minutes_band = '31_60', false) AS INTEGER) AS minutes_band_31_60,
       CAST(COALESCE(minutes_band = '61_90', false) AS INTEGER) AS minutes_band_61_90
FROM eng""",
        PANEL_FEATURE_DOUBLES,
    ),
)
def q_panel_features(spark, sf):
    return round_doubles(fe.engineer_panel(tb.fixture_rows(spark, sf, null_cost=True)))


_CONFORM = fe.select_features()


@register(
    "conform_features",
    "P17 P18 U4",
    rsql(
        with_panel()
        + "\nSELECT player_id, gameweek_id, "
        + ", ".join(
            c if c in {
                "total_points", "minutes_played", "goals_scored", "assists", "clean_sheets", "bonus", "ict_index",
                "three_week_players_roll_avg_points", "five_week_players_roll_avg_points", "total_games_played",
                "team_roll_avg_goals_scored", "now_cost",
            } else (
                f"CAST(COALESCE(position_id = {dict(fe.SEGMENT_FLAGS)[c]}, false) AS INTEGER) AS {c}"
                if c in dict(fe.SEGMENT_FLAGS) else f"CAST(0.0 AS DOUBLE) AS {c}"
            )
            for c in _CONFORM
        )
        + " FROM targeted",
        ["total_points", "minutes_played", "ict_index", "three_week_players_roll_avg_points",
         "five_week_players_roll_avg_points", "team_roll_avg_goals_scored", "now_cost"],
    ),
)
def q_conform(spark, sf):
    p = fe.segment_one_hot(targeted(spark, sf))
    return round_doubles(fe.conform_features(p, _CONFORM).select("player_id", "gameweek_id", *_CONFORM))


# ------------------------------------------------------------------ z-scores & stats

_ZSTATS = """
st AS (SELECT avg(total_points) AS m1, CASE WHEN stddev_samp(total_points) > 0 THEN stddev_samp(total_points) ELSE 1.0 END AS s1,
              avg(minutes_played) AS m2, CASE WHEN stddev_samp(minutes_played) > 0 THEN stddev_samp(minutes_played) ELSE 1.0 END AS s2,
              avg(ict_index) AS m3, CASE WHEN stddev_samp(ict_index) > 0 THEN stddev_samp(ict_index) ELSE 1.0 END AS s3
       FROM {src})"""
_ZCOLS = """COALESCE((total_points - m1) / s1, 0.0) AS total_points_z_score,
       COALESCE((minutes_played - m2) / s2, 0.0) AS minutes_played_z_score,
       COALESCE((ict_index - m3) / s3, 0.0) AS ict_index_z_score"""
Z_DOUBLES = ["total_points_z_score", "minutes_played_z_score", "ict_index_z_score"]


@register(
    "global_stats",
    "A2",
    rsql(
        with_panel(SPLIT5_SQL)
        + """
SELECT avg(total_points) AS total_points_mean,
       CASE WHEN stddev_samp(total_points) > 0 THEN stddev_samp(total_points) ELSE 1.0 END AS total_points_std,
       avg(minutes_played) AS minutes_played_mean,
       CASE WHEN stddev_samp(minutes_played) > 0 THEN stddev_samp(minutes_played) ELSE 1.0 END AS minutes_played_std,
       avg(ict_index) AS ict_index_mean,
       CASE WHEN stddev_samp(ict_index) > 0 THEN stddev_samp(ict_index) ELSE 1.0 END AS ict_index_std
FROM split WHERE role = 'train'""",
        ["total_points_mean", "total_points_std", "minutes_played_mean", "minutes_played_std", "ict_index_mean", "ict_index_std"],
    ),
)
def q_global_stats(spark, sf):
    return round_doubles(fe.global_stats(split5(spark, sf).filter(F.col("role") == "train")))


@register(
    "zscore_apply",
    "P19",
    rsql(
        with_panel(SPLIT5_SQL, _ZSTATS.format(src="split WHERE role = 'train'"))
        + f"\nSELECT player_id, gameweek_id, target_gameweek_id, {_ZCOLS} FROM split, st WHERE role = 'holdout'",
        Z_DOUBLES,
    ),
)
def q_zscore_apply(spark, sf):
    s = split5(spark, sf)
    stats = fe.global_stats(s.filter(F.col("role") == "train"))
    z = fe.zscore_apply(s.filter(F.col("role") == "holdout"), stats)
    return round_doubles(z.select("player_id", "gameweek_id", "target_gameweek_id", *Z_DOUBLES))


@register(
    "zscore_self",
    "P20",
    rsql(
        with_panel(_ZSTATS.format(src="collapsed"))
        + f"\nSELECT player_id, gameweek_id, {_ZCOLS} FROM collapsed, st",
        Z_DOUBLES,
    ),
)
def q_zscore_self(spark, sf):
    z = fe.zscore_self(collapsed(spark, sf))
    return round_doubles(z.select("player_id", "gameweek_id", *Z_DOUBLES))


@register(
    "heuristic_forecast",
    "P21 P10 W2",
    rsql(
        with_panel()
        + """,
inf AS (SELECT * FROM rolled WHERE gameweek_id > 3),
st AS (SELECT avg(total_points) AS m1,
              CASE WHEN stddev_samp(total_points) > 0 THEN stddev_samp(total_points) ELSE 1.0 END AS s1 FROM inf),
scored AS (SELECT player_id, gameweek_id,
                  greatest(0.0, COALESCE(three_week_players_roll_avg_points, 2.0) * 0.7
                                + COALESCE((total_points - m1) / s1, 0.0) * 1.5 + 2.0) AS expected_points_next_gw,
                  row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id DESC) AS rn
           FROM inf, st)
SELECT player_id, CAST(gameweek_id AS INTEGER) AS source_gameweek_id,
       CAST((SELECT max(gameweek_id) FROM inf) + 1 AS INTEGER) AS target_gameweek_id, expected_points_next_gw
FROM scored WHERE rn = 1""",
        ["expected_points_next_gw"],
    ),
)
def q_heuristic(spark, sf):
    inf = rolled(spark, sf).filter(F.col("gameweek_id") > 3)
    z = fe.zscore_apply(inf, fe.global_stats(inf, ["total_points"]), ["total_points"])
    scored = z.withColumn("expected_points_next_gw", fe.heuristic_forecast(z))
    latest = ao.latest_per_entity(scored.select("player_id", "gameweek_id", "expected_points_next_gw"))
    tgt = inf.agg((F.max("gameweek_id") + 1).cast("int").alias("target_gameweek_id"))
    from panelforge.operators.common import attach_row

    out = attach_row(latest, tgt).select(
        "player_id", F.col("gameweek_id").cast("int").alias("source_gameweek_id"), "target_gameweek_id", "expected_points_next_gw"
    )
    return round_doubles(out)


@register(
    "target_sanity",
    "P27",
    with_panel()
    + """,
raw AS (SELECT gameweek_id, lead(total_points) OVER w AS tp, lead(gameweek_id) OVER w AS tg
        FROM rolled_team WINDOW w AS (PARTITION BY player_id ORDER BY gameweek_id)),
cnt AS (SELECT count(*) AS n_rows,
               CAST(count_if(tp IS NULL) AS BIGINT) AS n_null_target,
               CAST(count_if(tg IS NULL) AS BIGINT) AS n_null_target_gameweek,
               CAST(count_if(tg <= 0) AS BIGINT) AS n_nonpositive_target_gameweek,
               CAST(count_if(tg <= gameweek_id) AS BIGINT) AS n_target_not_after,
               CAST(count_if(tp IS NOT NULL AND tg IS NOT NULL) AS BIGINT) AS n_kept
        FROM raw)
SELECT *, (n_null_target + n_null_target_gameweek + n_nonpositive_target_gameweek + n_target_not_after) = 0 AS valid
FROM cnt""",
)
def q_target_sanity(spark, sf):
    from panelforge.operators.quality import target_sanity

    return target_sanity(fe.next_period_target(fe.rolling_features(collapsed(spark, sf)), keep_terminal=True))


# ------------------------------------------------------------------ splits & policy

@register(
    "temporal_split",
    "W10",
    with_panel(SPLIT5_SQL) + "\nSELECT player_id, gameweek_id, target_gameweek_id, role FROM split",
)
def q_temporal_split(spark, sf):
    return split5(spark, sf).select("player_id", "gameweek_id", "target_gameweek_id", "role")


def _policy_split_sql(pol: sp.PeriodPolicy, n: int = 5) -> str:
    excl = f"""(SELECT * FROM {_values(pol.excluded_gameweeks)} e(w)
   UNION (SELECT * FROM {_values(pol.backfilled_but_untrusted_gameweeks)} u(w)
          EXCEPT SELECT * FROM {_values(pol.trusted_backfilled_gameweeks)} t(w)))"""
    elig_h = (
        f"AND w IN (SELECT * FROM {_values(pol.eligible_holdout_backtest_gameweeks)} h(w))"
        if pol.eligible_holdout_backtest_gameweeks else ""
    )
    elig_t = (
        f"t.target_gameweek_id IN (SELECT * FROM {_values(pol.eligible_training_gameweeks)} et(w))"
        if pol.eligible_training_gameweeks else "true"
    )
    return with_panel(
        f"""
filt AS (SELECT * FROM targeted WHERE target_gameweek_id NOT IN (SELECT w FROM {excl} x WHERE w IS NOT NULL))""",
        f"""
hw AS (SELECT w FROM (SELECT DISTINCT target_gameweek_id AS w FROM filt) d WHERE true {elig_h} ORDER BY w DESC LIMIT {n})""",
        f"""
psplit AS (
  SELECT t.*, CASE WHEN t.target_gameweek_id IN (SELECT w FROM hw) THEN 'holdout'
                   WHEN {elig_t} THEN 'train' END AS role
  FROM filt t)""",
    ) + "\nSELECT player_id, gameweek_id, target_gameweek_id, role FROM psplit WHERE role IS NOT NULL"


@register("policy_split", "W11 J10 U2", _policy_split_sql(DEMO_POLICY))
def q_policy_split(spark, sf):
    return sp.policy_split(targeted(spark, sf), DEMO_POLICY).select("player_id", "gameweek_id", "target_gameweek_id", "role")


@register(
    "expanding_folds",
    "W13",
    with_panel()
    + """,
wk AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS idx, count(*) OVER () AS p
       FROM (SELECT DISTINCT target_gameweek_id AS w FROM targeted) d),
folds AS (SELECT CAST(f.fold AS INTEGER) AS fold, w,
                 CASE WHEN idx < p - (5 - f.fold) * (p // 6) THEN 'train'
                      WHEN idx < p - (5 - f.fold) * (p // 6) + p // 6 THEN 'test' END AS role
          FROM wk, range(5) f(fold) WHERE p // 6 > 0)
SELECT fold, role, count(*) AS n_rows, CAST(min(t.target_gameweek_id) AS INTEGER) AS min_week,
       CAST(max(t.target_gameweek_id) AS INTEGER) AS max_week
FROM folds JOIN targeted t ON t.target_gameweek_id = folds.w
WHERE role IS NOT NULL GROUP BY fold, role""",
)
def q_expanding_folds(spark, sf):
    t = targeted(spark, sf)
    folds = sp.expanding_folds(t)
    j = t.join(F.broadcast(folds), t.target_gameweek_id == folds.week)
    return j.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("target_gameweek_id").cast("int").alias("min_week"),
        F.max("target_gameweek_id").cast("int").alias("max_week"),
    )


@register(
    "period_quality",
    "P26",
    with_panel()
    + f"""
SELECT CAST(gameweek_id AS INTEGER) AS gameweek_id, count(*) AS n_rows,
       CASE WHEN gameweek_id IN ({_ints(DEMO_POLICY.excluded_gameweeks)}) THEN 'excluded'
            WHEN gameweek_id IN (SELECT * FROM {_values(DEMO_POLICY.excluded_gameweeks)} e(w)
                                 UNION (SELECT * FROM {_values(DEMO_POLICY.backfilled_but_untrusted_gameweeks)} u(w)
                                        EXCEPT SELECT * FROM {_values(DEMO_POLICY.trusted_backfilled_gameweeks)} t(w)))
            THEN 'backfilled_untrusted' ELSE 'trusted' END AS status
FROM collapsed GROUP BY gameweek_id""",
)
def q_period_quality(spark, sf):
    counts = collapsed(spark, sf).groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return sp.classify_periods(counts, DEMO_POLICY).select(
        F.col("gameweek_id").cast("int"), "n_rows", "status"
    )


@register(
    "effective_exclusions",
    "U2",
    with_panel()
    + f"""
SELECT CAST(x.w AS INTEGER) AS week, COALESCE(c.n, 0) AS n_rows
FROM (SELECT * FROM {_values(DEMO_POLICY.excluded_gameweeks)} e(w)
      UNION (SELECT * FROM {_values(DEMO_POLICY.backfilled_but_untrusted_gameweeks)} u(w)
             EXCEPT SELECT * FROM {_values(DEMO_POLICY.trusted_backfilled_gameweeks)} t(w))) x
LEFT JOIN (SELECT gameweek_id, count(*) AS n FROM collapsed GROUP BY gameweek_id) c ON c.gameweek_id = x.w""",
)
def q_effective_exclusions(spark, sf):
    counts = collapsed(spark, sf).groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("n"))
    ex = sp.effective_exclusions_frame(spark, DEMO_POLICY)
    j = ex.join(counts, ex.week == counts.gameweek_id, "left")
    return j.select(F.col("week").cast("int"), F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n_rows"))


def _policy_values_sql(pol: sp.PeriodPolicy) -> str:
    rows = [f"({int(w)}, '{n}')" for n in sp.LIST_NAMES for w in getattr(pol, n)]
    return "(VALUES " + ", ".join(rows) + ") p(week, list_name)"


@register(
    "policy_table",
    "S7 U5",
    with_panel()
    + f"""
SELECT CAST(p.week AS INTEGER) AS week, p.list_name, COALESCE(c.n, 0) AS n_rows
FROM (SELECT DISTINCT week, list_name FROM {_policy_values_sql(DEMO_POLICY)}) p
LEFT JOIN (SELECT gameweek_id, count(*) AS n FROM collapsed GROUP BY gameweek_id) c ON c.gameweek_id = p.week""",
)
def q_policy_table(spark, sf):
    counts = collapsed(spark, sf).groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("n"))
    pf = sp.policy_frame(spark, DEMO_POLICY).distinct()
    j = F.broadcast(pf).join(counts, pf.week == counts.gameweek_id, "left")
    return j.select("week", "list_name", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n_rows"))


# ------------------------------------------------------------------ latest / dedup / as-of

@register(
    "latest_per_entity",
    "W2",
    rsql(
        with_panel()
        + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id DESC) AS rn
                            FROM rolled_team) x
WHERE rn = 1""",
        ["total_points", "minutes_played", "ict_index", "now_cost", "three_week_players_roll_avg_points",
         "five_week_players_roll_avg_points", "team_roll_avg_goals_scored"],
    ),
)
def q_latest(spark, sf):
    return round_doubles(ao.latest_per_entity(rolled(spark, sf)))


_LI_REST = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()


@register(
    "dedup_latest",
    "W3",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, """ + ", ".join(f"{c} DESC" for c in _LI_REST) + """) AS rn
  FROM lineitem) x
WHERE rn = 1""",
)
def q_dedup(spark, sf):
    li = tb.dup_keys(spark, sf)
    return ao.dedup_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(*li.columns)


@register(
    "asof_latest",
    "J12",
    rsql(
        with_panel()
        + """,
tg AS (SELECT CAST(t AS INTEGER) AS t FROM range((SELECT min(gameweek_id) + 1 FROM rolled),
                                             (SELECT max(gameweek_id) + 2 FROM rolled)) r(t)),
cand AS (SELECT r.player_id, tg.t AS target_gameweek_id, r.gameweek_id AS source_gameweek_id, r.total_points,
                r.five_week_players_roll_avg_points,
                row_number() OVER (PARTITION BY r.player_id, tg.t ORDER BY r.gameweek_id DESC) AS rn
         FROM rolled r JOIN tg ON r.gameweek_id <= tg.t - 1)
SELECT * EXCLUDE (rn) FROM cand WHERE rn = 1""",
        ["total_points", "five_week_players_roll_avg_points"],
    ),
)
def q_asof(spark, sf):
    a = ao.asof_latest(rolled(spark, sf))
    return round_doubles(
        a.select("player_id", "target_gameweek_id", F.col("source_gameweek_id").cast("int"), "total_points",
                 "five_week_players_roll_avg_points")
    )


# ------------------------------------------------------------------ stats

@register(
    "target_stats",
    "A3",
    rsql(
        with_panel(SPLIT5_SQL)
        + """
SELECT count(*) AS n, avg(target_next_gw_points) AS target_mean, stddev_samp(target_next_gw_points) AS target_std,
       min(target_next_gw_points) AS target_min, max(target_next_gw_points) AS target_max,
       avg(target_next_gw_points) AS league_mean, CAST(min(gameweek_id) AS INTEGER) AS train_min_gameweek,
       CAST(max(gameweek_id) AS INTEGER) AS train_max_gameweek,
       CAST(max(target_gameweek_id) AS INTEGER) AS train_max_target_gameweek
FROM split WHERE role = 'train'""",
        ["target_mean", "target_std", "target_min", "target_max", "league_mean"],
    ),
)
def q_target_stats(spark, sf):
    return round_doubles(me.target_stats(split5(spark, sf).filter(F.col("role") == "train")))


@register(
    "p95_caps",
    "A4",
    rsql(
        with_panel(SPLIT5_SQL)
        + """
SELECT 'position' AS cap_type, CAST(position_id AS BIGINT) AS cap_key,
       quantile_cont(target_next_gw_points, 0.95) AS cap, count(*) AS n
FROM split WHERE role = 'train' GROUP BY position_id
UNION ALL
SELECT 'player', player_id, quantile_cont(target_next_gw_points, 0.95), count(*)
FROM split WHERE role = 'train' GROUP BY player_id HAVING count(*) >= 10""",
        ["cap"],
    ),
)
def q_p95_caps(spark, sf):
    train = split5(spark, sf).filter(F.col("role") == "train")
    pos = me.percentile_caps(train, "position_id", "target_next_gw_points").select(
        F.lit("position").alias("cap_type"), F.col("position_id").cast("bigint").alias("cap_key"), "cap", "n"
    )
    ply = me.percentile_caps(train, "player_id", "target_next_gw_points", min_count=10).select(
        F.lit("player").alias("cap_type"), F.col("player_id").cast("bigint").alias("cap_key"), "cap", "n"
    )
    return round_doubles(pos.unionByName(ply))


@register(
    "panel_profile",
    "A17",
    with_panel()
    + """
SELECT count(*) AS n_rows, count(DISTINCT player_id) AS n_entities, count(DISTINCT gameweek_id) AS n_periods,
       CAST(min(gameweek_id) AS INTEGER) AS min_period, CAST(max(gameweek_id) AS INTEGER) AS max_period
FROM collapsed""",
)
def q_panel_profile(spark, sf):
    return me.panel_profile(collapsed(spark, sf))
