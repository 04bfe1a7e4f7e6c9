"""Registered queries: panel stages and the weekly back-test (slice 0)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import backtest as bt
from panelforge.operators import features as fe
from panelforge.operators.common import materialize, round_doubles
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import WEEKLY_DOUBLES, backtest_ctes, with_panel
from panelforge.sources import tables as tb

PANEL_DOUBLES = [
    "total_points", "minutes_played", "ict_index", "now_cost",
    "three_week_players_roll_avg_points", "five_week_players_roll_avg_points",
    "team_roll_avg_goals_scored",
]


def panel(spark, sf):
    """collapse -> rolling -> next-period target over the events projection,
    written once (several branches of each query read it)."""
    return materialize(fe.base_panel(tb.fixture_rows(spark, sf)))


# ------------------------------------------------------------------ slice 0

@register(
    "weekly_backtest",
    "A9 W4 W5 W6 P28",
    rsql(with_panel(*backtest_ctes("five_week_players_roll_avg_points")) + "\nSELECT * FROM wk", WEEKLY_DOUBLES),
)
def q_weekly_backtest(spark, sf):
    return round_doubles(bt.weekly_backtest(panel(spark, sf), pred="five_week_players_roll_avg_points", materialize_input=False))


@register(
    "collapse_periods",
    "A1",
    rsql(with_panel() + "\nSELECT * FROM collapsed", ["total_points", "minutes_played", "ict_index", "now_cost"]),
)
def q_collapse(spark, sf):
    return round_doubles(fe.collapse_periods(tb.fixture_rows(spark, sf)))


@register(
    "rolling_features",
    "W9",
    rsql(with_panel() + "\nSELECT * FROM rolled_team", PANEL_DOUBLES[:-1] + ["team_roll_avg_goals_scored"]),
)
def q_rolling(spark, sf):
    return round_doubles(fe.rolling_features(fe.collapse_periods(tb.fixture_rows(spark, sf))))


@register(
    "next_period_target",
    "W1",
    rsql(
        with_panel() + "\nSELECT * FROM targeted",
        PANEL_DOUBLES + ["target_next_gw_points", "target_next_gw_minutes"],
    ),
)
def q_next_target(spark, sf):
    return round_doubles(panel(spark, sf))


@register(
    "segment_totals",
    "A10",
    rsql(
        with_panel(*backtest_ctes("five_week_players_roll_avg_points"))
        + """
SELECT CAST(target_gameweek_id AS INTEGER) AS gameweek_id, CAST(position_id AS INTEGER) AS position_id,
       count(*) AS count, sum(predicted_points) AS predicted_points, sum(actual_points) AS actual_points,
       sum(actual_points) - sum(predicted_points) AS bias, avg(abs_error) AS mae, avg(error_bias) AS mean_bias
FROM bt GROUP BY GROUPING SETS ((position_id, target_gameweek_id), (position_id))""",
        ["predicted_points", "actual_points", "bias", "mae", "mean_bias"],
    ),
)
def q_segment_totals(spark, sf):
    return round_doubles(bt.segment_totals(panel(spark, sf), pred="five_week_players_roll_avg_points"))


@register(
    "bias_flips",
    "W7",
    rsql(
        with_panel(*backtest_ctes("five_week_players_roll_avg_points"))
        + """
SELECT CAST(prev_gameweek_id AS INTEGER) AS prev_gameweek_id, CAST(gameweek_id AS INTEGER) AS gameweek_id,
       prev_bias, bias
FROM (SELECT lag(gameweek_id) OVER (ORDER BY gameweek_id) AS prev_gameweek_id, gameweek_id,
             lag(bias) OVER (ORDER BY gameweek_id) AS prev_bias, bias FROM wk) x
WHERE prev_bias IS NOT NULL AND sign(prev_bias) <> 0 AND sign(bias) <> 0 AND sign(prev_bias) <> sign(bias)
  AND abs(prev_bias) >= 1.0 AND abs(bias) >= 1.0""",
        ["prev_bias", "bias"],
    ),
)
def q_bias_flips(spark, sf):
    # Threshold 1.0 on this data (the rules' 10.0 finds no flips at this scale).
    wk = bt.weekly_backtest(panel(spark, sf), pred="five_week_players_roll_avg_points", materialize_input=False)
    return round_doubles(bt.bias_flips(wk, threshold=1.0))


@register(
    "largest_misses",
    "W8",
    rsql(
        with_panel(*backtest_ctes("five_week_players_roll_avg_points"))
        + """
SELECT CAST(target_gameweek_id AS INTEGER) AS gameweek_id, CAST(rn AS INTEGER) AS miss_rank, player_id, web_name,
       actual_points, predicted_points, abs_error
FROM (SELECT *, row_number() OVER (PARTITION BY target_gameweek_id ORDER BY abs_error DESC, player_id) AS rn
      FROM bt WHERE abs_error IS NOT NULL) x
WHERE rn <= 5""",
        ["actual_points", "predicted_points", "abs_error"],
    ),
)
def q_largest_misses(spark, sf):
    return round_doubles(bt.largest_misses(panel(spark, sf), pred="five_week_players_roll_avg_points"))


@register(
    "largest_misses_overall",
    "W8",
    rsql(
        with_panel(*backtest_ctes("five_week_players_roll_avg_points"))
        + """
SELECT CAST(target_gameweek_id AS INTEGER) AS gameweek_id, CAST(rn AS INTEGER) AS miss_rank, player_id, web_name,
       actual_points, predicted_points, abs_error
FROM (SELECT *, row_number() OVER (ORDER BY abs_error DESC, player_id, target_gameweek_id) AS rn
      FROM bt WHERE abs_error IS NOT NULL) x
WHERE rn <= 5""",
        ["actual_points", "predicted_points", "abs_error"],
    ),
)
def q_largest_misses_overall(spark, sf):
    return round_doubles(bt.largest_misses(panel(spark, sf), pred="five_week_players_roll_avg_points", overall=True))


@register(
    "backtest_summary",
    "A11",
    rsql(
        with_panel(*backtest_ctes("five_week_players_roll_avg_points"))
        + """,
flips AS (
  SELECT count(*) AS bias_flip_weeks FROM (
    SELECT lag(bias) OVER (ORDER BY gameweek_id) AS pb, bias FROM wk) x
  WHERE pb IS NOT NULL AND sign(pb) <> 0 AND sign(bias) <> 0 AND sign(pb) <> sign(bias)
    AND abs(pb) >= 10.0 AND abs(bias) >= 10.0
),
seg AS (SELECT COALESCE(max(abs(b)), 0.0) AS max_position_bias_abs
        FROM (SELECT avg(error_bias) AS b FROM bt GROUP BY position_id) s),
rows_ AS (SELECT avg(abs_error) AS mae, sqrt(avg(error_bias * error_bias)) AS rmse, avg(error_bias) AS bias FROM bt)
SELECT count(*) AS weekly_count,
       COALESCE(avg(top_k_hit_rate), 0.0) AS top_k_hit_rate_mean,
       COALESCE(avg(rank_correlation), 0.0) AS rank_correlation_mean,
       COALESCE(avg(selected_xi_regret), 0.0) AS selected_xi_regret_mean,
       COALESCE(avg(selected_xi_actual_total), 0.0) AS selected_xi_actual_total_mean,
       COALESCE(avg(oracle_xi_actual_total), 0.0) AS oracle_xi_actual_total_mean,
       COALESCE(avg(abs(selected_squad_bias)), 0.0) AS squad_total_bias_abs_mean,
       COALESCE(min(prediction_to_actual_ratio), 1.0) AS prediction_to_actual_ratio_min,
       COALESCE(max(prediction_to_actual_ratio), 1.0) AS prediction_to_actual_ratio_max,
       CAST(count_if(prediction_collapse) AS BIGINT) AS prediction_collapse_weeks,
       COALESCE(array_to_string(list_sort(list(gameweek_id) FILTER (WHERE prediction_collapse)), ','), '')
         AS prediction_collapse_gameweeks,
       any_value(r.mae) AS mae, any_value(r.rmse) AS rmse, any_value(r.bias) AS bias,
       any_value(s.max_position_bias_abs) AS max_position_bias_abs,
       any_value(f.bias_flip_weeks) AS bias_flip_weeks
FROM wk, rows_ r, seg s, flips f""",
        [
            "top_k_hit_rate_mean", "rank_correlation_mean", "selected_xi_regret_mean",
            "selected_xi_actual_total_mean", "oracle_xi_actual_total_mean", "squad_total_bias_abs_mean",
            "prediction_to_actual_ratio_min", "prediction_to_actual_ratio_max", "mae", "rmse", "bias",
            "max_position_bias_abs",
        ],
    ),
)
def q_backtest_summary(spark, sf):
    p = panel(spark, sf)
    wk = bt.weekly_backtest(p, pred="five_week_players_roll_avg_points", materialize_input=False)
    s = bt.backtest_summary(p, wk, pred="five_week_players_roll_avg_points")
    return round_doubles(
        s.withColumn("prediction_collapse_gameweeks", F.array_join(F.col("prediction_collapse_gameweeks").cast("array<string>"), ","))
    )


# ------------------------------------------------------------------ larger panel (orders by customer-month)

@register(
    "panel_large_backtest",
    "A9 W1 W9 W4-W6 (orders panel)",
    rsql(
        """
WITH pl AS (
  SELECT o_custkey AS player_id, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS gameweek_id,
         sum(o_totalprice) / 10000.0 AS total_points
  FROM orders GROUP BY 1, 2),
rolled AS (
  SELECT *, avg(total_points) OVER (PARTITION BY player_id ORDER BY gameweek_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
              AS five_week_players_roll_avg_points
  FROM pl),
targeted AS (
  SELECT * FROM (SELECT *, lead(total_points) OVER w AS target_next_gw_points, lead(gameweek_id) OVER w AS target_gameweek_id
                 FROM rolled WINDOW w AS (PARTITION BY player_id ORDER BY gameweek_id)) x
  WHERE target_next_gw_points IS NOT NULL),
bt AS (SELECT *, target_next_gw_points AS actual_points, five_week_players_roll_avg_points AS predicted_points,
              target_next_gw_points - five_week_players_roll_avg_points AS error_bias,
              abs(target_next_gw_points - five_week_players_roll_avg_points) AS abs_error FROM targeted),
base AS (SELECT target_gameweek_id AS g, count(*) AS n_rows, sum(predicted_points) AS prediction_total,
                sum(actual_points) AS actual_total, avg(abs_error) AS mae, sqrt(avg(error_bias * error_bias)) AS rmse,
                avg(error_bias) AS bias FROM bt GROUP BY 1),
sq AS (SELECT g, sum(CASE WHEN rn <= 11 THEN actual_points END) AS selected_xi_actual_total FROM (
         SELECT target_gameweek_id AS g, actual_points,
                row_number() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points DESC, player_id) AS rn FROM bt) x
       WHERE rn <= 15 GROUP BY g),
orc AS (SELECT g, sum(actual_points) AS oracle_xi_actual_total FROM (
         SELECT target_gameweek_id AS g, actual_points,
                row_number() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points DESC, player_id) AS rn FROM bt) x
       WHERE rn <= 11 GROUP BY g),
hits AS (SELECT p.g, count(*) AS h FROM
          (SELECT target_gameweek_id AS g, player_id, row_number() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points DESC, player_id) AS rn FROM bt) p
          JOIN (SELECT target_gameweek_id AS g, player_id, row_number() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points DESC, player_id) AS rn FROM bt) a
          ON p.g = a.g AND p.player_id = a.player_id WHERE p.rn <= 11 AND a.rn <= 11 GROUP BY p.g),
rk AS (SELECT target_gameweek_id AS g,
              rank() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points)
                + (count(*) OVER (PARTITION BY target_gameweek_id, predicted_points) - 1) / 2.0 AS rp,
              rank() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points)
                + (count(*) OVER (PARTITION BY target_gameweek_id, actual_points) - 1) / 2.0 AS ra FROM bt),
cr AS (SELECT g, CASE WHEN count(*) >= 2 AND stddev_pop(rp) * stddev_pop(ra) > 0
                      THEN covar_pop(rp, ra) / (stddev_pop(rp) * stddev_pop(ra)) END AS rank_correlation FROM rk GROUP BY g)
SELECT CAST(b.g AS INTEGER) AS gameweek_id, b.n_rows, b.prediction_total, b.actual_total, b.mae, b.rmse, b.bias,
       s.selected_xi_actual_total, o.oracle_xi_actual_total, o.oracle_xi_actual_total - s.selected_xi_actual_total AS selected_xi_regret,
       CAST(COALESCE(h.h, 0) AS DOUBLE) / least(11, b.n_rows) AS top_k_hit_rate, c.rank_correlation
FROM base b LEFT JOIN sq s ON s.g = b.g LEFT JOIN orc o ON o.g = b.g LEFT JOIN hits h ON h.g = b.g LEFT JOIN cr c ON c.g = b.g""",
        ["prediction_total", "actual_total", "mae", "rmse", "bias", "selected_xi_actual_total", "oracle_xi_actual_total",
         "selected_xi_regret", "top_k_hit_rate", "rank_correlation"],
    ),
)
def q_panel_large_backtest(spark, sf):
    p = fe.rolling_features(tb.panel_large(spark, sf), team=None)
    p = materialize(fe.next_period_target(p, minutes="minutes_played"))
    wk = bt.weekly_backtest(p, pred="five_week_players_roll_avg_points", materialize_input=False)
    return round_doubles(wk.select("gameweek_id", "n_rows", "prediction_total", "actual_total", "mae", "rmse", "bias",
                                   "selected_xi_actual_total", "oracle_xi_actual_total", "selected_xi_regret",
                                   "top_k_hit_rate", "rank_correlation"))
