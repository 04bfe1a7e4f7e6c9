"""DuckDB SQL twins of the projections and the panel stages.

They are written independently of the Spark code (plain SQL windows and
aggregates) and serve as the oracle in ``oracle_sql()``.  Each constant is a
list of CTE definitions to prefix with ``WITH``.
"""

FIXTURE_ROWS = """
fr AS (
  SELECT user_id AS player_id,
         concat('P', CAST(user_id AS VARCHAR)) AS web_name,
         CAST(day(ts) AS INTEGER) AS gameweek_id,
         event_id AS fixture_id,
         CAST(user_id % 4 + 1 AS INTEGER) AS position_id,
         CAST(user_id % 20 + 1 AS INTEGER) AS team_id,
         value / 25.0 AS total_points,
         CAST(event_id % 91 AS DOUBLE) AS minutes_played,
         CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS goals_scored,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS INTEGER) AS assists,
         CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS INTEGER) AS clean_sheets,
         CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS INTEGER) AS bonus,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS yellow_cards,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 10.0 AS ict_index,
         4.0 + CAST(user_id % 90 AS DOUBLE) / 10.0 AS now_cost
  FROM events
)"""

COLLAPSED = """
collapsed AS (
  SELECT player_id, gameweek_id,
         arg_max(web_name, CASE WHEN web_name IS NOT NULL THEN fixture_id END) AS web_name,
         max(fixture_id) AS fixture_id,
         arg_max(position_id, CASE WHEN position_id IS NOT NULL THEN fixture_id END) AS position_id,
         arg_max(team_id, CASE WHEN team_id IS NOT NULL THEN fixture_id END) AS team_id,
         COALESCE(sum(total_points), 0) AS total_points,
         COALESCE(sum(minutes_played), 0) AS minutes_played,
         CAST(COALESCE(sum(goals_scored), 0) AS INTEGER) AS goals_scored,
         CAST(COALESCE(sum(assists), 0) AS INTEGER) AS assists,
         CAST(COALESCE(sum(clean_sheets), 0) AS INTEGER) AS clean_sheets,
         CAST(COALESCE(sum(bonus), 0) AS INTEGER) AS bonus,
         CAST(COALESCE(sum(yellow_cards), 0) AS INTEGER) AS yellow_cards,
         COALESCE(sum(ict_index), 0) AS ict_index,
         arg_max(now_cost, CASE WHEN now_cost IS NOT NULL THEN fixture_id END) AS now_cost
  FROM fr
  WHERE player_id IS NOT NULL AND gameweek_id IS NOT NULL
  GROUP BY player_id, gameweek_id
)"""

ROLLED = """
rolled AS (
  SELECT c.*,
         avg(total_points) OVER (PARTITION BY player_id ORDER BY gameweek_id
                                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three_week_players_roll_avg_points,
         avg(total_points) OVER (PARTITION BY player_id ORDER BY gameweek_id
                                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS five_week_players_roll_avg_points,
         CAST(row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id) AS INTEGER) AS total_games_played
  FROM collapsed c
),
team_roll AS (
  SELECT team_id, gameweek_id,
         avg(team_total) OVER (PARTITION BY team_id ORDER BY gameweek_id
                               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS team_roll_avg_goals_scored
  FROM (SELECT team_id, gameweek_id, CAST(sum(goals_scored) AS DOUBLE) AS team_total
        FROM collapsed GROUP BY team_id, gameweek_id) t
),
rolled_team AS (
  SELECT r.*, tr.team_roll_avg_goals_scored
  FROM rolled r LEFT JOIN team_roll tr ON r.team_id = tr.team_id AND r.gameweek_id = tr.gameweek_id
)"""

TARGETED = """
targeted AS (
  SELECT * FROM (
    SELECT rt.*,
           lead(total_points) OVER w AS target_next_gw_points,
           lead(gameweek_id) OVER w AS target_gameweek_id,
           lead(minutes_played) OVER w AS target_next_gw_minutes
    FROM rolled_team rt
    WINDOW w AS (PARTITION BY player_id ORDER BY gameweek_id)
  ) x
  WHERE target_next_gw_points IS NOT NULL AND target_gameweek_id IS NOT NULL
)"""

PANEL = ",".join([FIXTURE_ROWS, COLLAPSED, ROLLED, TARGETED])


NOW_COST_LINE = "4.0 + CAST(user_id % 90 AS DOUBLE) / 10.0 AS now_cost"
# Null injection used by the fill / coalesce tests: every fixture row of a
# (player, period) with (player + period) % 11 = 0 has no price.
NOW_COST_NULLED = (
    "CASE WHEN (user_id + day(ts)) % 11 = 0 THEN NULL "
    "ELSE 4.0 + CAST(user_id % 90 AS DOUBLE) / 10.0 END AS now_cost"
)


def with_panel(*extra: str, null_cost: bool = False) -> str:
    """``WITH`` + panel CTEs + extra CTE definitions."""
    panel = PANEL.replace(NOW_COST_LINE, NOW_COST_NULLED) if null_cost else PANEL
    return "WITH " + ",".join([panel, *extra])


def backtest_ctes(pred_expr: str, src: str = "targeted", actual_expr: str = "target_next_gw_points") -> list[str]:
    """CTEs computing the weekly back-test table ``wk`` for a predictor."""
    return [
        f"""
bt AS (
  SELECT *, CAST({actual_expr} AS DOUBLE) AS actual_points, CAST({pred_expr} AS DOUBLE) AS predicted_points,
         CAST({actual_expr} AS DOUBLE) - CAST({pred_expr} AS DOUBLE) AS error_bias,
         abs(CAST({actual_expr} AS DOUBLE) - CAST({pred_expr} AS DOUBLE)) AS abs_error
  FROM {src}
)""",
        """
bt_base AS (
  SELECT target_gameweek_id AS g, count(*) AS n_rows,
         COALESCE(sum(predicted_points), 0.0) AS prediction_total,
         COALESCE(sum(actual_points), 0.0) AS actual_total,
         avg(abs_error) AS mae, sqrt(avg(error_bias * error_bias)) AS rmse, avg(error_bias) AS bias,
         max(actual_points) - min(actual_points) AS act_range,
         max(predicted_points) - min(predicted_points) AS pred_range,
         count_if(minutes_played >= 60) AS n_likely
  FROM bt GROUP BY target_gameweek_id
)""",
        """
bt_sq AS (
  SELECT g, sum(predicted_points) AS selected_squad_predicted_total,
         COALESCE(sum(actual_points), 0.0) AS selected_squad_actual_total,
         COALESCE(sum(CASE WHEN rn <= 11 THEN actual_points END), 0.0) AS selected_xi_actual_total
  FROM (SELECT target_gameweek_id AS g, predicted_points, actual_points,
               row_number() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points DESC, player_id) AS rn
        FROM bt WHERE predicted_points IS NOT NULL) s
  WHERE rn <= 15 GROUP BY g
)""",
        """
bt_or AS (
  SELECT g, sum(actual_points) AS oracle_xi_actual_total
  FROM (SELECT target_gameweek_id AS g, actual_points,
               row_number() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points DESC, player_id) AS rn
        FROM bt WHERE actual_points IS NOT NULL) s
  WHERE rn <= 11 GROUP BY g
)""",
        """
bt_lk AS (SELECT * FROM bt WHERE minutes_played >= 60)""",
        """
bt_hits AS (
  SELECT p.g, count(*) AS hits
  FROM (SELECT target_gameweek_id AS g, player_id,
               row_number() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points DESC, player_id) AS rn
        FROM bt_lk WHERE predicted_points IS NOT NULL) p
  JOIN (SELECT target_gameweek_id AS g, player_id,
               row_number() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points DESC, player_id) AS rn
        FROM bt_lk WHERE actual_points IS NOT NULL) a
    ON p.g = a.g AND p.player_id = a.player_id
  WHERE p.rn <= 11 AND a.rn <= 11
  GROUP BY p.g
)""",
        """
bt_rk AS (
  SELECT target_gameweek_id AS g,
         rank() OVER (PARTITION BY target_gameweek_id ORDER BY predicted_points)
           + (count(*) OVER (PARTITION BY target_gameweek_id, predicted_points) - 1) / 2.0 AS rp,
         rank() OVER (PARTITION BY target_gameweek_id ORDER BY actual_points)
           + (count(*) OVER (PARTITION BY target_gameweek_id, actual_points) - 1) / 2.0 AS ra
  FROM bt_lk WHERE predicted_points IS NOT NULL AND actual_points IS NOT NULL
)""",
        """
bt_corr AS (
  SELECT g, CASE WHEN count(*) >= 2 AND stddev_pop(rp) * stddev_pop(ra) > 0
                 THEN covar_pop(rp, ra) / (stddev_pop(rp) * stddev_pop(ra)) END AS rank_correlation
  FROM bt_rk GROUP BY g
)""",
        """
wk AS (
  SELECT CAST(b.g AS INTEGER) AS gameweek_id, b.n_rows, b.prediction_total, b.actual_total,
         b.prediction_total / greatest(b.actual_total, 1e-9) AS prediction_to_actual_ratio,
         b.mae, b.rmse, b.bias,
         b.pred_range / greatest(b.act_range, 1e-9) AS prediction_range_ratio,
         s.selected_squad_predicted_total, s.selected_squad_actual_total,
         s.selected_squad_actual_total - s.selected_squad_predicted_total AS selected_squad_bias,
         s.selected_xi_actual_total, o.oracle_xi_actual_total,
         o.oracle_xi_actual_total - s.selected_xi_actual_total AS selected_xi_regret,
         CASE WHEN least(11, b.n_likely) > 0
              THEN CAST(COALESCE(h.hits, 0) AS DOUBLE) / least(11, b.n_likely) END AS top_k_hit_rate,
         CASE WHEN least(11, b.n_likely) > 0 THEN c.rank_correlation END AS rank_correlation,
         (b.prediction_total / greatest(b.actual_total, 1e-9) < 0.6
          OR b.prediction_total / greatest(b.actual_total, 1e-9) > 1.6) AS prediction_collapse
  FROM bt_base b
  LEFT JOIN bt_sq s ON s.g = b.g
  LEFT JOIN bt_or o ON o.g = b.g
  LEFT JOIN bt_hits h ON h.g = b.g
  LEFT JOIN bt_corr c ON c.g = b.g
)""",
    ]


WEEKLY_DOUBLES = (
    "prediction_total actual_total prediction_to_actual_ratio mae rmse bias prediction_range_ratio "
    "selected_squad_predicted_total selected_squad_actual_total selected_squad_bias selected_xi_actual_total "
    "oracle_xi_actual_total selected_xi_regret top_k_hit_rate rank_correlation"
).split()


def backtest_by_ctes(src: str, by: str = "predictor", p: str = "b_", flip_threshold: float = 10.0) -> list[str]:
    """Weekly back-test + summary per ``by`` key over ``src`` with columns
    (by, player_id, target_gameweek_id, minutes_played, position_id,
    actual_points, predicted_points).  Produces ``{p}wk`` and ``{p}sum``."""
    k = f"{by}, target_gameweek_id"
    return [
        f"""
{p}bt AS (SELECT *, actual_points - predicted_points AS error_bias,
                 abs(actual_points - predicted_points) AS abs_error FROM {src})""",
        f"""
{p}base AS (
  SELECT {k}, count(*) AS n_rows,
         COALESCE(sum(predicted_points), 0.0) AS prediction_total, COALESCE(sum(actual_points), 0.0) AS actual_total,
         avg(abs_error) AS mae, sqrt(avg(error_bias * error_bias)) AS rmse, avg(error_bias) AS bias,
         max(actual_points) - min(actual_points) AS act_range, max(predicted_points) - min(predicted_points) AS pred_range,
         count_if(minutes_played >= 60) AS n_likely
  FROM {p}bt GROUP BY {k})""",
        f"""
{p}sq AS (
  SELECT {k}, sum(predicted_points) AS selected_squad_predicted_total,
         COALESCE(sum(actual_points), 0.0) AS selected_squad_actual_total,
         COALESCE(sum(CASE WHEN rn <= 11 THEN actual_points END), 0.0) AS selected_xi_actual_total
  FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY predicted_points DESC, player_id) AS rn
        FROM {p}bt WHERE predicted_points IS NOT NULL) s
  WHERE rn <= 15 GROUP BY {k})""",
        f"""
{p}orc AS (
  SELECT {k}, sum(actual_points) AS oracle_xi_actual_total
  FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY actual_points DESC, player_id) AS rn
        FROM {p}bt WHERE actual_points IS NOT NULL) s
  WHERE rn <= 11 GROUP BY {k})""",
        f"""
{p}lk AS (SELECT * FROM {p}bt WHERE minutes_played >= 60)""",
        f"""
{p}hits AS (
  SELECT a.{by}, a.target_gameweek_id, count(*) AS hits
  FROM (SELECT {k}, player_id, row_number() OVER (PARTITION BY {k} ORDER BY predicted_points DESC, player_id) AS rn
        FROM {p}lk WHERE predicted_points IS NOT NULL) a
  JOIN (SELECT {k}, player_id, row_number() OVER (PARTITION BY {k} ORDER BY actual_points DESC, player_id) AS rn
        FROM {p}lk WHERE actual_points IS NOT NULL) b
    ON a.{by} = b.{by} AND a.target_gameweek_id = b.target_gameweek_id AND a.player_id = b.player_id
  WHERE a.rn <= 11 AND b.rn <= 11
  GROUP BY a.{by}, a.target_gameweek_id)""",
        f"""
{p}rk AS (
  SELECT {k},
         rank() OVER (PARTITION BY {k} ORDER BY predicted_points)
           + (count(*) OVER (PARTITION BY {k}, predicted_points) - 1) / 2.0 AS rp,
         rank() OVER (PARTITION BY {k} ORDER BY actual_points)
           + (count(*) OVER (PARTITION BY {k}, actual_points) - 1) / 2.0 AS ra
  FROM {p}lk WHERE predicted_points IS NOT NULL AND actual_points IS NOT NULL)""",
        f"""
{p}corr AS (
  SELECT {k}, CASE WHEN count(*) >= 2 AND stddev_pop(rp) * stddev_pop(ra) > 0
                   THEN covar_pop(rp, ra) / (stddev_pop(rp) * stddev_pop(ra)) END AS rank_correlation
  FROM {p}rk GROUP BY {k})""",
        f"""
{p}wk AS (
  SELECT b.{by}, CAST(b.target_gameweek_id AS INTEGER) AS gameweek_id, b.n_rows, b.prediction_total, b.actual_total,
         b.prediction_total / greatest(b.actual_total, 1e-9) AS prediction_to_actual_ratio,
         b.mae, b.rmse, b.bias, b.pred_range / greatest(b.act_range, 1e-9) AS prediction_range_ratio,
         s.selected_squad_predicted_total, s.selected_squad_actual_total,
         s.selected_squad_actual_total - s.selected_squad_predicted_total AS selected_squad_bias,
         s.selected_xi_actual_total, o.oracle_xi_actual_total,
         o.oracle_xi_actual_total - s.selected_xi_actual_total AS selected_xi_regret,
         CASE WHEN least(11, b.n_likely) > 0 THEN CAST(COALESCE(h.hits, 0) AS DOUBLE) / least(11, b.n_likely) END AS top_k_hit_rate,
         CASE WHEN least(11, b.n_likely) > 0 THEN c.rank_correlation END AS rank_correlation,
         (b.prediction_total / greatest(b.actual_total, 1e-9) < 0.6
          OR b.prediction_total / greatest(b.actual_total, 1e-9) > 1.6) AS prediction_collapse
  FROM {p}base b
  LEFT JOIN {p}sq s ON s.{by} = b.{by} AND s.target_gameweek_id = b.target_gameweek_id
  LEFT JOIN {p}orc o ON o.{by} = b.{by} AND o.target_gameweek_id = b.target_gameweek_id
  LEFT JOIN {p}hits h ON h.{by} = b.{by} AND h.target_gameweek_id = b.target_gameweek_id
  LEFT JOIN {p}corr c ON c.{by} = b.{by} AND c.target_gameweek_id = b.target_gameweek_id)""",
        f"""
{p}flips AS (
  SELECT {by}, CAST(count_if(pb IS NOT NULL AND sign(pb) <> 0 AND sign(bias) <> 0 AND sign(pb) <> sign(bias)
                             AND abs(pb) >= {flip_threshold} AND abs(bias) >= {flip_threshold}) AS BIGINT) AS bias_flip_weeks
  FROM (SELECT {by}, bias, lag(bias) OVER (PARTITION BY {by} ORDER BY gameweek_id) AS pb FROM {p}wk) x
  GROUP BY {by})""",
        f"""
{p}rows AS (
  SELECT {by}, avg(abs_error) AS mae, sqrt(avg(error_bias * error_bias)) AS rmse, avg(error_bias) AS bias
  FROM {p}bt GROUP BY {by})""",
        f"""
{p}seg AS (
  SELECT {by}, COALESCE(max(abs(b)), 0.0) AS max_position_bias_abs
  FROM (SELECT {by}, position_id, avg(error_bias) AS b FROM {p}bt GROUP BY {by}, position_id) x GROUP BY {by})""",
        f"""
{p}sum AS (
  SELECT w.{by}, count(*) AS weekly_count,
         COALESCE(avg(top_k_hit_rate), 0.0) AS top_k_hit_rate_mean,
         COALESCE(avg(rank_correlation), 0.0) AS rank_correlation_mean,
         COALESCE(avg(selected_xi_regret), 0.0) AS selected_xi_regret_mean,
         COALESCE(avg(selected_xi_actual_total), 0.0) AS selected_xi_actual_total_mean,
         COALESCE(avg(oracle_xi_actual_total), 0.0) AS oracle_xi_actual_total_mean,
         COALESCE(avg(abs(selected_squad_bias)), 0.0) AS squad_total_bias_abs_mean,
         COALESCE(min(prediction_to_actual_ratio), 1.0) AS prediction_to_actual_ratio_min,
         COALESCE(max(prediction_to_actual_ratio), 1.0) AS prediction_to_actual_ratio_max,
         CAST(count_if(prediction_collapse) AS BIGINT) AS prediction_collapse_weeks,
         any_value(r.mae) AS mae, any_value(r.rmse) AS rmse, any_value(r.bias) AS bias,
         any_value(s.max_position_bias_abs) AS max_position_bias_abs,
         COALESCE(any_value(f.bias_flip_weeks), 0) AS bias_flip_weeks
  FROM {p}wk w JOIN {p}rows r ON r.{by} = w.{by} JOIN {p}seg s ON s.{by} = w.{by}
  LEFT JOIN {p}flips f ON f.{by} = w.{by}
  GROUP BY w.{by})""",
    ]
