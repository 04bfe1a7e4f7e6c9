"""Registered queries: metrics, calibration, post-processing and drift on a
scored split panel.

The "model" here is the heuristic forecast (P21) with z-scores from train-only
statistics, so every query stays SQL-expressible and gets a DuckDB twin; the
three baselines are the reference's (5- and 3-appearance means, z-score).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import calibration as ca
from panelforge.operators import drift as dr
from panelforge.operators import features as fe
from panelforge.operators import metrics as me
from panelforge.operators.common import attach_row, materialize, round_doubles
from panelforge.plans.q_split import SPLIT5_SQL, split5
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel

ACT = "target_next_gw_points"

SCORED_SQL = SPLIT5_SQL + """,
zst AS (SELECT avg(total_points) AS m1,
               CASE WHEN stddev_samp(total_points) > 0 THEN stddev_samp(total_points) ELSE 1.0 END AS s1
        FROM split WHERE role = 'train'),
scored AS (
  SELECT s.*, COALESCE((s.total_points - z.m1) / z.s1, 0.0) AS total_points_z_score,
         greatest(0.0, COALESCE(s.three_week_players_roll_avg_points, 2.0) * 0.7
                       + COALESCE((s.total_points - z.m1) / z.s1, 0.0) * 1.5 + 2.0) AS predicted_points
  FROM split s, zst z)"""


def scored(spark, sf):
    """Split panel + train-stat z-score + heuristic model prediction."""
    s = split5(spark, sf)
    stats = fe.global_stats(s.filter(F.col("role") == "train"), ["total_points"])
    z = fe.zscore_apply(s, stats, ["total_points"])
    # Many branches read this panel (train/holdout stats, caps, variants):
    # write it once and cut the lineage.
    return materialize(z.withColumn("predicted_points", fe.heuristic_forecast(z)))


def _train(spark, sf):
    return scored(spark, sf).filter(F.col("role") == "train")


def _holdout(spark, sf):
    return scored(spark, sf).filter(F.col("role") == "holdout")


# ------------------------------------------------------------------ metrics

@register(
    "error_metrics",
    "A5 A5b",
    rsql(
        with_panel(SCORED_SQL)
        + f"""
SELECT role, count(*) AS n, avg(abs({ACT} - predicted_points)) AS mae,
       sqrt(avg(({ACT} - predicted_points) * ({ACT} - predicted_points))) AS rmse,
       avg({ACT} - predicted_points) AS bias,
       CASE WHEN var_pop({ACT}) * count({ACT}) > 0
            THEN 1 - sum(({ACT} - predicted_points) * ({ACT} - predicted_points)) / (var_pop({ACT}) * count({ACT})) END AS r2
FROM scored GROUP BY role""",
        ["mae", "rmse", "bias", "r2"],
    ),
)
def q_error_metrics(spark, sf):
    return round_doubles(me.error_metrics(scored(spark, sf), ACT, "predicted_points", ["role"]))


_BAND = """CASE WHEN minutes_played > -1 AND minutes_played <= 30 THEN '0_30'
                WHEN minutes_played > 30 AND minutes_played <= 60 THEN '31_60'
                WHEN minutes_played > 60 AND minutes_played <= 1000000 THEN '61_90' END"""


@register(
    "group_bias",
    "A6",
    rsql(
        with_panel(SCORED_SQL)
        + f""",
h AS (SELECT * FROM scored WHERE role = 'holdout'),
bands AS (SELECT * FROM (VALUES ('0_30'), ('31_60'), ('61_90')) b(band)),
hb AS (SELECT {_BAND} AS band, {ACT} AS a, predicted_points AS p FROM h WHERE minutes_played > 30)
SELECT 'position' AS group_type, CAST(position_id AS VARCHAR) AS group_value, count(*) AS count,
       avg(predicted_points) AS avg_predicted_points, avg({ACT}) AS avg_actual_points,
       avg(abs({ACT} - predicted_points)) AS mae, avg({ACT} - predicted_points) AS bias
FROM h GROUP BY position_id
UNION ALL
SELECT 'minutes_band', b.band, count(hb.a), avg(hb.p), avg(hb.a), avg(abs(hb.a - hb.p)), avg(hb.a - hb.p)
FROM bands b LEFT JOIN hb ON hb.band = b.band GROUP BY b.band""",
        ["avg_predicted_points", "avg_actual_points", "mae", "bias"],
    ),
)
def q_group_bias(spark, sf):
    h = _holdout(spark, sf)
    pos = me.group_bias(h, ACT, "predicted_points", "position_id").select(
        F.lit("position").alias("group_type"), F.col("position_id").cast("string").alias("group_value"),
        "count", "avg_predicted_points", "avg_actual_points", "mae", "bias",
    )
    band = me.band_bias(h.filter(F.col("minutes_played") > 30), ACT, "predicted_points").select(
        F.lit("minutes_band").alias("group_type"), F.col("minutes_band").alias("group_value"),
        "count", "avg_predicted_points", "avg_actual_points", "mae", "bias",
    )
    return round_doubles(pos.unionByName(band))


@register(
    "focus_bias",
    "A7",
    rsql(
        with_panel(SCORED_SQL)
        + f"""
SELECT COALESCE(avg(abs(b)), 0.0) AS focus_abs_bias
FROM (SELECT avg({ACT} - predicted_points) AS b FROM scored
      WHERE role = 'holdout' AND position_id IN (1, 2) GROUP BY position_id) x""",
        ["focus_abs_bias"],
    ),
)
def q_focus_bias(spark, sf):
    return round_doubles(me.focus_bias(_holdout(spark, sf), ACT, "predicted_points"))


@register(
    "p95_by_segment",
    "A8",
    rsql(
        with_panel(SCORED_SQL)
        + f"""
SELECT CAST(position_id AS INTEGER) AS position_id, quantile_cont({ACT}, 0.95) AS actual_p95,
       quantile_cont(predicted_points, 0.95) AS predicted_p95
FROM scored WHERE role = 'holdout' GROUP BY position_id""",
        ["actual_p95", "predicted_p95"],
    ),
)
def q_p95_by_segment(spark, sf):
    from panelforge.operators.ranking import exact_percentile

    h = _holdout(spark, sf).withColumn("position_id", F.col("position_id").cast("int"))
    a = exact_percentile(h, ["position_id"], ACT, 0.95, "actual_p95").drop("n")
    p = exact_percentile(h, ["position_id"], "predicted_points", 0.95, "predicted_p95").drop("n")
    return round_doubles(a.join(p, "position_id"))


# ------------------------------------------------------------------ calibration

def _coef_sql(src: str, strength: float = 0.8, min_samples: int = 25) -> str:
    s = strength
    return f"""
g_m AS (SELECT stddev_pop(a) AS st, stddev_pop(p) AS sp, avg(a) AS mt, avg(p) AS mp, count(*) AS n FROM {src}),
g_c AS (SELECT 1.0 + {s} * ((CASE WHEN sp = 0 THEN 1.0 ELSE st / sp END) - 1.0) AS a,
               {s} * (CASE WHEN sp = 0 THEN 0.0 ELSE mt - (st / sp) * mp END) AS b, n FROM g_m),
s_m AS (SELECT position_id, stddev_pop(a) AS st, stddev_pop(p) AS sp, avg(a) AS mt, avg(p) AS mp, count(*) AS n
        FROM {src} WHERE position_id IS NOT NULL GROUP BY position_id),
coef AS (
  SELECT 'global' AS scope, CAST(NULL AS INTEGER) AS position_id, a, b, n AS count, CAST(NULL AS VARCHAR) AS fallback FROM g_c
  UNION ALL
  SELECT 'position', CAST(s.position_id AS INTEGER),
         CASE WHEN s.n < {min_samples} THEN g.a ELSE 1.0 + {s} * ((CASE WHEN s.sp = 0 THEN 1.0 ELSE s.st / s.sp END) - 1.0) END,
         CASE WHEN s.n < {min_samples} THEN g.b ELSE {s} * (CASE WHEN s.sp = 0 THEN 0.0 ELSE s.mt - (s.st / s.sp) * s.mp END) END,
         s.n, CASE WHEN s.n < {min_samples} THEN 'global' END
  FROM s_m s, g_c g)"""


CAL_SQL = SCORED_SQL + f""",
tr AS (SELECT {ACT} AS a, predicted_points AS p, position_id FROM scored WHERE role = 'train'),
{_coef_sql('tr')},
ho AS (SELECT player_id, target_gameweek_id, position_id, {ACT} AS a, predicted_points AS p FROM scored WHERE role = 'holdout'),
hv AS (
  SELECT h.*, gc.a * h.p + gc.b AS p_global,
         COALESCE(pc.a, gc.a) * h.p + COALESCE(pc.b, gc.b) AS p_position
  FROM ho h CROSS JOIN (SELECT a, b FROM coef WHERE scope = 'global') gc
  LEFT JOIN (SELECT position_id, a, b FROM coef WHERE scope = 'position') pc ON pc.position_id = h.position_id),
lv AS (SELECT 'none' AS variant, a, p, position_id FROM hv
       UNION ALL SELECT 'global', a, p_global, position_id FROM hv
       UNION ALL SELECT 'position_aware', a, p_position, position_id FROM hv),
rep0 AS (SELECT variant, avg(abs(a - p)) AS mae, sqrt(avg((a - p) * (a - p))) AS rmse, avg(a - p) AS bias FROM lv GROUP BY variant),
fb AS (SELECT variant, avg(abs(b)) AS focus_abs_bias
       FROM (SELECT variant, position_id, avg(a - p) AS b FROM lv WHERE position_id IN (1, 2) GROUP BY variant, position_id) x
       GROUP BY variant),
rep AS (SELECT r.variant, r.mae, r.rmse, r.bias, COALESCE(f.focus_abs_bias, 0.0) AS focus_abs_bias,
               r.mae - n.mae AS delta_mae, r.rmse - n.rmse AS delta_rmse, r.bias - n.bias AS delta_bias
        FROM rep0 r LEFT JOIN fb f ON f.variant = r.variant, (SELECT * FROM rep0 WHERE variant = 'none') n)"""


def _cal_pieces(spark, sf):
    s = scored(spark, sf)
    tr = s.filter(F.col("role") == "train")
    ho = s.filter(F.col("role") == "holdout")
    coeffs = ca.fit_calibration(tr, ACT, "predicted_points")
    return tr, ho, coeffs


@register(
    "calibration_fit",
    "A12 P24",
    rsql(with_panel(CAL_SQL) + "\nSELECT * FROM coef", ["a", "b"]),
)
def q_calibration_fit(spark, sf):
    _, _, coeffs = _cal_pieces(spark, sf)
    return round_doubles(coeffs)


@register(
    "position_calibration_apply",
    "J5 P23",
    rsql(
        with_panel(CAL_SQL)
        + "\nSELECT player_id, target_gameweek_id, position_id, p AS predicted_points, p_global, p_position FROM hv",
        ["predicted_points", "p_global", "p_position"],
    ),
)
def q_position_calibration_apply(spark, sf):
    _, ho, coeffs = _cal_pieces(spark, sf)
    h = ho.select("player_id", "target_gameweek_id", "position_id", "predicted_points")
    h = ca.apply_global(h, "predicted_points", coeffs, "p_global")
    h = ca.apply_position(h, "predicted_points", coeffs, "p_position")
    return round_doubles(h)


@register(
    "calibration_report",
    "A13",
    rsql(with_panel(CAL_SQL) + "\nSELECT * FROM rep",
         ["mae", "rmse", "bias", "focus_abs_bias", "delta_mae", "delta_rmse", "delta_bias"]),
)
def q_calibration_report(spark, sf):
    _, ho, coeffs = _cal_pieces(spark, sf)
    return round_doubles(ca.calibration_report(ca.variant_long(ho, ACT, "predicted_points", coeffs)))


CSEL_SQL = """
cand AS (SELECT *, CASE variant WHEN 'none' THEN 0 WHEN 'global' THEN 1 ELSE 2 END AS priority,
                CASE WHEN variant = 'none' THEN 0.0 ELSE focus_abs_bias END AS fscore
         FROM rep WHERE variant = 'none' OR (delta_mae <= 0.0 AND delta_rmse <= 0.0)),
sel AS (SELECT variant FROM cand ORDER BY mae, rmse, abs(bias), fscore, priority LIMIT 1),
csel AS (
  SELECT s.variant AS selected_variant,
         (SELECT focus_abs_bias FROM rep WHERE variant = 'global') AS gk_def_abs_bias_global,
         (SELECT focus_abs_bias FROM rep WHERE variant = 'position_aware') AS gk_def_abs_bias_position,
         r.delta_mae AS selected_delta_mae, r.delta_rmse AS selected_delta_rmse, r.delta_bias AS selected_delta_bias,
         (SELECT focus_abs_bias FROM rep WHERE variant = 'global')
           - (SELECT focus_abs_bias FROM rep WHERE variant = 'position_aware') AS position_calibration_gain
  FROM sel s JOIN rep r ON r.variant = s.variant)"""


@register(
    "calibration_select",
    "M7",
    rsql(
        with_panel(CAL_SQL, CSEL_SQL) + "\nSELECT * FROM csel",
        ["gk_def_abs_bias_global", "gk_def_abs_bias_position", "selected_delta_mae", "selected_delta_rmse",
         "selected_delta_bias", "position_calibration_gain"],
    ),
)
def q_calibration_select(spark, sf):
    _, ho, coeffs = _cal_pieces(spark, sf)
    rep = ca.calibration_report(ca.variant_long(ho, ACT, "predicted_points", coeffs))
    return round_doubles(ca.select_variant(rep))


@register(
    "postprocess_chain",
    "P25 P22 J4 F2 F13",
    rsql(
        with_panel(CAL_SQL)
        + f""",
caps AS (SELECT position_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train' GROUP BY position_id),
lm AS (SELECT avg({ACT}) AS league_mean FROM scored WHERE role = 'train'),
shr AS (SELECT h.*, 0.9 * h.p + 0.1 * lm.league_mean AS p_shrunk FROM ho h, lm),
cal AS (SELECT s.*, COALESCE(pc.a, gc.a) * s.p_shrunk + COALESCE(pc.b, gc.b) AS p_cal
        FROM shr s CROSS JOIN (SELECT a, b FROM coef WHERE scope = 'global') gc
        LEFT JOIN (SELECT position_id, a, b FROM coef WHERE scope = 'position') pc ON pc.position_id = s.position_id)
SELECT c.player_id, c.target_gameweek_id, c.position_id, c.p AS predicted_points,
       least(greatest(c.p_cal, 0.0), COALESCE(k.cap, CAST('inf' AS DOUBLE))) AS final_points
FROM cal c LEFT JOIN caps k ON k.position_id = c.position_id""",
        ["predicted_points", "final_points"],
    ),
)
def q_postprocess(spark, sf):
    tr, ho, coeffs = _cal_pieces(spark, sf)
    caps = me.percentile_caps(tr, "position_id", ACT)
    lm = tr.agg(F.avg(ACT).alias("__lm"))
    h = attach_row(ho.select("player_id", "target_gameweek_id", "position_id", "predicted_points"), lm)
    out = ca.postprocess(h, "predicted_points", "final_points", league_mean=F.col("__lm"), alpha=0.1,
                         variant="position_aware", coeffs=coeffs, caps=caps)
    return round_doubles(out.drop("__lm"))


@register(
    "cap_exceed_rate",
    "A21 J6",
    rsql(
        with_panel(SCORED_SQL)
        + f""",
pc AS (SELECT position_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train' GROUP BY position_id),
yc AS (SELECT player_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train'
       GROUP BY player_id HAVING count(*) >= 10),
h AS (SELECT * FROM scored WHERE role = 'holdout')
SELECT 'position' AS cap_type, COALESCE(avg(CASE WHEN h.predicted_points > pc.cap THEN 1.0 ELSE 0.0 END), 0.0) AS exceed_rate,
       count(*) AS exceed_n
FROM h JOIN pc ON pc.position_id = h.position_id
UNION ALL
SELECT 'player', COALESCE(avg(CASE WHEN h.predicted_points > yc.cap THEN 1.0 ELSE 0.0 END), 0.0), count(*)
FROM h JOIN yc ON yc.player_id = h.player_id""",
        ["exceed_rate"],
    ),
)
def q_cap_exceed(spark, sf):
    s = scored(spark, sf)
    tr, ho = s.filter(F.col("role") == "train"), s.filter(F.col("role") == "holdout")
    pos = me.cap_exceed_rate(ho, "predicted_points", me.percentile_caps(tr, "position_id", ACT), "position_id")
    ply = me.cap_exceed_rate(ho, "predicted_points", me.percentile_caps(tr, "player_id", ACT, 10), "player_id")
    return round_doubles(
        pos.select(F.lit("position").alias("cap_type"), "*").unionByName(ply.select(F.lit("player").alias("cap_type"), "*"))
    )


EXCEED_CTES = f"""
pc AS (SELECT position_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train' GROUP BY position_id),
yc AS (SELECT player_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train'
       GROUP BY player_id HAVING count(*) >= 10),
hh AS (SELECT * FROM scored WHERE role = 'holdout'),
pe AS (SELECT COALESCE(avg(CASE WHEN hh.predicted_points > pc.cap THEN 1.0 ELSE 0.0 END), 0.0) AS position_exceed_rate,
              count(*) AS position_exceed_n FROM hh JOIN pc ON pc.position_id = hh.position_id),
ye AS (SELECT COALESCE(avg(CASE WHEN hh.predicted_points > yc.cap THEN 1.0 ELSE 0.0 END), 0.0) AS player_exceed_rate,
              count(*) AS player_exceed_n FROM hh JOIN yc ON yc.player_id = hh.player_id)"""


@register(
    "sanity_metrics",
    "A20",
    rsql(
        with_panel(SCORED_SQL)
        + f""",
h AS (SELECT * FROM scored WHERE role = 'holdout'),
pc AS (SELECT position_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train' GROUP BY position_id),
yc AS (SELECT player_id, quantile_cont({ACT}, 0.95) AS cap FROM scored WHERE role = 'train'
       GROUP BY player_id HAVING count(*) >= 10),
st AS (SELECT avg({ACT}) AS actual_mean, stddev_pop({ACT}) AS actual_std, min({ACT}) AS actual_min, max({ACT}) AS actual_max,
              avg(predicted_points) AS pred_mean, stddev_pop(predicted_points) AS pred_std,
              min(predicted_points) AS pred_min, max(predicted_points) AS pred_max FROM h),
pe AS (SELECT COALESCE(avg(CASE WHEN h.predicted_points > pc.cap THEN 1.0 ELSE 0.0 END), 0.0) AS position_exceed_rate,
              count(*) AS position_exceed_n FROM h JOIN pc ON pc.position_id = h.position_id),
ye AS (SELECT COALESCE(avg(CASE WHEN h.predicted_points > yc.cap THEN 1.0 ELSE 0.0 END), 0.0) AS player_exceed_rate,
              count(*) AS player_exceed_n FROM h JOIN yc ON yc.player_id = h.player_id)
SELECT st.*, pe.*, ye.*, (SELECT count(*) FROM yc) AS player_caps_count FROM st, pe, ye""",
        ["actual_mean", "actual_std", "actual_min", "actual_max", "pred_mean", "pred_std", "pred_min", "pred_max",
         "position_exceed_rate", "player_exceed_rate"],
    ),
)
def q_sanity(spark, sf):
    s = scored(spark, sf)
    return round_doubles(me.sanity_metrics(s.filter(F.col("role") == "train"), s.filter(F.col("role") == "holdout"), ACT, "predicted_points"))


# ------------------------------------------------------------------ drift

KS_BODY = """
kl AS (SELECT 'total_points' AS feature, COALESCE(CAST(total_points AS DOUBLE), 0.0) AS v, role FROM split
       UNION ALL SELECT 'minutes_played', COALESCE(CAST(minutes_played AS DOUBLE), 0.0), role FROM split
       UNION ALL SELECT 'ict_index', COALESCE(CAST(ict_index AS DOUBLE), 0.0), role FROM split),
kc AS (SELECT feature, v, count_if(role = 'train') AS c1, count_if(role = 'holdout') AS c2 FROM kl GROUP BY feature, v),
kt AS (SELECT feature, sum(c1) AS n1, sum(c2) AS n2 FROM kc GROUP BY feature),
kcum AS (SELECT feature, v, sum(c1) OVER (PARTITION BY feature ORDER BY v) AS cum1,
                sum(c2) OVER (PARTITION BY feature ORDER BY v) AS cum2 FROM kc),
ks AS (SELECT k.feature, max(abs(k.cum1 / t.n1 - k.cum2 / t.n2)) AS ks_stat,
              CAST(any_value(t.n1) AS BIGINT) AS n_a, CAST(any_value(t.n2) AS BIGINT) AS n_b
       FROM kcum k JOIN kt t ON t.feature = k.feature GROUP BY k.feature)"""
KS_SQL = SPLIT5_SQL + ",\n" + KS_BODY


def _ks(spark, sf):
    s = materialize(split5(spark, sf))
    return dr.ks_two_sample(s.filter(F.col("role") == "train"), s.filter(F.col("role") == "holdout"))


@register(
    "ks_drift",
    "A18 A18b",
    rsql(
        with_panel(KS_SQL)
        + """,
lam AS (SELECT *, (sqrt(n_a * n_b / (n_a + n_b)) + 0.12 + 0.11 / sqrt(n_a * n_b / (n_a + n_b))) * ks_stat AS l FROM ks)
SELECT feature, ks_stat, n_a, n_b, ks_stat > 0.2 AS breach,
       least(1.0, greatest(0.0, 2.0 * (SELECT sum(power(-1.0, k - 1) * exp(-2.0 * k * k * l * l)) FROM range(1, 101) r(k))))
         AS p_value, CASE WHEN n_a * n_b <= 10000 THEN 'exact' ELSE 'asymptotic' END AS p_value_method
FROM lam""",
        ["ks_stat", "p_value"],
    ),
)
def q_ks_drift(spark, sf):
    s = materialize(split5(spark, sf))
    ks = dr.ks_two_sample(s.filter(F.col("role") == "train"), s.filter(F.col("role") == "holdout"), with_p_value=True)
    return round_doubles(ks)


@register(
    "drift_decision",
    "V2 A18b",
    rsql(
        with_panel(KS_SQL)
        + """
SELECT CAST(count_if(ks_stat > 0.2) AS BIGINT) AS breached, count_if(ks_stat > 0.2) / 3.0 AS breach_ratio,
       0.34 AS trigger_threshold, count_if(ks_stat > 0.2) / 3.0 >= 0.34 AS drift_triggered
FROM ks""",
        ["breach_ratio", "trigger_threshold"],
    ),
)
def q_drift_decision(spark, sf):
    return round_doubles(dr.drift_decision(_ks(spark, sf)))
