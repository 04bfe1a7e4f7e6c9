"""Readers for the driver tables and the panel projections built on them.

Each projection is a plain DataFrame plan over the parquet scan, so filters
and column pruning reach the reader.  The same definitions exist as SQL in
``panelforge.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _flag(event_type: str):
    return F.when(F.col("event_type") == event_type, 1).otherwise(0).cast("int")


def fixture_rows(spark: SparkSession, sf_dir: str, null_cost: bool = False) -> DataFrame:
    """events -> one row per (player, period, fixture); several per period.

    ``null_cost`` blanks the price of every row of a (player, period) with
    (player + period) % 11 = 0 (input for the fill / coalesce paths).
    """
    ev = read_table(spark, sf_dir, "events")
    uid = F.col("user_id")
    cost = 4.0 + (uid % 90) / 10.0
    if null_cost:
        cost = F.when((uid + F.dayofmonth("ts")) % 11 != 0, cost)
    return ev.select(
        uid.alias("player_id"),
        F.concat(F.lit("P"), uid.cast("string")).alias("web_name"),
        F.dayofmonth("ts").cast("int").alias("gameweek_id"),
        F.col("event_id").alias("fixture_id"),
        (uid % 4 + 1).cast("int").alias("position_id"),
        (uid % 20 + 1).cast("int").alias("team_id"),
        (F.col("value") / 25.0).alias("total_points"),
        (F.col("event_id") % 91).cast("double").alias("minutes_played"),
        _flag("purchase").alias("goals_scored"),
        _flag("click").alias("assists"),
        _flag("view").alias("clean_sheets"),
        _flag("signup").alias("bonus"),
        _flag("error").alias("yellow_cards"),
        (F.get_json_object("props", "$.k").try_cast("int") / 10.0).alias("ict_index"),
        cost.alias("now_cost"),
    )


def player_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> player dimension."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("player_id"),
        (4.0 + (k % 90) / 10.0).alias("current_value"),
        (k % 4 + 1).cast("int").alias("position_id"),
        F.col("c_nationkey").alias("team_id"),
    )


def team_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("team_id"),
        F.col("n_name").alias("name"),
        F.substring("n_name", 1, 3).alias("short_name"),
        F.col("n_regionkey").alias("strength"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders (home side via customer, away side via the order's min supplier)."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    away = (
        li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s_suppkey"))
        .join(s, "s_suppkey")
        .select(F.col("l_orderkey").alias("fixture_id"), F.col("s_nationkey").alias("team_a"))
    )
    home = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("fixture_id"),
        F.col("o_orderdate").alias("kickoff_time"),
        F.col("c_nationkey").alias("team_h"),
        (F.col("o_orderstatus") == "F").alias("finished"),
    )
    return home.join(away, "fixture_id")


def panel_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (customer, month) panel with 80 periods."""
    o = read_table(spark, sf_dir, "orders")
    return (
        o.select(
            F.col("o_custkey").alias("player_id"),
            ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("int").alias("gameweek_id"),
            F.col("o_totalprice"),
        )
        .groupBy("player_id", "gameweek_id")
        .agg((F.sum("o_totalprice") / 10000.0).alias("total_points"))
    )


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def string_nums(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("p_partkey"),
        F.when(k % 10 == 0, F.lit(""))
        .when(k % 11 == 0, F.lit("n/a"))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("raw_value"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("node"),
        F.col("ts"),
        F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> one row per experiment candidate with summary metrics."""
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    return p.select(
        F.col("p_partkey").alias("iteration"),
        (F.col("p_retailprice") / 1000.0).alias("mae"),
        (F.col("p_retailprice") / 800.0).alias("rmse"),
        ((size - 25.0) / 50.0).alias("bias"),
        (size / 50.0).alias("top_k_hit_rate_mean"),
        ((size - 20.0) / 60.0).alias("rank_correlation_mean"),
        (size * 1.5).alias("selected_xi_regret_mean"),
        (size / 4.0).alias("squad_total_bias_abs_mean"),
        (size / 20.0).alias("max_position_bias_abs"),
        (F.col("p_size") % 3).cast("int").alias("prediction_collapse_weeks"),
        (F.col("p_size") % 2).cast("int").alias("bias_flip_weeks"),
        ((F.col("p_size") % 7) / 50.0).alias("position_exceed_rate"),
        ((F.col("p_size") % 5) / 40.0).alias("player_exceed_rate"),
        ((size - 25.0) / 100.0).alias("position_calibration_gain"),
        (0.5 + size / 100.0).alias("prediction_to_actual_ratio_min"),
        (1.0 + size / 50.0).alias("prediction_to_actual_ratio_max"),
        (F.col("p_size") % 4 != 0).alias("baseline_gate_passed"),
        (F.col("p_size") % 3 != 0).alias("gates_passed"),
        ((F.col("p_size") % 10) / 2.0).alias("actual_std"),
    )


def candidate_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> long-form proposed hyper-parameters (iteration, param, value),
    some outside the search-space bounds on purpose."""
    p = read_table(spark, sf_dir, "part")
    size, price, k = F.col("p_size").cast("double"), F.col("p_retailprice"), F.col("p_partkey")
    vals = {
        "n_estimators": size * 25.0 + (k % 7),
        "max_depth": size / 4.0,
        "learning_rate": price / 5000.0,
        "subsample": 0.3 + size / 50.0,
        "reg_lambda": (k % 13) - 1.5,
        "calibration_strength": size / 40.0,
    }
    return p.select(
        k.alias("iteration"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("param"), v.alias("value")) for n, v in vals.items()])).alias("kv"),
    ).select("iteration", "kv.param", "kv.value")
