"""Land API-like JSON documents built from the driver tables (S1 input).

The reference fetches JSON envelopes over HTTP; here the same documents are
derived from the tables with Spark and written as JSON-lines text (one
envelope per line) below the shared folder.  Every document is bounded in
size: player elements are chunked by ``player_id div 500`` (one row per
player and period after the collapse), fixtures by ``fixture_id div 1000``,
history documents hold one player's periods.  Documents are whole; only on
demand some bootstrap documents are truncated (input for the quarantine path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row
from panelforge.operators.features import collapse_periods
from panelforge.session import scratch_path
from panelforge.sources import tables as tb

ELEMENT_CHUNK = 500
FIXTURE_CHUNK = 1000
MALFORMED_EVERY = 7  # bootstrap documents of periods divisible by 7, chunk 0


def _iso(ts_col) -> F.Column:
    return F.date_format(ts_col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _envelope(data: F.Column, endpoint: str, fetched: F.Column, key: F.Column) -> F.Column:
    body = F.to_json(data)
    meta = F.struct(
        F.lit(endpoint).alias("endpoint_name"),
        F.concat(F.lit(f"https://api.example.invalid/{endpoint}/"), key.cast("string")).alias("url"),
        fetched.alias("fetch_timestamp"),
        F.lit(200).alias("status_code"),
        F.octet_length(body).alias("response_size_bytes"),
        F.struct(F.lit("application/json").alias("accept"), F.concat(F.lit("k-"), key.cast("string")).alias("x_api_key"),
                 F.struct(F.array(F.concat(F.lit("s3cr-"), key.cast("string"))).alias("a")).alias("auth_tokens")).alias("request_headers"),
    )
    return F.to_json(F.struct(data.alias("data"), meta.alias("metadata")))


def bootstrap_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One element row per (player, period), API field names."""
    c = collapse_periods(tb.fixture_rows(spark, sf_dir))
    form = F.when((F.col("player_id") + F.col("gameweek_id")) % 9 == 0, F.lit("")).otherwise(
        F.concat((F.col("goals_scored") + F.col("assists")).cast("string"), F.lit(".5"))
    )
    key = F.col("player_id")
    return c.select(
        F.col("gameweek_id").alias("event"),
        F.floor(F.col("player_id") / ELEMENT_CHUNK).cast("bigint").alias("chunk"),
        F.struct(
            F.col("player_id").alias("id"),
            F.col("web_name"),
            F.col("team_id").alias("team"),
            F.col("position_id").alias("element_type"),
            F.round(F.col("now_cost") * 10).cast("int").alias("now_cost"),
            form.alias("form"),
            F.round(F.col("total_points")).cast("int").alias("total_points"),
            F.col("minutes_played").cast("int").alias("minutes"),
            "goals_scored", "assists", "clean_sheets", "bonus",
            F.concat(F.lit("F"), key.cast("string")).alias("first_name"),
            F.concat(F.lit("S"), key.cast("string")).alias("second_name"),
            F.when(key % 7 == 0, F.lit("")).otherwise(F.concat((key % 100).cast("string"), F.lit(".5"))).alias("selected_by_percent"),
            F.concat((key % 13).cast("string"), F.lit(".25")).alias("value_season"),
            F.when(key % 11 == 0, F.lit("n/a")).otherwise(F.concat((key % 5).cast("string"), F.lit(".75"))).alias("value_form"),
            (F.col("minutes_played").cast("int") % 4).alias("goals_conceded"),
            (F.col("minutes_played").cast("int") * 2 + F.col("gameweek_id")).alias("bps"),
            F.when(key % 5 == 0, F.lit("i")).otherwise(F.lit("a")).alias("status"),
            F.when(key % 3 != 0, (key % 4).cast("int") * 25).alias("chance_of_playing_next_round"),
        ).alias("el"),
    )


# Fixed field names of the API's teams and events.
TEAM_STRENGTHS = ("strength_overall_home", "strength_overall_away", "strength_attack_home", "strength_attack_away",
                  "strength_defence_home", "strength_defence_away")
PERIOD_PICKS = ("most_selected", "most_transferred_in", "most_captained", "most_vice_captained")

ALL_KINDS = ("elements", "teams", "events", "fixtures", "history")


def land_raw_documents(spark: SparkSession, sf_dir: str, path: str | None = None,
                       kinds: tuple[str, ...] = ALL_KINDS, malformed: bool = False) -> str:
    """Write the envelopes (bootstrap elements / teams / events, fixtures,
    element-summary history) as JSON lines; returns the folder.  ``kinds``
    lands only the document kinds a caller reads; ``malformed`` truncates the
    first chunk of every seventh period's elements."""
    path = path or scratch_path(spark, "raw_docs")
    el = bootstrap_elements(spark, sf_dir)
    ev_days = tb.read_table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").cast("int").alias("gw")).agg(
        F.min("ts").alias("first_ts")
    )
    fetched = F.concat(F.lit("2024-02-01T06:00:"), F.lpad((F.col("event") % 60).cast("string"), 2, "0"), F.lit("Z"))

    boot = el.groupBy("event", "chunk").agg(F.sort_array(F.collect_list("el")).alias("elements"))
    line = _envelope(F.struct("event", "chunk", "elements"), "bootstrap-static", fetched,
                     F.concat_ws("-", F.col("event").cast("string"), F.col("chunk").cast("string")))
    bad = F.lit(malformed) & (F.col("event") % MALFORMED_EVERY == 0) & (F.col("chunk") == 0)
    boot_lines = boot.select(F.when(bad, F.substring(line, 1, 60)).otherwise(line).alias("value"))

    t = tb.team_dim(spark, sf_dir).select(
        F.struct(
            F.col("team_id").alias("id"), "name", "short_name", "strength",
            F.when(F.col("team_id") % 4 == 0, F.lit("")).otherwise(F.concat(F.col("strength").cast("string"), F.lit(".0"))).alias("form"),
            (F.col("team_id") * 3).alias("points"),
            (F.col("team_id") + 1).alias("position"),
            *[(F.col("team_id") * k + 1000).alias(c) for k, c in enumerate(TEAM_STRENGTHS, 1)],
        ).alias("t")
    )
    teams_lines = t.agg(F.sort_array(F.collect_list("t")).alias("teams")).select(
        _envelope(F.struct("teams"), "bootstrap-static", F.lit("2024-02-01T06:00:00Z"), F.lit("teams")).alias("value")
    )

    mx = ev_days.agg(F.max("gw").alias("mx"))
    evs = attach_row(ev_days, mx).select(
        F.struct(
            F.col("gw").alias("id"),
            F.concat(F.lit("Gameweek "), F.col("gw").cast("string")).alias("name"),
            _iso(F.col("first_ts")).alias("deadline_time"),
            (F.col("gw") < F.col("mx") - 3).alias("finished"),
            (F.col("gw") == F.col("mx") - 3).alias("is_current"),
            (F.col("gw") == F.col("mx") - 2).alias("is_next"),
            (F.col("gw") == F.col("mx") - 4).alias("is_previous"),
            (F.col("gw") * 7).alias("highest_score"),
            F.when(F.col("gw") < F.col("mx") - 3, F.col("gw") * 3).alias("average_entry_score"),
            *[(F.col("gw") * k).alias(c) for k, c in enumerate(PERIOD_PICKS, 11)],
        ).alias("e")
    )
    events_lines = evs.agg(F.sort_array(F.collect_list("e")).alias("events")).select(
        _envelope(F.struct("events"), "bootstrap-static", F.lit("2024-02-01T06:00:00Z"), F.lit("events")).alias("value")
    )

    m = tb.matches(spark, sf_dir)
    o = tb.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    fx = m.join(o, m.fixture_id == o.o_orderkey).select(
        F.floor(F.col("fixture_id") / FIXTURE_CHUNK).cast("bigint").alias("chunk"),
        F.struct(
            F.col("fixture_id").alias("id"),
            ((F.year("kickoff_time") - 1995) * 12 + F.month("kickoff_time")).cast("int").alias("event"),
            _iso(F.col("kickoff_time")).alias("kickoff_time"),
            "team_h", "team_a",
            (F.col("fixture_id") % 5).cast("int").alias("team_h_score"),
            (F.col("o_custkey") % 4).cast("int").alias("team_a_score"),
            "finished",
            F.lit(True).alias("started"),
        ).alias("f"),
    )
    fx_docs = fx.groupBy("chunk").agg(F.sort_array(F.collect_list("f")).alias("fixtures"))
    fixtures_lines = fx_docs.select(
        F.to_json(
            F.struct(
                F.col("fixtures").alias("data"),
                F.struct(F.lit("fixtures").alias("endpoint_name"),
                         F.concat(F.lit("https://api.example.invalid/fixtures/"), F.col("chunk").cast("string")).alias("url"),
                         F.lit("2024-02-01T06:00:00Z").alias("fetch_timestamp"), F.lit(200).alias("status_code"),
                         F.octet_length(F.to_json(F.col("fixtures"))).alias("response_size_bytes")).alias("metadata"),
            )
        ).alias("value")
    )

    hist = el.select(
        F.col("el.id").alias("pid"),
        F.struct(F.col("el.id").alias("element"), F.col("event").alias("round"), F.col("el.total_points"),
                 F.col("el.minutes")).alias("h"),
    ).groupBy("pid").agg(F.sort_array(F.collect_list("h")).alias("history"))
    hist_lines = hist.select(
        _envelope(F.struct("history"), "element-summary", F.lit("2024-02-01T06:00:00Z"), F.col("pid")).alias("value")
    )

    parts = {"elements": boot_lines, "teams": teams_lines, "events": events_lines, "fixtures": fixtures_lines,
             "history": hist_lines}
    out = None
    for k in kinds:
        out = parts[k] if out is None else out.unionByName(parts[k])
    out.write.mode("overwrite").text(path)
    return path
