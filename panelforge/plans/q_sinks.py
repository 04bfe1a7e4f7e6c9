"""Registered queries: typed tables, upsert, history, evolution, scans and
snapshots (K1, K3-K8, K10, S3-S5, S8, A19, A22, P32, P33, V1, A15)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.operators import features as fe
from panelforge.operators import quality as qu
from panelforge.operators.common import attach_row, materialize, round_doubles
from panelforge.plans.q_ingest import PLAYER_SQL, env
from panelforge.plans.q_split import targeted
from panelforge.plans.registry import register, rsql
from panelforge.plans.sqlparts import with_panel
from panelforge.session import scratch_path
from panelforge.sources import json_docs as jd
from panelforge.sources import sinks as sk
from panelforge.sources import snapshot as sn
from panelforge.sources import tables as tb

LOAD_TS = "2024-02-01 06:00:00"
COLLAPSED_COLS = ("player_id gameweek_id web_name fixture_id position_id team_id total_points minutes_played goals_scored "
                  "assists clean_sheets bonus yellow_cards ict_index now_cost").split()
COLLAPSED_DOUBLES = {"total_points", "minutes_played", "ict_index", "now_cost"}


def collapsed(spark, sf):
    return fe.collapse_periods(tb.fixture_rows(spark, sf))


def _load_ts():
    return F.lit(LOAD_TS).cast("timestamp_ntz")


def _canon_sql(cols=COLLAPSED_COLS, doubles=COLLAPSED_DOUBLES) -> str:
    parts = []
    for c in cols:
        v = f"CAST(CAST(round({c} * 1e6) AS DECIMAL(38, 0)) AS VARCHAR)" if c in doubles else f"CAST({c} AS VARCHAR)"
        parts.append(f"COALESCE(CAST(length({v}) AS VARCHAR) || ':' || {v}, '-')")
    return " || ".join(parts)


def _fp_sql(src: str) -> str:
    part = "CAST(COALESCE(sum(CAST(CAST(('0x' || substr(h, {at}, 15)) AS BIGINT) AS DECIMAL(38, 0))), 0) AS VARCHAR)"
    return f"""SELECT count(*) AS row_count,
       sha256(CAST(count(*) AS VARCHAR) || ':' || {part.format(at=1)} || ':' || {part.format(at=16)}) AS content_hash
FROM (SELECT sha256({_canon_sql()}) AS h FROM {src}) x"""


@register(
    "dataset_fingerprint",
    "A22",
    with_panel() + "\n" + _fp_sql("collapsed"),
)
def q_fingerprint(spark, sf):
    return qu.dataset_fingerprint(collapsed(spark, sf), digits=6)


@register(
    "row_fingerprint",
    "P32 F14",
    with_panel() + f"\nSELECT player_id, gameweek_id, sha256({_canon_sql()}) AS row_hash FROM collapsed",
)
def q_row_fingerprint(spark, sf):
    c = collapsed(spark, sf)
    return c.select("player_id", "gameweek_id", qu.row_fingerprint(c, digits=6).alias("row_hash"))


_FAMILY = """CASE WHEN typeof({c}) IN ('TINYINT','SMALLINT','INTEGER','BIGINT','HUGEINT') THEN 'integer'
     WHEN typeof({c}) IN ('FLOAT','DOUBLE') OR typeof({c}) LIKE 'DECIMAL%' THEN 'number'
     WHEN typeof({c}) = 'BOOLEAN' THEN 'boolean'
     WHEN typeof({c}) LIKE 'TIMESTAMP%' OR typeof({c}) = 'DATE' THEN 'datetime' ELSE 'string' END"""


@register(
    "column_contract",
    "P33 F3",
    with_panel()
    + ",\none AS (SELECT * FROM collapsed LIMIT 1)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{e}' AS expected, {_FAMILY.format(c=c)} AS observed, true AS present, "
        + (f"{_FAMILY.format(c=c)} IN ('integer','number') AS ok" if e == "number" else f"{_FAMILY.format(c=c)} = '{e}' AS ok")
        + " FROM one"
        for c, e in qu.REQUIRED_COLUMN_FAMILY
    ),
)
def q_column_contract(spark, sf):
    return qu.column_contract(collapsed(spark, sf))


VALID_CTES = """
v_one AS (SELECT * FROM targeted LIMIT 1),
v_agg AS (SELECT count(*) AS n, count_if(target_next_gw_points IS NULL) AS n1, count_if(player_id IS NULL) AS n2,
                 count_if(gameweek_id IS NULL) AS n3, count_if(target_gameweek_id < gameweek_id) AS leak,
                 (SELECT count(*) FROM (SELECT 1 FROM targeted GROUP BY player_id, gameweek_id) g) AS groups
          FROM targeted),
vrows AS (
""" + "\nUNION ALL\n".join(
    [f"SELECT 'required' AS check, '{c}' AS column_name, 1.0 AS observed_value, 1.0 AS limit_value, "
     f"CAST(NULL AS VARCHAR) AS observed_text, CAST(NULL AS VARCHAR) AS expected_text, true AS ok"
     for c in qu.SchemaRules().required_columns]
    + [f"SELECT 'dtype', '{c}', NULL, NULL, {_FAMILY.format(c=c)}, '{e}', "
       + (f"{_FAMILY.format(c=c)} IN ('integer','number')" if e == "number" else f"{_FAMILY.format(c=c)} = '{e}'")
       + " FROM v_one"
       for c, e in qu.SchemaRules().dtypes]
    + [f"SELECT 'null_ratio', '{c}', CASE WHEN n > 0 THEN {v} / n ELSE 0.0 END, 0.0, NULL, NULL, "
       f"CASE WHEN n > 0 THEN {v} / n ELSE 0.0 END <= 0.0 FROM v_agg"
       for c, v in (("target_next_gw_points", "n1"), ("player_id", "n2"), ("gameweek_id", "n3"))]
    + ["SELECT 'duplicate_ratio', 'player_id,gameweek_id', (n - groups) / n, 0.01, NULL, NULL, (n - groups) / n <= 0.01 FROM v_agg",
       "SELECT 'temporal_leakage', 'gameweek_id->target_gameweek_id', leak, 0.0, NULL, NULL, leak = 0 FROM v_agg"]
) + ")"


@register(
    "validation_report",
    "V1 A14 A16",
    rsql(with_panel(VALID_CTES) + "\nSELECT * FROM vrows", ["observed_value", "limit_value"]),
)
def q_validation(spark, sf):
    return round_doubles(qu.validation_report(targeted(spark, sf)))


@register(
    "duplicate_key_ratio",
    "A15 C13",
    rsql(
        """
WITH a AS (SELECT count(*) AS n_rows FROM lineitem),
g AS (SELECT count(*) AS n_groups FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber) x)
SELECT n_rows, n_groups, (n_rows - n_groups) / n_rows AS duplicate_ratio, 0.01 AS max_ratio,
       (n_rows - n_groups) / n_rows <= 0.01 AS ok FROM a, g""",
        ["duplicate_ratio", "max_ratio"],
    ),
)
def q_dup_ratio(spark, sf):
    return round_doubles(qu.duplicate_key_ratio(tb.dup_keys(spark, sf), ["l_orderkey", "l_linenumber"]))


# ------------------------------------------------------------------ typed tables & sinks

def _typed_players_sql() -> str:
    sel = []
    src = {"player_id": "CAST(player_id AS INTEGER)", "web_name": "web_name", "team_id": "team_id",
           "position_id": "position_id", "now_cost": "now_cost", "form": "form", "total_points": "total_points",
           "minutes": "minutes", "goals_scored": "goals_scored", "assists": "assists", "clean_sheets": "clean_sheets",
           "bonus": "bonus", **{c: c for c in ("first_name", "second_name", "selected_by_percent", "value_season", "value_form", "goals_conceded", "bps", "status",
                                              "chance_of_playing_next_round")}, "gameweek_fetched": "gameweek_fetched",
           "ingestion_timestamp": f"TIMESTAMP '{LOAD_TS}'"}
    for f in sk.table_schema("players").fields:
        t = {"int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}[f.dataType.simpleString()]
        sel.append(f"CAST({src.get(f.name, 'NULL')} AS {t}) AS {f.name}")
    return with_panel() + ",\np AS (" + PLAYER_SQL + ")\nSELECT " + ", ".join(sel) + " FROM p"


@register("typed_schema_conform", "K1", _typed_players_sql())
def q_typed_conform(spark, sf):
    return sk.conform(jd.parse_players(env(spark, sf, ("elements",))), "players", load_ts=_load_ts())


_MERGE_SQL = """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal * 0.9 AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0)
SELECT COALESCE(s.c_custkey, t.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       CASE WHEN s.c_custkey IS NOT NULL AND t.c_custkey IS NOT NULL THEN 'updated'
            WHEN s.c_custkey IS NOT NULL THEN 'inserted' ELSE 'untouched' END AS merge_action
FROM t FULL OUTER JOIN s ON s.c_custkey = t.c_custkey"""


@register("merge_upsert", "K4 J3 Q14", rsql(_MERGE_SQL, ["c_acctbal"]))
def q_merge(spark, sf):
    c = tb.read_table(spark, sf, "customer")
    tgt = c.filter(F.col("c_custkey") % 3 != 0).withColumn("c_acctbal", F.col("c_acctbal") * 0.9)
    src = c.filter((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 3 == 0))  # every key is in one of them at least
    merged = sk.merge_upsert(tgt, src, ["c_custkey"])
    path = scratch_path(spark, "merge_v")
    merged.write.parquet(path)  # new version folder; the inputs are never overwritten
    return round_doubles(spark.read.parquet(path))


@register(
    "append_history",
    "K5",
    with_panel()
    + """
SELECT gameweek_id AS gameweek_fetched, count(*) AS n_rows, CAST(sum(CAST(round(total_points) AS INTEGER)) AS BIGINT) AS points,
       count(DISTINCT player_id) AS n_players
FROM collapsed GROUP BY gameweek_id""",
)
def q_append_history(spark, sf):
    players = jd.parse_players(env(spark, sf, ("elements",)))
    path = scratch_path(spark, "history")
    sk.append_history(players.filter(F.col("gameweek_fetched") <= 15), path, load_ts=_load_ts())
    sk.append_history(players.filter(F.col("gameweek_fetched") > 15), path, load_ts=_load_ts())
    h = spark.read.parquet(path)
    return h.groupBy("gameweek_fetched").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_points").cast("bigint").alias("points"),
        F.countDistinct("snapshot_id").alias("n_players"),
    )


@register(
    "replace_period",
    "K6",
    with_panel()
    + """,
p AS (SELECT gameweek_id, player_id, CAST(round(total_points) AS INTEGER) AS tp FROM collapsed),
mx AS (SELECT max(gameweek_id) AS m FROM p),
final AS (SELECT gameweek_id, tp FROM p, mx WHERE gameweek_id <> m
          UNION ALL SELECT gameweek_id, tp * 2 FROM p, mx WHERE gameweek_id = m AND player_id % 2 = 0)
SELECT gameweek_id AS gameweek_fetched, count(*) AS n_rows, CAST(sum(tp) AS BIGINT) AS points FROM final GROUP BY gameweek_id""",
)
def q_replace_period(spark, sf):
    players = jd.parse_players(env(spark, sf, ("elements",))).select("player_id", "total_points", "gameweek_fetched")
    path = scratch_path(spark, "history")
    players.write.partitionBy("gameweek_fetched").parquet(path)
    h0 = spark.read.parquet(path)
    mx = h0.agg(F.max("gameweek_fetched").alias("__mx"))
    redo = (
        attach_row(h0, mx)
        .filter((F.col("gameweek_fetched") == F.col("__mx")) & (F.col("player_id") % 2 == 0))
        .drop("__mx")
        .withColumn("total_points", F.col("total_points") * 2)
    )
    # The new rows are read from the folder being overwritten: checkpoint them
    # first so the overwrite never reads its own output.
    sk.replace_periods(materialize(redo), path)
    h = spark.read.parquet(path)
    return h.groupBy("gameweek_fetched").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_points").cast("bigint").alias("points"))


@register(
    "schema_evolve_union",
    "K7",
    """
SELECT n_nationkey AS team_id, n_name AS name FROM nation WHERE n_nationkey % 2 = 0
UNION ALL BY NAME
SELECT n_nationkey AS team_id, n_name AS name, 'pit_backfill' AS backfill_method, n_regionkey > 1 AS backfill_trusted
FROM nation WHERE n_nationkey % 2 = 1""",
)
def q_evolve(spark, sf):
    t = tb.team_dim(spark, sf).select("team_id", "name")
    old = t.filter(F.col("team_id") % 2 == 0)
    new = tb.team_dim(spark, sf).filter(F.col("team_id") % 2 == 1).select(
        "team_id", "name", F.lit("pit_backfill").alias("backfill_method"), (F.col("strength") > 1).alias("backfill_trusted")
    )
    path = scratch_path(spark, "evolve")
    old.write.parquet(f"{path}/part=old")
    new.write.parquet(f"{path}/part=new")
    return spark.read.option("mergeSchema", "true").parquet(path).drop("part").select(
        "team_id", "name", "backfill_method", "backfill_trusted"
    )


@register("table_scan_lower", "S3 F7", "SELECT * FROM customer")
def q_scan_lower(spark, sf):
    c = tb.read_table(spark, sf, "customer")
    view = "pf_customer_upper_" + scratch_path(spark, "v").rsplit("-", 1)[-1]
    c.toDF(*[x.upper() for x in c.columns]).createOrReplaceTempView(view)
    return sk.lower_case_scan(spark, view)


@register("snapshot_scan", "S4", rsql(with_panel() + "\nSELECT * FROM collapsed", sorted(COLLAPSED_DOUBLES)))
def q_snapshot_scan(spark, sf):
    root = scratch_path(spark, "snap")
    path, _ = sn.write_snapshot(collapsed(spark, sf), root, created_at="2024-02-01T06:00:00Z", source="events",
                                query_text="collapse(events)", run_id="run-1")
    return round_doubles(spark.read.parquet(path))


@register("csv_roundtrip", "S5", rsql(with_panel() + "\nSELECT * FROM collapsed", sorted(COLLAPSED_DOUBLES)))
def q_csv(spark, sf):
    c = collapsed(spark, sf)
    path = scratch_path(spark, "csv")
    c.write.option("header", True).csv(path)
    return round_doubles(spark.read.option("header", True).schema(c.schema).csv(path))


@register(
    "snapshot_manifest",
    "K8 A19",
    with_panel()
    + ",\nfp AS (" + _fp_sql("collapsed") + ")"
    + """
SELECT '1.0.0' AS manifest_version, '1.0.0' AS schema_version, '2024-02-01T06:00:00Z' AS created_at_utc, 'events' AS source,
       fp.row_count, 15 AS column_count, (SELECT CAST(min(gameweek_id) AS INTEGER) FROM collapsed) AS min_gameweek,
       (SELECT CAST(max(gameweek_id) AS INTEGER) FROM collapsed) AS max_gameweek, true AS required_columns_present,
       fp.content_hash AS file_sha256
FROM fp""",
)
def q_manifest(spark, sf):
    root = scratch_path(spark, "snap")
    _, m = sn.write_snapshot(collapsed(spark, sf), root, created_at="2024-02-01T06:00:00Z", source="events",
                             query_text="collapse(events)", run_id="run-1", digits=6)
    return m.select(
        "manifest_version", "schema_version", "created_at_utc", "source", "row_count",
        F.col("column_count").cast("int"), F.col("min_gameweek").cast("int"), F.col("max_gameweek").cast("int"),
        "required_columns_present", "file_sha256",
    )


@register(
    "snapshot_acceptance",
    "S8 V7 K9 F9",
    rsql(
        with_panel()
        + ",\nfull_fp AS (" + _fp_sql("collapsed") + "),\npart_fp AS (" + _fp_sql("collapsed WHERE gameweek_id > 1") + ")"
        + """
SELECT 'fresh' AS scenario, true AS fields_ok, true AS schema_major_ok, 3.0 AS age_days, true AS fresh_ok, true AS hash_ok,
       true AS contract_ok, true AS contract_hash_ok, CAST(NULL AS VARCHAR) AS code, true AS accepted, true AS allow_fallback
UNION ALL
SELECT 'stale', true, true, 10.0, false, true, true, true, 'SNAPSHOT_STALE', false, true
UNION ALL
SELECT 'tampered', true, true, 3.0, true, f.content_hash = p.content_hash, true, true,
       CASE WHEN f.content_hash = p.content_hash THEN NULL ELSE 'SNAPSHOT_HASH_MISMATCH' END,
       f.content_hash = p.content_hash, true
FROM full_fp f, part_fp p""",
        ["age_days"],
    ),
)
def q_acceptance(spark, sf):
    root = scratch_path(spark, "snap")
    path, m = sn.write_snapshot(collapsed(spark, sf), root, created_at="2024-02-01T06:00:00Z", source="events",
                                query_text="collapse(events)", run_id="run-1")
    data = spark.read.parquet(path)
    fresh = sn.accept_snapshot(data, m, "2024-02-04 06:00:00").select(F.lit("fresh").alias("scenario"), "*")
    stale = sn.accept_snapshot(data, m, "2024-02-11 06:00:00").select(F.lit("stale").alias("scenario"), "*")
    tampered = sn.accept_snapshot(data.filter(F.col("gameweek_id") > 1), m, "2024-02-04 06:00:00").select(
        F.lit("tampered").alias("scenario"), "*"
    )
    return round_doubles(fresh.unionByName(stale).unionByName(tampered))


@register(
    "retention_plan",
    "K10 W14",
    with_panel()
    + """,
v AS (SELECT 'v' || lpad(CAST(gameweek_id AS VARCHAR), 2, '0') AS version,
             '2024-01-' || lpad(CAST(gameweek_id AS VARCHAR), 2, '0') || 'T06:00:00Z' AS created_at_utc,
             CAST(sum(count(*)) OVER (ORDER BY gameweek_id) AS BIGINT) AS row_count
      FROM collapsed GROUP BY gameweek_id),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY created_at_utc DESC, version DESC) AS INTEGER) AS rank_newest FROM v)
SELECT *, rank_newest <= 12 OR version = 'v01' AS keep FROM r""",
)
def q_retention(spark, sf):
    per = collapsed(spark, sf).groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("n"))
    g2 = F.lpad(F.col("gameweek_id").cast("string"), 2, "0")
    # one row per version (period): the windows below run over #periods rows
    v = per.select(
        F.concat(F.lit("v"), g2).alias("version"),
        F.concat(F.lit("2024-01-"), g2, F.lit("T06:00:00Z")).alias("created_at_utc"),
        F.sum("n").over(Window.orderBy("gameweek_id").rowsBetween(Window.unboundedPreceding, 0)).alias("row_count"),
    )
    return sn.retention_plan(v, keep=12, preserve="v01").withColumn("rank_newest", F.col("rank_newest").cast("int"))


@register(
    "retention_applied",
    "K10 K9 W14",
    with_panel()
    + """,
v AS (SELECT k, 'v=202402' || lpad(CAST(6 - k AS VARCHAR), 2, '0') || 'T060000' AS version,
             (SELECT count(*) FROM collapsed WHERE gameweek_id <= (SELECT max(gameweek_id) FROM collapsed) - k) AS row_count
      FROM range(0, 5) r(k))
SELECT version, CAST(row_count AS BIGINT) AS row_count, true AS refresh_skipped FROM v WHERE k < 2 OR k = 4""",
)
def q_retention_applied(spark, sf):
    """Five snapshots of the panel as it grew, the newest two and the preserved oldest kept:
    what is on disk afterwards. A second run removes nothing, and a refresh of the fresh
    newest one is skipped."""
    root, panel = scratch_path(spark, "versions"), materialize(collapsed(spark, sf))
    last = panel.agg(F.max("gameweek_id")).first()[0]  # one row
    for k in range(4, -1, -1):
        sn.write_snapshot(panel.filter(F.col("gameweek_id") <= last - k), root, created_at=f"2024-02-{6 - k:02d}T06:00:00Z", source="events",
                          query_text="collapse(events)", run_id=f"run-{k}")
    stamp = F.regexp_replace("created_at_utc", "[-:Z]", "")
    versions = sn.read_manifests(spark, root).select(F.concat(F.lit("v="), stamp).alias("version"), "created_at_utc")
    plan = materialize(sn.retention_plan(versions, keep=2, preserve="v=20240202T060000"))
    sn.apply_retention(spark, root, plan, preserve="v=20240202T060000")
    again = sn.apply_retention(spark, root, plan, preserve="v=20240202T060000")
    skipped = not sn.refresh_snapshot(spark, root, "2024-02-07 06:00:00", lambda: None) and not again
    left = F.regexp_extract(F.input_file_name(), "(v=[0-9T]+)", 1)
    files = spark.read.parquet(*[f"{root}/{v}" for v in sn.versions_on_disk(spark, root)])
    return files.groupBy(left.alias("version")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("refresh_skipped", F.lit(skipped))


@register(
    "event_log_append",
    "K12 P31",
    """
SELECT event_type AS node, count(*) AS n_rows, CAST(count_if(event_type = 'error') AS BIGINT) AS n_failed,
       CAST(0 AS BIGINT) AS leaked, 2 * count(*) AS redacted_values
FROM events GROUP BY event_type""",
)
def q_event_log_append(spark, sf):
    """The event log with secrets in its payload (plain and nested), appended
    as JSON lines in two loads and read back."""
    log = tb.event_log(spark, sf)
    detail = F.to_json(F.struct(F.col("node"), F.concat(F.lit("k-"), F.col("run_id").cast("string")).alias("api_key"),
                                F.struct(F.array(F.concat(F.lit("s3cr-"), F.col("node"))).alias("list")).alias("auth_tokens")))
    rows = log.select("run_id", "node", "status", "duration_ms", detail.alias("detail"))
    path = scratch_path(spark, "event_log")
    sk.append_event_log(rows.filter(F.col("run_id") % 2 == 0), path)
    sk.append_event_log(rows.filter(F.col("run_id") % 2 == 1), path)
    back = spark.read.schema("node string, status string, detail string").json(path)
    return back.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("detail").rlike("k-[0-9]|s3cr")).alias("leaked"),
        F.sum(F.size(F.split("detail", r"\[REDACTED\]")) - 1).cast("bigint").alias("redacted_values"))


@register(
    "report_sink",
    "K11",
    rsql(with_panel() + """
SELECT gameweek_id, count(*) AS n_rows, sum(total_points) AS points FROM collapsed GROUP BY gameweek_id""", ["points"]),
)
def q_report_sink(spark, sf):
    """A per-period report written as JSON and read back."""
    c = collapsed(spark, sf)
    report = round_doubles(c.groupBy("gameweek_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_points").alias("points")))
    path = sk.write_report(report, scratch_path(spark, "report"))
    return spark.read.schema(report.schema).json(path)


@register(
    "source_selection",
    "S9 S10 X1",
    with_panel() + """,
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE gameweek_id > 1) AS m FROM collapsed)
SELECT 'local' AS scenario, 'local' AS data_source_selected, false AS fallback_taken, CAST(NULL AS VARCHAR) AS fallback_reason, n AS n_rows FROM n
UNION ALL SELECT 'stale', 'remote', true, 'SNAPSHOT_STALE', m FROM n
UNION ALL SELECT 'missing', 'remote', true, 'SNAPSHOT_MISSING', m FROM n
UNION ALL SELECT 'remote', 'remote', false, NULL, m FROM n""",
)
def q_source_selection(spark, sf):
    """Which source a training run reads, by snapshot state, and the logged
    record of it; the remote rows are told apart by lacking the first period."""
    c = materialize(collapsed(spark, sf))
    root = scratch_path(spark, "snap")
    sn.write_snapshot(c, root, created_at="2024-02-01T06:00:00Z", source="events", query_text="collapse(events)", run_id="run-1")
    remote = lambda: c.filter(F.col("gameweek_id") > 1)
    out = None
    for scenario, source, where, now in (("local", "local", root, "2024-02-03 06:00:00"), ("stale", "local", root, "2024-03-03 06:00:00"),
                                         ("missing", "local", scratch_path(spark, "none"), "2024-02-03 06:00:00"), ("remote", "remote", None, "2024-02-03 06:00:00")):
        frame, meta = sn.load_training_frame(spark, source=source, local_root=where, now=now, remote_loader=remote, policy="LOCAL_THEN_REMOTE")
        log = sn.selection_log_row(spark, scenario, meta).select(
            F.col("context").alias("scenario"), *[F.get_json_object("detail", f"$.{k}").cast(t).alias(k) for k, t in
                                                  (("data_source_selected", "string"), ("fallback_taken", "boolean"), ("fallback_reason", "string"))])
        row = attach_row(log, frame.agg(F.count(F.lit(1)).alias("n_rows")))
        out = row if out is None else out.unionByName(row)
    return out
