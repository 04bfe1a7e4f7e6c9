"""Table maintenance on plain parquet (K1-K7).

Parquet has no MERGE or primary keys, so the reference's warehouse verbs are
re-expressed as DataFrame plans that write a *new* version folder (never
overwrite a path that is being read):

* upsert = dedupe source on the key (latest wins) -> full outer join on the
  key -> source values where matched, target values otherwise (K4);
* append-only history = drop auto columns, stamp, append partitioned by
  period (K5); replacing one period = dynamic partition overwrite (K6);
* additive evolution = ``unionByName(allowMissingColumns=True)`` and
  ``mergeSchema`` on read (K7);
* typed tables = fixed schemas -> ``StructType``; first NOT NULL column is
  the key, enforced by validation (K1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import scratch_path

# Fixed values of the reference: the six typed table schemas (name, type).
TABLE_SCHEMAS: dict[str, tuple[tuple[str, str], ...]] = {
    "players": (
        ("player_id", "INTEGER NOT NULL"), ("web_name", "VARCHAR(100)"), ("first_name", "VARCHAR(100)"),
        ("second_name", "VARCHAR(100)"), ("team_id", "INTEGER"), ("position_id", "INTEGER"), ("now_cost", "INTEGER"),
        ("selected_by_percent", "FLOAT"), ("form", "FLOAT"), ("value_season", "FLOAT"), ("value_form", "FLOAT"),
        ("total_points", "INTEGER"), ("minutes", "INTEGER"), ("goals_scored", "INTEGER"), ("assists", "INTEGER"),
        ("clean_sheets", "INTEGER"), ("goals_conceded", "INTEGER"), ("bonus", "INTEGER"), ("bps", "INTEGER"),
        ("status", "VARCHAR(10)"), ("chance_of_playing_next_round", "INTEGER"),
        ("ingestion_timestamp", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"), ("gameweek_fetched", "INTEGER"),
    ),
    "players_gameweek_snapshot": (
        ("snapshot_id", "INTEGER AUTOINCREMENT NOT NULL"), ("player_id", "INTEGER"), ("web_name", "VARCHAR(100)"),
        ("first_name", "VARCHAR(100)"), ("second_name", "VARCHAR(100)"), ("team_id", "INTEGER"), ("position_id", "INTEGER"),
        ("now_cost", "INTEGER"), ("selected_by_percent", "FLOAT"), ("form", "FLOAT"), ("value_season", "FLOAT"),
        ("value_form", "FLOAT"), ("total_points", "INTEGER"), ("minutes", "INTEGER"), ("goals_scored", "INTEGER"),
        ("assists", "INTEGER"), ("clean_sheets", "INTEGER"), ("goals_conceded", "INTEGER"), ("bonus", "INTEGER"),
        ("bps", "INTEGER"), ("status", "VARCHAR(10)"), ("chance_of_playing_next_round", "INTEGER"),
        ("gameweek_fetched", "INTEGER"), ("ingestion_timestamp", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"),
    ),
    "teams": (
        ("team_id", "INTEGER NOT NULL"), ("name", "VARCHAR(100)"), ("short_name", "VARCHAR(10)"), ("strength", "INTEGER"),
        ("form", "FLOAT"), ("points", "INTEGER"), ("position", "INTEGER"), ("strength_overall_home", "INTEGER"),
        ("strength_overall_away", "INTEGER"), ("strength_attack_home", "INTEGER"), ("strength_attack_away", "INTEGER"),
        ("strength_defence_home", "INTEGER"), ("strength_defence_away", "INTEGER"),
        ("ingestion_timestamp", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"),
    ),
    "gameweeks": (
        ("gameweek_id", "INTEGER NOT NULL"), ("name", "VARCHAR(50)"), ("deadline_time", "TIMESTAMP_NTZ"),
        ("finished", "BOOLEAN"), ("is_current", "BOOLEAN"), ("is_next", "BOOLEAN"), ("is_previous", "BOOLEAN"),
        ("average_entry_score", "INTEGER"), ("highest_score", "INTEGER"), ("most_selected", "INTEGER"),
        ("most_transferred_in", "INTEGER"), ("most_captained", "INTEGER"), ("most_vice_captained", "INTEGER"),
        ("ingestion_timestamp", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"),
    ),
    "fixtures": (
        ("fixture_id", "INTEGER NOT NULL"), ("gameweek_id", "INTEGER"), ("kickoff_time", "TIMESTAMP_NTZ"),
        ("team_h", "INTEGER"), ("team_a", "INTEGER"), ("team_h_score", "INTEGER"), ("team_a_score", "INTEGER"),
        ("finished", "BOOLEAN"), ("started", "BOOLEAN"), ("ingestion_timestamp", "TIMESTAMP_NTZ DEFAULT CURRENT_TIMESTAMP()"),
    ),
    "recommended_squad": (
        ("recommendation_key", "VARCHAR(100) NOT NULL"), ("recommended_at", "TIMESTAMP_NTZ"),
        ("backfill_method", "VARCHAR(100)"), ("backfill_trusted", "BOOLEAN"), ("backfill_validation_status", "VARCHAR(50)"),
        ("backfill_validation_details", "VARCHAR(500)"), ("backfill_validation_version", "VARCHAR(50)"),
        ("backfill_validated_at", "TIMESTAMP_NTZ"), ("backfill_train_max_target_gw", "INTEGER"),
        ("backfill_inference_max_source_gw", "INTEGER"), ("player_id", "INTEGER"), ("web_name", "VARCHAR(100)"),
        ("position_id", "INTEGER"), ("team_id", "INTEGER"), ("now_cost", "FLOAT"), ("gameweek_id", "INTEGER"),
        ("expected_points_next_gw", "FLOAT"), ("expected_points_5_gw", "FLOAT"), ("is_in_squad", "BOOLEAN"),
        ("is_starter", "BOOLEAN"), ("is_captain", "BOOLEAN"), ("is_vice_captain", "BOOLEAN"),
    ),
}
# Tables whose upsert also refreshes ingestion_timestamp.
TIMESTAMPED_UPSERT = ("players", "teams", "gameweeks", "fixtures")
AUTO_COLUMNS = ("snapshot_id", "ingestion_timestamp")


def _spark_type(decl: str) -> T.DataType:
    d = decl.upper()
    if d.startswith("INTEGER"):
        return T.LongType() if "AUTOINCREMENT" in d else T.IntegerType()
    if d.startswith("FLOAT"):
        return T.DoubleType()
    if d.startswith("VARCHAR"):
        return T.StringType()
    if d.startswith("BOOLEAN"):
        return T.BooleanType()
    if d.startswith("TIMESTAMP"):
        return T.TimestampNTZType()
    raise ValueError(f"unsupported column type {decl}")


def table_schema(table: str) -> T.StructType:
    """K1: fixed schema -> StructType (NOT NULL -> nullable=False)."""
    if table not in TABLE_SCHEMAS:
        raise ValueError(f"Unknown table: {table}")
    return T.StructType([T.StructField(n, _spark_type(t), "NOT NULL" not in t.upper()) for n, t in TABLE_SCHEMAS[table]])


def primary_key(table: str) -> str | None:
    """First NOT NULL column is the key."""
    for n, t in TABLE_SCHEMAS[table]:
        if "NOT NULL" in t.upper():
            return n
    return None


def create_table_sql(table: str, location: str) -> str:
    """K1 as Spark SQL DDL (parquet table, no PK constraint available)."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(table).fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet LOCATION '{location}'"


def conform(df: DataFrame, table: str, load_ts: Column | None = None) -> DataFrame:
    """K1: project ``df`` onto the typed schema: casts, missing columns NULL,
    defaults for the auto columns, rows with a NULL key flagged out."""
    schema = table_schema(table)
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name == "ingestion_timestamp":
            c = load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz")
        elif f.name == "snapshot_id":
            c = F.xxhash64(*[F.col(x) for x in ("player_id", "gameweek_fetched") if x in have])
        elif f.name in have:
            c = F.col(f.name).try_cast(f.dataType)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    out = df.select(*cols)
    pk = primary_key(table)
    return out.filter(F.col(pk).isNotNull()) if pk else out


def dedupe_latest(df: DataFrame, key: Sequence[str], order: str | None) -> DataFrame:
    """Source de-duplication before a merge: latest ``order`` wins per key."""
    if order is None:
        return df.dropDuplicates(list(key))
    others = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*others), F.struct(F.col(order), *[F.col(c) for c in others if c != order]))
    return df.groupBy(*key).agg(best.alias("__b")).select(*key, *[F.col(f"__b.{c}").alias(c) for c in others])


def merge_upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: str | None = None,
                 stamp: Column | None = None) -> DataFrame:
    """K4: MERGE emulation.  Matched -> every non-key column from the source
    (missing source columns -> NULL), not matched -> insert, other target
    rows untouched.  Adds ``merge_action``.  Write the result to a new
    version folder; never over the path being read."""
    key = list(key)
    src = dedupe_latest(source, key, order)
    cols = [c for c in target.columns if c not in key]
    s = src.select(*[F.col(k).alias(f"__s_{k}") for k in key],
                   *[(F.col(c) if c in src.columns else F.lit(None).cast(target.schema[c].dataType)).alias(f"__s_{c}") for c in cols],
                   F.lit(True).alias("__in_s"))
    t = target.select(*[F.col(k).alias(f"__t_{k}") for k in key], *[F.col(c).alias(f"__t_{c}") for c in cols],
                      F.lit(True).alias("__in_t"))
    cond = None
    for k in key:
        e = F.col(f"__s_{k}") == F.col(f"__t_{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    in_s, in_t = F.col("__in_s").isNotNull(), F.col("__in_t").isNotNull()
    out = [F.when(in_s, F.col(f"__s_{k}")).otherwise(F.col(f"__t_{k}")).alias(k) for k in key]
    for c in cols:
        v = F.when(in_s, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}"))
        if c == "ingestion_timestamp" and stamp is not None:
            v = F.when(in_s, stamp).otherwise(F.col(f"__t_{c}"))
        out.append(v.alias(c))
    action = F.when(in_s & in_t, "updated").when(in_s, "inserted").otherwise("untouched")
    return j.select(*out, action.alias("merge_action"))


def append_history(df: DataFrame, path: str, period: str = "gameweek_fetched", load_ts: Column | None = None) -> str:
    """K5: drop auto columns, stamp defaults, append partitioned by period."""
    d = df.drop(*[c for c in AUTO_COLUMNS if c in df.columns])
    keys = [c for c in ("player_id", period) if c in d.columns]
    d = d.withColumns(
        {
            "snapshot_id": F.xxhash64(*[F.col(k) for k in keys]),
            "ingestion_timestamp": load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz"),
        }
    )
    d.write.mode("append").partitionBy(period).parquet(path)
    return path


def replace_periods(df: DataFrame, path: str, period: str = "gameweek_fetched") -> str:
    """K6: delete-then-load of the periods present in ``df`` = dynamic
    partition overwrite (only those partitions are replaced)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)
    return path


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """K7: additive schema evolution: columns missing on either side -> NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def append_raw_documents(env: DataFrame, root: str | None = None) -> DataFrame:
    """K3 / K2: append parsed documents to the raw table and the malformed
    ones to a quarantine folder (per-record isolation: a bad document never
    fails the batch); returns total / success / failed read back from what
    was written."""
    spark = env.sparkSession
    root = root or scratch_path(spark, "raw_table")
    good = env.filter("is_valid").select(
        F.col("line").alias("data"), F.col("url").alias("source_url"), F.col("endpoint_name"),
        F.try_to_timestamp(F.regexp_replace("fetch_timestamp", "Z$", "")).cast("timestamp_ntz").alias("ingestion_timestamp"),
    )
    bad = env.filter(~F.col("is_valid")).select(F.col("line").alias("data"), F.col("source_file"))
    good.write.mode("append").partitionBy("endpoint_name").parquet(f"{root}/raw")
    bad.write.mode("append").parquet(f"{root}/quarantine")
    ok = spark.read.parquet(f"{root}/raw").agg(F.count(F.lit(1)).alias("success"))
    ko = spark.read.parquet(f"{root}/quarantine").agg(F.count(F.lit(1)).alias("failed"))
    from panelforge.operators.common import attach_row

    return attach_row(ok, ko).select((F.col("success") + F.col("failed")).alias("total"), "success", "failed")


def lower_case_scan(spark: SparkSession, name: str) -> DataFrame:
    """S3: table scan with lower-cased column names; the identifier is
    validated first (letters, digits, underscore, dot)."""
    import re

    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}", name):
        raise ValueError(f"invalid table identifier: {name!r}")
    df = spark.table(name)
    return df.toDF(*[c.lower() for c in df.columns])


def append_event_log(df: DataFrame, path: str) -> str:
    """Append event records (run_id, node, state, duration_ms, status,
    detail JSON) as JSON lines; sensitive keys in ``detail`` are redacted at any
    depth, with all that is nested under them."""
    from panelforge.sources.json_docs import redact_json_deep

    out = df.withColumn("detail", redact_json_deep(F.col("detail"))) if "detail" in df.columns else df
    out.withColumn("timestamp_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).write.mode(
        "append"
    ).json(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """A (small, one-row or per-period) report as JSON files."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
