"""Versioned snapshots with a manifest, retention and acceptance checks
(S4, S8, K8, K9, K10, A19, W14).

A snapshot version is a parquet folder ``<root>/v=<stamp>`` plus a one-row
manifest written as JSON under ``<root>/_manifests/v=<stamp>``.  The
manifest holds counts, columns, period range, the contract hash and an
order-independent content hash (``quality.dataset_fingerprint``), so a
reader can check a version without trusting file bytes or file order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.operators.common import attach_row
from panelforge.operators.quality import (
    REQUIRED_COLUMN_FAMILY,
    SCHEMA_VERSION,
    column_contract,
    contract_hash,
    dataset_fingerprint,
)

MANIFEST_VERSION = "1.0.0"
DEFAULT_MAX_AGE_DAYS = 8
DEFAULT_RETENTION = 12
# Fixed values of the reference: the 15 required manifest fields.
REQUIRED_MANIFEST_FIELDS = (
    "manifest_version", "schema_version", "created_at_utc", "source", "query_fingerprint", "row_count",
    "column_count", "columns", "dtypes", "min_gameweek", "max_gameweek", "required_columns_present",
    "contract_hash", "file_sha256", "refresh_run_id",
)


def build_manifest(df: DataFrame, *, created_at: str, source: str, query_text: str, run_id: str,
                   period: str = "gameweek_id", digits: int | None = None) -> DataFrame:
    """One-row manifest from aggregates over the snapshot data.
    ``file_sha256`` carries the content hash (order-independent; of values
    rounded to ``digits`` decimals if given)."""
    stats = df.agg(F.min(period).cast("int").alias("min_gameweek"), F.max(period).cast("int").alias("max_gameweek"))
    fp = dataset_fingerprint(df, digits=digits)
    present = column_contract(df).agg(F.bool_and("ok").alias("required_columns_present"))
    m = attach_row(attach_row(fp, stats), present)
    return m.select(
        F.lit(MANIFEST_VERSION).alias("manifest_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(created_at).alias("created_at_utc"),
        F.lit(source).alias("source"),
        F.sha2(F.lit(query_text), 256).alias("query_fingerprint"),
        F.col("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(f"{n}:{t}" for n, t in df.dtypes)).alias("dtypes"),
        "min_gameweek",
        "max_gameweek",
        "required_columns_present",
        F.lit(contract_hash(df)).alias("contract_hash"),
        F.col("content_hash").alias("file_sha256"),
        F.lit(run_id).alias("refresh_run_id"),
    )


def stamp_of(created_at: str) -> str:
    return created_at.replace("-", "").replace(":", "").replace("Z", "").replace("+0000", "")


def write_snapshot(df: DataFrame, root: str, *, created_at: str, source: str, query_text: str, run_id: str,
                   period: str = "gameweek_id", digits: int | None = None) -> tuple[str, DataFrame]:
    """K8: write the data version, then the manifest computed from the
    written files (so it describes what a reader will see)."""
    spark = df.sparkSession
    vpath = f"{root}/v={stamp_of(created_at)}"
    df.write.mode("errorifexists").parquet(vpath)
    written = spark.read.parquet(vpath)
    manifest = build_manifest(written, created_at=created_at, source=source, query_text=query_text, run_id=run_id,
                              period=period, digits=digits).withColumn("snapshot_path", F.lit(vpath))
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/_manifests/v={stamp_of(created_at)}")
    return vpath, spark.read.json(f"{root}/_manifests/v={stamp_of(created_at)}")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.json(f"{root}/_manifests")


def age_days(created_at: Column, now: Column) -> Column:
    created = F.to_timestamp(F.regexp_replace(created_at, "Z$", ""))
    return F.greatest(F.lit(0.0), (F.unix_timestamp(now) - F.unix_timestamp(created)) / 86400.0)


def is_fresh(manifests: DataFrame, now: str, max_age_days: int = DEFAULT_MAX_AGE_DAYS) -> DataFrame:
    """K9: the newest manifest is fresh -> a refresh can be skipped."""
    newest = manifests.agg(F.max_by(F.struct("*"), F.col("created_at_utc")).alias("m"))
    a = age_days(F.col("m.created_at_utc"), F.to_timestamp(F.lit(now)))
    return newest.select(F.col("m.created_at_utc").alias("created_at_utc"), a.alias("age_days"),
                         (a <= max_age_days).alias("skip_refresh"))


def retention_plan(versions: DataFrame, keep: int = DEFAULT_RETENTION, preserve: str | None = None,
                   order: str = "created_at_utc", key: str = "version") -> DataFrame:
    """Newest-first rank; keep the newest ``keep`` versions and
    always the ``preserve`` one.  The version list has one row per version
    (bounded), so the ordering window is small."""
    r = versions.withColumn("rank_newest", F.row_number().over(Window.orderBy(F.col(order).desc(), F.col(key).desc())))
    keep_c = F.col("rank_newest") <= keep
    if preserve is not None:
        keep_c = keep_c | (F.col(key) == preserve)
    return r.withColumn("keep", keep_c)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions_on_disk(spark: SparkSession, root: str) -> list[str]:
    """Names of the version folders below the snapshot root."""
    fs, at = _files(spark, root)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def apply_retention(spark: SparkSession, root: str, plan: DataFrame, preserve: str | None = None, key: str = "version", dry_run: bool = False) -> list[str]:
    """Remove the version folders that ``plan`` (``retention_plan``) doesn't keep;
    returns their names.

    The plan is written below the root first, so a run that stops in the middle can be
    repeated: folders that are gone are skipped.  Only names that are direct
    folders of the root are removed, never ``preserve`` and never a version that
    the plan doesn't know; a plan that keeps nothing is refused.  ``dry_run`` removes nothing.
    """
    rows = plan.select(key, "keep").collect()  # one row a version
    if not any(r["keep"] for r in rows):
        raise ValueError("a retention plan must keep a version")
    there = set(versions_on_disk(spark, root))
    there |= set(versions_on_disk(spark, f"{root}/_manifests"))
    gone = sorted(r[key] for r in rows if not r["keep"] and r[key] in there and r[key] != preserve)
    if dry_run or not gone:
        return gone
    plan.coalesce(1).write.mode("overwrite").json(f"{root}/_retention")
    fs, _ = _files(spark, root)
    for name in gone:
        for folder in (root, f"{root}/_manifests"):  # the data first: a manifest without data is found again, data without one is not
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), True)
    return gone


def refresh_snapshot(spark: SparkSession, root: str, now: str, write, max_age_days: int = DEFAULT_MAX_AGE_DAYS) -> bool:
    """K9: call ``write()`` unless the newest snapshot below ``root`` is still fresh; whether it was called."""
    if versions_on_disk(spark, root) and is_fresh(read_manifests(spark, root), now, max_age_days).first()["skip_refresh"]:
        return False
    write()
    return True


@dataclass(frozen=True)
class Acceptance:
    max_age_days: int = DEFAULT_MAX_AGE_DAYS
    schema_version: str = SCHEMA_VERSION


def accept_snapshot(data: DataFrame, manifest: DataFrame, now: str, rules: Acceptance = Acceptance(),
                    digits: int | None = None) -> DataFrame:
    """One row of checks on a (data, manifest) pair: required fields,
    schema major version, age, content hash, contract and contract hash;
    ``code`` names the first failure (the major-version failure is the one
    that must never fall back to another source)."""
    fields_ok = F.lit(all(f in manifest.columns for f in REQUIRED_MANIFEST_FIELDS))
    major = rules.schema_version.split(".")[0]
    fp = dataset_fingerprint(data, digits=digits).select(F.col("content_hash").alias("__actual_hash"))
    contract = column_contract(data).agg(F.bool_and("ok").alias("__contract_ok"))
    m = attach_row(attach_row(manifest, fp), contract)
    age = age_days(F.col("created_at_utc"), F.to_timestamp(F.lit(now)))
    checks = {
        "fields_ok": fields_ok,
        "schema_major_ok": F.split(F.col("schema_version"), r"\.").getItem(0) == major,
        "age_days": age,
        "fresh_ok": age <= rules.max_age_days,
        "hash_ok": F.col("file_sha256") == F.col("__actual_hash"),
        "contract_ok": F.col("__contract_ok"),
        "contract_hash_ok": F.col("contract_hash") == F.lit(contract_hash(data, rules.schema_version)),
    }
    out = m.select(*[v.alias(k) for k, v in checks.items()])
    code = (
        F.when(~F.col("fields_ok"), F.lit("MANIFEST_MISSING_FIELDS"))
        .when(~F.col("schema_major_ok"), F.lit("SCHEMA_MAJOR_MISMATCH"))
        .when(~F.col("fresh_ok"), F.lit("SNAPSHOT_STALE"))
        .when(~F.col("hash_ok"), F.lit("SNAPSHOT_HASH_MISMATCH"))
        .when(~F.col("contract_ok"), F.lit("CONTRACT_VALIDATION_FAILED"))
        .when(~F.col("contract_hash_ok"), F.lit("CONTRACT_HASH_MISMATCH"))
    )
    return out.withColumns({"code": code, "accepted": code.isNull(),
                            "allow_fallback": F.coalesce(code != "SCHEMA_MAJOR_MISMATCH", F.lit(True))})


__all__ = [
    "REQUIRED_COLUMN_FAMILY", "build_manifest", "write_snapshot", "read_manifests", "is_fresh",
    "retention_plan", "accept_snapshot", "Acceptance",
]


# ------------------------------------------------------------------ source selection

RECOVERABLE_CODES = ("SNAPSHOT_MISSING", "MANIFEST_MISSING", "MANIFEST_MISSING_FIELDS", "SNAPSHOT_STALE",
                     "SNAPSHOT_HASH_MISMATCH", "CONTRACT_VALIDATION_FAILED", "CONTRACT_HASH_MISMATCH")


def load_training_frame(spark: SparkSession, *, source: str, local_root: str | None, now: str,
                        remote_loader=None, policy: str = "LOCAL_ONLY",
                        max_age_days: int = DEFAULT_MAX_AGE_DAYS) -> tuple[DataFrame, dict]:
    """Choose the training source.  ``local``: newest snapshot version
    that passes acceptance; with policy ``LOCAL_THEN_REMOTE`` a recoverable
    failure falls back to ``remote_loader()`` (a callable returning a
    DataFrame); a schema major mismatch never falls back.  Returns the frame
    and the selection record (S10).  Only the one-row acceptance result is
    read on the driver."""
    if source == "remote":
        if remote_loader is None:
            raise ValueError("remote source requested without a loader")
        return remote_loader(), {"data_source_selected": "remote", "fallback_taken": False, "fallback_reason": None}
    code, meta = "SNAPSHOT_MISSING", {}
    if local_root:
        try:
            manifests = read_manifests(spark, local_root)
            newest = manifests.orderBy(F.col("created_at_utc").desc()).limit(1)
            m = newest.first()
        except AnalysisException as e:  # a missing or empty folder is a missing snapshot, nothing else is
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            m = None
        if m is not None:
            data = spark.read.parquet(m["snapshot_path"])
            acc = accept_snapshot(data, newest, now, Acceptance(max_age_days=max_age_days)).first()
            if acc["accepted"]:
                return data, {"data_source_selected": "local", "snapshot_path": m["snapshot_path"],
                              "snapshot_age_days": float(acc["age_days"]), "fallback_taken": False, "fallback_reason": None}
            code, meta = acc["code"], {"snapshot_path": m["snapshot_path"]}
    if code == "SCHEMA_MAJOR_MISMATCH" or policy != "LOCAL_THEN_REMOTE" or remote_loader is None \
            or code not in RECOVERABLE_CODES:
        raise RuntimeError(f"local snapshot rejected: {code}")
    return remote_loader(), {"data_source_selected": "remote", "fallback_taken": True, "fallback_reason": code, **meta}


def selection_log_row(spark: SparkSession, context: str, meta: dict) -> DataFrame:
    """The selection record as a one-row frame for the event log."""
    import json

    return spark.createDataFrame([(context, json.dumps(meta, sort_keys=True, default=str))], "context string, detail string")
