"""Data-quality operators: target sanity, column contract, validation report,
duplicate ratio, fingerprints (P27, P33, V1, A14-A16, A22, P32).

Each check is one aggregate pass producing counts; results are rows, never
driver-side loops over data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.common import attach_row


def target_sanity(df: DataFrame, period: str = "gameweek_id", target: str = "target_next_gw_points",
                  target_period: str = "target_gameweek_id") -> DataFrame:
    """Violation counts in one aggregate; ``valid`` when all are zero."""
    tp, tg, g = F.col(target), F.col(target_period), F.col(period)
    out = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(tp.isNull()).alias("n_null_target"),
        F.count_if(tg.isNull()).alias("n_null_target_gameweek"),
        F.count_if(tg <= 0).alias("n_nonpositive_target_gameweek"),
        F.count_if(tg <= g).alias("n_target_not_after"),
        F.count_if(tp.isNotNull() & tg.isNotNull()).alias("n_kept"),
    )
    return out.withColumn(
        "valid",
        (F.col("n_null_target") + F.col("n_null_target_gameweek") + F.col("n_nonpositive_target_gameweek")
         + F.col("n_target_not_after")) == 0,
    )


# Fixed values of the reference: the 7-column snapshot contract and the
# schema / split rules of the shipped domain rules.
REQUIRED_COLUMN_FAMILY = (
    ("player_id", "integer"),
    ("gameweek_id", "integer"),
    ("position_id", "integer"),
    ("total_points", "number"),
    ("minutes_played", "number"),
    ("ict_index", "number"),
    ("now_cost", "number"),
)
SCHEMA_VERSION = "1.0.0"


@dataclass(frozen=True)
class SchemaRules:
    required_columns: tuple[str, ...] = (
        "player_id", "gameweek_id", "target_gameweek_id", "target_next_gw_points",
        "position_id", "total_points", "minutes_played", "ict_index",
    )
    dtypes: tuple[tuple[str, str], ...] = (
        ("player_id", "integer"), ("gameweek_id", "integer"), ("target_gameweek_id", "integer"),
        ("target_next_gw_points", "number"), ("position_id", "integer"), ("total_points", "number"),
        ("minutes_played", "number"), ("ict_index", "number"),
    )
    null_limits: tuple[tuple[str, float], ...] = (
        ("target_next_gw_points", 0.0), ("player_id", 0.0), ("gameweek_id", 0.0),
    )
    duplicate_keys: tuple[str, ...] = ("player_id", "gameweek_id")
    duplicate_max_ratio: float = 0.01
    leakage_source: str = "gameweek_id"
    leakage_target: str = "target_gameweek_id"
    leakage_allow_equal: bool = True


_INT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUM = (T.FloatType, T.DoubleType, T.DecimalType)


def dtype_family(dt: T.DataType) -> str:
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, _INT):
        return "integer"
    if isinstance(dt, _NUM):
        return "number"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "string"


def _family_ok(observed: str, expected: str, nonwhole: Column | None) -> Column:
    """Family match; 'integer' also accepts a number column whose non-null
    values are all whole (``nonwhole`` counts the others)."""
    if expected == "integer" and observed == "number" and nonwhole is not None:
        return nonwhole == 0
    if expected == "number":
        return F.lit(observed in ("integer", "number"))
    return F.lit(observed == expected)


def column_contract(df: DataFrame, required: Sequence[tuple[str, str]] = REQUIRED_COLUMN_FAMILY) -> DataFrame:
    """One row per required column: expected / observed family, present,
    ok.  Types come from the schema; the whole-number test is one aggregate."""
    types = {f.name: f.dataType for f in df.schema.fields}
    need_whole = [c for c, e in required if c in types and e == "integer" and dtype_family(types[c]) == "number"]
    agg = df.agg(*[F.count_if((F.col(c) % 1) != 0).alias(f"__nw_{c}") for c in need_whole]) if need_whole else None
    rows = []
    for c, exp in required:
        present = c in types
        obs = dtype_family(types[c]) if present else None
        ok = _family_ok(obs, exp, F.col(f"__nw_{c}") if c in need_whole else None) if present else F.lit(False)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(exp).alias("expected"),
                             F.lit(obs).cast("string").alias("observed"), F.lit(present).alias("present"), ok.alias("ok")))
    base = agg if agg is not None else df.sparkSession.range(1)
    return base.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def contract_hash(df: DataFrame, schema_version: str = SCHEMA_VERSION,
                  required: Sequence[tuple[str, str]] = REQUIRED_COLUMN_FAMILY) -> str:
    """Deterministic hash text of the contract (schema version + required
    columns with their observed families); metadata only, no data pass."""
    import hashlib

    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [schema_version] + [f"{c}:{dtype_family(types[c]) if c in types else 'missing'}" for c, _ in required]
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def validation_report(df: DataFrame, rules: SchemaRules = SchemaRules()) -> DataFrame:
    """V1 + A14 + A15 + A16: every check as a row (check, column_name,
    observed_value, limit_value, observed_text, expected_text, ok) from one
    aggregate pass plus one grouped count for the duplicate keys."""
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__n")]
    nl = [(c, lim) for c, lim in rules.null_limits if c in types]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c, _ in nl]
    dt = [(c, e) for c, e in rules.dtypes if c in types]
    nw = [c for c, e in dt if e == "integer" and dtype_family(types[c]) == "number"]
    aggs += [F.count_if((F.col(c) % 1) != 0).alias(f"__nw_{c}") for c in nw]
    src, tgt = rules.leakage_source, rules.leakage_target
    has_leak = src in types and tgt in types
    if has_leak:
        cmp = F.col(tgt) < F.col(src) if rules.leakage_allow_equal else F.col(tgt) <= F.col(src)
        aggs.append(F.count_if(cmp).alias("__leak"))
    one = df.agg(*aggs)
    keys = list(rules.duplicate_keys)
    has_dup = all(k in types for k in keys)
    if has_dup:
        groups = df.groupBy(*keys).count().agg(F.count(F.lit(1)).alias("__groups"))
        one = attach_row(one, groups)

    def row(check, col, ov, lv, ot, et, ok):
        return F.struct(
            F.lit(check).alias("check"), F.lit(col).alias("column_name"),
            (ov if isinstance(ov, Column) else F.lit(ov)).cast("double").alias("observed_value"),
            F.lit(lv).cast("double").alias("limit_value"),
            F.lit(ot).cast("string").alias("observed_text"), F.lit(et).cast("string").alias("expected_text"),
            (ok if isinstance(ok, Column) else F.lit(ok)).alias("ok"),
        )

    rows = [row("required", c, 1.0 if c in types else 0.0, 1.0, None, None, c in types) for c in rules.required_columns]
    for c, e in dt:
        obs = dtype_family(types[c])
        rows.append(row("dtype", c, None, None, obs, e, _family_ok(obs, e, F.col(f"__nw_{c}") if c in nw else None)))
    n = F.col("__n")
    for c, lim in nl:
        ratio = F.when(n > 0, F.col(f"__null_{c}") / n).otherwise(F.lit(0.0))
        rows.append(row("null_ratio", c, ratio, lim, None, None, ratio <= lim))
    if has_dup:
        ratio = F.when(n > 0, (n - F.col("__groups")) / n).otherwise(F.lit(0.0))
        rows.append(row("duplicate_ratio", ",".join(keys), ratio, rules.duplicate_max_ratio, None, None,
                        ratio <= rules.duplicate_max_ratio))
    if has_leak:
        rows.append(row("temporal_leakage", f"{src}->{tgt}", F.col("__leak"), 0.0, None, None, F.col("__leak") == 0))
    else:
        rows.append(row("temporal_leakage", f"{src}->{tgt}", None, 0.0, "missing", None, False))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_key_ratio(df: DataFrame, keys: Sequence[str], max_ratio: float = 0.01) -> DataFrame:
    """(n - #distinct key tuples) / n; NULL keys equal each other (group
    semantics, not ``countDistinct``, which skips NULLs)."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    g = df.groupBy(*keys).count().agg(F.count(F.lit(1)).alias("n_groups"))
    out = attach_row(n, g)
    ratio = F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("n_groups")) / F.col("n_rows")).otherwise(F.lit(0.0))
    return out.withColumns({"duplicate_ratio": ratio, "max_ratio": F.lit(max_ratio)}).withColumn(
        "ok", F.col("duplicate_ratio") <= max_ratio
    )


def canonical_row(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> Column:
    """A row as text that no other row has: every field with its length in
    front, NULL as '-'.  Doubles are written exactly; with ``digits`` they are
    rounded to so many decimals first (for values that two engines add up in
    different orders)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in cols or df.columns:
        v = F.col(c).cast("string")
        if digits is not None and isinstance(types[c], _NUM):
            d = F.col(c).cast("double")
            v = F.when(F.isnan(d) | (F.abs(d) >= 1e30), d.cast("string")).otherwise(F.round(d * 10**digits).cast("decimal(38,0)").cast("string"))
        parts.append(F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.concat(*parts)


def row_fingerprint(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> Column:
    """SHA-256 of the canonical row text."""
    return F.sha2(canonical_row(df, cols, digits), 256)


def dataset_fingerprint(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """Order-independent content hash: sha256 of the row count and the
    sums of two 60-bit parts of each row's hash (DECIMAL(38,0): no overflow)."""
    h = row_fingerprint(df, cols, digits)
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    agg = df.agg(F.count(F.lit(1)).alias("row_count"), part(1).alias("__a"), part(16).alias("__b"))
    return agg.select("row_count", F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("row_count", "__a", "__b")]), 256).alias("content_hash"))
