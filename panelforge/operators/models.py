"""Model training and scoring.

Fits are jobs of ``boosting.fit_many``: one plan grows the shared model, the
models of all segments and both stages at once.  A fitted model is a row of a
written forest table; scoring is a column expression over it, so rows of all
segments find their model by its name in one scan (``boosting.score_rows``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import signed_expm1, signed_log1p
from panelforge.operators import boosting as bo
from panelforge.operators.features import conform_features


@dataclass(frozen=True)
class GBTParams(bo.BoostParams):
    """The booster's parameters and the post-processing that a search tunes with them."""

    shrinkage_alpha: float = 0.0
    calibration_strength: float = 0.0

    @classmethod
    def from_row(cls, row: Mapping) -> "GBTParams":
        """From a parameter table's names; absent ones keep their defaults."""
        known = {f: row["colsample_bytree" if f == "colsample" else f] for f in cls.__dataclass_fields__
                 if row.get("colsample_bytree" if f == "colsample" else f) is not None}
        return replace(cls(), **{k: int(v) if k in ("n_estimators", "max_depth", "seed") else float(v) for k, v in known.items()})


TARGET = "target_next_gw_points"
MINUTES_TARGET = "target_next_gw_minutes"
LONG_MINUTES = 60.0


@dataclass(frozen=True)
class Model:
    """A forest of a written table by its name."""

    forests: DataFrame
    name: str
    log_target: bool = True


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """M4 input: absent features -> 0 (P18), NULL / NaN features -> 0."""
    d = conform_features(df, features)
    return d.withColumns({f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in features})


def _key(df: DataFrame, features: Sequence[str]) -> list[str]:
    """What tells rows apart when they are sampled."""
    return [c for c in ("player_id", "gameweek_id") if c in df.columns] or list(features)


def _target(target: str, log_target: bool) -> Column:
    return signed_log1p(target) if log_target else F.col(target).cast("double")


def fit_named(train: DataFrame, features: Sequence[str], jobs: Sequence[bo.Job], views: Mapping[str, Column], target: str = TARGET, log_target: bool = True,
              minutes_target: str = MINUTES_TARGET, rows_in_task: int = bo.ROWS_IN_TASK) -> DataFrame:
    """Forest table of jobs whose labels are "points" (the target) or "p60" (next minutes of 60 and more)."""
    labels = {"points": _target(target, log_target)}
    if any(j.label == "p60" for j in jobs):
        labels["p60"] = (F.col(minutes_target) >= LONG_MINUTES).cast("double")
    absent = [f for f in features if f not in train.columns]
    return bo.fit_many(prepare(train, features), features, jobs, views, labels, _key(train, features), rows_in_task, absent)


def train_shared(train: DataFrame, features: Sequence[str], params: bo.BoostParams = GBTParams(), target: str = TARGET,
                 log_target: bool = True) -> Model:
    """M1: one regressor on all rows; label = sign(y) log1p|y| when ``log_target``."""
    return Model(fit_named(train, features, [bo.Job("all", "all", "points", params)], {"all": F.lit(True)}, target, log_target), "all", log_target)


def _inverse(margin: str, log_target: bool) -> Column:
    return signed_expm1(margin) if log_target else F.col(margin)


def predict(model: Model, df: DataFrame, features: Sequence[str], out: str = "predicted_points") -> DataFrame:
    """M4: score and inverse target transform."""
    scored = bo.score_rows(prepare(df, features), model.forests, features, F.lit(model.name), out)
    return scored.withColumn(out, _inverse(out, model.log_target))


# ---------------------------------------------------------------- variants (M2, M3, M8)

def segments_of(train: DataFrame, segment: str = "position_id") -> list:
    return sorted(r[0] for r in train.select(segment).where(F.col(segment).isNotNull()).distinct().collect())  # a handful of ids


def variant_jobs(variant: str, params: bo.BoostParams, segments: Sequence = (), segment: str = "position_id", prefix: str = "",
                 columns: tuple[int, ...] | None = None, minutes_target: str = MINUTES_TARGET) -> tuple[list[bo.Job], dict[str, Column]]:
    """Jobs and views of a variant: the shared model, also one a segment, or the two stages."""
    job = lambda name, view, label="points", objective="squared": bo.Job(prefix + name, view, label, params, objective, columns)
    if variant == "two_stage_minutes_points":
        return [job("p60", "all", "p60", "logistic"), job("long", "long")], {"all": F.lit(True), "long": F.col(minutes_target) >= LONG_MINUTES}
    views, jobs = {"all": F.lit(True)}, [job("all", "all")]
    if variant == "per_position_models":
        for s in segments:
            views[f"segment {s}"] = F.col(segment) == s
            jobs.append(job(f"segment {s}", f"segment {s}"))
    return jobs, views


def _bundle(variant: str, forests: DataFrame, segments: Sequence, prefix: str = "", log_target: bool = True):
    model = lambda name, log=log_target: Model(forests, prefix + name, log)
    if variant == "per_position_models":
        return "segments", {None: model("all"), **{s: model(f"segment {s}") for s in segments}}
    if variant == "two_stage_minutes_points":
        return "two_stage", (model("p60", False), model("long"))
    return "shared", model("all")


def fit_variant(variant: str, train: DataFrame, features: Sequence[str], params: bo.BoostParams):
    segments = segments_of(train) if variant == "per_position_models" else []
    jobs, views = variant_jobs(variant, params, segments)
    return _bundle(variant, fit_named(train, features, jobs, views), segments)


def fit_variants(variants: Mapping[str, Sequence[str]], train: DataFrame, params: bo.BoostParams) -> dict:
    """Bundles of several variants, each with its own features, from one fit."""
    features = list(dict.fromkeys(f for own in variants.values() for f in own))
    segments, jobs, views = segments_of(train), [], {}
    for v, own in variants.items():
        more, seen = variant_jobs(v, params, segments, prefix=f"{v}/", columns=tuple(features.index(f) for f in own))
        jobs += more
        views |= seen
    forests = fit_named(train, features, jobs, views)
    return {v: _bundle(v, forests, segments, f"{v}/") for v in variants}, features


def predict_variant(bundle, df: DataFrame, features: Sequence[str], out: str = "predicted_points", segment: str = "position_id") -> DataFrame:
    """M2, M3: rows take their segment's model (the shared one where there is
    none), or chance of long minutes times the points of those who play long."""
    kind, m = bundle
    if kind == "segments":
        rest = m[None]
        known = [s for s in m if s is not None]
        name = F.coalesce(F.when(F.col(segment).isin(known), F.concat(F.lit(rest.name[:-len("all")] + "segment "), F.col(segment).cast("string"))), F.lit(rest.name))
        scored = bo.score_rows(prepare(df, features), rest.forests, features, name, out)
        return scored.withColumn(out, _inverse(out, rest.log_target))
    if kind == "two_stage":
        chance, points = m
        return predict(points, predict(chance, df, features, "__p60"), features, out).withColumn(out, F.col("__p60") * F.col(out)).drop("__p60")
    return predict(m, df, features, out)


def predict_variants(bundles: Mapping, df: DataFrame, features: Sequence[str], out: str = "predicted_points", segment: str = "position_id") -> DataFrame:
    """Every row once for each variant (column ``model``), scored by that variant's
    bundle of ``fit_variants``: rows name the models of all variants, and are copied once scored."""
    names, forests = {}, None
    for k, (kind, m) in enumerate(bundles.values()):
        if kind == "two_stage":
            names |= {f"__chance{k}": F.lit(m[0].name), f"__points{k}": F.lit(m[1].name)}
            forests = m[1].forests
        elif kind == "segments":
            name = F.lit(m[None].name)
            for s in m:
                name = F.when(F.col(segment) == s, F.lit(m[s].name)).otherwise(name) if s is not None else name
            names[f"__points{k}"], forests = name, m[None].forests
        else:
            names[f"__points{k}"], forests = F.lit(m.name), m.forests
    rows = bo.score_each(prepare(df, features), forests, features, names)
    chance = lambda k: F.coalesce(F.col(f"__chance{k}"), F.lit(1.0)) if f"__chance{k}" in names else F.lit(1.0)
    each = [F.struct(F.lit(v).alias("model"), (signed_expm1(f"__points{k}") * chance(k)).alias(out)) for k, v in enumerate(bundles)]
    kept = [c for c in rows.columns if c not in names]
    return rows.select(*kept, F.inline(F.array(*each)))


def _models(bundle) -> list[Model]:
    kind, m = bundle
    return list(m.values()) if kind == "segments" else list(m) if kind == "two_stage" else [m]


def feature_importance(bundle, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Mean gain of a feature's splits, as a share; the mean over segment models or both stages."""
    models = _models(bundle)
    own = models[0].forests.filter(F.col("model").isin([m.name for m in models]))
    names = F.array(*[F.lit(f) for f in features])
    gain = F.transform(F.arrays_zip("gain", "splits"), lambda z: F.when(z["splits"] > 0, z["gain"] / z["splits"]).otherwise(0.0))
    rows = own.select("model", F.posexplode(gain).alias("at", "g"))
    total = rows.groupBy("model").agg(F.sum("g").alias("total"))
    share = F.when(F.col("total") > 0, F.col("g") / F.col("total")).otherwise(0.0)
    return rows.join(total, "model").groupBy(F.get(names, F.col("at")).alias("feature")).agg(F.avg(share).alias("importance"))


def error_row(pred: DataFrame, actual: str = TARGET, col: str = "predicted_points", by: Sequence[str] = ()) -> DataFrame:
    e = F.col(actual) - F.col(col)
    return pred.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))


def save_model(bundle, features: Sequence[str], path: str, metadata: dict | None = None) -> str:
    """Write the forests of a bundle and a metadata record (features,
    post-processing payload, gates) below ``path`` (shared storage)."""
    kind, m = bundle
    models = _models(bundle)
    spark = models[0].forests.sparkSession
    models[0].forests.filter(F.col("model").isin([x.name for x in models])).write.mode("overwrite").parquet(f"{path}/forests")
    keys = [[k, x.name] for k, x in m.items()] if kind == "segments" else [x.name for x in models]
    meta = {"kind": kind, "models": keys, "log_target": models[-1].log_target, "feature_cols": list(features), **(metadata or {})}
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{path}/_metadata")
    return path


def load_model(spark: SparkSession, path: str):
    """M12 input: the stored bundle and its metadata."""
    meta = json.loads(spark.read.text(f"{path}/_metadata").first()[0])
    forests, log = spark.read.parquet(f"{path}/forests"), meta["log_target"]
    if meta["kind"] == "segments":
        return ("segments", {k: Model(forests, name, log) for k, name in meta["models"]}), meta
    if meta["kind"] == "two_stage":
        return ("two_stage", (Model(forests, meta["models"][0], False), Model(forests, meta["models"][1], log))), meta
    return ("shared", Model(forests, meta["models"][0], log)), meta
