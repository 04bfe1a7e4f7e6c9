"""JSON envelope scan and typed parsing.

Landed documents are read as text (one envelope per line), parsed once into
VARIANT with ``try_parse_json`` (malformed lines become NULL and are counted,
never fatal), and typed with ``variant_get`` / ``try_variant_get``; arrays are
exploded with ``explode`` over ``array<variant>``.  All of it is JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import safe_float, safe_timestamp

# Keys whose values are redacted (case-insensitive substring match).
SENSITIVE_KEY_PATTERN = ("KEY", "TOKEN", "SECRET")


def envelope_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed envelope with its parsed VARIANT and metadata."""
    raw = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
    v = F.try_parse_json("line")
    return raw.withColumn("doc", v).select(
        "line",
        "source_file",
        "doc",
        F.col("doc").isNotNull().alias("is_valid"),
        F.try_variant_get("doc", "$.metadata.endpoint_name", "string").alias("endpoint_name"),
        F.try_variant_get("doc", "$.metadata.url", "string").alias("url"),
        F.try_variant_get("doc", "$.metadata.fetch_timestamp", "string").alias("fetch_timestamp"),
        F.try_variant_get("doc", "$.metadata.status_code", "int").alias("status_code"),
        F.octet_length("line").alias("line_bytes"),
    )


def _items(env: DataFrame, path: str, endpoint: str, extra: dict[str, Column] | None = None) -> DataFrame:
    docs = env.filter(F.col("is_valid") & (F.col("endpoint_name") == endpoint))
    arr = F.try_variant_get("doc", path, "array<variant>")
    cols = {k: v for k, v in (extra or {}).items()}
    return docs.select(*[v.alias(k) for k, v in cols.items()], F.posexplode(arr).alias("pos", "e"))


def _g(field: str, typ: str) -> Column:
    return F.try_variant_get("e", f"$.{field}", typ)


def parse_players(env: DataFrame) -> DataFrame:
    """Elements -> typed player rows (id->player_id, team->team_id,
    element_type->position_id), safe floats, stamped with the period."""
    it = _items(env, "$.data.elements", "bootstrap-static", {"gameweek_fetched": F.try_variant_get("doc", "$.data.event", "int")})
    return it.select(
        _g("id", "bigint").alias("player_id"),
        _g("web_name", "string").alias("web_name"),
        _g("team", "int").alias("team_id"),
        _g("element_type", "int").alias("position_id"),
        _g("now_cost", "int").alias("now_cost"),
        safe_float(_g("form", "string")).alias("form"),
        _g("total_points", "int").alias("total_points"),
        _g("minutes", "int").alias("minutes"),
        _g("goals_scored", "int").alias("goals_scored"),
        _g("assists", "int").alias("assists"),
        _g("clean_sheets", "int").alias("clean_sheets"),
        _g("bonus", "int").alias("bonus"),
        *[_g(c, "string").alias(c) for c in ("first_name", "second_name", "status")],
        *[safe_float(_g(c, "string")).alias(c) for c in ("selected_by_percent", "value_season", "value_form")],
        *[_g(c, "int").alias(c) for c in ("goals_conceded", "bps", "chance_of_playing_next_round")],
        "gameweek_fetched",
    )


def parse_teams(env: DataFrame) -> DataFrame:
    """Teams array -> typed team rows."""
    it = _items(env, "$.data.teams", "bootstrap-static")
    return it.select(
        _g("id", "int").alias("team_id"), _g("name", "string").alias("name"), _g("short_name", "string").alias("short_name"),
        _g("strength", "int").alias("strength"), safe_float(_g("form", "string")).alias("form"),
        _g("points", "int").alias("points"), _g("position", "int").alias("position"),
        *[_g(f"strength_{part}_{side}", "int").alias(f"strength_{part}_{side}") for part in ("overall", "attack", "defence") for side in ("home", "away")],
    )


def parse_gameweeks(env: DataFrame) -> DataFrame:
    """Events array -> typed period rows (ISO deadline -> TIMESTAMP_NTZ)."""
    it = _items(env, "$.data.events", "bootstrap-static")
    return it.select(
        _g("id", "int").alias("gameweek_id"), _g("name", "string").alias("name"),
        safe_timestamp(_g("deadline_time", "string")).alias("deadline_time"),
        _g("finished", "boolean").alias("finished"), _g("is_current", "boolean").alias("is_current"),
        _g("is_next", "boolean").alias("is_next"), _g("is_previous", "boolean").alias("is_previous"),
        *[_g(c, "int").alias(c) for c in ("average_entry_score", "highest_score", "most_selected", "most_transferred_in", "most_captained", "most_vice_captained")],
    )


def parse_fixtures(env: DataFrame) -> DataFrame:
    """Root-array documents -> typed fixture rows."""
    it = _items(env, "$.data", "fixtures")
    return it.select(
        _g("id", "bigint").alias("fixture_id"), _g("event", "int").alias("gameweek_id"),
        safe_timestamp(_g("kickoff_time", "string")).alias("kickoff_time"),
        _g("team_h", "int").alias("team_h"), _g("team_a", "int").alias("team_a"),
        _g("team_h_score", "int").alias("team_h_score"), _g("team_a_score", "int").alias("team_a_score"),
        _g("finished", "boolean").alias("finished"), _g("started", "boolean").alias("started"),
    )


def extract_ids(env: DataFrame) -> DataFrame:
    """All element ids; an element without an id fails the job."""
    it = _items(env, "$.data.elements", "bootstrap-static")
    pid = _g("id", "bigint")
    return it.select(F.when(pid.isNull(), F.raise_error(F.lit("element without id"))).otherwise(pid).alias("player_id")).distinct()


def current_period(env: DataFrame) -> DataFrame:
    """First is_current event, else first is_next, else NULL (list order)."""
    it = _items(env, "$.data.events", "bootstrap-static")
    e = it.select("pos", _g("id", "int").alias("id"), _g("is_current", "boolean").alias("cur"), _g("is_next", "boolean").alias("nxt"))
    return e.agg(
        F.coalesce(
            F.min_by(F.when(F.col("cur"), F.col("id")), F.when(F.col("cur"), F.col("pos"))),
            F.min_by(F.when(F.col("nxt"), F.col("id")), F.when(F.col("nxt"), F.col("pos"))),
        ).alias("current_gameweek_id")
    )


def flatten_history(env: DataFrame) -> DataFrame:
    """LATERAL FLATTEN(data:history) -> one row per player and round."""
    it = _items(env, "$.data.history", "element-summary")
    return it.select(
        _g("element", "bigint").alias("player_id"), _g("round", "int").alias("gameweek_id"),
        _g("total_points", "int").alias("total_points"), _g("minutes", "int").alias("minutes"),
    )


def ingest_stats(env: DataFrame, max_items: int | None = None) -> DataFrame:
    """Per endpoint total / parsed / failed documents (bad documents
    are skipped and counted).  ``max_items`` caps each endpoint to its first
    N documents by url (T6)."""
    e = env
    if max_items is not None:
        from panelforge.operators.ranking import topk

        e = topk(env, ["endpoint_name"], [F.col("url").asc()], max_items).drop("rn")
    ep = F.coalesce(F.col("endpoint_name"), F.lit("<unparsed>"))
    return e.groupBy(ep.alias("endpoint_name")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_valid").alias("success"),
        F.count_if(~F.col("is_valid")).alias("failed"),
        F.sum("line_bytes").alias("bytes"),
    )


def raw_json_profile(env: DataFrame) -> DataFrame:
    """Distinct element ids inside the raw documents + latest fetch time."""
    it = _items(env, "$.data.elements", "bootstrap-static", {"fetch_timestamp": F.col("fetch_timestamp")})
    return it.agg(
        F.countDistinct(_g("id", "bigint")).alias("distinct_players"),
        F.count(F.lit(1)).alias("element_rows"),
        F.max(safe_timestamp(F.col("fetch_timestamp"))).alias("latest_fetch"),
    )


def redact_pattern(patterns=SENSITIVE_KEY_PATTERN) -> str:
    keys = "|".join(p.lower() for p in patterns)
    return r'("[^"]*(?i:' + keys + r')[^"]*"\s*:\s*)("(?:[^"\\]|\\.)*"|-?[0-9.eE+]+|true|false|null)'


def redact_json_text(col: Column, patterns=SENSITIVE_KEY_PATTERN) -> Column:
    """P31 on JSON text: scalar values of keys containing KEY / TOKEN / SECRET
    (any case, any depth) become "[REDACTED]".  Object or array values under
    such keys need ``redact_json_deep``."""
    return F.regexp_replace(col, redact_pattern(patterns), '$1"[REDACTED]"')


#: Code points that no text uses; they stand for escapes while a text is cut into tokens.
_BACKSLASH, _QUOTE = "\ufdd1", "\ufdd2"


def redact_json_deep(col: Column, patterns=SENSITIVE_KEY_PATTERN) -> Column:
    """P31, full depth: the value under a sensitive key goes as a whole, whatever
    is nested in it.  Native: VARIANT brings the text into one form (no spaces, plain
    escapes), it is cut into brackets, sensitive keys and runs of anything between them, a fold
    over these keeps the depth and notes the ranges under sensitive keys, and the rest is joined again.  Text
    that is no JSON (or repeats a key) can't be trusted to hold no secret: it
    goes as a whole; what stands behind a whole value is dropped."""
    cut = lambda plain: F.replace(F.replace(plain, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    # a token: a bracket, a key that may be sensitive with its colon and plain value, or a run of anything else
    words = "|".join(p.lower() for p in patterns)
    key = rf'"(?=[^"]*?(?:(?i:{words})|[^\x00-\x7f]))[^"]*+":'
    run = rf'(?:[^"{{}}\[\]]++|(?!{key})"[^"]*+"){{1,1000}}+'
    tokens = lambda plain: F.regexp_extract_all(cut(plain), F.lit(rf'{run}|[{{}}\[\]]|{key}(?:"[^"]*+"|[^"{{}}\[\],]++)?'), F.lit(0))
    sensitive = lambda t: F.upper(F.regexp_extract(t, r'^"[^"]*+"(?=:)', 0)).rlike("|".join(p.upper() for p in patterns))
    empty = F.array().cast("array<struct<lo: int, hi: int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(-1).alias("lo"), F.lit(0).alias("floor"), empty.alias("cuts"))

    def step(s: Column, t: Column) -> Column:
        depth = s["depth"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
        # the bracket behind a sensitive key begins a range, which ends where the depth is back
        begins = (s["lo"] < 0) & t.endswith('":') & sensitive(t)
        ends = (s["lo"] >= 0) & (s["at"] >= s["lo"]) & (depth == s["floor"])
        return F.struct((s["at"] + 1).alias("at"), depth.alias("depth"), F.when(begins, s["at"] + 1).when(ends, F.lit(-1)).otherwise(s["lo"]).alias("lo"),
                        F.when(begins, s["depth"]).otherwise(s["floor"]).alias("floor"),
                        F.when(ends, F.concat(s["cuts"], F.array(F.struct(s["lo"].alias("lo"), s["at"].alias("hi"))))).otherwise(s["cuts"]).alias("cuts"))

    def shown(pair: Column) -> Column:
        """The tokens that stay; a range's first one and a plain value become the mark."""
        cuts = pair["cuts"]
        plain_value = lambda t: F.regexp_replace(t, r'(?s)^("[^"]*+":).+$', '$1"[REDACTED]"')
        return F.transform(pair["tokens"], lambda t, i: F.when(F.exists(cuts, lambda c: c["lo"] == i), F.lit('"[REDACTED]"'))
                           .when(F.exists(cuts, lambda c: (c["lo"] < i) & (i <= c["hi"])), F.lit("")).when(sensitive(t), plain_value(t)).otherwise(t))

    def redacted(plain: Column) -> Column:
        bound = F.transform(F.array(tokens(plain)), lambda ts: F.struct(ts.alias("tokens"), F.aggregate(ts, start, step, lambda s: s["cuts"]).alias("cuts")))
        out = F.array_join(F.get(F.transform(bound, shown), 0), "")
        out = F.replace(F.replace(out, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
        return F.when(plain.isNull(), F.lit('"[UNPARSED]"')).otherwise(out)

    # bound once: as a plain expression the text would be parsed for each use
    whole = F.get(F.transform(F.array(F.to_json(F.try_parse_json(col))), redacted), 0)
    return F.when(col.isNotNull(), whole)
