"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's expression a Boolean trigram query is derived.  One scan of
the documents writes the postings (trigram, id) of the trigrams that occur in
any query, case folded; the queries intersect postings by id; each rule then
runs on its candidates only.  Rules without mandatory trigrams run on every
document.  Matches are leftmost and do not overlap within a rule; a match
that fails its rule's length is dropped.

Defined cases: null texts are empty and have no spans; rows that share an id
share candidates (a superset, nothing is missed); null ids are an id of their
own; overlapping spans of different rules are all reported; ties go by start,
then by the order of the rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm import spans, trigrams
from panelforge.llm.common import BROADCAST_IDS
from panelforge.operators.common import materialize, maybe_broadcast


@dataclass(frozen=True)
class Rule:
    """``group``/``least``: the group's (or the match's) length that a match needs."""

    kind: str
    regex: str
    least: int = 0
    group: int = 0


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The base rules, then those the method adds.
BASE = (Rule("assign", _ASSIGN, 6, 2), Rule("access", r"AKIA[A-Z0-9]+", 20), Rule("hex", r"[0-9a-f]{24,}"))
ADDED = (Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"), Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
         Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"), Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
         Rule("google", r"AIza[A-Za-z0-9_-]{35}"))
RULES = BASE + ADDED


def postings(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(trigram, id): which of these trigrams each lower-cased text holds."""
    low = F.col("low")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in vocabulary]))
    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.lower(F.col(f"`{text_col}`").cast("string")).alias("low"))
            .select("id", F.explode(held).alias("trigram")))


def candidates(index: DataFrame, queries: dict[int, trigrams.Query]) -> DataFrame:
    """(id, rules): a bit for each rule whose query the id's postings meet."""
    entries = [(rule, k, i, t, (1 << len(c)) - 1) for rule, q in queries.items() for k, c in enumerate(sorted(map(sorted, q))) for i, t in enumerate(c)]
    terms = index.sparkSession.createDataFrame(entries, "rule int, part int, bit int, trigram string, mask long")
    met = (index.join(F.broadcast(terms), "trigram")
           .groupBy("id", "rule", "part", "mask").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("held"))
           .where("held = mask"))
    return met.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def _valid(rule: Rule):
    if not rule.least:
        return None
    return lambda m: F.char_length(F.regexp_extract(m, rule.regex, rule.group)) >= rule.least


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' ids and texts with ``found``: an array of spans by start."""
    queries = {i: trigrams.query(r.regex) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if frozenset() not in q}
    vocabulary = sorted({t for q in indexed.values() for c in q for t in c})
    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("raw"))
    if vocabulary:
        index = materialize(postings(docs, vocabulary, id_col, text_col))
        chosen = materialize(candidates(index, indexed)).withColumnRenamed("id", "candidate")
        text = text.join(maybe_broadcast(chosen, BROADCAST_IDS), F.col("id").eqNullSafe(F.col("candidate")), "left").drop("candidate")
    else:
        text = text.withColumn("rules", F.lit(0).cast("long"))
    text = text.select("id", spans.plain(F.col("raw")).alias("text"), F.coalesce("rules", F.lit(0).cast("long")).alias("rules"))

    def found(i: int, rule: Rule) -> Column:
        cut = spans.parts(F.col("text"), rule.regex)
        if i in indexed:
            cut = F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, cut).otherwise(F.array(F.lit("")))
        return spans.spans(cut, rule.kind, i, _valid(rule))

    each = text.select("id", "text", *[found(i, r).alias(f"s{i}") for i, r in enumerate(rules)])
    return each.select("id", "text", F.array_sort(F.concat(*[F.col(f"s{i}") for i in range(len(rules))])).alias("found"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans."""
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    out = scan(docs, RULES, id_col, text_col).select("id", "found", base.alias("base"))
    return out.select(F.col("id").alias(id_col), *[spans.count(F.col("base"), r.kind).alias(f"n_{r.kind}") for r in BASE],
                      F.sha2(spans.listed(F.col("base")), 256).alias("base_sha256"), spans.listed(F.col("found")).alias("spans"))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' ids and texts with every secret replaced by its [KIND]."""
    return scan(docs, RULES, id_col, text_col).select(F.col("id").alias(id_col), spans.masked(F.col("text"), F.col("found")).alias(text_col))
