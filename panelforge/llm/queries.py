"""Registered queries of the dealt operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import bpe, conversations, decontaminate, hnsw, html_extract, kneser_ney, langid, packing, pii, probminhash, secret_scan, warc, whitening
from panelforge.llm.common import table
from panelforge.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: A code point no text uses, put around matches (see ``spans``).
_MARK = "chr(64976)"


def _spans_sql(kind: str, rank: int, regex: str, valid: str = "true") -> str:
    """List of {start, rank, stop, kind} of the valid matches in ``t``."""
    cut = f"string_split(regexp_replace(t, '{regex}', {_MARK} || '\\0' || {_MARK}, 'g'), {_MARK})"
    return f"""list_transform(list_filter(list_transform(range(2, len({cut}) + 1, 2), lambda i: {{'m': ({cut})[i],
      'start': COALESCE(list_sum(list_transform(({cut})[1:i - 1], lambda x: length(x))), 0)}}), lambda x: {valid}),
    lambda x: {{'start': x.start, 'rank': {rank}, 'stop': x.start + length(x.m), 'kind': '{kind}'}})"""


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _secrets_sql() -> str:
    words = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
    quote = '["\'\']?'
    assign = f"({words}){quote}\\x20*[:=]\\x20*{quote}([A-Za-z0-9+/_.=-]+)"
    rules = [("assign", assign, f"length(regexp_extract(x.m, '{assign}', 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "length(x.m) >= 20"), ("hex", "[0-9a-f]{24,}", "true")]
    rules += [(r.kind, r.regex, "true") for r in secret_scan.ADDED]
    lists = ", ".join(_spans_sql(k, i, rx, ok) for i, (k, rx, ok) in enumerate(rules))
    text = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.start || ':' || x.stop), ',')"
    base = "list_filter(f, lambda x: x.rank < 3)"
    n = ", ".join(f"CAST(len(list_filter(f, lambda x: x.kind = '{k}')) AS BIGINT) AS n_{k}" for k, _, _ in rules[:3])
    return f"""SELECT doc_id, {n}, sha256({text.format(base)}) AS base_sha256, {text.format('f')} AS spans
FROM (SELECT doc_id, list_sort(flatten([{lists}])) AS f FROM (SELECT doc_id, COALESCE(text, '') AS t FROM documents) d) s"""


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op7_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS key
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0) x),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS key
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) s WHERE len(w) >= k) x),
hit AS (SELECT dw.doc_id, dw.i, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.key = win.key),
hw AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS word FROM hit) x GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(hw.n, 0) AS n_hit, COALESCE(hi.n, 0) AS n_items,
       sha256(COALESCE(hi.items, '')) AS items_sha256, hw.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id"""

ORACLES["op4_secret_scan"] = _secrets_sql()

ORACLES["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) y
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, COALESCE(n.n, 0) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e JOIN m ON m.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), folder)
    return warc.page_digests(warc.read(spark, folder))


@query
def op8_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digest(table(spark, sf_dir, "conversations"))
