"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is an n-gram model of characters (``ORDER`` code points, the start
of a text padded), trained on trusted text: the documents that ``labels``
call good and not toxic.  One scan counts, for every n-gram of the whole
corpus, how often trusted text has it; the table is sharded by n-gram, and all
else is joins and group-bys on it: continuation counts of the lower orders,
three discounts an order from counts of counts, the mass that contexts leave,
and the interpolated probability of every n-gram that any document asks for.
A second scan adds the log-probabilities up per document; the table is
broadcast for it while it has at most ``BROADCAST_GRAMS`` n-grams, and joined
to the documents' n-grams beyond that.

A document is kept when its log-perplexity deviates from its language's median
by no more than quantiles, over all trusted documents, of the same deviation;
deviations are scaled by ``sqrt(n / (n + SHORT))`` of the ``n`` code points
first, as those of short texts scatter more (languages with fewer than
``LEAST`` trusted documents use the median of all).  A trusted document has
been counted itself, so its perplexity is too good a measure of others': the
upper bound and its median take it without the n-grams that no other trusted
text has (an n-gram of one text only backs off to its suffix).

Defined cases: null and empty texts have no perplexity and are not kept;
without trusted text there is no model, the perplexity is null and every
document with text is kept; a null language is a language of its own; a label
that contradicts itself is not trusted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import BROADCAST_IDS, small_batches
from panelforge.llm.textgrams import slices
from panelforge.operators.common import materialize, maybe_broadcast

ORDER = 5
BITS = 12
LOW_QUANTILE, HIGH_QUANTILE, SHORT, LEAST = 0.001, 0.995, 400, 30
BROADCAST_GRAMS = 4_000_000
#: n-grams that a counting task holds before it passes them on.
FLUSH = 2_000_000


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of ``BITS`` bits (code points from U+0800 on share 2,048 of them) and row offsets in code points."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    shared = np.uint32(2048) + ((points * np.uint32(2654435761)) >> np.uint32(21))
    return np.where(points < 2048, points, shared).astype(np.int64), starts


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each code point, as one integer, and row offsets."""
    s, starts = symbols(data, offsets)
    place = np.arange(len(s)) - np.repeat(starts[:-1], np.diff(starts))
    out = s.copy()
    for k in range(1, ORDER):
        out[k:] |= np.where(place[k:] >= k, s[:-k], 0) << (BITS * k)
    return out, starts


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Distinct n-grams of the parts: count, smallest and largest trusted document."""
    k, n, lo, hi = (np.concatenate(x) for x in zip(*parts))
    if not len(k):
        return k, n, lo, hi
    order = np.argsort(k, kind="stable")
    k = k[order]
    new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[new], np.add.reduceat(n[order], new), np.minimum.reduceat(lo[order], new), np.maximum.reduceat(hi[order], new)


def _counted(batches) -> Iterator[pa.RecordBatch]:
    none = (np.empty(0, np.int64),) * 4
    make = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(parts)], names=["gram", "n", "lo", "hi"])
    parts, held = [none], 0
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        ids = batch.column("id").fill_null(0).to_numpy()
        for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
            g, starts = grams(data, offsets)
            size = np.diff(starts)
            good = trusted[lo:hi]
            each = (good.astype(np.int64), np.where(good, ids[lo:hi], np.iinfo(np.int64).max), np.where(good, ids[lo:hi], np.iinfo(np.int64).min))
            parts.append(_merged([(g, *(np.repeat(x, size) for x in each))]))
            held += len(parts[-1][0])
            if held > FLUSH:
                parts = [_merged(parts)]
                held = len(parts[0][0])
                if held > FLUSH // 2:
                    yield make()
                    parts, held = [none], 0
    yield make()


def _lower(g: Column, order: int) -> Column:
    """The last ``order`` symbols of an n-gram."""
    return g.bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order, from how many n-grams occur 1 to 4 times."""
    n = table.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    if not all(n):
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3))


def _discount(d: tuple[float, float, float]) -> Column:
    n = F.col("n")
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def probabilities(counts: DataFrame) -> DataFrame:
    """(gram, p) of every n-gram in ``counts`` (gram, n; n is 0 where trusted text
    has it not).  With ``lo`` and ``hi`` there, the smallest and the largest
    document of each n-gram, also ``held``: p for a document that alone has it."""
    if "lo" not in counts.columns:
        return probabilities(counts.withColumns({"lo": F.lit(0), "hi": F.lit(1)})).select("gram", "p")
    tables = {ORDER: counts.where("n > 0")}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = materialize(tables[order + 1].groupBy(_lower(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    vocabulary = tables[1].count() + 1
    p = None
    for order in range(1, ORDER + 1):
        d = discounts(tables[order])
        asked = counts.select(_lower(F.col("gram"), order).alias("gram")).distinct() if order < ORDER else counts.select("gram")
        context = F.shiftright(F.col("gram"), BITS).alias("context")
        left = (tables[order].groupBy(context).agg(F.sum("n").alias("total"), F.sum(_discount(d)).alias("mass"), (F.min("lo") == F.max("hi")).alias("own_context"))
                .select("context", "total", (F.col("mass") / F.col("total")).alias("gamma"), "own_context"))
        rows = asked.join(tables[order], "gram", "left").withColumn("context", context).join(left, "context", "left")
        if p is None:
            rows = rows.withColumns({"shorter": F.lit(1.0 / vocabulary), "shorter_held": F.lit(1.0 / vocabulary)})
        else:
            rows = rows.withColumn("suffix", _lower(F.col("gram"), order - 1)).join(p.toDF("suffix", "shorter", "shorter_held"), "suffix")
        own, gamma = F.coalesce((F.col("n") - _discount(d)) / F.col("total"), F.lit(0.0)), F.coalesce("gamma", F.lit(1.0))
        others = F.when(F.col("lo") < F.col("hi"), own).otherwise(0.0)
        held = F.when(F.col("own_context"), F.col("shorter_held")).otherwise(others + gamma * F.col("shorter_held"))
        p = materialize(rows.select("gram", (own + gamma * F.col("shorter")).alias("p"), held.alias("held")))
    return p


def _documents(docs: DataFrame, labels: DataFrame | None, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    good = (labels.groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .where("q = 1 and t = 0").select("id", F.lit(True).alias("trusted")))
    return rows.join(maybe_broadcast(materialize(good), BROADCAST_IDS), "id", "left").select("id", "text", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"))


def perplexities(rows: DataFrame, p: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """(id, lang, trusted, perplexity, held, size) of (id, text, lang, trusted):
    ``held`` is the perplexity by the held-out probabilities, ``size`` in code points."""
    table = p.select("gram", F.log("p").alias("lp"), F.log("held").alias("lq"))
    if broadcast is None:
        broadcast = p.count() <= BROADCAST_GRAMS
    if not broadcast:
        return _joined(rows, table)
    known = table.toArrow().sort_by("gram")
    shared = rows.sparkSession.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("gram", "lp", "lq")))

    def score(batches):
        keys, *logs = shared.value
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                g, starts = grams(data, offsets)
                size = np.diff(starts)
                at = np.searchsorted(keys, g)
                total = [np.concatenate([[0.0], np.cumsum(x[at])]) if len(g) else np.zeros(1) for x in logs]
                ppl = [pa.array(np.exp(-np.diff(x[starts]) / np.maximum(size, 1)), mask=size == 0) for x in total]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("lang"), part.column("trusted"), *ppl, pa.array(size.astype(np.int64))],
                                                 names=["id", "lang", "trusted", "perplexity", "held", "size"])

    return rows.mapInArrow(score, "id long, lang string, trusted boolean, perplexity double, held double, size long")


def _joined(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same by a join of each document's n-grams, for models of any size."""

    def each(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                g, starts = grams(data, offsets)
                row = np.repeat(np.arange(lo, hi), np.diff(starts))
                order = np.lexsort((g, row))
                g, row = g[order], row[order]
                new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])])) if len(g) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row[new])), pa.array(g[new]), pa.array(np.diff(np.append(new, len(g))))], names=["id", "gram", "m"])

    mean = lambda c: (F.sum(F.col("m") * F.col(c)) / F.sum("m"))
    lp = (rows.select("id", "text").mapInArrow(each, "id long, gram long, m long").join(table, "gram")
          .groupBy("id").agg(mean("lp").alias("lp"), mean("lq").alias("lq"), F.sum("m").alias("size")))
    return (rows.select("id", "lang", "trusted").join(lp.withColumnRenamed("id", "other"), F.col("id").eqNullSafe(F.col("other")), "left")
            .select("id", "lang", "trusted", F.exp(-F.col("lp")).alias("perplexity"), F.exp(-F.col("lq")).alias("held"), F.coalesce("size", F.lit(0)).alias("size")))


def _scored(rows: DataFrame, broadcast: bool | None) -> DataFrame | None:
    """``perplexities`` by the model of the trusted rows; None without trusted text."""
    counted = rows.select("id", F.coalesce("text", F.lit("")).alias("text"), "trusted").mapInArrow(_counted, "gram long, n long, lo long, hi long")
    counts = materialize(counted.groupBy("gram").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return None if counts.where("n > 0").isEmpty() else materialize(perplexities(rows, probabilities(counts), broadcast))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", broadcast: bool | None = None) -> DataFrame:
    """One row per document: id, lang, perplexity, low and high (bounds for its language and length), kept."""
    small_batches(docs.sparkSession)
    rows = _documents(docs, labels, id_col, text_col, lang_col)
    scored = _scored(rows, broadcast)
    if scored is None:
        none = F.lit(None).cast("double")
        return rows.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), none.alias("perplexity"), none.alias("low"), none.alias("high"),
                           (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("kept"))
    trusted = scored.where("trusted and perplexity is not null")
    middle = [F.percentile_approx(F.log(c), 0.5, 100_000).alias(f"mid_{c}") for c in ("perplexity", "held")]
    by_lang = materialize(trusted.groupBy(F.coalesce("lang", F.lit("")).alias("key")).agg(*middle, F.count("*").alias("n")).where(F.col("n") >= LEAST).drop("n"))
    every = trusted.agg(*middle).first()
    spread = F.sqrt(1 + SHORT / F.greatest("size", F.lit(1)))

    def centred(df: DataFrame) -> DataFrame:
        out = df.join(maybe_broadcast(by_lang, BROADCAST_IDS), F.coalesce("lang", F.lit("")) == F.col("key"), "left")
        return out.withColumns({c: F.coalesce(c, F.lit(every[c])) for c in ("mid_perplexity", "mid_held")}).withColumn("spread", spread)

    off = lambda c: (F.log(c) - F.col(f"mid_{c}")) / F.col("spread")
    below, above = centred(trusted).agg(F.percentile_approx(off("perplexity"), LOW_QUANTILE, 100_000), F.percentile_approx(off("held"), HIGH_QUANTILE, 100_000)).first()
    low = F.exp(F.col("mid_perplexity") + below * F.col("spread")) * (1 - 1e-9)
    high = F.exp(F.col("mid_held") + above * F.col("spread")) * (1 + 1e-9)
    return centred(scored).select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), "perplexity", low.alias("low"), high.alias("high"),
                                  F.coalesce(F.col("perplexity").between(low, high), F.lit(False)).alias("kept"))
