"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the 2-, 3- and 4-grams of UTF-8 bytes inside words (a word's
borders count as one byte); each hashes to a row of an embedding table.  The
rows are averaged over the whole text and classified by a linear softmax,
both trained by stochastic gradient descent in numpy on a bounded sample of
labelled documents (``SAMPLE_PER_LANG`` expected rows a language, whole texts
plus two short excerpts of each).  A fifth of the sample calibrates: a
temperature is fitted so that the softmax is a probability, and a document
whose calibrated probability is below ``REJECT_BELOW`` (more likely wrong than
right) is rejected.

Defined cases: null texts and texts without letters are ``und`` with score 0
and are rejected; subwords never seen in training have the zero embedding, so
a text of unknown subwords falls to the prior; ties go to the first language
in alphabetical order; without any labelled document every text is ``und``,
and only texts without letters are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import fresh, small_batches
from panelforge.llm.textgrams import LOWER, U64, mix, slices

BUCKETS = 1 << 15
DIM = 8
SIZES = (2, 3, 4)
#: Expected rows of the sample the classifier is fitted on, a language; with more than ``MANY_LANGS`` languages
#: each has its share of those of ``MANY_LANGS``, but at least ``LEAST_PER_LANG``.  Every language is learned.
SAMPLE_PER_LANG, LEAST_PER_LANG = 600, 20
MANY_LANGS = 200
REJECT_BELOW = 0.5
EPOCHS, BATCH, RATE = 6, 64, 1.5
#: Bytes of text that are read at a time: the arrays of a slice take some 80 times as much.
SLICE = 1 << 18

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32(id) mod 5 is 0, or no id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the subwords of each size."""
    low = LOWER[data]
    letter = _LETTER[low]
    code = np.where(letter, low, 0).astype(np.uint32)
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    acc, inner = code, None
    for n in range(2, max(SIZES) + 1):
        if len(code) < n:
            return
        acc = acc[:-1] * np.uint32(0x01000193) + code[n - 1:] + np.uint32(n)
        if n > 2:
            inner = letter[1: len(letter) - n + 2] if inner is None else inner[:-1] & letter[n - 2: len(letter) - 1]
        ok = (letter[: len(acc)] | letter[n - 1:]) if inner is None else inner
        at = np.flatnonzero(ok & (rows[: len(acc)] == rows[n - 1:]))
        h = acc[at] * np.uint32(0x9E3779B1)
        yield rows[at], ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(17)).astype(np.int32)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    weight: np.ndarray | None = None  # with many languages: of the embeddings, which ``table`` has then

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        total, count = np.zeros((rows, len(self.table))), np.zeros(rows)
        for row, bucket in subwords(data, offsets):
            if len(row):
                start = np.flatnonzero(np.diff(row, prepend=-1))
                count[row[start]] += np.diff(np.append(start, len(row)))
                for k in range(len(self.table)):
                    total[row[start], k] += np.add.reduceat(self.table[k][bucket], start)
        mean = total / np.maximum(count, 1)[:, None]
        return (mean if self.weight is None else mean @ self.weight) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: list[str], calibrate: np.ndarray, seed: int = 7) -> Model:
    """Fit on (buckets, counts) histograms ``x`` with language numbers ``y``;
    rows marked in ``calibrate`` fit the temperature only."""
    rng = np.random.default_rng(seed)
    embed, weight, bias = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.1, (DIM, len(langs))), np.zeros(len(langs))
    seen = np.zeros(BUCKETS, bool)
    learn = np.flatnonzero(~calibrate)
    for i in learn:
        seen[x[i][0]] = True

    def gather(rows: np.ndarray):
        idx = np.concatenate([x[i][0] for i in rows])
        share = np.concatenate([x[i][1] / max(x[i][1].sum(), 1) for i in rows])
        return idx, share, np.repeat(np.arange(len(rows)), [len(x[i][0]) for i in rows])

    def hidden(idx, share, row, n):
        return np.stack([np.bincount(row, embed[idx, k] * share, n) for k in range(DIM)], 1)

    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(learn)
        for lo in range(0, len(order), BATCH):
            rows = order[lo: lo + BATCH]
            idx, share, row = gather(rows)
            h = hidden(idx, share, row, len(rows))
            g = softmax(h @ weight + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            dh = g @ weight.T
            weight -= rate * h.T @ g / len(rows) * 10
            bias -= rate * 0.1 * g.mean(0)
            for k in range(DIM):
                embed[:, k] -= rate * np.bincount(idx, share * dh[row, k], BUCKETS)
    embed[~seen] = 0
    many = len(langs) > MANY_LANGS
    model = Model(langs, np.ascontiguousarray((embed if many else embed @ weight).T), bias, 1.0, weight if many else None)
    check = np.flatnonzero(calibrate)
    if len(check):
        z = hidden(*gather(check), len(check)) @ weight + bias
        grid = np.geomspace(0.02, 20, 61)
        loss = [-np.log(softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _histograms(batches):
    for batch in batches:
        langs, ids = batch.column("lang"), batch.column("id").to_numpy()
        for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
            out = []
            for i in range(lo, hi):
                text = data[offsets[i - lo]: offsets[i - lo + 1]]
                word = np.flatnonzero(text == 32)
                parts = [text]
                for size, seed in ((4, 1), (15, 2)):
                    if len(word) > 2 * size:
                        at = int(mix(np.array([ids[i] * 2 + seed], np.int64).view(U64))[0] % U64(len(word) - size))
                        parts.append(text[word[at]: word[at + size]])
                for part in parts:
                    found = [b for _, b in subwords(part, np.array([0, len(part)]))]
                    bucket, count = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
                    if len(bucket):
                        out.append((ids[i], langs[i].as_py(), bucket.tolist(), count.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                                              pa.array([r[2] for r in out], pa.list_(pa.int32())), pa.array([r[3] for r in out], pa.list_(pa.int32()))],
                                             names=["id", "lang", "bucket", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on a bounded sample of the labelled, not held-out documents."""
    small_batches(docs.sparkSession)
    known = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"),
                         F.col(f"`{lang_col}`").cast("string").alias("lang"))
             .where(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    counts = known.groupBy("lang").count().collect()  # a row a language
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30))
    per_lang = max(LEAST_PER_LANG, SAMPLE_PER_LANG * MANY_LANGS // max(MANY_LANGS, len(counts)))
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1 << 30, (per_lang << 30) // r["count"])) for r in counts], "lang string, share long")
    drawn = known.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("id", "text", "lang")
    sample = drawn.mapInArrow(_histograms, "id long, lang string, bucket array<int>, n array<int>").toArrow().sort_by("id")
    langs = sorted(set(sample["lang"].to_pylist()))
    if not langs:
        return None
    ids = sample["id"].to_numpy()
    x = [(np.asarray(b.values), np.asarray(n.values)) for b, n in zip(sample["bucket"], sample["n"])]
    number = {v: k for k, v in enumerate(langs)}
    y = np.array([number[v] for v in sample["lang"].to_pylist()])
    return train(x, y, langs, mix(ids.view(U64)) % U64(5) == 0)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, accepted."""
    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out(id_col).alias("held_out"),
                       F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        m = shared.value
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                n = hi - lo
                has = np.diff(offsets) > 0
                score, lang = np.zeros(n), np.full(n, "und", object)
                accepted = has.copy()
                if m is not None and n:
                    p = m.probabilities(m.logits(data, offsets))
                    best = p.argmax(1)
                    score = np.where(has, p[np.arange(n), best], 0.0)
                    lang = np.where(has, np.array(m.langs, object)[best], "und")
                    accepted &= score >= REJECT_BELOW
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, n), batch.column("held_out").slice(lo, n),
                                                  pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)],
                                                 names=["id", "held_out", "lang_pred", "score", "accepted"])

    out = rows.mapInArrow(label, "id long, held_out boolean, lang_pred string, score double, accepted boolean")
    return out.withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, all columns kept."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width = len(docs.columns)

    def accept(batches):
        m = shared.value
        for batch in batches:
            keep = [np.empty(0, bool)]
            for lo, hi, data, offsets in slices(batch.column(width), SLICE):
                good = np.ones(hi - lo, bool)
                if m is not None:
                    good = m.probabilities(m.logits(data, offsets)).max(1) >= REJECT_BELOW
                keep.append(good)
            yield batch.select(range(width)).filter(pa.array(np.concatenate(keep)))

    text = F.col(f"`{text_col}`").cast("string")
    lowered = docs.where(text.rlike(r"\p{L}")).select("*", F.lower(text).alias(fresh(docs, "lowered")))
    return lowered.mapInArrow(accept, docs.schema)
