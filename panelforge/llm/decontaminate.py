"""Benchmark decontamination: windows of benchmark words looked up in every document.

Each benchmark item gives its windows of ``n`` consecutive words (an item of
fewer words, but not none, is one window).  Their hashes form a set that is
broadcast while the benchmark is small (``BROADCAST_BYTES`` of text, measured
before); documents are scanned once, hits of the hash set are verified on the
words themselves.  A larger benchmark is joined instead: document windows and
benchmark windows meet on a 128-bit key.

Defined cases: a null or empty text has no words and no hits; a null or empty
item is no window; equal items count each by their own id; a repeated row is
answered once per row; other columns of the tables are
ignored by ``hits`` and kept untouched by ``decontaminate``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import fresh, id_text, small_batches
from panelforge.llm.textgrams import U64, byte_view, mix, ngrams, slices, words_of
from panelforge.operators.common import materialize

WINDOW = 10
#: Benchmark text that may be collected and broadcast as a hash set.
BROADCAST_BYTES = 64 << 20
_SIEVE = 1 << 22
#: Bytes of text that are read at a time: the arrays of a slice take some 30 times as much.
SLICE = 1 << 20

HITS = "id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class WindowSet:
    """Hashed windows of the benchmark items, with their words for verification."""

    def __init__(self, items: list[tuple[object, str | None]], n: int = WINDOW):
        self.by_hash: dict[int, list[tuple[bytes, set[str]]]] = defaultdict(list)
        seen: dict[bytes, set[str]] = {}
        for item, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            w = words_of(data, np.array([0, len(data)]))
            if not len(w.start):
                continue
            size = min(n, len(w.start))
            h, first = w.ngram(size)
            for x, i in zip(h.tolist(), first.tolist()):
                key = window_bytes(w, i, size)
                if key not in seen:
                    seen[key] = set()
                    self.by_hash[x].append((key, seen[key]))
                seen[key].add(str(item))
        self.sizes = sorted({key.count(b" ") + 1 for key in seen})
        self.hashes = np.sort(np.fromiter(self.by_hash, U64, len(self.by_hash)))
        self.sieve = np.zeros(_SIEVE, bool)
        self.sieve[(self.hashes & U64(_SIEVE - 1)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.sieve[(h & U64(_SIEVE - 1)).astype(np.int64)])
        if not len(at):
            return at
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        return at[self.hashes[k] == h[at]]


def window_bytes(w, first: int, size: int) -> bytes:
    return b" ".join(w.low[w.start[i]: w.end[i]].tobytes() for i in range(first, first + size))


def _scan(windows: WindowSet, column: pa.Array) -> Iterator[tuple[int, int, object, np.ndarray, dict[int, set[str]]]]:
    """For slices of rows: the words, which of them are hit, items by row."""
    for lo, hi, data, offsets in slices(column, SLICE):
        w = words_of(data, offsets)
        cover = np.zeros(len(w.start) + 1, np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for size in windows.sizes:
            h, first = w.ngram(size)
            for k in windows.candidates(h).tolist():
                i = int(first[k])
                key = window_bytes(w, i, size)
                for other, ids in windows.by_hash[int(h[k])]:
                    if other == key:
                        cover[i] += 1
                        cover[i + size] -= 1
                        items[int(w.row[i])] |= ids
        yield lo, hi, w, np.cumsum(cover[:-1]) > 0, items


def items_digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def window_set(benchmark: DataFrame, n: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> WindowSet | None:
    """The hash set, or None if the benchmark is larger than may be broadcast."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    return WindowSet([tuple(r) for r in items.collect()], n) if size <= BROADCAST_BYTES else None


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         broadcast: bool | None = None) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows.

    ``broadcast`` forces one of the two forms (None: by the benchmark's size)."""
    small_batches(docs.sparkSession)
    windows = window_set(benchmark, n) if broadcast is not False else None
    if windows is None:
        return _joined(docs, benchmark, n, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches):
        schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                            ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
        empty = items_digest(set())
        for batch in batches:
            for lo, hi, w, hit, items in _scan(shared.value, batch.column("text")):
                rows = hi - lo
                n_hit = np.bincount(w.row[hit], minlength=rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(lo, rows),
                    pa.array(np.bincount(w.row, minlength=rows)), pa.array(n_hit),
                    pa.array([len(items[r]) if r in items else 0 for r in range(rows)], pa.int64()),
                    pa.array([items_digest(items[r]) if r in items else empty for r in range(rows)], pa.string()),
                    pa.array(n_hit > 0)], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(scan, HITS).withColumnRenamed("id", id_col)


def _windows(df: DataFrame, sizes: list[int] | None, n: int) -> DataFrame:
    """(id, first word, words, k1, k2) of every window of every text; ``sizes``
    None: of items (one window if shorter than n)."""

    def emit(batches):
        for batch in batches:
            schema = pa.schema([("id", batch.column("id").type), ("first", pa.int32()), ("size", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64())])
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                w = words_of(data, offsets)
                count = np.bincount(w.row, minlength=hi - lo)
                start = np.concatenate([[0], np.cumsum(count)])
                for size in sizes or range(1, n + 1):
                    h, first = w.ngram(size)
                    h2, _ = ngrams(mix(w.hash + U64(0x5851F42D4C957F2D)), w.row, size)
                    row = w.row[first]
                    keep = np.ones(len(h), bool) if sizes or size == n else count[row] == size
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").slice(lo, hi - lo).take(pa.array(row[keep])),
                        pa.array((first - start[row])[keep].astype(np.int32)),
                        pa.array(np.full(int(keep.sum()), size, np.int32)),
                        pa.array(h[keep].view(np.int64)), pa.array(h2[keep].view(np.int64))], schema=schema)

    return df.mapInArrow(emit, f"id {df.schema['id'].dataType.simpleString()}, first int, size int, k1 long, k2 long")


def _joined(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """The same result by a join of windows on a key of the row's own, for benchmarks of any size."""
    text = materialize(id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("None")).alias("id"), F.col("text").cast("string").alias("text"))
    index = _windows(named, None, n).select(F.col("id").alias("item"), "size", "k1", "k2").distinct()
    sizes = sorted(r[0] for r in index.select("size").distinct().collect())
    if not sizes:
        sizes = [n]
    found = _windows(text.select(F.col("row").alias("id"), "text"), sizes, n).join(index, ["size", "k1", "k2"]).select(F.col("id").alias("row"), "first", "size", "item")
    words = found.select("row", F.explode(F.sequence("first", F.col("first") + F.col("size") - 1)).alias("word")).distinct()
    hit = words.groupBy("row").agg(F.count("*").alias("n_hit"))
    items = found.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))

    def count(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), batch.column("id").slice(lo, hi - lo),
                                                  pa.array(np.bincount(words_of(data, offsets).row, minlength=hi - lo))], names=["row", "id", "n_words"])

    return (text.mapInArrow(count, "row long, id long, n_words long").join(hit, "row", "left").join(items, "row", "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  max_share: float = 0.5, broadcast: bool | None = None) -> DataFrame:
    """Documents without benchmark passages, all columns kept.

    Hit words are cut out of the text (with what stands between two hit words
    of one passage); a document goes altogether when more than ``max_share``
    of its words are hit.  ``n_chars`` follows the text where there is one.
    Ids play no part: every row is judged on its own text.  ``broadcast``
    forces one of the two forms (None: by the benchmark's size).
    """
    small_batches(docs.sparkSession)
    windows = window_set(benchmark, n) if broadcast is not False else None
    at = docs.columns.index(text_col)
    if windows is None:
        rows, scan = _with_hits(docs, benchmark, n, text_col), lambda batch: _marked(batch, at)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        rows, scan = docs, lambda batch: ((lo, hi, w, hit) for lo, hi, w, hit, _ in _scan(shared.value, batch.column(at)))
    width = len(docs.columns)

    def clean(batches):
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            for lo, hi, w, hit in scan(batch):
                for r in range(lo, hi):
                    i, j = np.searchsorted(w.row, [r - lo, r - lo + 1])
                    mine = hit[i:j]
                    if not mine.any():
                        keep.append(r)
                    elif mine.mean() <= max_share:
                        texts[r] = _cut(texts[r].encode(), w.start[i:j] - (raw_at := _row_start(batch.column(at), lo, r)), w.end[i:j] - raw_at, mine)
                        keep.append(r)
            columns = [pa.array(texts, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(width)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(k) for k in range(width)])).take(pa.array(keep, pa.int64()))

    out = rows.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _with_hits(docs: DataFrame, benchmark: DataFrame, n: int, text_col: str) -> DataFrame:
    """The rows and, as last columns, the first word and the number of words
    of every hit window: the window join on a key of the row's own."""
    key, other, hit, first, size = (fresh(docs, name) for name in ("row_key", "hit_key", "hit", "hit_first", "hit_size"))
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()))
    index = materialize(_windows(benchmark.select(F.lit(0).alias("id"), F.col("text").cast("string").alias("text")), None, n).select("size", "k1", "k2").distinct())
    sizes = sorted(r[0] for r in index.select("size").distinct().collect()) or [n]
    found = (_windows(id_text(rows, key, text_col), sizes, n).join(index, ["size", "k1", "k2"], "left_semi")
             .groupBy(F.col("id").alias(other)).agg(F.collect_list(F.struct("first", "size")).alias(hit)))
    joined = rows.join(found, F.col(f"`{key}`") == F.col(other), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{hit}.first").alias(first), F.col(f"{hit}.size").alias(size))


def _marked(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, object, np.ndarray]]:
    """Like ``_scan`` for rows with their hit windows in the last two columns."""
    for lo, hi, data, offsets in slices(batch.column(at), SLICE):
        w = words_of(data, offsets)
        start = np.searchsorted(w.row, np.arange(hi - lo))
        cover = np.zeros(len(w.start) + 1, np.int64)
        firsts, sizes = (batch.column(batch.num_columns - k).slice(lo, hi - lo) for k in (2, 1))
        for r in np.flatnonzero(firsts.is_valid().to_numpy(zero_copy_only=False)):
            first = start[r] + np.asarray(firsts[int(r)].values, np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, first + np.asarray(sizes[int(r)].values, np.int64), -1)
        yield lo, hi, w, np.cumsum(cover[:-1]) > 0


def _row_start(column: pa.Array, lo: int, r: int) -> int:
    """Where row ``r`` begins in the slice that begins with row ``lo``."""
    _, offsets = byte_view(column.slice(lo, r - lo + 1))
    return int(offsets[-2])


def _cut(data: bytes, start: np.ndarray, end: np.ndarray, hit: np.ndarray) -> str:
    """The text without its runs of hit words."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    out, pos = [], 0
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        out.append(data[pos: start[a]])
        pos = int(end[b - 1])
    out.append(data[pos:])
    return b"".join(out).decode()
