"""Best-fit packing of documents into training sequences, by vector best-fit.

A document is its token ids and an end id; only documents longer than a
sequence are cut, into pieces of full length and a rest.  Every sequence has
three capacities: tokens, pieces and attention cost (the sum of squared piece
lengths).  Pieces are placed by falling length into the open sequence that has
room in all three and fits best: the smallest weighted norm of what would be
left (``rule="norm"``) or the smallest weighted dot product of the piece's
needs and what is left (``rule="dot"``); if there is none, a new one opens.

Pieces are dealt evenly into groups of about ``GROUP`` pieces, whatever their
ids, and groups are packed independently: a group loses less than one
sequence against a single run.  Only lengths travel; ids are encoded again
where sequences are written.

Defined cases: null or empty texts are the end id alone; ties go to the
sequence opened first; repeated rows are packed once per row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import id_text, small_batches
from panelforge.llm.textgrams import slices
from panelforge.llm.tokens import encoder
from panelforge.operators.common import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 0
LENGTH = 2048
GROUP = 4096
#: Bytes of text that are encoded at a time: the arrays of a slice take several times as much.
SLICE = 2 << 20
WEIGHTS = (1.0, 0.01, 0.01)

_PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def _encoded(column: pa.Array, file: str):
    """For slices of rows: first row, ids with the end id, row offsets."""
    for lo, hi, _, _ in slices(column, SLICE):
        ids, offsets = encoder(file).encode(column.slice(lo, hi - lo))
        n = hi - lo
        out = np.full(len(ids) + n, END_ID, "<u4")
        bounds = offsets + np.arange(n + 1)
        body = np.ones(len(out), bool)
        body[bounds[1:] - 1] = False
        out[body] = ids
        yield lo, out, bounds


def cut(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece number, first id) of the pieces of rows with these id offsets."""
    size = np.diff(bounds)
    n = -(-size // length)
    row = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, piece, piece * length


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, on demand, the ids."""
    small_batches(docs.sparkSession)

    def encode(batches):
        for batch in batches:
            for lo, ids, bounds in _encoded(batch.column("text"), tokenizer):
                row, piece, start = cut(bounds, length)
                first = bounds[row] + start
                last = np.minimum(first + length, bounds[row + 1])
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(first.tolist(), last.tolist())]
                columns = [batch.column("id").take(pa.array(row + lo)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(last - first), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, last[-1:]).astype(np.int32)), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_text(docs, id_col, text_col).mapInArrow(encode, _PIECES + ", ids array<int>" * with_ids)


def best_fit(size: np.ndarray, tokens: int, max_pieces: int, attention: float, rule: str = "norm",
             weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of pieces of these sizes, all at most ``tokens``."""
    size = np.asarray(size, np.int64)
    need = np.stack([size / tokens, np.full(len(size), 1 / max_pieces), size.astype(float) ** 2 / attention], 1)
    weight, eps = np.array(weights), 1e-9
    left, used = np.empty((len(size), 3)), np.zeros(len(size), np.int64)
    sequence, offset, n, live = np.empty(len(size), np.int64), np.empty(len(size), np.int64), 0, np.empty(0, np.int64)
    order = np.argsort(-size, kind="stable")
    smallest = size[order[-1]] / tokens if len(size) else 0
    for i in order.tolist():
        v = need[i]
        room = left[live]
        fit = (room >= v - eps).all(1)
        if fit.any():
            at = np.flatnonzero(fit)
            score = ((room[at] - v) ** 2 @ weight) if rule == "norm" else room[at] @ (weight * v)
            k = live[at[np.argmin(score)]]
        else:
            k = n
            left[k] = 1.0
            n += 1
            live = np.append(live, k)
        sequence[i], offset[i] = k, used[k]
        left[k] -= v
        used[k] += size[i]
        if left[k, 0] < smallest - eps:
            live = live[live != k]
    return sequence, offset


def pack(parts: DataFrame, length: int = LENGTH, max_pieces: int | None = None, attention: float | None = None, rule: str = "norm",
         weights: tuple[float, float, float] = WEIGHTS, group: int = GROUP) -> DataFrame:
    """``parts`` (from ``pieces``, written) with sequence_id and offset.  The
    piece and attention capacities default to what a full sequence can need."""
    pieces_cap, cost_cap = max_pieces or length, attention or float(length) ** 2
    if cost_cap < float(length) ** 2:
        raise ValueError("the attention capacity must hold a full-length piece")
    groups = max(1, -(-parts.count() // group))
    dealt = parts.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def place(table: pa.Table) -> pa.Table:
        size = table["length"].to_numpy()
        sequence, offset = np.empty(len(size), np.int64), np.zeros(len(size), np.int64)
        full = size == length
        sequence[full] = np.arange(full.sum())
        rest, at = best_fit(size[~full], length, pieces_cap, cost_cap, rule, weights)
        sequence[~full], offset[~full] = rest + full.sum(), at
        base = table["g"][0].as_py() << 32
        return table.drop_columns("g").append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    return dealt.groupBy("g").applyInArrow(place, _PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", **capacities) -> DataFrame:
    """One row per piece with its place: the id column, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = materialize(pieces(docs, length, tokenizer, id_col, text_col))
    return pack(parts, length, **capacities).withColumnRenamed("id", id_col)


def sequences(docs: DataFrame, placed: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids and where each piece
    ends (ids of documents must be unique)."""
    ids = pieces(docs, length, tokenizer, id_col, text_col, with_ids=True).select(F.col("id").alias(id_col), "piece", "ids")
    rows = placed.select(id_col, "piece", "sequence_id", "offset").join(ids, [id_col, "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (rows.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                    F.transform("parts", lambda p: p["offset"] + F.size(p["ids"])).alias("ends")))
