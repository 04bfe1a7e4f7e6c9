"""Byte-level BPE encoding and decoding with a distinct-word table.

``split`` cuts texts into words and gives blocks of about ``BLOCK`` bytes: the
word numbers of every document by position, and the block's distinct words,
dealt into hash parts.  ``word_ids`` meets the words of one part from all
blocks and encodes each distinct word once.  ``encode`` joins the ids back to
the blocks (written in buckets, so that they aren't shuffled) and puts them together by position.  ``decode`` joins ids with the
table of pieces and reads the bytes as UTF-8.  What travels is numbers and
distinct words of blocks, never a row per word; a frequent word comes once
from each block, whatever its share of the text.

A cut is made only where the tokenizer always starts a new piece, so that words
can be encoded on their own: before white space after something else, on
both sides of a single line feed, and before ASCII punctuation after a letter
or digit; never inside an added token of the tokenizer.  Where a neighbour might be
white space beyond ASCII no cut is made.

Defined cases: null texts are empty and have no ids; rows are independent, so
null and repeated ids, repeated rows and extra columns change nothing; a
document longer than a block is a block of its own.  Ids that the vocabulary
doesn't have decode to nothing, null lists to null, bytes that aren't UTF-8 to
U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.llm.common import fresh
from panelforge.llm.textgrams import byte_view
from panelforge.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
BLOCK = 32 << 20
#: Bytes of text for each hash part of the distinct words, and the least number of parts.
PART_BYTES, LEAST_PARTS = 64 << 20, 64
#: Spark's limit of buckets; a bucket's blocks are put together one at a time, however many it has.
MOST_BUCKETS = 100_000
#: Words that the tokenizer takes in one call, bytes that are searched for cuts and words that are put together at a time.
CALL, SLICE, TOGETHER = 50_000, 4 << 20, 1 << 20

_BYTE = np.arange(256)
_SPACE = ((_BYTE >= 9) & (_BYTE <= 13)) | (_BYTE == 32)
_ALNUM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
_PUNCT = (_BYTE > 32) & (_BYTE < 127) & ~_ALNUM
#: Bytes that surely begin or are something other than white space: ASCII from 21, and lead bytes of no white space.
_SURE = ((_BYTE > 32) & (_BYTE < 127)) | (_BYTE >= 0xC3) & ~np.isin(_BYTE, [0xE1, 0xE2, 0xE3])


@lru_cache(maxsize=4)
def tokenizer_of(file: str):
    """The tokenizer of a worker; only byte-level ones can be split into words."""
    from tokenizers import Tokenizer

    if not os.path.isabs(file):
        import public_tokenizers

        file = public_tokenizers.path(file)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(file)
    tok.no_truncation()
    tok.no_padding()
    spec = json.loads(tok.to_str())
    pre = spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
    if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{file} is not a plain byte-level tokenizer")
    return tok, [t["content"].encode() for t in spec["added_tokens"]]


def cuts(data: np.ndarray, starts: np.ndarray, added: list[bytes]) -> np.ndarray:
    """First byte of every word of the rows that begin at ``starts`` in ``data``."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    space, alnum = _SPACE[data], _ALNUM[data]
    # a character's last byte that surely is no white space: ASCII, or one behind a lead byte from C3 to DF or F0 on
    solid = _SURE[data] & (data < 128)
    solid[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    solid[3:] |= (data[3:] >= 0x80) & (data[:-3] >= 0xF0)
    letter = alnum.copy()  # Latin letters of two bytes count too, but for the signs of multiplication and division
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.zeros(n, bool)
    cut[1:] = (space[1:] & solid[:-1]) | (_PUNCT[data[1:]] & letter[:-1])
    if n > 2:
        cut[2:] |= (data[1:-1] == 10) & solid[:-2] & _SURE[data[2:]]
    raw = data.tobytes() if added else b""
    for word in added:
        at = raw.find(word)
        while at >= 0:
            cut[at + 1: at + len(word)] = False
            at = raw.find(word, at + 1)
    cut[starts[starts < n]] = True  # a cut behind a row's first line feed is right whatever the row before ends with
    return np.flatnonzero(cut)


def _packed(a: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as zstd of their byte planes."""
    planes = np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T
    return len(a).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    raw = pa.decompress(b[8:], 4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _hash_part(words: pa.Array, parts: int) -> np.ndarray:
    """Part of each distinct word: a polynomial hash of its bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: offsets[-1]].astype(np.uint64)
    size = np.diff(offsets)
    h = size.astype(np.uint64)
    for k in range(int(min(size.max(initial=0), 24))):  # the first 24 bytes and the length spread words enough
        has = size > k
        h[has] = h[has] * np.uint64(0x100000001B3) + data[offsets[:-1][has] + k]
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)).astype(np.int64) % parts


def _written(*columns: pa.Array) -> bytes:
    """Arrays of one length as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in columns], names=[str(k) for k in range(len(columns))])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read(data: bytes) -> list[pa.Array]:
    return pa.ipc.open_stream(data).read_next_batch().columns


_BLOCKS = "block long, part int, data binary, parts binary, words binary"


def _block_rows(number: int, keys: pa.Array, data: np.ndarray, size: np.ndarray, parts: int, added: list[bytes]) -> list[tuple]:
    """Rows of one block: a row with part -1 that holds row ids, words per row, part of each
    distinct word and word numbers (by falling frequency), and a row for each part with its words."""
    ends = np.cumsum(size)
    bounds, found, lo = np.append(0, ends), [], 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SLICE, side="right")) - 1)
        own = bounds[lo:hi] - bounds[lo]
        found.append(cuts(data[bounds[lo]: bounds[hi]], own[size[lo:hi] > 0], added) + bounds[lo])
        lo = hi
    first = np.concatenate(found)
    counts = np.diff(np.searchsorted(first, bounds))
    if not len(first):
        return [(number, -1, _written(keys, pa.array(counts)), None, None)]
    offsets = pa.py_buffer(np.append(first, bounds[-1]).astype(np.int32))
    coded = pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
    distinct, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(code, minlength=len(distinct)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    part = _hash_part(distinct, parts)[order]
    rows = [(number, -1, _written(keys, pa.array(counts)), _packed(part), _packed(rank[code]))]
    by_part = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[by_part], np.arange(parts + 1))
    words = distinct.take(pa.array(order[by_part]))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        rows.append((number, p, _written(words.slice(edges[p], edges[p + 1] - edges[p])), None, None))
    return rows


def split(docs: DataFrame, parts: int, tokenizer: str = TOKENIZER, block: int = BLOCK) -> DataFrame:
    """Blocks of rows (columns ``id``, ``text``), see ``_block_rows``."""

    def blocks(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        added = tokenizer_of(tokenizer)[1]
        ids, raws, sizes, held = [], [], [], 0

        def flush():
            nonlocal number, ids, raws, sizes, held
            data, size = np.concatenate(raws), np.concatenate(sizes)
            keys, ids, raws, sizes, held = pa.concat_arrays(ids), [], [], [], 0
            if len(data) >= 1 << 31:
                raise ValueError("a document of 2 GB or more")
            columns = zip(*_block_rows(number, keys, data, size, parts, added))
            number += 1
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "part", "data", "parts", "words"])

        for batch in batches:
            raw, offsets = byte_view(pc.fill_null(batch.column("text"), ""))
            lo, n = 0, batch.num_rows
            while lo < n:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block - held, side="right")) - 1)
                if held and offsets[hi] - offsets[lo] > block - held:
                    yield flush()
                    continue
                ids.append(batch.column("id").slice(lo, hi - lo))
                raws.append(raw[offsets[lo]: offsets[hi]].copy())
                sizes.append(np.diff(offsets[lo: hi + 1]))
                held += int(offsets[hi] - offsets[lo])
                lo = hi
                if held >= block:
                    yield flush()
        if ids:
            yield flush()

    return docs.select("id", "text").mapInArrow(blocks, _BLOCKS)


def word_ids(blocks: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Ids of the distinct words of every block and part: each distinct word of a
    part is encoded once and its ids go back to all blocks that have it."""

    def encode(table: pa.Table) -> pa.Table:
        tok = tokenizer_of(tokenizer)[0]
        lists = [_read(d.as_py())[0] for d in table["data"]]
        coded = pa.concat_arrays(lists).dictionary_encode()
        distinct = coded.dictionary.cast(pa.string())
        flat, size = [], []
        for lo in range(0, len(distinct), CALL):
            for e in tok.encode_batch_fast(distinct.slice(lo, CALL).to_pylist(), add_special_tokens=False):
                flat.append(e.ids)
                size.append(len(e.ids))
        size = np.array(size, np.int64)
        ids = np.fromiter((i for e in flat for i in e), "<u4", int(size.sum()))
        start = np.cumsum(size) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        out, at = [], 0
        for own in lists:
            c = code[at: at + len(own)]
            at += len(own)
            out.append((_packed(size[c]), _packed(ids[_spread(start[c], size[c])])))
        sizes, data = zip(*out)
        return pa.table({"block": table["block"], "part": table["part"], "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(data, pa.binary())})

    return blocks.filter("part >= 0").groupBy("part").applyInArrow(encode, "block long, part int, sizes binary, ids binary")


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of runs of these sizes that begin at ``start``, one run after the other."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks written once, bucketed by their number, so that word numbers stay
    where they are when ids come back.  The table is not kept in the catalog."""
    spark, path = blocks.sparkSession, scratch_path(blocks.sparkSession, "bpe")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    blocks.write.bucketBy(buckets, "block").option("path", path).format("parquet").saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE `{name}`")
    return written


def _each_block(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, block: int, make, schema: T.StructType) -> DataFrame:
    """Rows that ``make(keys, ids, offsets)`` gives for the encoded documents of each block."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = _bucketed(split(rows, max(LEAST_PARTS, -(-size // PART_BYTES)), tokenizer, block), min(MOST_BUCKETS, max(LEAST_PARTS, -(-2 * size // block))))
    words = word_ids(blocks, tokenizer)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, counts = _read(left["data"][0].as_py())
        bounds = np.append(0, np.cumsum(counts.to_numpy()))
        code, part, flat, size = (np.empty(0, np.uint32),) * 4
        if bounds[-1]:
            code, part = (_unpacked(left[c][0].as_py()) for c in ("words", "parts"))
            right = right.sort_by("part")
            flat, got = (np.concatenate([_unpacked(x.as_py()) for x in right[c]]) for c in ("ids", "sizes"))
            by_part = np.argsort(part, kind="stable")
            size = np.empty(len(got), np.int64)
            start = np.empty(len(got), np.int64)
            size[by_part], start[by_part] = got, np.cumsum(got) - got
        out, lo = [], 0
        while lo < len(keys):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + TOGETHER, side="right")) - 1)
            own = code[bounds[lo]: bounds[hi]]
            n = size[own]
            ends = np.append(0, np.cumsum(n, dtype=np.int64))
            ids = flat[_spread(start[own], n)] if len(own) else flat[:0]
            out.append(make(keys.slice(lo, hi - lo), ids, ends[bounds[lo: hi + 1] - bounds[lo]]))
            lo = hi
        return pa.concat_tables(out)

    docs_of = blocks.filter("part = -1").select("block", "data", "parts", "words")
    return docs_of.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, schema)


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: its id and ``ids`` (array of int)."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def make(keys, ids, offsets):
        return pa.table([keys, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))], names=schema.names)

    return _each_block(docs, id_col, text_col, tokenizer, block, make, schema)


@lru_cache(maxsize=4)
def pieces(tokenizer: str) -> pa.Array:
    """The id-to-piece table: bytes of each id (empty where there is none)."""
    tok, added = tokenizer_of(tokenizer)
    # fixed: the printable characters that stand for bytes in byte-level vocabularies
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocab = tok.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return pa.array(out, pa.binary())


def decoded(ids: np.ndarray, offsets: np.ndarray, tokenizer: str = TOKENIZER) -> list[bytes]:
    """UTF-8 text of each row of ids: a join by position with the piece table."""
    table = pieces(tokenizer)
    known = np.where((ids >= 0) & (ids < len(table)), ids, -1)
    got = table.take(pa.array(known, pa.int64(), mask=known < 0))
    at = np.frombuffer(got.buffers()[1], np.int32)[got.offset: got.offset + len(got) + 1]
    raw = (got.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    spans = at[offsets].tolist()
    return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(spans, spans[1:])]


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in a further column (``out``, or a free variant of that name)."""
    name = fresh(encoded, out)
    schema = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])

    def read(batches):
        for batch in batches:
            col = batch.column(batch.schema.names.index(ids_col))
            flat = pc.fill_null(col.flatten(), -1).cast(pa.int64()).to_numpy(zero_copy_only=False)
            offsets = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)))
            texts = pa.array(decoded(flat, offsets, tokenizer), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.if_else(col.is_valid(), texts, pa.scalar(None, pa.string()))], names=schema.names)

    return encoded.mapInArrow(read, schema)


def digest(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids as little-endian unsigned
    32-bit integers and of the text that they decode to."""
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
    types = [docs.schema[id_col].dataType, T.LongType(), T.StringType(), T.StringType()]

    def make(keys, ids, offsets):
        raw = memoryview(ids.astype("<u4").tobytes())
        spans = (4 * offsets).tolist()
        sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(spans, spans[1:])]
        text = [hashlib.sha256(t).hexdigest() for t in decoded(ids.astype(np.int64), offsets, tokenizer)]
        return pa.table([keys, pa.array(np.diff(offsets)), pa.array(sha, pa.string()), pa.array(text, pa.string())], names=names)

    return _each_block(docs, id_col, text_col, tokenizer, block, make, T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
