import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF01
from panelforge.llm import bpe as B

CASES = [None, "", " ", "\n\nx  y\n z \n", "<|endoftext|>", "a <|endoftext|>b<|endo", "don't we'll 3.14,15 a_b", "x\x1c\x85y z　 é×÷,ª.",
         "日本語 テキスト。\n\n次", "😀😀 ​﻿", "z" * 5000, "wörd, " * 4000, "\r\n\t tab"]


def expected(text):
    tok = B.tokenizer_of(B.TOKENIZER)[0]
    ids = tok.encode(text or "", add_special_tokens=False).ids
    back = tok.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_query_equals_the_library(spark):
    from __spark_entry__ import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = queries()["op13_bpe_codec"](spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(tuple(r)[1:] == expected(texts[r.doc_id]) for r in rows)


@pytest.mark.parametrize("block", [900, 20_000, 1 << 20])
def test_odd_texts_ids_and_columns_in_blocks_of_any_size(spark, block):
    rows = [(k if k % 3 else None, t, "x", 1) for k, t in enumerate(CASES * 2)]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string, block int").repartition(3)
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in B.digest(df, block=block).collect())
    assert got == sorted((str(k), *expected(t)) for k, t, _, _ in rows)
    assert B.digest(df, block=block).schema["doc_id"].dataType == df.schema["doc_id"].dataType


def test_encode_and_decode_round_trip(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(CASES)], "doc_id long, text string")
    coded = B.encode(df).persist()
    tok = B.tokenizer_of(B.TOKENIZER)[0]
    assert {r.doc_id: r.ids for r in coded.collect()} == {k: tok.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(CASES)}
    assert {r.doc_id: r.text for r in B.decode(coded).collect()} == {k: t or "" for k, t in enumerate(CASES)}
    assert B.decode(coded.withColumnRenamed("doc_id", "text")).columns == ["text", "ids", "text_"]
    odd = spark.createDataFrame([(1, None), (2, []), (3, [-1, 999999, 64, None]), (4, [170, 64])], "k int, ids array<int>")
    want = {1: None, 2: "", 3: tok.decode([64]), 4: tok.decode([170, 64])}
    assert {r.k: r.text for r in B.decode(odd).collect()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.digest(df).collect() == [] and B.encode(df).collect() == [] and B.decode(B.encode(df)).collect() == []


def test_cuts_never_change_ids():
    rng = random.Random(7)
    parts = ["a", "b", " ", " ", "\n", "\n", "\t", "'", "s", "'ll", "é", "×", "ª", "1", "½", ".", ",", "<|endoftext|>", "<|endo", " ", "　", " ",
             " ", "\x85", "\x1c", "\x7f", "中", "😀", "́", "_", "᠎", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(8000)]
    tok, added = B.tokenizer_of(B.TOKENIZER)
    raw = [t.encode() for t in texts]
    size = np.array([len(r) for r in raw])
    ends, data = np.cumsum(size), b"".join(raw)
    first = B.cuts(np.frombuffer(data, np.uint8), (ends - size)[size > 0], added)
    own = np.searchsorted(ends, first, side="right")
    got = [[] for _ in texts]
    for k, a, b in zip(own, first, [*first[1:], len(data)]):
        got[k] += tok.encode(data[a:b].decode(), add_special_tokens=False).ids
    assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_packed_numbers_and_foreign_tokenizers():
    a = np.random.default_rng(0).integers(0, 2**32, 1000, dtype=np.uint32)
    assert (B._unpacked(B._packed(a)) == a).all() and len(B._unpacked(B._packed(a[:0]))) == 0
    with pytest.raises(ValueError):
        B.tokenizer_of("word_bpe_49k.json")
    assert B._hash_part(pa.array([b"a", b"", b"b"], pa.binary()), 5).max() < 5
