import zlib
from collections import defaultdict

import numpy as np
import pytest

from panelforge.llm import packing as K
from panelforge.llm.tokens import encoder
from conftest import SF001, SF01


def ids_of(text):
    return encoder(K.TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, texts, length=2048):
    """Every piece right, sequences gapless and within bounds; returns the number of sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for d, own in by_doc.items():
        ids = ids_of(texts[d])
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // length)))
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert r.start == r.piece * length and r.length == min(length, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for spans in by_seq.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= length
    return len(by_seq)


def test_query_round_trip(spark):
    from __spark_entry__ import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = queries()["op2_best_fit_packing"](spark, SF01).collect()
    n = check(rows, texts)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1


CASES = {1: None, 2: "", 3: " \n", 4: "<|endoftext|> a", 5: "İstanbul don't x\x1cy é é  z", 6: "wörd, " * 5000, 7: "x" * 9000, 8: "it's 12 !!??"}


def test_odd_texts_and_real_sequences(spark):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in CASES.items()], "doc_id long, text string, piece int, offset long")
    placed = K.pack_documents(df, length=64).persist()
    check(placed.collect(), CASES, 64)
    where = {(r.sequence_id, r.offset): r for r in placed.collect()}
    for s in K.sequences(df, placed, length=64).collect():
        start = 0
        for end in s.ends:
            r = where[(s.sequence_id, start)]
            assert s.ids[start:end] == ids_of(CASES[r.doc_id])[r.start:r.start + r.length]
            start = end
        assert start == len(s.ids) <= 64
    assert K.pack_documents(df.limit(0)).collect() == []


def test_repeated_rows_are_packed_each(spark):
    df = spark.createDataFrame([(1, "a b c")] * 9, "doc_id long, text string")
    rows = K.pack_documents(df, length=8).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 9 and len({r.sequence_id for r in rows}) == 5


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(0)
    size = rng.integers(1, 101, 600)
    for max_pieces, attention in ((100, 1e4), (3, 1e4), (100, 1e4 + 1), (4, 1.2e4)):
        seq, off = K.best_fit(size, 100, max_pieces, attention, rule)
        for s in np.unique(seq):
            own = size[seq == s]
            assert own.sum() <= 100 and len(own) <= max_pieces and (own.astype(float) ** 2).sum() <= attention + 1e-6
            assert sorted(off[seq == s]) == sorted(np.cumsum(own[np.argsort(off[seq == s])]) - own[np.argsort(off[seq == s])])
    seq, _ = K.best_fit(size, 100, 100, 1e4, rule)
    left = []  # plain best-fit decreasing on tokens alone
    for n in sorted(size.tolist(), reverse=True):
        fit = [k for k, r in enumerate(left) if r >= n]
        if fit:
            left[min(fit, key=lambda k: left[k])] -= n
        else:
            left.append(100 - n)
    assert seq.max() + 1 <= len(left) + 2


def test_words_are_cut_at_marks_and_keep_their_ids():
    import pyarrow as pa

    texts = ["Word, word; WORD!", "don't x'.s ''s a.'tis 'VE", "J\u030c! A\u030a. <\u0338b a<\u0338", "", "É.a«!b a.«", "12a3.4 a1,2 ...a", "<|endoftext|> a\u00a0.b", ".", "ΑΣ.a İ'm", "a", "é"]
    e = encoder(K.TOKENIZER)
    for column in (pa.array(texts), pa.array(["zz.", *texts]).slice(1), pa.array(texts, pa.large_string())):
        ids, bounds = e.encode(column)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert "word" in e.words and not {"Word,", "word;", "WORD!"} & e.words.keys()


def test_a_worker_encodes_large_texts_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([" ".join(f"word{i % 900}, and-more" for i in range(k, k + 40_000)) for k in range(12)])
    list(K._encoded(texts.slice(0, 1), K.TOKENIZER))  # the words are known
    tracemalloc.start()
    ids = [len(own) for _, own, _ in K._encoded(texts, K.TOKENIZER)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) > 3 and peak < 5 * texts.nbytes


def test_remembered_words_take_little_memory(monkeypatch):
    """Words are remembered in Arrow and numpy, some 50 bytes each, and right after they are begun again."""
    import tracemalloc

    import pyarrow as pa
    from panelforge.llm import tokens as T

    e = T.Encoder(K.TOKENIZER)
    texts = [" ".join(f"w{chr(97 + k % 26)}{k}" for k in range(lo, lo + 10_000)) for lo in range(0, 60_000, 10_000)]
    e.encode(pa.array(["warm up"]))
    tracemalloc.start()
    held = pa.total_allocated_bytes()
    for t in texts:
        ids, bounds = e.encode(pa.array([t]))
        assert bounds.tolist() == [0, len(ids)]
    grown = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - held
    tracemalloc.stop()
    assert len(e.words) > 60_000
    assert grown < 90 * 60_000
    assert ids.tolist() == ids_of(texts[-1])[:-1]
    monkeypatch.setattr(T, "REMEMBER", 100)
    for t in [texts[0], "wa0 don't", None, texts[1] + " wa0"]:
        assert e.encode(pa.array([t], pa.string()))[0].tolist() == ids_of(t)[:-1]
    assert len(e.words) <= 10_001
