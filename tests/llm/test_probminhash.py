import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelforge.llm import probminhash as P
from panelforge.llm.components import components

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def weights(text):
    w = WORD.findall((text or "").lower())
    n = min(5, len(w))
    c = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1 if n else 0))
    return {k: 1 + math.log(v) for k, v in c.items()}


def jp(x, y):
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def brute_groups(rows, threshold=0.8):
    """doc -> smallest id of its group, over all pairs that share a shingle."""
    ws = {d: weights(t) for d, t in rows}
    texts = {d: (t or "").strip().lower() for d, t in rows}
    parent = {d: d for d, _ in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    by = {}
    for d, w in ws.items():
        for s in w:
            by.setdefault(s, []).append(d)
        if not w and texts[d]:
            by.setdefault(("text", texts[d]), []).append(d)
    pairs = {(a, b) for s, ds in by.items() for i, a in enumerate(sorted(ds)) for b in sorted(ds)[i + 1:]}
    for a, b in pairs:
        x, y = ws[a], ws[b]
        big, small = max(len(x), len(y)), min(len(x), len(y))
        if (not x and not y) or (x and y and small / big > 0.3 and jp(x, y) >= threshold):
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    return {d: find(d) for d in parent}


def test_query_equals_brute_force_at_sf0001(spark):
    from __spark_entry__ import queries
    from conftest import SF001

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op10_minhash_near_dedup"](spark, SF001).collect()
    want = brute_groups(rows)
    assert {r.doc_id: r.group_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.group_id) for r in got) and len(set(want.values())) < len(want)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40):
        x = {int(k): float(rng.integers(1, 9)) for k in rng.integers(1, 60, n)}
        y = {int(k): float(rng.integers(1, 9)) for k in rng.integers(1, 60, n)}
        arrays = [(np.array(sorted(v), np.uint64), np.array([v[k] for k in sorted(v)])) for v in (x, y)]
        exact = jp(x, y)
        assert P.probability_jaccard(*arrays) == pytest.approx(exact)
        m = 4096
        reg = P.probminhash(np.repeat([0, 1], [len(x), len(y)]), np.concatenate([a[0] for a in arrays]) * np.uint64(0x9E3779B97F4A7C15),
                            np.concatenate([a[1] for a in arrays]), 2, m)
        assert abs((reg[0] == reg[1]).mean() - exact) < 5 * math.sqrt(0.25 / m)


def sample(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows, base = [], text(200)
    for _ in range(60):  # near copies of one text
        w = base.split()
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append(" ".join(w))
    rows += [base.upper().replace(" ", ",  ")] * 20  # copies
    passage = text(60)
    rows += [text(30) + " " + passage + " " + text(30) for _ in range(40)]  # a shared passage is no near copy
    rows += ["tiny", "Tiny!", "tiny two", "", None, " \n", "***", "*** ", "!!", "é è", "É È", text(20000)]
    return list(enumerate(rows, 1000))


def test_copies_near_copies_and_odd_texts(spark):
    rows = sample()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, id string, group_id int")
    got = {r.doc_id: r.group_id for r in P.near_duplicates(df).collect()}
    assert got == brute_groups(rows)
    kept = {r.doc_id for r in P.deduplicate(df.union(df)).collect()}
    assert kept == set(got.values()) and P.deduplicate(df.union(df)).count() == len(kept)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.near_duplicates(df).collect() == [] and P.deduplicate(df).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 200), (None, 3)]
    random.Random(0).shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_null_and_repeated_ids_are_documents_of_their_own(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(None, text(1), "a"), (None, text(2), "b"), (2, text(3), "c"), (2, text(4), "d"), (5, text(1), "e"), (2, text(3), "f"), (None, None, "g"), (9, "", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    out = P.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(r.row_key for r in out.collect() if r.row_key not in "cf") == ["b", "d", "e", "g", "h"] and sum(r.row_key in "cf" for r in out.collect()) == 1
    got = P.near_duplicates(df).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 6
    assert sorted((r.doc_id is None, r.doc_id or 0, r.group_id is None, r.group_id or 0, r.kept) for r in got if r.doc_id != 2) == [
        (False, 5, False, 5, True), (False, 9, False, 9, True), (True, 0, False, 5, False), (True, 0, True, 0, True), (True, 0, True, 0, True)]


def test_recall_in_a_large_group_about_the_threshold(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    base, rows = rng.choices(words, k=220), []
    for i in range(300):  # one to seven edits: many pairs lie just below the threshold, many texts are linked through others only
        w = list(base)
        for _ in range(1 + i % 7):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    w = [P._weights(t) for _, t in rows]  # jp() itself is checked above; it is too slow for all pairs
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if P.probability_jaccard(w[a], w[b]) >= 0.8 - 1e-9:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = {i: find(i) for i in range(len(rows))}
    got = {r.doc_id: r.group_id for r in P.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [d for d in want if sum(g == want[d] for g in want.values()) > 1]
    hit = sum(got[d] == want[d] for d in linked) / len(linked)
    assert all(want[got[d]] == want[d] for d in want) and hit >= 0.97, hit
