import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelforge.llm import kneser_ney as K
from conftest import SF01


def model(texts):
    """Interpolated modified Kneser-Ney over code points, straight from the definition."""
    n = K.ORDER
    counts = {n: Counter()}
    for t in texts:
        s = "\0" * (n - 1) + t
        counts[n].update(s[i:i + n] for i in range(len(t)))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocabulary, disc, context = len(counts[1]) + 1, {}, {}
    for k, c in counts.items():
        cc = Counter(c.values())
        m = [cc[i] for i in (1, 2, 3, 4)]
        if all(m):
            y = m[0] / (m[0] + 2 * m[1])
            disc[k] = [min(max(i - (i + 1) * y * m[i] / m[i - 1], 0.0), float(i)) for i in (1, 2, 3)]
        else:
            disc[k] = [0.5, 0.75, 0.9]
        context[k] = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            context[k][g[:-1]][0] += v
            context[k][g[:-1]][1] += disc[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / vocabulary
        k = len(g)
        total, mass = context[k].get(g[:-1], (0, 0.0))
        if not total:
            return p(g[1:])
        v = counts[k].get(g, 0)
        return (v - disc[k][min(v, 3) - 1] if v else 0.0) / total + mass / total * p(g[1:])

    def perplexity(t):
        s = "\0" * (n - 1) + t
        return math.exp(-sum(math.log(p(s[i:i + n])) for i in range(len(t))) / len(t))

    return perplexity


GOOD = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the cats and the dogs sat", "naïve café, the end"] * 2
TEXTS = GOOD + ["the dog sat on the mat", "zzz### QQ", "", None, "é", "the " * 3000, "\U0001F600 cat"]


def frames(spark):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, 5, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, n int, trusted string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(GOOD))] + [(10, 1, 1), (11, 0, 0), (12, 1, None), (0, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("broadcast", [True, False])
def test_perplexities_follow_the_definition(spark, broadcast):
    docs, labels = frames(spark)
    got = {r.doc_id: r for r in K.quality(docs, labels, broadcast=broadcast).collect()}
    want = model([t for i, t in enumerate(TEXTS) if i < len(GOOD) or i == 12])
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        if not t:
            assert got[i].perplexity is None and not got[i].kept
        elif "\U0001F600" not in t:
            assert got[i].perplexity == pytest.approx(want(t))
    assert got[11].perplexity > got[10].perplexity and not got[11].kept and all(got[i].kept for i in range(len(GOOD)))


def test_probabilities_of_a_context_sum_to_one(spark):
    data = np.frombuffer("".join(GOOD).encode(), np.uint8)
    g, _ = K.grams(data, np.array([0, len(data)]))
    context = int(g[40]) >> K.BITS
    alphabet = sorted({int(x) & 0xFFF for x in g})
    asked = [((context << K.BITS) & ((1 << 60) - 1)) | a for a in alphabet]
    keys, n = np.unique(np.concatenate([g, np.array(asked)]), return_counts=True)
    counts = spark.createDataFrame([(int(k), int((g == k).sum())) for k in keys], "gram long, n long")
    p = {r.gram: r.p for r in K.probabilities(counts).collect()}
    total = sum(p[a] for a in asked)
    assert 0.9 < total <= 1 + 1e-9  # the rest is kept for symbols never seen


def test_no_model_and_empty_tables(spark):
    docs, labels = frames(spark)
    got = {r.doc_id: (r.perplexity, r.kept) for r in K.quality(docs, labels.limit(0)).collect()}
    assert got == {i: (None, bool(t)) for i, t in enumerate(TEXTS)}
    assert K.quality(docs.limit(0), labels).collect() == []


def test_query_keeps_good_and_drops_bad_documents(spark):
    from __spark_entry__ import queries

    rows = queries()["op8_quality_kneser_ney"](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality == 1 and r.toxic == 0], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) <= 0.4


@pytest.mark.parametrize("broadcast", [True, False])
def test_held_out_perplexity_lacks_what_only_the_text_itself_has(spark, broadcast):
    rows = spark.createDataFrame([(1, "the cat sat", "en", True), (2, "the cat sat", "en", True), (3, "zebra quartz", "en", True), (4, None, "en", False)], "id long, text string, lang string, trusted boolean")
    got = {r.id: r for r in K._scored(rows, broadcast).collect()}
    assert got[1].held == pytest.approx(got[1].perplexity) and got[3].held > 2 * got[3].perplexity
    assert got[4].held is None and [got[i].size for i in (1, 3, 4)] == [11, 12, 0]


def test_bounds_hold_on_more_documents(spark):
    folder = SF01.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rows = K.quality(docs, labels).join(labels, "doc_id", "left").collect()
    share = lambda rows: sum(r.kept for r in rows) / len(rows)
    assert share([r for r in rows if r.quality == 1 and r.toxic == 0]) >= 0.995
    assert share([r for r in rows if r.quality == 0]) <= 0.05
    assert share([r for r in rows if r.quality is None]) >= 0.84
