import hashlib
import re

import pytest
from pyspark.sql import functions as F

from panelforge.llm import decontaminate as D

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[a:a + k]), set()).add(str(i))
    sizes = {len(k) for k in wins}
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit |= set(range(a, a + k))
                    ids |= wins[tuple(w[a:a + k])]
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries
    from conftest import SF01

    docs = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").select("item_id", "text").collect()]
    got = result(queries()["op7_benchmark_decontamination"](spark, SF01))
    assert got == brute(docs, items) and sum(v[4] for v in got.values()) > 3


CASES = [(1, None), (2, ""), (3, "a b c d e f g h i j k"), (4, "x a\tb c D e F g h i J k y"), (5, "short one here"),
         (6, "SHORT, one - hère short one héré"), (7, "ünï " * 3000 + "short one here"), (8, "\n\n..!"), (9, "k j i h g f e d c b a")]
ITEMS = [(10, "A b c d e f g h i j k"), (9, "Short one HERE"), (2, None), (3, " .. "), (4, "Short one HERE")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_edge_cases_in_both_forms(spark, broadcast):
    docs = spark.createDataFrame([(d, t, 7) for d, t in CASES], "doc_id long, text string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(D.hits(docs, items, broadcast=broadcast)) == brute(CASES, ITEMS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    for b in (True, False):
        assert result(D.hits(docs, items, broadcast=b)) == brute([(1, "a b")], [])
        assert result(D.hits(docs.limit(0), items, broadcast=b)) == {}


def test_decontaminate_cuts_passages_and_drops_mostly_copied_documents(spark):
    rows = [(1, "one two three four five. A b c d e f g h i j k! six seven eight nine ten eleven", 3), (2, "a b c d e f g h i j k", 3), (3, "clean", 3), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in D.decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    left = "one two three four five. ! six seven eight nine ten eleven"
    assert got == {1: (left, len(left)), 3: ("clean", 5), 4: (None, None)}


def test_decontaminate_is_the_same_in_both_forms(spark):
    clean = "lorem ipsum dolor " * 6000
    rows = [(1, "one two three four five. A b c d e f g h i j k! six seven eight nine ten eleven", 3), (1, "clean row of the same id", 3), (2, "a b c d e f g h i j k", 3), (3, "clean", 3),
            (4, None, None), (None, "short one here", 3), (None, "é short ONE here and ü more words", 3), (5, clean + "a b c d e f g h i j " + clean, 3), (6, "short one here " * 3 + "x " * 30, 3)]
    rows += [(d + 10, t, 7) for d, t in CASES]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("row_key", F.lit("x")).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [sorted(map(repr, D.decontaminate(docs, items, broadcast=b).collect())) for b in (True, False)]
    assert got[0] == got[1]
    texts = [(r.doc_id, r.text) for r in D.decontaminate(docs, items, broadcast=False).collect()]
    assert (1, "clean row of the same id") in texts and (5, clean + " " + clean) in texts and (None, "é  and ü more words") in texts and len([t for d, t in texts if d == 5]) == 1
    assert not [d for d, t in texts if d == 2 or t == "short one here"]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, empty, broadcast=False).count() == len(rows) and D.decontaminate(docs.limit(0), items, broadcast=False).count() == 0


def test_both_forms_agree_on_text_ids_null_ids_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "short one here"), (1, "a b c d e f g h i j k"), (None, "short one here and more"), (None, "clean"), (2, "short one here")], "doc_id long, text string")
    items = spark.createDataFrame([("x-1", "short one here"), ("é2", "A b c d e f g h i j k"), (None, "short one here")], "item_id string, text string")
    got = [sorted(map(repr, D.hits(docs, items, broadcast=b).collect())) for b in (True, False)]
    assert got[0] == got[1] and len(got[0]) == 5 and sum("contaminated=True" in r for r in got[0]) == 4
    cut = [sorted(map(repr, D.decontaminate(docs, items, broadcast=b).collect())) for b in (True, False)]
    assert cut[0] == cut[1]
