import zlib

from panelforge.llm import langid as L
from conftest import SF01


def test_held_out_accuracy_and_digest_columns(spark):
    from __spark_entry__ import queries

    got = {r.doc_id: r for r in queries()["op9_language_id"](spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = []
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and d.lang is not None and any(c.isalpha() for c in d.text or ""):
            right.append(r.lang_pred == d.lang)
    assert len(right) > 150 and sum(right) / len(right) >= 0.98


def rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10**6 + i, t, "en") for i, t in enumerate([None, "", " 12 ** !", "\n", "щука мышь зебра", "the and of that", "a" * 300000])] + [(None, "the and", None)]
    return docs.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 AS id", "'x' AS held_out")


def test_edge_texts(spark):
    df = rows(spark)
    model = L.fit(df)
    got = {r.doc_id: r for r in L.predict(df, model).where("doc_id is null or doc_id >= 1000000").collect()}
    for i in (0, 1, 2, 3):
        assert (got[10**6 + i].lang_pred, got[10**6 + i].score, got[10**6 + i].accepted) == ("und", 0.0, False)
    assert got[10**6 + 5].lang_pred == "en" and got[10**6 + 6].lang_pred != "und" and got[None].held_out
    assert not got[10**6 + 4].accepted or got[10**6 + 4].score < 0.9
    kept = L.keep_accepted(df, model)
    assert kept.columns == df.columns
    assert kept.count() == L.predict(df, model).where("accepted").count()


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None), (3, "..", None)], "doc_id long, text string, lang string")
    assert L.fit(df) is None and L.fit(df.limit(0)) is None
    assert [r.lang_pred for r in L.predict(df, None).collect()] == ["und"] * 3
    assert [r.doc_id for r in L.keep_accepted(df, None).collect()] == [1]
    assert L.predict(df.limit(0), None).collect() == []


def test_every_language_is_learned(spark):
    langs = [f"l{k:03d}" for k in range(L.MANY_LANGS + 4)]
    docs = [(10 * k + i, " ".join([chr(0x4E00 + 7 * k + j) * 3 for j in range(7)] * 3), v) for k, v in enumerate(langs) for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.fit(df)
    learned = {v for i, _, v in docs if zlib.crc32(str(i).encode()) % 5}
    assert set(model.langs) == learned == set(langs)
    got = L.predict(df, model).collect()
    assert len(got) == len(docs) and {r.lang_pred for r in got} <= set(langs) and all(0 <= r.score <= 1 for r in got)
