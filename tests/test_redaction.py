"""Native redaction against the recursion in plain Python."""

import json

from pyspark.sql import functions as F

from panelforge.sources import json_docs as jd

PATS = tuple(p.upper() for p in jd.SENSITIVE_KEY_PATTERN)


def recursion(x):
    if isinstance(x, dict):
        return {k: "[REDACTED]" if any(p in k.upper() for p in PATS) else recursion(v) for k, v in x.items()}
    return [recursion(v) for v in x] if isinstance(x, list) else x


DOCS = [
    {"a": 1, "API_KEY": "x", "b": {"token": {"deep": [1, {"k": 2}], "s": "}{]["}, "c": [1, 2, {"Secret": [], "d": None}]}},
    {"x": "my KEY: \"token\": 1, {", "key\\\"y": [[[]], {}], "tab\t\n": "\\\\", "secret": "\\\""},
    [], {}, "text with token", 5, None, True, [[{"TOKEN": {"token": {"token": 1}}, "z": 1}], {"é": "ü 中 😀", "my_key": -1.5e3}],
    {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": {"monkey": {"i": [1, [2, [3]]]}, "j": 1}}}}}}}}},
    {"list": list(range(300)), "keys": [{"n": k, "s": "v" * 50} for k in range(200)], "end": "e" * 20000},
]


def test_equals_recursion_without_python(spark):
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=i % 2 == 0, indent=i % 3 or None)) for i, d in enumerate(DOCS)], "i int, j string")
    out = df.select("i", jd.redact_json_deep(F.col("j")).alias("r"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in out.collect():
        assert json.loads(r.r) == recursion(DOCS[r.i]), r.i


def test_what_is_no_json_goes_as_a_whole(spark):
    texts = [None, "", "{", '{"a": 1', "token=1"]
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    assert [r.r for r in df.select(jd.redact_json_deep(F.col("j")).alias("r")).collect()] == [None] + ['"[UNPARSED]"'] * 4
    behind = spark.createDataFrame([('{"key": 1} token',)], "j string").select(jd.redact_json_deep(F.col("j")).alias("r")).first()
    assert behind.r == '{"key":"[REDACTED]"}'  # what follows the value is dropped


def test_long_runs_keep_their_text_and_all_plain_values_go(spark):
    wide = {f"n{k}": [k, f"a:{k}", {"token": k, "plain": "the key: \\" , "müll\u2028": "\u2028"}] for k in range(900)}
    texts = [json.dumps(wide), json.dumps({"ßecret": 1, "é": [2, {"x:KEY": "a\"b:"}], "": ":", "key": [], "a": {"keys": {"b": {}}, "c": None}}), '[1,"key",{"k":"key"}]', '"key"']
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    for t, r in zip(texts, df.select(jd.redact_json_deep(F.col("j")).alias("r")).collect()):
        assert json.loads(r.r) == recursion(json.loads(t))
    # strings and marks between sensitive keys are one token, not one each
    run = df.limit(1).select(jd.redact_json_deep(F.lit(json.dumps({"a": list(range(5000))}))).alias("r")).first().r
    assert json.loads(run) == {"a": list(range(5000))}
