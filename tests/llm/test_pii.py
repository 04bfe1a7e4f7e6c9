import hashlib
import re

import pytest

from panelforge.llm import pii
from conftest import SF01


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(m):
    return re.sub("[^0-9]", "", m[0])


PLAIN = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
         ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
         ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
         ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(only_digits(m)) <= 15)]


def brute(text):
    base = [f"{k}:{m.start()}:{m.end()}" for k, rx, ok in PLAIN for m in rx.finditer(text or "") if ok(m)]
    return (*[sum(s.startswith(k + ":") for s in base) for k, _, _ in PLAIN], hashlib.sha256(",".join(base).encode()).hexdigest()), base


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op5_pii"](spark, SF01).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        want, base = brute(text)
        assert tuple(got[d])[1:6] == want
        assert set(base) <= set(got[d].spans.split(","))
    assert sum(sum(tuple(r)[1:5]) for r in got.values()) > 20


CASES = [None, "", "a@b.c.d@e.f g%h+i@j-k.l..m n@o.p. q@r _s@t.uu_vv@w.x", "1.2.3.4.5.6.7.8 256.1.1.1 0001.0255.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1",
         "x4111111111111111 12--4111111111111111 4111  1111111111111 5500005555555559-4", "+44 (0)20 7946-0958 +1-1 +12345678 +1234567890123456 ++49.30.901820 +1 (555) 010-9999)", "é@é.com \U0001F600 me@here.org ﷐you@there.net",
         "a" * 60000 + " " + "9" * 60000 + " b@c" + ".d" * 20000 + " " + "1 " * 30000, "mail to x@y.z, " * 800, "1.2.3.4111111111111111", "0.0.0.0 000000000000000000", "+1.2.3.4.5.6.7.8.9 a@1.2.3.4"]


def test_edge_texts(spark):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(CASES)] + [(2, CASES[2], None, None)], "doc_id long, text string, found string, plain int")
    for r in pii.digest(df).collect():
        assert tuple(r)[1:6] == brute(CASES[r.doc_id])[0], CASES[r.doc_id][:80]
    assert pii.digest(df.limit(0)).collect() == []


@pytest.mark.parametrize("text,spans", [
    ("IBAN DE89 3704 0044 0532 0130 00 ok", ["iban:5:32"]), ("GB82WEST12345698765432", ["iban:0:22"]), ("GB82WEST12345698765431", []),
    ("social security 123-45-6789", ["ssn:16:27"]), ("part no 123-45-6789", []), ("ssn" + " " * 60 + "123-45-6789", [])])
def test_added_kinds_need_checks_or_context(spark, text, spans):
    got = pii.digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [s for s in got.split(",") if s] == spans


IBAN = "DE89 3704 0044 0532 0130 00"
PROSE = [(IBAN + " Please", ["iban:0:27"]), (IBAN + " 2024", ["iban:0:27"]), ("DE89370400440532013000 BIC COBADEFF", ["iban:0:22"]), (IBAN + "x", []),
         ("To " + IBAN + " GB82 WEST 1234 5698 7654 32 NOW", ["iban:3:30", "iban:31:58"]), ("BE12 " + IBAN, ["iban:5:32"]), ("ID12 " + IBAN, ["iban:5:32"]),
         ("é\U0001F600 FR14 2004 1010 0505 0001 3M02 606 A", ["iban:3:36"]), ("NO9386011117947 and BE68 5390 0754 7034 OK", ["iban:0:15", "iban:20:39"]), ("DE893704004405320130 00 0", ["iban:0:23"]), ("DE893704004405320130000", []),
         ("SSN 123-45-6789, 123-45-6780", ["ssn:4:15", "ssn:17:28"]), ("ssn" + " " * 46 + "123-45-6789 123-45-6780", []), ("ssn" + " " * 45 + "123-45-6789 123-45-6780", ["ssn:48:59"]),
         ("AA11 " * 5000 + IBAN, ["iban:25000:25027"])]


def test_added_kinds_in_prose(spark):
    got = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(list(enumerate(t for t, _ in PROSE)), "doc_id long, text string")).collect()}
    for i, (text, spans) in enumerate(PROSE):
        assert [s for s in got[i].split(",") if s.startswith(("iban", "ssn"))] == spans, text[:80]
    masked = pii.mask(spark.createDataFrame([(1, IBAN + " Please")], "doc_id long, text string")).first().text
    assert masked == "[IBAN] Please"


def test_scores_follow_context(spark):
    rows = pii.find(spark.createDataFrame([(1, "server 10.0.0.1 and then, a good deal of text after which stands 10.0.0.2")], "doc_id long, text string")).first().found
    assert [s.score for s in rows] == [0.9, 0.6]


def test_mask(spark):
    rows = [(1, "to a@b.cc, 10.0.0.1!", "en", 20), (2, None, "en", None), (3, "clean", "en", 5), (4, "x4111 1111 1111 1111 é", "en", 1)]
    got = {r.doc_id: r for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string, found string, n_chars long")).collect()}
    assert (got[1].text, got[1].n_chars) == ("to [EMAIL], [IP]!", 17) and got[2].text is None and got[3].n_chars == 5
    assert got[4].text == "x[CARD] é"


def test_no_python_on_the_plan(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for out in (pii.digest(df), pii.mask(df)):
        assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
