"""Every stage of the pipeline against brute force on its own input."""

import re

import corpus_pipeline as C
from panelforge.operators.common import materialize
from conftest import SF001
from llm.test_decontaminate import brute as hits
from llm.test_packing import check
from llm.test_pii import brute as pii_of
from llm.test_probminhash import brute_groups


def test_stages(spark):
    tables = [spark.read.parquet(f"{SF001}/documents.parquet")]
    for _, stage in C.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF001)))
    assert [t.columns for t in tables[:-1]] == [tables[0].columns] * 5
    raw, spoken, single, clean, masked = ({r.doc_id: r for r in t.collect()} for t in tables[:-1])
    # language: nothing without letters stays, nearly all else does, rows untouched
    letters = {d for d, r in raw.items() if any(c.isalpha() for c in r.text or "")}
    assert set(spoken) <= letters and len(spoken) >= 0.98 * len(letters) and all(spoken[d] == raw[d] for d in spoken)
    # near-duplicates: the smallest id of each group
    groups = brute_groups([(d, r.text) for d, r in spoken.items()])
    assert set(single) == set(groups.values()) and all(single[d] == raw[d] for d in single)
    # benchmark: no window is left, clean documents are untouched
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    before = hits([(d, r.text) for d, r in single.items()], items)
    after = hits([(d, r.text) for d, r in clean.items()], items)
    assert not any(v[4] for v in after.values()) and any(v[4] for v in before.values())
    for d, v in before.items():
        if not v[4]:
            assert clean[d] == single[d]
        elif v[1] <= 0.5 * v[0]:
            assert after[d][0] == v[0] - v[1] and clean[d].n_chars == len(clean[d].text)
        else:
            assert d not in clean
    # personal data: masked, and only it
    assert set(masked) == set(clean)
    for d, r in clean.items():
        spans = pii_of(r.text)[1]
        if spans:
            assert masked[d].text != r.text and masked[d].n_chars == len(masked[d].text)
            for span in spans:
                kind, a, b = span.split(":")
                assert r.text[int(a):int(b)] not in re.split(r"\[[A-Z]+\]", masked[d].text)[0] or kind == "phone"
        else:
            assert masked[d] == r or re.search(r"\[(IBAN|SSN)\]", masked[d].text)
    # packing: what is left, whole
    assert check(tables[-1].collect(), {d: r.text for d, r in masked.items()}) > 0
