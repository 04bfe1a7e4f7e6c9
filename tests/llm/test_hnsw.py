import math
from collections import defaultdict

import numpy as np
import pytest

from panelforge.llm import hnsw as H
from conftest import SF01


def brute(rows):
    """vec_id -> (n_links, component_id, kept); rows are (id, vector, label)."""
    groups, out = defaultdict(list), {}
    for i, v, label in rows:
        a = np.array([math.nan if x is None else x for x in v], np.float64) if v else np.empty(0)
        if label is None or not len(a) or not np.isfinite(a).all() or not a.any():
            out[i] = (0, i, True)
        else:
            groups[label, len(a)].append((i, a))
    for own in groups.values():
        m = np.array([a for _, a in own])
        norm = np.linalg.norm(m, axis=1)
        link = (m @ m.T) / np.outer(norm, norm) >= 0.98
        np.fill_diagonal(link, False)
        ids, comp = [i for i, _ in own], [i for i, _ in own]
        changed = True
        while changed:
            changed = False
            for a, b in zip(*np.nonzero(link)):
                if comp[a] < comp[b]:
                    comp[b], changed = comp[a], True
        for k, i in enumerate(ids):
            out[i] = (int(link[k].sum()), comp[k], comp[k] == i)
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = result(queries()["op1_embedding_near_dedup"](spark, SF01))
    assert got == brute(rows)


def test_odd_vectors_copies_and_many_shards(spark):
    rng = np.random.default_rng(2)
    center = rng.normal(size=(4, 8))
    rows = [(i, (center[i % 4] + rng.normal(0, 0.09, 8)).astype(np.float32).tolist(), i % 2) for i in range(400)]
    rows += [(500 + i, rows[0][1], 0) for i in range(30)]
    odd = [None, [], [0.0] * 8, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    rows += [(600 + i, v, 1) for i, v in enumerate(odd)] + [(700, rows[0][1], None), (701, rows[1][1], 7)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n long, shard string")
    assert result(H.near_duplicates(df, shard=60)) == brute(rows)
    assert H.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_search_needs_few_looks_and_misses_little(seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(1500, 24))
    v[500:] = v[rng.integers(0, 500, 1000)] + rng.normal(0, 0.03, (1000, 24))
    u = H.unit_rows(v)
    g = H.build(u)
    want = [set(np.flatnonzero(r >= 0.98)) - {i} for i, r in enumerate(u.astype(float) @ u.T.astype(float))]
    plain = H.links(g, v, v, np.arange(1500), audit=0.0)
    found = sum(len(set(p) & w) for p, w in zip(plain, want))
    assert found >= 0.98 * sum(map(len, want))
    audited = H.links(g, v, v, np.arange(1500))
    assert [set(p) for p in audited] == want
    looks = []
    for q in u[:50]:
        g.search(q, [g.descend(q, 0)], H.BEAM, 0, 0.95)
        looks.append((g.stamp == g.time).sum())
    assert np.mean(looks) < 800


def test_the_audit_widens_beams_until_nothing_is_missing():
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(size=(300, 6)), np.tile(rng.normal(size=6), (40, 1)) + rng.normal(0, 0.02, (40, 6))])
    g = H.build(H.unit_rows(v))
    g.degree[:] = np.minimum(g.degree, 1)  # a graph that leads nowhere
    want = [set(np.flatnonzero(r >= 0.98)) - {i} for i, r in enumerate(H.unit_rows(v).astype(float) @ H.unit_rows(v).T.astype(float))]
    assert [set(p) for p in H.links(g, v, v, np.arange(340))] == want
