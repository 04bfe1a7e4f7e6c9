"""Every pair of a bucket that is not linked yet is compared, however large the bucket is."""

from panelforge.llm import probminhash as P
from pyspark.sql import functions as F


def test_all_members_of_different_components_meet_in_blocks(spark):
    # a bucket of 40 members: one component of 25 and fifteen of one member each, and a bucket that is one component
    rows = [(7, i, 0 if i < 25 else i) for i in range(40)] + [(8, i, 0) for i in range(25)]
    at = P._pairs_of_blocks(spark.createDataFrame(rows, "group long, id long, c long"), 4).collect()
    met, works = set(), {}
    for r in at:
        works.setdefault((r.group, r.i, r.j), []).append((r.block, r.id, r.c))
    for (group, i, j), own in works.items():
        assert group == 7 and len(own) <= 8
        met |= {(min(a, b), max(a, b)) for x, a, c in own for y, b, d in own if c != d and (x != y or i == j)}
    assert met == {(a, b) for a in range(40) for b in range(25, 40) if a < b}


def test_the_only_partner_in_a_crowded_bucket_is_found(spark):
    """120 texts share a passage of a bucket's size with all others but only text 57 and 83 are near copies:
    neither is the smallest, the largest, or has most company."""
    words = lambda k, n: [f"w{k}x{i}" for i in range(n)]
    texts = {i: words("same", 60) + words(i, 8 + i % 5) for i in range(120)}
    texts[83] = texts[57][:-1] + ["other"]
    rows = [(i, i, " ".join(t).lower()) for i, t in texts.items()]
    text = spark.createDataFrame([(i, t) for i, _, t in rows], "id long, text string")
    sketches = text.mapInArrow(P._features, P._FEATURES).select("id", "sketch")
    blocks = P._pairs_of_blocks(text.select(F.lit(1).cast("long").alias("group"), "id", F.col("id").alias("c")), 16)
    links = {(r.a, r.b) for r in P._compared(blocks, sketches, text, 0.95).collect()}
    w = {i: P._weights(t) for i, _, t in rows}
    want = {(a, b) for a in w for b in w if a < b and P.probability_jaccard(w[a], w[b]) >= 0.95 - 1e-9}
    assert want == {(57, 83)} and {(min(p), max(p)) for p in links} == want
    near = P.components(P._sketched(blocks, sketches)).collect()
    assert {r.component for r in near if r.id in (57, 83)} == {min(r.component for r in near if r.id == 57)}
