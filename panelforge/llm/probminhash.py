"""MinHash near-duplicates of documents by ProbMinHash sketches.

A document is its word 5-grams (one shingle of all words if it has fewer)
weighted by ``1 + ln(times it occurs)``.  Each shingle sends a Poisson process
of arrivals at a rate of its weight; every arrival lands in a random register,
which keeps the earliest one, and a shingle stops as soon as its next arrival
is later than every register's.  Two documents agree in a register with the
probability Jaccard similarity of their weights.

Sketches are cut into bands; documents that agree in a band share a bucket.
In the first few bands each member meets its bucket's smallest id, then in all bands
the smallest and the largest where they are not linked yet: that links nearly all.
Members of buckets that are still in several components are compared with
all members of the others, in blocks of bounded size (``_pairs_of_blocks``): first by their
sketches, which leaves a forest of candidates, then each tree of that forest by its
texts, which leaves a forest of links.  So no pair that shares a bucket is left out,
and what leaves the tasks grows with the members; the comparisons alone grow with the square of
texts that share a bucket without being linked.
Candidates whose registers agree too rarely are dropped (4.5 standard
deviations), the rest is verified on the exact probability Jaccard of the texts.
Copies of one word sequence count as one document throughout, so thousands of
copies cost one sketch in the buckets.

Defined cases: null texts and texts of white space are groups of their own;
texts without words are in a group with equal texts only; rows
with null or repeated ids are documents of their own; ``group_id`` is the smallest id.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import fresh, id_text, only_ids, small_batches
from panelforge.llm.components import components
from panelforge.llm.textgrams import U64, mix, slices, words_of
from panelforge.operators.common import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 7
REGISTERS = BANDS * ROWS
FIRST_BANDS = 8
#: Members of a block that are compared by sketches, and by texts.
SKETCHES, TEXTS = 2048, 256
#: Shingles that a task keeps weighed at once (16 bytes each).
WEIGHED = 4_000_000
#: Share of equal registers below which a candidate can't reach the threshold.
ESTIMATE = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5

_GOLDEN = U64(0x9E3779B97F4A7C15)
_FEATURES = "id long, blank boolean, k1 long, k2 long, bands array<long>, sketch array<short>"


def shingles(hash_: np.ndarray, row: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: (row, shingle, weight), from its words."""
    from panelforge.llm.textgrams import ngrams

    keys, rows = [], []
    count = np.bincount(row) if len(row) else np.zeros(0, np.int64)
    for size in range(1, n + 1):
        h, first = ngrams(hash_, row, size)
        r = row[first]
        keep = slice(None) if size == n else count[r] == size
        keys.append(h[keep])
        rows.append(r[keep])
    key, r = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((key, r))
    key, r = key[order], r[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return r[at], key[at], 1 + np.log(np.diff(np.append(at, len(key))))


def probminhash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int, m: int = REGISTERS) -> np.ndarray:
    """``rows`` x ``m`` registers (0 where a row has no element)."""
    first = np.full(rows * m, np.inf)
    register = np.zeros(rows * m, U64)
    r, x, w, t, k = row, key, weight, np.zeros(len(key)), 0
    stream = mix(key ^ U64(0xD6E8FEB86659FD93))
    while len(x):
        k += 1
        u = mix(stream + U64(k * int(_GOLDEN) % 2**64))
        t = t - np.log(((u >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        cell = r * m + (mix(u ^ _GOLDEN) % U64(m)).astype(np.int64)
        early = np.flatnonzero(t < first[cell])
        np.minimum.at(first, cell[early], t[early])
        win = early[t[early] == first[cell[early]]]
        register[cell[win]] = x[win]
        keep = np.flatnonzero(t < first.reshape(rows, m).max(1)[r])
        r, x, w, t, stream = r[keep], x[keep], w[keep], t[keep], stream[keep]
    return register.reshape(rows, m)


def _features(batches):
    for batch in batches:
        texts = batch.column("text")
        for lo, hi, data, offsets in slices(texts, 1 << 18):
            rows = hi - lo
            w = words_of(data, offsets)
            n_words = np.bincount(w.row, minlength=rows)
            some = n_words > 0
            position = np.arange(len(w.row)) - (np.cumsum(n_words) - n_words)[w.row]
            keys = [np.zeros(rows, U64), np.zeros(rows, U64)]
            for seed, out in enumerate(keys):
                np.add.at(out, w.row, mix(w.hash ^ mix(position.astype(U64) * U64(2) + U64(seed))))
            blank = np.zeros(rows, bool)
            for i in np.flatnonzero(~some):
                text = (texts[lo + int(i)].as_py() or "").strip()
                blank[i] = not text
                digest = np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], U64)
                keys[0][i], keys[1][i] = digest
            register = probminhash(*shingles(w.hash, w.row), rows)[some]
            band = np.zeros((len(register), BANDS), U64)
            for j in range(ROWS):
                band = mix(band * U64(31) + register[:, j::ROWS])
            band = mix(band + np.arange(1, BANDS + 1, dtype=U64) * _GOLDEN)
            sketch = (mix(register) & U64(0xFFFF)).astype(np.uint16).view(np.int16)
            ends = np.concatenate([[0], np.cumsum(some)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").slice(lo, rows), pa.array(blank), *(pa.array(k.view(np.int64)) for k in keys),
                pa.ListArray.from_arrays(pa.array(ends * np.int32(BANDS)), pa.array(band.reshape(-1).view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends * np.int32(REGISTERS)), pa.array(sketch.reshape(-1))),
            ], names=["id", "blank", "k1", "k2", "bands", "sketch"])


def _weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    w = words_of(data, np.array([0, len(data)]))
    _, key, weight = shingles(w.hash, w.row)
    return key, weight


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """sum over shared d of 1 / sum over all e of max(x_e / x_d, y_e / y_d), by
    sorting the elements by x / y (keys sorted and distinct)."""
    key = np.union1d(a[0], b[0])
    if not len(key):
        return 0.0
    x, y = np.zeros(len(key)), np.zeros(len(key))
    x[np.searchsorted(key, a[0])], y[np.searchsorted(key, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        order = np.argsort(x / y)
    x, y = x[order], y[order]
    more_x = np.cumsum(x[::-1])[::-1]
    less_y = np.cumsum(y) - y
    both = (x > 0) & (y > 0)
    return float((1 / (more_x[both] / x[both] + less_y[both] / y[both])).sum())


def _verified(threshold: float):
    def verify(batches):
        cached = lru_cache(maxsize=256)(_weights)
        for batch in batches:
            ta, tb = batch.column("ta"), batch.column("tb")
            keep = [i for i in range(batch.num_rows) if probability_jaccard(cached(ta[i].as_py()), cached(tb[i].as_py())) >= threshold - 1e-9]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).take(pa.array(keep, pa.int64()))

    return verify


def _alike(a, b):
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return same >= int(ESTIMATE * REGISTERS)


def _keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, str] | None:
    """``docs`` written with a key of its rows and the key's name, where ids are null or repeated."""
    n, distinct = docs.agg(F.count("*"), F.count_distinct(F.col(f"`{id_col}`").cast("long"))).first()  # one row
    if n == distinct:
        return None
    key = fresh(docs, "row_key")
    return materialize(docs.withColumn(key, F.monotonically_increasing_id())), key


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``group_id`` (smallest id of its group, null if all are),
    ``kept`` (it is that one).  Of rows that share the smallest id one is kept."""
    keyed = _keyed(docs, id_col)
    if keyed is None:
        return _groups(docs, id_col, text_col, threshold).select(F.col("id").alias(id_col), F.col("g").alias("group_id"), (F.col("id") == F.col("g")).alias("kept"))
    members, first = _first_of_groups(*keyed, id_col, text_col, threshold)
    return members.join(first, "g").select(F.col("own").alias(id_col), F.col("first.own").alias("group_id"), (F.col("id") == F.col("first.id")).alias("kept"))


def _first_of_groups(rows: DataFrame, key: str, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(row key ``id``, its group ``g`` and ``own`` id; the first row of each group: smallest id, nulls last, then key)."""
    own = rows.select(F.col(key).alias("id"), F.col(f"`{id_col}`").cast("long").alias("own"))
    members = materialize(_groups(rows, key, text_col, threshold).join(own, "id"))
    # texts without a character are alone, but for repeated rows of one id
    again = members.where("blank AND own IS NOT NULL").groupBy(F.col("own").alias("again")).agg(F.min("id").alias("first"))
    members = materialize(members.join(again, (F.col("own") == F.col("again")) & F.col("blank"), "left").select("id", "own", F.coalesce("first", "g").alias("g")))
    return members, members.groupBy("g").agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "id")).alias("first"))


def _groups(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``id`` (unique) of each document, ``g``, the smallest id of its group, and ``blank``, without any character."""
    small_batches(docs.sparkSession)
    text = id_text(docs, id_col, text_col).withColumn("text", F.lower("text"))
    features = materialize(text.mapInArrow(_features, _FEATURES))
    classes = materialize(features.where("not blank").groupBy("k1", "k2").agg(F.min("id").alias("rep")))
    reps = materialize(only_ids(features.where(F.size("bands") > 0), classes.select(F.col("rep").alias("id"))).select("id", "bands", "sketch"))
    sketches = reps.select("id", "sketch")
    banded = reps.select("id", F.posexplode("bands").alias("k", "band"))
    buckets = materialize(banded.groupBy("band").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo < hi"))
    members = materialize(banded.join(buckets, "band"))

    def with_sketch(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b")
                .where(_alike(F.col("sa"), F.col("sb"))).select("a", "b"))

    def verified(pairs: DataFrame) -> DataFrame:
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        own = materialize(only_ids(text, ids).dropDuplicates(["id"]))
        both = pairs.join(own.toDF("a", "ta"), "a").join(own.toDF("b", "tb"), "b")
        return materialize(both.mapInArrow(_verified(threshold), "a long, b long"))

    # a few bands link nearly all; from then on only what is still apart is compared
    links = verified(materialize(with_sketch(members.where(F.col("k") < FIRST_BANDS).select(F.col("lo").alias("a"), F.col("id").alias("b")).where("a < b").distinct())))
    found = components(links)
    links = links.union(verified(materialize(with_sketch(_hubs(members, found)))))
    found = components(links)
    apart = _apart(members.where("n > 3"), found)  # of up to three members the smallest and the largest have met all
    if not apart.isEmpty():
        near = components(materialize(_sketched(_pairs_of_blocks(apart, SKETCHES), sketches)))
        named = _component(near.toDF("id", "group"), found, "id", "c")
        own = materialize(only_ids(text, near.select("id")))
        links = links.union(materialize(_compared(_pairs_of_blocks(named, TEXTS), sketches, own, threshold)))
        found = components(links)
    group = classes.join(found.toDF("rep", "component"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("g"))
    labelled = features.where("not blank").select("id", "k1", "k2").join(materialize(group), ["k1", "k2"]).select("id", "g")
    return labelled.select("id", "g", F.lit(False).alias("blank")).union(features.where("blank").select("id", "id", F.lit(True)))


def _component(df: DataFrame, found: DataFrame, of: str, name: str) -> DataFrame:
    """``df`` with the component of the id in column ``of``."""
    return df.join(found.toDF(of, "found"), of, "left").withColumn(name, F.coalesce("found", of)).drop("found")


def _pair(x, y):
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _hubs(members: DataFrame, found: DataFrame) -> DataFrame:
    """Every member with its bucket's smallest and largest id, where they are not linked yet."""
    hubs = members.select("band", "lo", "hi").distinct()
    hubs = materialize(_component(_component(hubs, found, "lo", "c_lo"), found, "hi", "c_hi"))
    rows = materialize(_component(members.select("band", "id"), found, "id", "c")).join(hubs, "band")
    low, high = [F.when(F.col(c) != F.col("c"), _pair(F.col(h), F.col("id"))) for h, c in (("lo", "c_lo"), ("hi", "c_hi"))]
    return rows.select(F.explode(F.array_compact(F.array(low, high))).alias("p")).select("p.*").distinct()


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """(group, id, c) of the buckets that the links have left in several components."""
    rows = materialize(_component(members.select(F.col("band").alias("group"), "id"), found, "id", "c"))
    open_ = rows.groupBy("group").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least < most").select("group")
    return materialize(rows.join(open_, "group", "left_semi"))


def _pairs_of_blocks(rows: DataFrame, size: int) -> DataFrame:
    """(group, i, j, block, id, c): the members of ``rows`` (group, id, c) in blocks of ``size``, for
    every two blocks i <= j of a group both together, unless all are of one component."""
    order = Window.partitionBy("group").orderBy("c", "id")
    dealt = materialize(rows.withColumn("block", ((F.row_number().over(order) - 1) / size).cast("int")))
    blocks = materialize(dealt.groupBy("group", "block").agg(F.min("c").alias("least"), F.max("c").alias("most")))
    i, j = (blocks.select("group", *[F.col(c).alias(f"{k}_{c}") for c in ("block", "least", "most")]) for k in "ij")
    pairs = i.join(j, "group").where("i_block <= j_block AND least(i_least, j_least) < greatest(i_most, j_most)")
    sides = pairs.select("group", F.col("i_block").alias("i"), F.col("j_block").alias("j"), F.explode(F.array_distinct(F.array("i_block", "j_block"))).alias("block"))
    return dealt.join(sides, ["group", "block"])


def _by_work(rows: DataFrame) -> DataFrame:
    """The rows of each pair of blocks in a row in one partition."""
    return rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "block")


def _works(batches):
    """The tables of the pairs of blocks, from batches in which their rows follow each other."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        work = np.stack([batch.column(c).to_numpy() for c in ("group", "i", "j")])
        new = np.flatnonzero((work[:, 1:] != work[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            if held and tuple(work[:, lo]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(work[:, lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(table: pa.Table):
    """(row, its candidates): rows of other components whose sketches are alike; of two blocks one row of each."""
    sketch = table["sketch"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, REGISTERS)
    c, block = table["c"].to_numpy(), table["block"].to_numpy()
    for a in range(table.num_rows - 1):
        other = np.flatnonzero((c[a + 1:] != c[a]) & ((block[a + 1:] != block[a]) | (block[0] == block[-1]))) + a + 1
        if len(other):
            yield a, other[(sketch[other] == sketch[a]).sum(1) >= int(ESTIMATE * REGISTERS)].tolist()


class _Forest(dict):
    """Disjoint sets."""

    def top(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = self.get(up, up)
            x = up
        return x


def _edges(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _sketched(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Links (a, b) under which all candidates of the blocks hang together."""

    def compare(batches):
        for table in _works(batches):
            ids, forest, found = table["id"].to_pylist(), _Forest(), []
            for a, others in _candidates(table):
                for b in others:
                    x, y = forest.top(a), forest.top(b)
                    if x != y:
                        forest[x] = y
                        found.append((ids[a], ids[b]))
            if found:
                yield _edges(found)

    return _by_work(rows.join(sketches, "id")).mapInArrow(compare, "a long, b long")


def _compared(rows: DataFrame, sketches: DataFrame, text: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of the candidates that reach the threshold, where the components are not linked by others."""

    def compare(batches):
        for table in _works(batches):
            ids, c, forest, found = table["id"].to_pylist(), table["c"].to_pylist(), _Forest(), []
            texts, weighed, held = table["text"], {}, 0
            for a, others in _candidates(table):
                for b in others:
                    x, y = forest.top(c[a]), forest.top(c[b])
                    if x == y:
                        continue
                    for k in (a, b):
                        if k not in weighed:
                            if held > WEIGHED:
                                weighed, held = {k: v for k, v in weighed.items() if k == a}, 0
                            weighed[k] = _weights(texts[k].as_py())
                            held += len(weighed[k][0])
                    if probability_jaccard(weighed[a], weighed[b]) >= threshold - 1e-9:
                        forest[x] = y
                        found.append((ids[a], ids[b]))
            if found:
                yield _edges(found)

    return _by_work(rows.join(sketches, "id").join(text, "id")).mapInArrow(compare, "a long, b long")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each group, all columns kept.  Rows with a null id or with one that others
    have too are documents of their own: only their texts decide."""
    keyed = _keyed(docs, id_col)
    if keyed is None:
        kept = materialize(near_duplicates(docs, id_col, text_col, threshold).where("kept").select(id_col))
        return only_ids(docs, kept, id_col)
    rows, key = keyed
    kept = materialize(_first_of_groups(rows, key, id_col, text_col, threshold)[1].select(F.col("first.id").alias(key)))
    return only_ids(rows, kept, key).drop(key)
