"""Embedding near-duplicates over hierarchical navigable small-world graphs.

Vectors are compared within a label (and length) only.  Copies of one vector
count as one; the distinct ones of a label are dealt evenly into shards of
about ``SHARD`` vectors and each shard gets its own graph, built in one task of
bounded size.  Blocks of vectors then query every shard of their label.  A
search follows the graph with a beam and goes on through everything within one
and a half times the threshold's angle; what it has seen there is verified by
the exact cosine in double precision.  An audit compares the links of ``AUDIT`` of the queries with
those of a scan over the shard: queries with a missing link are searched again
with wider beams and angles and more starting points until the audit passes (in
the end the starting points are the whole shard).  Links are counted in the tasks, which
pass on the counts and a spanning forest; components are the union of these.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing; vectors of
different lengths don't link; copies link with each other; repeated ids are
vectors of their own that share one answer row each.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import BROADCAST_IDS
from panelforge.llm.components import components
from panelforge.operators.common import materialize, maybe_broadcast

THRESHOLD = 0.98
SHARD, BLOCK = 16384, 1024
DEGREE, BEAM_BUILD, BEAM = 12, 40, 32
#: Share of the queries whose links are audited.  Link counts must be exact: all.
AUDIT = 1.0
_MARGIN = 1e-5


@dataclass
class Graph:
    """Neighbours of each node on the ground level and on the levels above."""

    unit: np.ndarray
    ground: np.ndarray
    degree: np.ndarray
    upper: list[dict[int, np.ndarray]]
    entry: int

    def __post_init__(self):
        self.stamp = np.zeros(len(self.unit), np.int64)
        self.time = 0

    def neighbours(self, node: int, level: int) -> np.ndarray:
        return self.ground[node, : self.degree[node]] if level == 0 else self.upper[level - 1].get(node, _NOBODY)

    def search(self, q: np.ndarray, starts: list[int], beam: int, level: int, through: float = 2.0) -> tuple[list[tuple[float, int]], list[int]]:
        """The ``beam`` nodes found closest to ``q`` as (similarity, node), and
        all nodes seen that reach ``through``, each of which is expanded."""
        self.time += 1
        stamp, now, unit = self.stamp, self.time, self.unit
        start = np.array(starts)
        stamp[start] = now
        sims = unit[start] @ q
        best = [(s, i) for s, i in zip(sims.tolist(), starts)]
        queue = [(-s, i) for s, i in best]
        heapq.heapify(best)
        heapq.heapify(queue)
        while len(best) > beam:
            heapq.heappop(best)
        near = [i for s, i in zip(sims.tolist(), starts) if s >= through]
        while queue:
            s, node = heapq.heappop(queue)
            if -s < best[0][0] and len(best) >= beam and -s < through:
                break
            nb = self.neighbours(node, level)
            nb = nb[stamp[nb] != now]
            if not len(nb):
                continue
            stamp[nb] = now
            sims = unit[nb] @ q
            for s, i in zip(sims.tolist(), nb.tolist()):
                if s >= through:
                    near.append(i)
                if len(best) < beam:
                    heapq.heappush(best, (s, i))
                    heapq.heappush(queue, (-s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                    heapq.heappush(queue, (-s, i))
                elif s >= through:
                    heapq.heappush(queue, (-s, i))
        return best, near

    def descend(self, q: np.ndarray, to: int) -> int:
        """The closest node that a greedy walk reaches on level ``to`` + 1."""
        node = self.entry
        for level in range(len(self.upper), to, -1):
            node = max(self.search(q, [node], 1, level)[0])[1]
        return node


_NOBODY = np.empty(0, np.int32)


def _diverse(unit: np.ndarray, sims: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Neighbours by falling similarity, each closer to the node than to those
    taken before; the closest of the others fill up."""
    order = np.argsort(-sims, kind="stable")
    if len(nodes) <= most:
        return nodes[order]
    nodes, sims = nodes[order], sims[order]
    between = unit[nodes] @ unit[nodes].T
    closest = np.full(len(nodes), -2.0, np.float32)
    taken = np.zeros(len(nodes), bool)
    n = 0
    for k in range(len(nodes)):
        if sims[k] > closest[k]:
            taken[k] = True
            n += 1
            if n == most:
                break
            np.maximum(closest, between[k], out=closest)
    rest = np.flatnonzero(~taken)[: most - n]
    return nodes[np.sort(np.concatenate([np.flatnonzero(taken), rest]))]


def build(unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM_BUILD, seed: int = 0) -> Graph:
    """The graph of unit vectors (float32), by insertion."""
    n = len(unit)
    levels = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int), 12)
    g = Graph(unit, np.full((n, 2 * degree), -1, np.int32), np.zeros(n, np.int32), [], 0)
    for node in range(n):
        top = int(levels[node])
        if node:
            q = unit[node]
            at = [g.descend(q, min(top, len(g.upper)))]
            for level in range(min(top, len(g.upper)), -1, -1):
                found, _ = g.search(q, at, beam, level)
                at = [i for _, i in found]
                chosen = _diverse(unit, np.array([s for s, _ in found], np.float32), np.array(at, np.int32), degree)
                _link(g, node, chosen, level, degree)
        if top > len(g.upper) or not node:
            while len(g.upper) < top:
                g.upper.append({})
            g.entry = node
        for level in range(1, top + 1):
            g.upper[level - 1].setdefault(node, _NOBODY)
    _link_back(g)
    return g


def _link_back(g: Graph, closest: int = 4) -> None:
    """Pruning can cut a node off: let its closest neighbours lead back to it."""
    n, width = g.ground.shape
    sims = np.full((n, width), -2.0, np.float32)
    for lo in range(0, n, 4096):
        part = g.ground[lo: lo + 4096]
        sims[lo: lo + 4096] = np.where(part >= 0, np.einsum("nd,nkd->nk", g.unit[lo: lo + 4096], g.unit[part]), -2.0)
    top = np.argsort(-sims, axis=1, kind="stable")[:, :closest]
    node = np.repeat(np.arange(n, dtype=np.int32), top.shape[1])
    other = np.take_along_axis(g.ground, top, 1).ravel()
    node, other = node[other >= 0], other[other >= 0]
    lost = ~(g.ground[other] == node[:, None]).any(1)
    node, other = node[lost], other[lost]
    order = np.argsort(other, kind="stable")
    node, other = node[order], other[order]
    place = np.arange(len(other)) - np.searchsorted(other, other) + g.degree[other]
    if len(place) and place.max() >= width:
        g.ground = np.pad(g.ground, ((0, 0), (0, int(place.max()) + 1 - width)), constant_values=-1)
    g.ground[other, place] = node
    np.add.at(g.degree, other, 1)


def _link(g: Graph, node: int, chosen: np.ndarray, level: int, degree: int) -> None:
    if level:
        g.upper[level - 1][node] = chosen
    else:
        g.ground[node, : len(chosen)] = chosen
        g.degree[node] = len(chosen)
    room = degree if level else 2 * degree
    for other in chosen.tolist():
        own = g.neighbours(other, level)
        if len(own) < room:
            if level:
                g.upper[level - 1][other] = np.append(own, np.int32(node))
            else:
                g.ground[other, len(own)] = node
                g.degree[other] += 1
            continue
        both = np.append(own, np.int32(node))
        # a half of the room is left for links to come
        kept = _diverse(g.unit, g.unit[both] @ g.unit[other], both, room - room // 4)
        if level:
            g.upper[level - 1][other] = kept
        else:
            g.ground[other, : len(kept)] = kept
            g.degree[other] = len(kept)


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def links(g: Graph, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray | None, threshold: float = THRESHOLD, audit: float = AUDIT,
          beam: int = BEAM, seed: int = 0) -> list[np.ndarray]:
    """For each query the nodes whose exact cosine reaches the threshold
    (``own``: the queries' own nodes, where they are of this shard)."""
    rng = np.random.default_rng(seed)
    unit, v = unit_rows(queries), vectors.astype(np.float64)
    q64 = queries.astype(np.float64)
    norm, q_norm = np.linalg.norm(v, axis=1), np.linalg.norm(q64, axis=1)
    near = threshold - _MARGIN

    def exact(k: int, nodes: np.ndarray) -> np.ndarray:
        nodes = nodes[v[nodes] @ q64[k] / (norm[nodes] * q_norm[k]) >= threshold] if len(nodes) else nodes
        return np.sort(nodes if own is None else nodes[nodes != own[k]])

    found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
    todo, seeds, reach = np.arange(len(queries)), 0, 1.5
    audited = rng.random(len(queries)) < audit
    truth: dict[int, np.ndarray] = {}
    for lo in range(0, len(queries), 256):
        rows = np.flatnonzero(audited[lo: lo + 256]) + lo
        sims = unit[rows] @ g.unit.T
        for k, r in zip(rows.tolist(), sims):
            truth[k] = exact(k, np.flatnonzero(r >= near))
    while len(todo):
        missed = []
        through = min(near, float(np.cos(min(reach * np.arccos(min(threshold, 1.0)), np.pi))))
        for k in todo.tolist():
            starts = {g.descend(unit[k], 0)} | ({int(own[k])} if own is not None else set())
            if seeds:
                starts |= set(rng.choice(len(v), min(seeds, len(v)), replace=False).tolist())
            _, close = g.search(unit[k], sorted(starts), beam, 0, through)
            found[k] = exact(k, np.array(close, np.int64))
            if k in truth and len(found[k]) < len(truth[k]):
                missed.append(k)
        todo, beam, seeds, reach = np.array(missed, int), 2 * beam, max(4 * seeds, 16), reach + 0.5
    return found


def _valid(v) -> bool:
    a = np.asarray(v, np.float64)
    return bool(len(a)) and bool(np.isfinite(a).all()) and bool(np.linalg.norm(a) > 0)


_PACKED = "label string, dim int, shard int, ids binary, copies binary, vectors binary"


def _pack(table: pa.Table) -> pa.Table:
    """One row of a shard: ids, copies, vectors and the pickled graph."""
    table = table.sort_by("id")
    v = np.array(table["v"].to_pylist(), np.float64)
    g = build(unit_rows(v))
    return pa.table({"label": table["label"][:1].combine_chunks(), "dim": table["dim"][:1].combine_chunks(), "shard": table["shard"][:1].combine_chunks(),
                     "ids": [table["id"].to_numpy().tobytes()], "copies": [table["copies"].to_numpy().tobytes()], "vectors": [v.tobytes()],
                     "graph": [pickle.dumps((g.ground, g.degree, g.upper, g.entry))]})


def _blocks(batches):
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["ids"]) // 8
            width = 8 * row["dim"]
            for lo in range(0, n, BLOCK):
                hi = min(lo + BLOCK, n)
                yield pa.RecordBatch.from_pylist([{"label": row["label"], "dim": row["dim"], "of": row["shard"], "first": lo, "q_ids": row["ids"][8 * lo: 8 * hi],
                                                   "queries": row["vectors"][width * lo: width * hi]}],
                                                 schema=pa.schema([("label", pa.string()), ("dim", pa.int32()), ("of", pa.int32()), ("first", pa.int32()), ("q_ids", pa.binary()), ("queries", pa.binary())]))


def _query(threshold: float, audit: float):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, copies, q_ids = (np.frombuffer(row[c], np.int64) for c in ("ids", "copies", "q_ids"))
                v = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
                q = np.frombuffer(row["queries"]).reshape(len(q_ids), -1)
                ground, degree, upper, entry = pickle.loads(row["graph"])
                own = np.arange(row["first"], row["first"] + len(q_ids)) if row["of"] == row["shard"] else None
                found = links(Graph(unit_rows(v), ground, degree, upper, entry), v, q, own, threshold, audit)
                parent: dict[int, int] = {}

                def root(a: int) -> int:
                    while parent.setdefault(a, a) != a:
                        parent[a] = a = parent[parent[a]]
                    return a

                for a, nodes in zip(q_ids.tolist(), found):
                    for b in ids[nodes].tolist():
                        ra, rb = root(a), root(b)
                        if ra != rb:
                            parent[max(ra, rb)] = min(ra, rb)
                n = np.array([int(copies[nodes].sum()) for nodes in found], np.int64)
                some = np.flatnonzero(n)
                nodes = sorted(parent)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([q_ids[some], np.array(nodes, np.int64)])),
                    pa.array(np.concatenate([n[some], np.zeros(len(nodes), np.int64)])),
                    pa.array([None] * len(some) + [root(a) for a in nodes], pa.int64())], names=["id", "n", "root"])

    return run


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
                    shard: int = SHARD, audit: float = AUDIT) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id reachable), kept."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"), F.col(f"`{label_col}`").cast("string").alias("label"), F.size(v).cast("int").alias("dim"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(F.col("label").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0) & F.col("id").isNotNull(), F.lit(False))
    classes = materialize(rows.where(usable).groupBy("label", "dim", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    counts = materialize(classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")))
    n_shards = counts.agg(F.sum("shards")).first()[0] or 1
    dealt = classes.join(maybe_broadcast(counts, BROADCAST_IDS), ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")).drop("shards")
    key = ["label", "dim", "shard"]
    shards = materialize(dealt.repartition(4 * n_shards, *key).groupBy(*key).applyInArrow(_pack, _PACKED + ", graph binary"))
    blocks = materialize(shards.mapInArrow(_blocks, "label string, dim int, of int, first int, q_ids binary, queries binary"))
    pairs = blocks.count() * max(1, -(-n_shards // max(1, counts.count())))
    met = blocks.join(shards, ["label", "dim"]).repartition(max(1, 2 * pairs), "label", "dim", "shard", "of", "first")
    found = materialize(met.mapInArrow(_query(threshold, audit), "id long, n long, root long"))
    n_links = found.where("root is null").groupBy("id").agg(F.sum("n").alias("n"))
    component = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    answer = materialize(classes.select("label", "dim", "v", F.col("id").alias("rep"), "copies")
                         .join(n_links.withColumnRenamed("id", "rep"), "rep", "left").join(component.withColumnRenamed("id", "rep"), "rep", "left")
                         .select("label", "dim", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked = rows.where(usable).join(answer, ["label", "dim", "v"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
