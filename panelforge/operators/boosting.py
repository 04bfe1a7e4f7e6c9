"""Many regularised boosters in one plan, and forests as column expressions
(M1-M6, M8, M9, X3).

Second-order gradient boosting over histograms.  A fit is a list of ``Job``s
(folds, segments, targets, trials ...) over one table: each has a view (the rows
that it learns from), a label, an objective, columns and parameters.

* One pass cuts every feature of every view into bins by its quantiles (``percentile_approx``; ``borders`` for
  many rows, which are sorted once for all views), one makes blocks of ``BLOCK`` binned rows of a view: a byte a feature and row, all
  rows of a feature together.  Rows go to Python once, whatever the number of their views.
* Gradients are whole multiples of a power of two, chosen so that sums
  of all rows stay exact in a double.  Sums don't depend on their order,
  so the result doesn't depend on partitions or on the form that ran.
* Views of up to ``ROWS_IN_TASK`` rows are sent to one task for each model, all models grow at the
  same time without a job for each level.  Of two sisters only the smaller one is added up,
  the other is what is left of their parent.  A task keeps 18 to 26 bytes a row in memory; keys, bins
  and labels of many rows lie in a file of its own.  Processes of the task share the rows of
  the largest models where the fit leaves task slots idle: each adds up its own, the sums are gathered.
* Larger views grow by levels: tasks turn their blocks into
  sums by (feature, bin) for each node, one shuffle by (model, node) adds them up, and the
  best split of each node comes to the driver: a few rows a model and level,
  whatever the data.  All models grow a level in the same job.  Margins are
  written with the blocks every ``KEEP`` trees, which also cuts the lineage.
  Both forms give the same trees (tested).

Gain and leaves (alpha L1, lambda L2, G and H sums of first and second derivatives):

    T(G) = sign(G) max(|G| - alpha, 0),   w = -T(G) / (H + lambda) within +-max_delta_step
    score(G, H) = -(2 G w + (H + lambda) w**2 + 2 alpha |w|)
    gain = score(left) + score(right) - score(node), at least gamma

Rows are sampled by a hash of their key, seed and tree, columns by seed and
tree.  Missing values are the caller's business (``models.prepare`` makes them 0).
"""

from __future__ import annotations

import hashlib
import math
import mmap
import os
import tempfile
import traceback
import warnings
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing import Pipe

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.common import materialize, spread

MAX_BINS = 64
ROWS_IN_TASK = 16_000_000
BLOCK = 1 << 14
KEEP = 10
#: Bytes of a forest table that are broadcast at most; beyond it the plain join runs.
BROADCAST_BYTES = 64 << 20
LEAST_GAIN = 1e-6
#: Points that stand for the rows of a view's part when its quantiles are taken, and rows sorted at a time.
_POINTS = 4096
_SORTED = 1 << 19
#: Rows of all views up to which ``percentile_approx`` takes their quantiles.
_FEW_ROWS = 1_000_000
_CHUNK = 1 << 18
#: Processes of a model's task at most, where the fit leaves task slots idle, and the least rows of each.
_WORKERS = 4
_LEAST_SHARE = 50_000
#: Bytes from which an array of a model's rows lies in a file.
_IN_FILE = 1 << 22
#: Codes of a group of features that are added up together (a table of them and of a level's nodes stays in a core's cache).
_CELLS = 65 * 65
#: Rows that are added up at a time (what belongs to them stays in a core's cache).
_ADDED = 1 << 16
#: Split nodes of a level up to which all its conditions are taken for all rows.
_FLAT_LEVEL = 32
#: Rows that are scored at a time, and rows of a batch of them in one model's walk.
_SCORED = 1 << 18
_WALKED = 1 << 16
#: Nodes up to which all conditions of a tree are taken for all rows; deeper trees are walked.
_FLAT_NODES = 256


@dataclass(frozen=True)
class BoostParams:
    # Fixed defaults of the reference's regressor.
    n_estimators: int = 200
    max_depth: int = 5
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_delta_step: float = 0.0
    seed: int = 42


@dataclass(frozen=True)
class Job:
    """One model: a name, the names of its view and label, and how to fit it."""

    model: str
    view: str
    label: str
    params: BoostParams = BoostParams()
    objective: str = "squared"  # or "logistic"
    columns: tuple[int, ...] | None = None


@dataclass
class Tree:
    """Nodes in the order they were made; the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def arrays(self):
        return np.array(self.feature), np.array(self.bin), np.array(self.child), np.array(self.value)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` ([feature, row]) has come to."""
        n = bins.shape[1]
        if len(self.feature) > _FLAT_NODES:
            return self._walked(bins)

        def below(k: int):
            f, c = self.feature[k], self.child[k]
            if f < 0:
                return np.uint8(k)
            right = (bins[f] > self.bin[k]).view(np.uint8)
            if self.feature[c] < 0 and self.feature[c + 1] < 0:
                return right + np.uint8(c)
            a, b = below(c), below(c + 1)
            return a ^ ((a ^ b) & -right)

        return np.broadcast_to(below(0), n)

    def _walked(self, bins: np.ndarray) -> np.ndarray:
        feature, at, child, _ = self.arrays()
        node, rows, f = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1]), feature[:1]
        while (f >= 0).any():
            f = feature[node]
            node = np.where(f >= 0, child[node] + (bins[np.maximum(f, 0), rows] > at[node]), node)
        return node


# ---------------------------------------------------------------- one tree, wherever the sums come from

def leaf(g, h, p: BoostParams):
    """Weight of a leaf with these sums, before the learning rate."""
    g, h = np.asarray(g, float), np.asarray(h, float)
    w = -np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)
    w = np.divide(w, h + p.reg_lambda, out=np.zeros(np.broadcast(w, h).shape), where=h + p.reg_lambda > 0)
    return np.clip(w, -p.max_delta_step, p.max_delta_step) if p.max_delta_step > 0 else w


def score(g, h, p: BoostParams):
    w = leaf(g, h, p)
    return -(2.0 * g * w + (h + p.reg_lambda) * w * w + 2.0 * p.reg_alpha * np.abs(w))


def tree_columns(job: Job, features: int, tree: int) -> np.ndarray:
    """Features that a tree may split on."""
    own = np.array(job.columns if job.columns is not None else range(features))
    k = max(1, int(job.params.colsample * len(own)))
    return own if k == len(own) else np.sort(np.random.default_rng([job.params.seed, tree]).choice(own, k, replace=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sampled(key: np.ndarray, p: BoostParams, tree: int) -> np.ndarray:
    """Whether rows with these keys are in the tree's sample."""
    if p.subsample >= 1:
        return np.ones(len(key), bool)
    salt = _mixed(np.array([(p.seed << 24) + tree + 1], np.uint64))
    return _mixed(key.view(np.uint64) ^ salt) < np.uint64(math.ceil(p.subsample * 2.0**53) << 11)  # of the upper 53 bits


def gradients(y: np.ndarray, margin: np.ndarray, objective: str, scale: float) -> tuple[np.ndarray, np.ndarray | float]:
    """First and second derivatives as whole multiples of 1 / scale; one number where all rows have the same."""
    if objective == "logistic":
        q = 1.0 / (1.0 + np.exp(-margin))
        return np.rint((q - y) * scale), np.rint(np.maximum(q * (1.0 - q), 1e-16) * scale)
    return np.rint((margin - y) * scale), float(np.rint(scale))


def sums(bins: np.ndarray, columns: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray | float, slots: int, width: int, groups=None) -> np.ndarray:
    """[g or h, slot, column, bin] sums of the rows with a slot; ``bins`` is [feature, row],
    ``h`` one number if all rows have the same, ``groups`` what ``packed`` gives for these rows, if known:
    the rows are then added up once a group, not once a feature."""
    out = np.zeros((2, slots, len(columns), width))
    place = {int(f): c for c, f in enumerate(columns)}
    wanted = [x for x in groups or [([f], [(0, np.arange(width))], bins[f]) for f in place] if not place.keys().isdisjoint(x[0])]
    shapes = [[len(used) for _, used in sorted({axis: used for axis, used in axes}.items())] for _, axes, _ in wanted]
    size = max((math.prod(shape) for shape in shapes), default=1)
    whole = [np.zeros(slots * size, complex) for _ in wanted]  # g and h of a cell lie side by side
    for lo in range(0, len(slot), _ADDED):
        rows = np.flatnonzero(slot[lo: lo + _ADDED] >= 0)
        rows += lo
        first, each = slot.take(rows).astype(np.intp), np.empty(len(rows), complex)
        first *= size
        each.real, each.imag = g.take(rows), 1.0 if np.isscalar(h) else h.take(rows)
        for (_, _, code), total in zip(wanted, whole):
            np.add.at(total, first + code.take(rows), each)
    for (features, axes, _), shape, total in zip(wanted, shapes, whole):
        table, every = total.reshape(slots, size)[:, :math.prod(shape)].reshape(slots, *shape), range(len(shape))
        lines = [table.sum(axis=tuple(1 + j for j in every if j != k)) for k in every]
        for f, (axis, used) in zip(features, axes):
            if f in place:
                out[0, :, place[f], used] = lines[axis].real.T
                out[1, :, place[f], used] = lines[axis].imag.T
    if np.isscalar(h):
        out[1] *= h
    return out


@dataclass
class Growth:
    """A tree under way: ``active`` are the nodes of the lowest level, with their sums once known."""

    job: Job
    scale: float
    tree: Tree = field(default_factory=Tree)
    active: list[int] = field(default_factory=lambda: [0])
    level: int = 0
    parents: list[int] = field(default_factory=list)  # for each pair of active sisters the slot that they come from
    left_lighter: list[bool] = field(default_factory=list)

    def slots(self) -> np.ndarray:
        """Slot of each node: its number among the active ones, or -1."""
        out = np.full(len(self.tree.feature), -1)
        out[self.active] = np.arange(len(self.active))
        return out

    def lighter(self) -> np.ndarray:
        """For each active node below the root whether it is the lighter of its pair."""
        left = np.array(self.left_lighter, bool)
        return np.column_stack([left, ~left]).ravel()

    def grow(self, best: Mapping[int, tuple]) -> None:
        """Split the active nodes; ``best`` has for each slot with rows the node's sums and its
        best split: (g, h, gain, feature, bin, left g, left h), gain None without one."""
        p, t, below = self.job.params, self.tree, []
        self.parents, self.left_lighter = [], []
        for slot, node in enumerate(self.active):
            g, h, gain, feature, at, left_g, left_h = best.get(slot, (0.0, 0.0, None, -1, 0, 0.0, 0.0))
            if node == 0:
                t.value[0] = float(leaf(g, h, p)) * p.learning_rate
            if gain is None or gain <= LEAST_GAIN or gain < p.gamma or self.level >= p.max_depth:
                continue
            child = len(t.feature)
            t.feature[node], t.bin[node], t.child[node], t.gain[node] = feature, at, child, gain
            for a, b in ((left_g, left_h), (g - left_g, h - left_h)):
                t.feature.append(-1), t.bin.append(0), t.child.append(0), t.gain.append(0.0)
                t.value.append(float(leaf(a, b, p)) * p.learning_rate)
            below += [child, child + 1]
            self.parents.append(slot)
            self.left_lighter.append(2 * left_h <= h)
        self.level += 1
        self.active = below if self.level < p.max_depth else []


def best_splits(table: np.ndarray, columns: np.ndarray, p: BoostParams, scale: float) -> dict[int, tuple]:
    """Best split of each slot of ``sums``: the largest gain, of equal ones the first feature and bin."""
    left = np.cumsum(table, axis=3) / scale
    whole = left[:, :, :1, -1:]
    (lg, lh), (g, h) = left, whole
    rg, rh = g - lg, h - lh
    ok = (lh > 0) & (rh > 0) & (lh >= p.min_child_weight) & (rh >= p.min_child_weight)
    gain = np.where(ok, score(lg, lh, p) + score(rg, rh, p) - score(g, h, p), -np.inf)
    flat = gain.reshape(len(gain), -1)
    pick = flat.argmax(1) if flat.size else []
    out = {}
    for slot, k in enumerate(pick):
        f, b = divmod(int(k), gain.shape[2])
        top = float(flat[slot, k])
        found = (None, -1, 0, 0.0, 0.0) if top == -np.inf else (top, int(columns[f]), b, float(lg[slot, f, b]), float(lh[slot, f, b]))
        out[slot] = (float(g[slot, 0, 0]), float(h[slot, 0, 0]), *found)
    return out


def array_of(shape: Sequence[int], kind) -> np.ndarray:
    """An array for the rows of a model; a large one lies in a file without a name, which goes with it."""
    size = math.prod(shape) * np.dtype(kind).itemsize
    if size < _IN_FILE:
        return np.empty(shape, kind)
    with tempfile.TemporaryFile() as f:
        os.posix_fallocate(f.fileno(), 0, size)
        return np.frombuffer(mmap.mmap(f.fileno(), size), kind).reshape(shape)


def packed(bins: np.ndarray, gather: Callable[[bytes], list[bytes]] = lambda own: [own]) -> list[tuple[list[int], list[tuple[int, np.ndarray]], np.ndarray]]:
    """(features, their axes and bins, code) of groups of features that are added up together: a row's code
    names its place on all axes of the group, at most ``_CELLS`` codes a group.  An axis has the bins that
    occur; features that cut the rows into the same parts (a column and its z-score) share one.
    ``gather`` gives what all processes that share the rows say."""
    occur = np.stack([np.bincount(row, minlength=256) > 0 for row in bins])
    occur = np.bitwise_or.reduce([np.frombuffer(x, bool).reshape(occur.shape) for x in gather(occur.tobytes())])
    used, same = [np.flatnonzero(x) for x in occur], {}

    def part_of(f: int) -> np.ndarray:
        place = np.zeros(256, np.uint8)
        place[used[f]] = np.arange(len(used[f]))
        return place.take(bins[f])

    marks = gather(b"".join(hashlib.blake2b(part_of(f), digest_size=16).digest() for f in range(len(bins))))
    for f in range(len(bins)):
        same.setdefault((len(used[f]), *(m[16 * f: 16 * f + 16] for m in marks)), []).append(f)
    same = {own[0]: own for own in same.values()}
    groups: list[list[int]] = []
    cells: list[int] = []
    for f in sorted(same, key=lambda f: -len(used[f])):
        k = next((k for k, c in enumerate(cells) if c * len(used[f]) <= _CELLS), len(cells))
        if k == len(cells):
            groups.append([])
            cells.append(1)
        groups[k].append(f)
        cells[k] *= max(1, len(used[f]))
    out = []
    for own in groups:
        code = array_of(bins.shape[1:], np.uint16)
        code[:] = 0
        for f in own:
            code *= np.uint16(len(used[f]))
            code += part_of(f)
        out.append(([f for k in own for f in same[k]], [(axis, used[f]) for axis, k in enumerate(own) for f in same[k]], code))
    return out


def _stepped(node: np.ndarray, bins: np.ndarray, tree: Tree, level: Sequence[int]) -> None:
    """Move rows at split nodes of ``level`` to the child that they belong to."""
    split = [k for k in level if tree.feature[k] >= 0]
    if len(split) > _FLAT_LEVEL:
        feature, at, child, _ = tree.arrays()
        rows = np.flatnonzero((feature >= 0)[node])
        k = node[rows]
        node[rows] = child[k] + (bins[feature[k], rows] > at[k])
        return
    before, kind = node.copy(), node.dtype.type
    number = lambda yes: yes.view(np.uint8) if kind is np.uint8 else yes.astype(kind)
    for k in split:
        step = number(bins[tree.feature[k]] > tree.bin[k])
        step += kind(tree.child[k] - k)
        step *= number(before == kind(k))
        node += step


def grow_forest(key: np.ndarray, bins: np.ndarray, y: np.ndarray, job: Job, base: float, scale: float, workers: int = 1,
                names: Sequence[int] | None = None, features: int | None = None) -> list[Tree]:
    """All trees of a model whose rows are at hand; ``bins`` is [feature, row], its features are ``names`` of all
    ``features``, the others are 0 everywhere.  ``workers`` processes share the rows: the same sums in any order."""
    names = np.arange(len(bins)) if names is None else np.asarray(names)
    features = len(bins) if features is None else features
    if workers == 1:
        return _grown(key, bins, y, job, base, scale, names, features)
    size = -(-len(y) // workers)
    share = lambda k: slice(min(k * size, len(y)), min((k + 1) * size, len(y)))
    return together(workers, lambda k, gather: _grown(key[share(k)], bins[:, share(k)], y[share(k)], job, base, scale, names, features, gather))


def together(workers: int, work: Callable[[int, Callable[[bytes], list[bytes]]], list]) -> list:
    """What ``work`` gives to this process, the first of ``workers``; the others are forked.  Each gets its number and
    ``gather``, which all call alike: it gives what each of them says, in order."""
    ends, children = [], []

    def alone(k: int, up) -> None:
        def gather(own: bytes) -> list[bytes]:
            up.send_bytes(own)
            return up.recv()

        status = 1
        try:
            work(k, gather)
            status = 0
        except BaseException:
            traceback.print_exc()
        finally:
            os._exit(status)

    def gather(own: bytes) -> list[bytes]:
        said = [own, *(end.recv_bytes() for end in ends)]
        for end in ends:
            end.send(said)
        return said

    try:
        for k in range(1, workers):
            down, up = Pipe()
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")  # the children only compute
                pid = os.fork()
            if not pid:
                for end in (down, *ends):
                    end.close()
                alone(k, up)
            up.close()
            ends.append(down)
            children.append(pid)
        return work(0, gather)
    finally:
        for end in ends:
            end.close()
        for pid in children:
            os.waitpid(pid, 0)


def _grown(key: np.ndarray, bins: np.ndarray, y: np.ndarray, job: Job, base: float, scale: float, names: np.ndarray, features: int,
           gather: Callable[[bytes], list[bytes]] | None = None) -> list[Tree]:
    """``grow_forest`` of a process: of all rows, or of its share if ``gather`` gives what the others say."""
    p, n, margin, trees, width = job.params, len(y), np.full(len(y), base), [], MAX_BINS + 1
    groups = packed(bins, gather) if gather else packed(bins)
    kind, slots = (np.uint8, np.int8) if 2 ** (p.max_depth + 1) - 1 <= 256 else (np.int32, np.int16)
    parts = [slice(lo, min(lo + _CHUNK, n)) for lo in range(0, n, _CHUNK)]
    left_out, node, g, h = np.empty(n, slots), np.empty(n, kind), np.empty(n), np.empty(n) if job.objective == "logistic" else float(np.rint(scale))
    for k in range(p.n_estimators):
        columns, growth = kept_columns(job, names, features, k), Growth(job, scale)
        node[:] = 0
        for o in parts:
            np.subtract(sampled(key[o], p, k), 1, out=left_out[o], dtype=slots)  # -1: not in the sample
            g[o], each = gradients(y[o], margin[o], job.objective, scale)
            if job.objective == "logistic":
                h[o] = each
        before = None  # sums of the level above, and for each pair its parent's slot
        while growth.active:
            # of two sisters the one with fewer rows is added up, the other is the rest of their parent
            added = np.arange(1) if before is None else np.flatnonzero(growth.lighter())
            slot_of = np.full(len(growth.tree.feature), -1, slots)
            slot_of[np.array(growth.active)[added]] = np.arange(len(added))
            slot = slot_of.take(node)
            slot |= left_out
            own = sums(bins, columns, slot, g, h, len(added), width, groups)
            table = np.zeros((2, len(growth.active), len(columns), width))
            table[:, added] = own if gather is None else _gathered(own, columns, groups, gather)
            if before is not None:
                table[:, added ^ 1] = before[:, growth.parents] - table[:, added]
            before, level = table, growth.active
            growth.grow(best_splits(table, columns, p, scale))
            for o in parts:
                _stepped(node[o], bins[:, o], growth.tree, level)
        value = np.array(growth.tree.value)
        for o in parts:
            margin[o] += value.take(node[o])
        trees.append(growth.tree)
    for t in trees:
        t.feature = [int(names[f]) if f >= 0 else f for f in t.feature]
    return trees


def kept_columns(job: Job, names: np.ndarray, features: int, tree: int) -> np.ndarray:
    """Places in ``names`` of the features that a tree may split on; one that is not among them is 0
    everywhere, and so is the one of ``names`` that stands for all of them (``standing_for``)."""
    own, place = tree_columns(job, features, tree), np.full(features, -1)
    place[names] = np.arange(len(names))
    rest = place[own] < 0
    if rest.any():
        place[place < 0] = len(names) - 1
    return np.unique(place[own])


def _gathered(own: np.ndarray, columns: np.ndarray, groups, gather: Callable[[bytes], list[bytes]]) -> np.ndarray:
    """``sums`` of the rows of all processes: each says those of one feature an axis and of the bins that occur."""
    place, cells, copies = {int(f): c for c, f in enumerate(columns)}, np.zeros(own.shape[2:], bool), []
    for features, axes, _ in groups:
        first: dict[int, int] = {}
        for f, (axis, used) in zip(features, axes):
            if f in place and axis in first:
                copies.append((f, first[axis]))
            elif f in place:
                first[axis] = f
                cells[place[f], used] = True
    used_by = {f: used for features, axes, _ in groups for f, (_, used) in zip(features, axes)}
    told = own[:, :, cells]
    total = sum(np.frombuffer(x).reshape(told.shape) for x in gather(told.tobytes()))
    out = np.zeros_like(own)
    out[:, :, cells] = total
    for f, of in copies:
        out[:, :, place[f], used_by[f]] = out[:, :, place[of], used_by[of]]
    return out


# ---------------------------------------------------------------- fits

#: Trees are stored complete, a step of ``depth`` for every row: node k has the children 2k + 1 (below the
#: cut) and 2k + 2, nodes below a leaf lead left (an infinite cut), ``value`` has the lowest level.
_TREES = "array<struct<feature: array<int>, cut: array<double>, value: array<double>>>"
FOREST = f"model string, objective string, base double, depth int, n_rows long, gain array<double>, splits array<long>, trees {_TREES}"


def _complete(t: Tree, depth: int, cuts: Sequence[Sequence[float]]) -> dict:
    """A tree of all nodes down to ``depth``."""
    inner = 2**depth - 1
    at, feature, cut = np.zeros(2 * inner + 1, np.int64), [0] * inner, [math.inf] * inner
    for k in range(inner):
        node = at[k]
        f = t.feature[node]
        if f >= 0:
            feature[k], cut[k] = int(f), float(cuts[f][t.bin[node]])
            at[2 * k + 1], at[2 * k + 2] = t.child[node], t.child[node] + 1
        else:
            at[2 * k + 1] = at[2 * k + 2] = node
    return {"feature": feature, "cut": cut, "value": np.array(t.value)[at[inner:]].tolist()}


def _forest_row(job: Job, base: float, n: int, trees: Sequence[Tree], cuts: Sequence[Sequence[float]]) -> dict:
    gain, splits, nodes = np.zeros(len(cuts)), np.zeros(len(cuts), np.int64), []
    for t in trees:
        for f, g in zip(t.feature, t.gain):
            if f >= 0:
                gain[f] += g
                splits[f] += 1
        nodes.append(_complete(t, max(1, job.params.max_depth), cuts))
    return {"model": job.model, "objective": job.objective, "base": base, "depth": max(1, job.params.max_depth), "n_rows": n, "gain": gain.tolist(), "splits": splits.tolist(),
            "trees": nodes}


_ARROW_FOREST = pa.schema([("model", pa.string()), ("objective", pa.string()), ("base", pa.float64()), ("depth", pa.int32()), ("n_rows", pa.int64()),
                           ("gain", pa.list_(pa.float64())), ("splits", pa.list_(pa.int64())),
                           ("trees", pa.list_(pa.struct([("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))])))])


_BLOCKS = "view int, n int, key binary, bins binary, y binary, margin binary"
_ARROW_BLOCKS = pa.schema([("view", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("key", "bins", "y", "margin"))])


def _block_row(view: int, key: np.ndarray, bins: np.ndarray, y: np.ndarray, margin: np.ndarray) -> dict:
    """A block of rows of one view: key [row], bins [feature, row], y [label, row], margin [model, row]."""
    return {"view": view, "n": len(key), **{c: np.ascontiguousarray(v).tobytes() for c, v in (("key", key), ("bins", bins), ("y", y), ("margin", margin))}}


def _blocks(batch):
    """(view, key, bins, y, margin) of each block."""
    for r in batch.to_pylist():
        n = r["n"]
        yield (r["view"], np.frombuffer(r["key"], np.int64), np.frombuffer(r["bins"], np.uint8).reshape(-1, n),
               np.frombuffer(r["y"]).reshape(-1, n), np.frombuffer(r["margin"]).reshape(-1, n))


def fit_many(df: DataFrame, features: Sequence[str], jobs: Sequence[Job], views: Mapping[str, Column], labels: Mapping[str, Column],
             key: Sequence[str] = ("player_id", "gameweek_id"), rows_in_task: int = ROWS_IN_TASK, zero: Collection[str] = ()) -> DataFrame:
    """Fit all jobs; one row per model (see ``FOREST``), written.

    ``views`` are conditions on the rows, ``labels`` numeric columns.  Rows without a
    label or of a view without rows don't count; a job without rows is a
    forest of no trees with base 0.  ``key`` names the columns that tell rows apart for sampling,
    ``zero`` features that are 0 in every row: their one border needs no pass.
    """
    view_names, label_names, n_features = list(views), list(labels), len(features)
    # models that differ in their names alone are one: it is grown once
    first: dict[Job, str] = {}
    names_of: dict[str, list[str]] = {}
    for job in jobs:
        names_of.setdefault(first.setdefault(replace(job, model=""), job.model), []).append(job.model)
    jobs = [job for job in jobs if job.model in names_of]
    # features that are 0 everywhere have one bin: the last one of ``names`` stands for all of them
    names = [i for i, f in enumerate(features) if f not in zero] + [i for i, f in enumerate(features) if f in zero][:1]
    live = [i for i in names if features[i] not in zero]
    inside = F.filter(F.array(*[F.when(F.coalesce(views[v], F.lit(False)), F.lit(i)) for i, v in enumerate(view_names)]), lambda v: v.isNotNull())
    base = df.select(F.xxhash64(*key).alias("key"), F.array(*[F.col(features[i]).cast("double") for i in live]).cast("array<double>").alias("x"),
                     F.array(*[c.cast("double") for c in labels.values()]).alias("y"), inside.alias("views"))
    base = materialize(base.filter(F.size("views") > 0).withColumn("within", F.array_join(F.col("views").cast("array<string>"), ",")))

    # size and label sums of every view, and the bin borders of its features
    facts = [F.count(F.lit(1)).alias("n")]
    for k in range(len(label_names)):
        facts += [F.avg(F.col("y")[k]).alias(f"mean{k}"), F.max(F.abs(F.col("y")[k])).alias(f"top{k}"), F.count(F.col("y")[k]).alias(f"n{k}")]
    rows = base.select("y", F.explode("views").alias("view"))
    about = {view_names[r["view"]]: r for r in rows.groupBy("view").agg(*facts).collect()}  # one row a view
    few = sum(r["n"] for r in about.values()) <= _FEW_ROWS
    cut_by = quantiles(base, len(live)) if few else borders(spread(base), len(live))
    found = {(r["view"], r["feature"]): sorted(set(r["cuts"] or [])) for r in cut_by.collect()}  # views x features
    base = spread(base)
    at = {i: k for k, i in enumerate(live)}
    cuts = {v: [[0.0] if f in zero else found.get((view_names.index(v), at[i]), []) for i, f in enumerate(features)] for v in about}

    def blocks(some: Collection[int]) -> DataFrame:
        """Blocks of the rows of some views."""
        own = base.filter(F.arrays_overlap("views", F.array(*map(F.lit, some)))) if len(some) < len(view_names) else base
        return own.select("key", "x", "y", "within").mapInArrow(_cut({v: [cuts[view_names[v]][i] for i in names] for v in some}, len(live)), _BLOCKS)

    plan: dict[int, tuple[Job, int, float, float, int]] = {}
    empty = []
    for i, job in enumerate(jobs):
        r, k = about.get(job.view), label_names.index(job.label)
        if r is None or not r[f"n{k}"]:
            empty.append(_forest_row(job, 0.0, 0, [], [[]] * n_features))
            continue
        mean = r[f"mean{k}"]
        start = math.log(max(mean, 1e-16) / max(1 - mean, 1e-16)) if job.objective == "logistic" else mean
        top = 1.0 if job.objective == "logistic" else max(1.0, r[f"top{k}"])
        scale = 2.0 ** max(-20, min(40, math.floor(50 - math.log2(4 * top * r["n"]))))
        plan[i] = (job, k, start, scale, r["n"])
    small = {i: v for i, v in plan.items() if v[4] <= rows_in_task}
    large = {i: v for i, v in plan.items() if i not in small}
    forests = df.sparkSession.createDataFrame(empty, FOREST)
    if small:
        forests = forests.unionByName(_in_tasks(blocks, small, view_names, cuts, names))
    if large:
        own = sorted({view_names.index(v[0].view) for v in large.values()})
        grown = _by_levels(materialize(blocks(own)), large, view_names, names, n_features)
        done = [_forest_row(job, start, n, grown[i], cuts[job.view]) for i, (job, _, start, _, n) in large.items()]
        forests = forests.unionByName(df.sparkSession.createDataFrame(done, FOREST))
    if any(len(own) > 1 for own in names_of.values()):
        every = F.create_map(*[x for m, own in names_of.items() for x in (F.lit(m), F.array(*map(F.lit, own)))])
        forests = materialize(forests).withColumn("model", F.explode(every[F.col("model")]))
    return materialize(forests)


def quantiles(base: DataFrame, features: int) -> DataFrame:
    """``borders`` by ``percentile_approx``, for few rows: they are copied for each view."""
    shares = F.array(*[F.lit(k / MAX_BINS) for k in range(MAX_BINS)])
    each = F.array(*[F.percentile_approx(F.col("x")[f], shares, 10_000) for f in range(features)]).cast("array<array<double>>")
    rows = base.select("x", F.explode("views").alias("view")).groupBy("view").agg(each.alias("each"))
    return rows.select("view", F.posexplode("each").alias("feature", "cuts"))


def borders(base: DataFrame, features: int) -> DataFrame:
    """(view, feature, cuts): the ``MAX_BINS`` quantiles of each feature in each view, each value once.

    Rows of the same views are a part; a task sorts a part's values once for all of its views, and ``_POINTS``
    of them stand for more (a quantile is then off by 1 / (2 * _POINTS) of the rows at most)."""

    def points(batches):
        held: dict[str, list] = {}

        def told():
            for within, some in held.items():
                x, views = np.concatenate(some), [int(v) for v in within.split(",")]
                for f in range(features):
                    v = x[:, f]
                    v, weight = np.sort(v[~np.isnan(v)]), 1.0
                    if len(v) > _POINTS:
                        at = ((np.arange(_POINTS) + 0.5) * len(v) / _POINTS).astype(np.int64)
                        at[0] = 0
                        v, weight = v[at], len(v) / _POINTS
                    yield pa.RecordBatch.from_pylist([{"feature": f, "views": views, "weight": weight, "points": v.tobytes()}], schema=_ARROW_POINTS)
            held.clear()

        n = 0
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            within = batch.column("within").dictionary_encode()
            part = within.indices.to_numpy()
            for k, name in enumerate(within.dictionary.to_pylist()):
                held.setdefault(name, []).append(x[part == k])
            n += batch.num_rows
            if n >= _SORTED:
                yield from told()
                n = 0
        yield from told()

    def merged(table: pa.Table) -> pa.Table:
        weights = np.repeat(table["weight"].to_numpy(), [len(p.as_py()) // 8 for p in table["points"]])
        values = np.frombuffer(b"".join(p.as_py() for p in table["points"]))
        part = np.repeat(np.arange(table.num_rows), [len(p.as_py()) // 8 for p in table["points"]])
        order = np.argsort(values, kind="stable")
        values, weights, part = values[order], weights[order], part[order]
        own, out = [set(v.as_py()) for v in table["views"]], []
        for view in sorted(set().union(*own)):
            below = np.cumsum(weights * np.array([view in v for v in own])[part])
            n = round(below[-1]) if len(below) else 0
            ranks = [max(1, math.ceil(k / MAX_BINS * n)) - 0.5 for k in range(MAX_BINS)]
            picked = values[np.minimum(np.searchsorted(below, ranks), len(below) - 1)] if n else []
            out.append({"view": view, "feature": table["feature"][0].as_py(), "cuts": sorted({float(v) for v in picked})})
        return pa.Table.from_pylist(out, schema=_ARROW_CUTS)

    parts = base.select("x", "within").mapInArrow(points, "feature int, views array<int>, weight double, points binary")
    return parts.groupBy("feature").applyInArrow(merged, "view int, feature int, cuts array<double>")


_ARROW_POINTS = pa.schema([("feature", pa.int32()), ("views", pa.list_(pa.int32())), ("weight", pa.float64()), ("points", pa.binary())])
_ARROW_CUTS = pa.schema([("view", pa.int32()), ("feature", pa.int32()), ("cuts", pa.list_(pa.float64()))])


def _cut(by_view: Mapping[int, Sequence[Sequence[float]]], live: int):
    """Rows of all views as blocks of the binned rows of one view (``by_view`` has the borders of
    its features; those behind the ``live`` ones are 0)."""
    # a value's place among the borders of all views, and the bin of each view that it stands for
    every = [np.unique(np.concatenate([np.asarray(cuts[f], float) for cuts in by_view.values()])) for f in range(live)]
    bin_of = {v: [np.concatenate([[0], np.searchsorted(cuts[f], every[f], side="right")]).astype(np.uint8) for f in range(live)] for v, cuts in by_view.items()}
    rest = {v: [np.searchsorted(c, 0.0, side="right") for c in cuts[live:]] for v, cuts in by_view.items()}

    def blocks_of(batches):
        held: dict[int, list] = {v: [] for v in by_view}
        waiting = dict.fromkeys(by_view, 0)

        def told(v: int, least: int):
            keys, bins, y = zip(*held[v])
            keys, bins, y = np.concatenate(keys), np.concatenate(bins, axis=1), np.concatenate(y)
            whole = len(keys) // least * least
            for lo in range(0, whole, BLOCK):
                o = slice(lo, min(lo + BLOCK, whole))
                yield pa.RecordBatch.from_pylist([_block_row(v, keys[o], bins[:, o], y[o].T, np.empty(0))], schema=_ARROW_BLOCKS)
            held[v], waiting[v] = [(keys[whole:], bins[:, whole:], y[whole:])], len(keys) - whole

        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            y = batch.column("y").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
            key, within = batch.column("key").to_numpy(), batch.column("within").dictionary_encode()
            part, parts = within.indices.to_numpy(), [set(map(int, w.split(","))) for w in within.dictionary.to_pylist()]
            place = [np.searchsorted(every[f], x[:, f], side="right") for f in range(live)]
            for v in by_view:
                own = np.flatnonzero(np.array([v in p for p in parts])[part])
                if not len(own):
                    continue
                bins = np.empty((live + len(rest[v]), len(own)), np.uint8)
                for f in range(live):
                    bins[f] = bin_of[v][f].take(place[f].take(own))
                for k, b in enumerate(rest[v]):
                    bins[live + k] = b
                held[v].append((key[own], bins, y[own]))
                waiting[v] += len(own)
                if waiting[v] >= BLOCK:
                    yield from told(v, BLOCK)
        for v in by_view:
            if held[v]:
                yield from told(v, 1)

    return blocks_of


def _in_tasks(blocks, plan, view_names, cuts, names) -> DataFrame:
    """Each model in a task of its own, all at the same time."""
    # the longest first: the number of a model is that of its partition
    work = {i: v[4] * v[0].params.n_estimators * v[0].params.max_depth * (3 if v[0].objective == "logistic" else 2) for i, v in plan.items()}
    order = sorted(plan, key=lambda i: -work[i])
    models_of: dict[int, list[int]] = {}
    for at, i in enumerate(order):
        models_of.setdefault(view_names.index(plan[i][0].view), []).append(at)
    lists = F.create_map(*[x for v, own in models_of.items() for x in (F.lit(v), F.array(*map(F.lit, own)))])
    rows = blocks(sorted(models_of)).withColumn("model", F.explode(lists[F.col("view")])).repartitionById(len(order), "model")
    # task slots that the models leave idle go to the largest ones
    slots, whole = rows.sparkSession.sparkContext.defaultParallelism, max(1, sum(work.values()))
    workers = {i: max(1, min(_WORKERS, round(slots * work[i] / whole), v[4] // _LEAST_SHARE)) for i, v in plan.items()}

    def train(batches):
        at, lo = None, 0
        for batch in batches:
            if at is None:
                at = batch.column("model")[0].as_py()
                job, k, start, scale, n = plan[order[at]]
                keys, bins, ys = array_of([n], np.int64), array_of([len(names), n], np.uint8), array_of([n], float)
            for _, key, block, y, _ in _blocks(batch):
                has = ~np.isnan(y[k])
                o = slice(lo, lo + int(has.sum()))
                keys[o], bins[:, o], ys[o] = key[has], block.compress(has, axis=1), y[k][has]  # rows of a feature together
                lo = o.stop
        if at is not None:
            many = min(workers[order[at]], os.cpu_count() or 1)
            trees = grow_forest(keys[:lo], bins[:, :lo], ys[:lo], job, start, scale, many, names, n_features)
            yield pa.RecordBatch.from_pylist([_forest_row(job, start, n, trees, cuts[job.view])], schema=_ARROW_FOREST)

    n_features = len(next(iter(cuts.values())))
    return rows.mapInArrow(train, FOREST)


def _by_levels(blocks: DataFrame, plan, view_names, names, n_features) -> dict[int, list[Tree]]:
    """All models level by level; sums are grouped by (model, node)."""
    spark = blocks.sparkSession
    place: dict[int, tuple[int, int]] = {}  # model -> (view, position of its margin)
    start_of: dict[int, list[float]] = {}
    for i, (job, _, start, _, _) in plan.items():
        v = view_names.index(job.view)
        place[i] = (v, len(start_of.setdefault(v, [])))
        start_of[v].append(start)
    trees: dict[int, list[Tree]] = {i: [] for i in plan}
    kept = 0  # trees that the written margins hold

    def first_margins(batches):
        for batch in batches:
            rows = [_block_row(v, key, bins, y, np.repeat(start_of[v], len(key))) for v, key, bins, y, _ in _blocks(batch)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_BLOCKS)

    state = materialize(blocks.filter(F.col("view").isin(list(start_of))).mapInArrow(first_margins, _BLOCKS))

    def margins(bins, margin, recent):
        """Margins of one model's rows, with the trees that are not in the table yet."""
        for t in recent:
            margin = margin + np.array(t.value)[t.nodes(bins)]
        return margin

    def level(k: int, under_way: dict[int, Growth]) -> dict[int, dict[int, tuple]]:
        recent = spark.sparkContext.broadcast({i: trees[i][kept:] for i in under_way})
        columns = {i: kept_columns(plan[i][0], np.asarray(names), n_features, k) for i in under_way}

        def add_up(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for v, key, bins, ys, margin in _blocks(batch):
                    for i, growth in under_way.items():
                        if place[i][0] != v:
                            continue
                        job, label, _, scale, _ = plan[i]
                        y = ys[label]
                        mine = sampled(key, job.params, k) & ~np.isnan(y)
                        g, h = gradients(np.where(mine, y, 0.0), margins(bins, margin[place[i][1]], recent.value[i]), job.objective, scale)
                        slot = np.where(mine, growth.slots()[growth.tree.nodes(bins)], -1)
                        own = sums(bins, columns[i], slot, g, h, len(growth.active), MAX_BINS + 1)
                        total[i] = total[i] + own if i in total else own
            for i, t in total.items():
                some = np.flatnonzero(t[1].any(axis=(1, 2)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i, np.int32)), pa.array(some.astype(np.int32)),
                                                  pa.array([t[:, s].tobytes() for s in some], pa.binary())], names=["model", "slot", "sums"])

        def pick(table: pa.Table) -> pa.Table:
            i, slot = table["model"][0].as_py(), table["slot"][0].as_py()
            whole = sum(np.frombuffer(s.as_py()) for s in table["sums"]).reshape(2, 1, len(columns[i]), -1)
            names = ("g", "h", "gain", "feature", "bin", "lg", "lh")
            row = dict(zip(names, best_splits(whole, columns[i], plan[i][0].params, plan[i][3])[0]))
            return pa.Table.from_pylist([{"model": i, "slot": slot, **row}], schema=_ARROW_SPLITS)

        parts = state.mapInArrow(add_up, "model int, slot int, sums binary")
        out: dict[int, dict[int, tuple]] = {i: {} for i in under_way}
        for r in parts.groupBy("model", "slot").applyInArrow(pick, _SPLITS).collect():  # one row a node of the level
            out[r["model"]][r["slot"]] = (r["g"], r["h"], r["gain"], r["feature"], r["bin"], r["lg"], r["lh"])
        recent.unpersist()
        return out

    def with_margins(batches):
        for batch in batches:
            rows = []
            for v, key, bins, y, margin in _blocks(batch):
                fresh = np.array(margin)
                for i, (at, col) in place.items():
                    if at == v:
                        fresh[col] = margins(bins, fresh[col], trees[i][kept:])
                rows.append(_block_row(v, key, bins, y, fresh))
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_BLOCKS)

    for k in range(max(job.params.n_estimators for job, *_ in plan.values())):
        growing = {i: Growth(v[0], v[3]) for i, v in plan.items() if k < v[0].params.n_estimators}
        open_ = dict(growing)
        while open_:
            best = level(k, open_)
            for i, growth in open_.items():
                growth.grow(best[i])
            open_ = {i: g for i, g in open_.items() if g.active}
        for i, growth in growing.items():
            trees[i].append(growth.tree)
        if k + 1 - kept >= KEEP:
            state = materialize(state.mapInArrow(with_margins, _BLOCKS))
            kept = k + 1
    for t in (t for own in trees.values() for t in own):
        t.feature = [names[f] if f >= 0 else f for f in t.feature]
    return trees


_SPLITS = "model int, slot int, g double, h double, gain double, feature int, bin int, lg double, lh double"
_ARROW_SPLITS = pa.schema([("model", pa.int32()), ("slot", pa.int32()), ("g", pa.float64()), ("h", pa.float64()), ("gain", pa.float64()),
                           ("feature", pa.int32()), ("bin", pa.int32()), ("lg", pa.float64()), ("lh", pa.float64())])


# ---------------------------------------------------------------- forests as columns

def forest_margin(x: Column, trees: Column, base: Column, steps: Column, inner: Column) -> Column:
    """Base plus the leaf that ``x`` (array of double) reaches in each tree: a fold
    over the trees, and in each a walk of ``steps`` from the root past the ``inner`` nodes.
    ``x`` is bound once; as a plain expression the walk would build it anew for every node."""

    def reached(tree: Column, v: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            return 2 * node + F.when(F.get(v, F.get(tree["feature"], node)) < F.get(tree["cut"], node), F.lit(1)).otherwise(F.lit(2))

        return F.get(tree["value"], F.aggregate(steps, F.lit(0), step) - inner)

    return F.get(F.transform(F.array(x), lambda v: F.aggregate(trees, base, lambda total, tree: total + reached(tree, v))), 0)


def score_forests(df: DataFrame, forests: DataFrame, features: Sequence[str], model: Column, out: str) -> DataFrame:
    """``df`` with the score of the model that each row names (null if there is no
    such model): one scan, one join on the model's name, no Python."""
    nodes = forests.agg(F.sum(F.aggregate("trees", F.lit(0).cast("long"), lambda n, t: n + F.size(t["value"])))).first()[0] or 0
    small = nodes * 20 <= BROADCAST_BYTES
    own = forests.select(F.col("model").alias("__forest_name"), "objective", "base", F.sequence(F.lit(1), "depth").alias("steps"),
                         (F.pow(F.lit(2), F.col("depth")) - 1).cast("int").alias("inner"), "trees")
    own = own.select("__forest_name", F.struct("objective", "base", "steps", "inner", "trees").alias("__forest"))
    rows = spread(df).withColumn("__forest_key", model).join(F.broadcast(own) if small else own, F.col("__forest_key") == F.col("__forest_name"), "left")
    x = F.array(*[F.col(f).cast("double") for f in features])
    margin = forest_margin(x, F.col("__forest.trees"), F.col("__forest.base"), F.col("__forest.steps"), F.col("__forest.inner"))
    rows = rows.withColumn(out, margin)
    chance = 1.0 / (1.0 + F.exp(-F.col(out)))
    return rows.withColumn(out, F.when(F.col("__forest.objective") == "logistic", chance).otherwise(F.col(out))).drop("__forest_key", "__forest_name", "__forest")


def score_rows(df: DataFrame, forests: DataFrame, features: Sequence[str], model: Column, out: str) -> DataFrame:
    """``score_each`` for one model a row."""
    return score_each(df, forests, features, {out: model})


def score_each(df: DataFrame, forests: DataFrame, features: Sequence[str], models: Mapping[str, Column]) -> DataFrame:
    """``df`` with the score of each of the models that its rows name (new column: model), as ``score_forests`` gives them to the
    bit; rows go to Python once.  Trees are walked by batches of rows in numpy (some 10 nanoseconds a tree and row: values become
    places among a forest's cuts, a byte each, and all conditions of a tree are taken for all rows); forests above
    ``BROADCAST_BYTES`` take the join of ``score_forests``."""
    nodes = forests.agg(F.sum(F.aggregate("trees", F.lit(0).cast("long"), lambda n, t: n + F.size(t["value"])))).first()[0] or 0
    if nodes * 20 > BROADCAST_BYTES or not features:
        for out, model in models.items():
            df = score_forests(df, forests, features, model, out)
        return df
    own, logistic = {}, []
    for r in forests.select("model", "objective", "base", "depth", "trees").collect():  # bounded as above
        own[r["model"]] = (r["base"], *_by_places([(t["feature"], t["cut"], t["value"]) for t in r["trees"]]))
        logistic += [r["model"]] * (r["objective"] == "logistic")
    used = sorted({f for _, cuts, _ in own.values() for f in cuts}) or [0]
    column, many = {f: c for c, f in enumerate(used)}, len(models)
    shared = df.sparkSession.sparkContext.broadcast(own)

    def margin(x: np.ndarray, name: str) -> np.ndarray:
        base, cuts, trees = shared.value[name]
        place = {f: np.searchsorted(c, x[column[f]], side="right").astype(np.uint8 if len(c) < 256 else np.int32) for f, c in cuts.items()}
        total = np.full(x.shape[1], base)
        for root, value in trees:
            total += value.take(_leaves(root, place)) if isinstance(root, tuple) else value[root]
        return total

    def scored(some: list[tuple[pa.Array, ...]]) -> pa.Array:
        x = np.stack([np.concatenate([s[many + c].to_numpy(zero_copy_only=False).astype(float) for s in some]) for c in range(len(used))])
        total, found = np.zeros((x.shape[1], many)), np.zeros((x.shape[1], many), bool)
        for k in range(many):
            names = pa.concat_arrays([s[k] for s in some]).dictionary_encode()
            at = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for i, name in enumerate(names.dictionary.to_pylist()):
                if name in shared.value:
                    mine = np.flatnonzero(at == i)
                    for lo in range(0, len(mine), _WALKED):
                        own_rows = mine[lo: lo + _WALKED]
                        total[own_rows, k] = margin(x[:, own_rows], name)
                        found[own_rows, k] = True
        values = pa.array(total.ravel(), mask=~found.ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(x.shape[1] + 1, dtype=np.int32) * many), values)

    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch[0])
            if n >= _SCORED:
                yield scored(held)
                held, n = [], 0
        if held:
            yield scored(held)

    walked, keys = F.arrow_udf(score, "array<double>"), [m.cast("string") for m in models.values()]
    rows = spread(df).withColumn("__scores", walked(*keys, *[F.col(features[f]).cast("double") for f in used]))
    rows = rows.withColumns({out: F.get("__scores", F.lit(k)) for k, out in enumerate(models)}).drop("__scores")
    if not logistic:
        return rows
    return rows.withColumns({out: F.when(key.isin(logistic), 1.0 / (1.0 + F.exp(-F.col(out)))).otherwise(F.col(out)) for out, key in zip(models, keys)})


def _by_places(trees: Sequence[tuple]) -> tuple[dict[int, np.ndarray], list[tuple]]:
    """Cuts of each feature of a forest, and of each tree the root and the leaves' values: a node is (feature, place of its cut,
    left, right) or a leaf's number.  A node without a cut has the same leaf on both sides."""
    cuts: dict[int, set] = {}
    for feature, cut, _ in trees:
        for f, c in zip(feature, cut):
            if c < math.inf:
                cuts.setdefault(f, set()).add(c)
    places = {f: np.array(sorted(c)) for f, c in cuts.items()}

    def node(k: int, feature, cut):
        if k >= len(feature):
            return k - len(feature)
        if cut[k] == math.inf:
            return node(2 * k + 1, feature, cut)
        return feature[k], int(np.searchsorted(places[feature[k]], cut[k])), node(2 * k + 1, feature, cut), node(2 * k + 2, feature, cut)

    return places, [(node(0, feature, cut), np.array(value, float)) for feature, cut, value in trees]


def _leaves(node: tuple, place: Mapping[int, np.ndarray]) -> np.ndarray:
    """The leaf that each row comes to below ``node``."""
    f, cut, left, right = node
    above = place[f] > cut
    a, b = (_leaves(x, place) if isinstance(x, tuple) else x for x in (left, right))
    if not isinstance(left, tuple) and not isinstance(right, tuple):
        if b < 256:
            above = above.view(np.uint8)
            above = above * np.uint8(b - a)
            above += np.uint8(a)
            return above
        return np.where(above, b, a)
    small = all(x.dtype == np.uint8 if isinstance(x, np.ndarray) else x < 256 for x in (a, b))
    if not small:
        return np.where(above, b, a)
    a, b = (x if isinstance(x, np.ndarray) else np.uint8(x) for x in (a, b))
    return a ^ ((a ^ b) & -above.view(np.uint8))
