"""Repair of conversation structure at the least cost.

A conversation should read as an optional system turn and then pairs of a user's
and an assistant's turn.  Edits go along its rows, ordered by turn (nulls
first; ties by role, then text): keep (cost 0), give the row the role that is due,
user or assistant (1), delete it (2; blank rows and repeats of an
earlier row must go), insert an empty turn of the role that is due (5).  A row that
stays though its text ends in the middle costs 5 more.  Of the cheapest edits
the ASCII-least sequence of initials (the audit) is taken.

Method.  Nodes are (row, state), where the state is what came last: nothing,
system, user or assistant.  A cost table is filled from the last row to the
first for many conversations at once.  The arcs on cheapest paths are then ranked
by the audit that begins with them: first by their own letter, then by pairs of
ranks, so that the compared length doubles each time.  Each node's least arc
is its pointer, and pointers of doubled reach write out the path.

Conversations of at most ``WHOLE_ROWS`` rows and ``WHOLE_CHARS`` code points are
streamed by the sorted partition that holds them.  Longer ones are dealt into
chunks of their order: each chunk gives a 4 x 4 table of costs from state to
state, tables are combined along the conversation, and each chunk then finds
its own part of the path, so no task ever holds the rows of a long
conversation.

Defined cases: null roles and texts are one space; rows with a null
conversation id are one conversation, null turns come first and leave no gap;
repeated rows and further columns (also of the names used here) are fine; roles
that don't begin with s, u or a can't be kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import BROADCAST_IDS
from panelforge.operators.common import materialize, maybe_broadcast

WHOLE_ROWS, WHOLE_CHARS = 65_536, 32 << 20
CHUNK_BITS = 11

#: Costs of the edits.
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
_FAR = 1 << 40
#: States: 0 nothing, 1 system, 2 user, 3 assistant.  The state after the role that is due, and after a kept role (-1: not allowed).
_DUE = np.array([2, 2, 3, 2])
_KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
_LETTERS = np.frombuffer(b"DIKR", np.uint8)
_BLANKS = " \t\n\x0b\x0c\r"
SOUND, GONE, SHORT = 0, 1, 2


def _with_inserts(w: np.ndarray) -> np.ndarray:
    """Costs when up to two turns may be inserted first (more never help)."""
    return np.minimum(w, np.minimum(INSERT + w[..., _DUE], 2 * INSERT + w[..., _DUE[_DUE]]))


#: Cost from each state at the very end.
END = _with_inserts(np.array([0, _FAR, _FAR, 0]))


def costs(initial: np.ndarray, fault: np.ndarray, length: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Least cost from (row, state) to the end, [row, conversation, state]; ``initial``
    and ``fault`` are [conversation, row], ``goal`` is the cost behind the last row."""
    m, n = initial.shape
    out = np.empty((n + 1, m, 4), np.int64)
    out[n] = goal
    for i in range(n - 1, -1, -1):
        after = out[i + 1]
        extra = np.where(fault[:, i] == SHORT, CUT_SHORT, 0)[:, None] + np.where(fault[:, i] == GONE, _FAR, 0)[:, None]
        to = _KEPT[initial[:, i]]
        keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1), _FAR)
        best = np.minimum(DELETE + after, extra + np.minimum(keep, REROLE + after[:, _DUE]))
        out[i] = np.where((i < length)[:, None], _with_inserts(best), goal)
    return np.minimum(out, _FAR)


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Dense rank of tuples of non-negative numbers."""
    one = keys[0]
    for k in keys[1:]:
        one = one * (int(k.max(initial=0)) + 1) + k
    return np.unique(one, return_inverse=True)[1].ravel()


def least_paths(initial: np.ndarray, fault: np.ndarray, length: np.ndarray, entry: np.ndarray, goal: np.ndarray,
                closing: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cost, letters, state before each letter, state at the end) of the least cheapest audit from the
    entry states; letters and states are [conversation, step], -1 behind the last step.  ``closing``: the
    conversation ends here, so turns may be inserted behind its last row."""
    m, n = initial.shape
    table = costs(initial, fault, length, goal)
    node = (np.arange(n + 1)[:, None, None] * m + np.arange(m)[:, None]) * 4 + np.arange(4)
    inside = (np.arange(n)[:, None] < length)[..., None]
    here, after = table[:-1], table[1:]
    extra = (np.where(fault.T == SHORT, CUT_SHORT, 0) + np.where(fault.T == GONE, _FAR, 0))[..., None]
    to = _KEPT[initial.T]
    kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 2), _FAR) + extra
    # a row's arcs lead to the next row, or to the conversation's end node (row ``length``)
    below = node[1:]
    arcs = [(0, here == DELETE + after, below), (1, here == INSERT + here[..., _DUE], node[:-1][..., _DUE]),
            (2, here == kept, np.take_along_axis(below, np.maximum(to, 0), 2)), (3, here == REROLE + after[..., _DUE] + extra, below[..., _DUE])]
    src, label, dst = [], [], []
    for k, best, target in arcs:
        at = np.nonzero(best & inside & (here < _FAR))
        src.append(node[:-1][at])
        dst.append(target[at])
        label.append(np.full(len(at[0]), k + 1))
    end = (length[:, None] * m + np.arange(m)[:, None]) * 4 + np.arange(4)
    last = np.take_along_axis(table, length[None, :, None], 0)[0]
    insert = closing & (last == INSERT + last[:, _DUE])
    src += [end[insert], end[~insert]]
    dst += [end[:, _DUE][insert], end[~insert]]
    label += [np.full(int(insert.sum()), 2), np.zeros(int((~insert).sum()), np.int64)]  # 0: the path ends here
    src, label, dst = map(np.concatenate, (src, label, dst))
    order = np.lexsort((label, src))
    src, label, dst = src[order], label[order], dst[order]
    # ranks of arcs by 1, 2, 4 ... letters; the arc reached after as many
    rank, reach = _dense(label), np.searchsorted(src, dst)
    steps = 2 * n + 4  # inserts cost more than deletions, so fewer than half as many as rows, and two
    width = 1
    while width < steps:
        rank, reach = _dense(rank, rank[reach]), reach[reach]
        width *= 2
    order = np.lexsort((rank, src))
    first = order[np.append(True, np.diff(src[order]) > 0)] if len(order) else order
    arc_of = np.zeros(node.size, np.int64)
    arc_of[src[first]] = first
    path, jump = (np.arange(m) * 4 + entry)[:, None], dst[arc_of]
    if not n:
        path = end[np.arange(m), entry][:, None]
    while path.shape[1] < steps:
        path, jump = np.concatenate([path, jump[path]], 1), jump[jump]
    letter = label[arc_of[path]] - 1
    return table[0, np.arange(m), entry], letter, np.where(letter >= 0, path % 4, -1), path[:, -1] % 4


def _by_length(length: np.ndarray):
    """Groups of conversations of about the same length."""
    size = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for k in np.unique(size):
        yield np.flatnonzero(size == k)


def _matrix(flat: np.ndarray, start: np.ndarray, length: np.ndarray, fill: int) -> np.ndarray:
    n = int(length.max(initial=0))
    col = np.arange(n)
    inside = col < length[:, None]
    out = np.full((len(start), n), fill, np.int64)
    out[inside] = flat[(start[:, None] + col)[inside]]
    return out


def _texts(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(initial 0 s, 1 u, 2 a, 3 other; blank; ends in the middle) of the rows."""
    start = pc.utf8_slice_codeunits(table["role"], 0, 1)
    initial = np.full(table.num_rows, 3)
    for k, c in enumerate("sua"):
        initial[pc.equal(start, c).to_numpy(zero_copy_only=False)] = k
    body = pc.utf8_trim(table["text"], _BLANKS)
    blank = pc.equal(body, "").to_numpy(zero_copy_only=False)
    ended = np.zeros(table.num_rows, bool)
    for c in ".!?":
        ended |= pc.ends_with(body, c).to_numpy(zero_copy_only=False)
    return initial, blank, ~ended & ~blank


def _odd_pairs(initial: np.ndarray) -> np.ndarray:
    """Whether each neighbouring pair is none of su, ua, au."""
    a, b = initial[:-1], initial[1:]
    return ~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))


def _messages(role: pa.Array, text: pa.Array, letter: np.ndarray, state: np.ndarray, start: np.ndarray) -> pa.Array:
    """The repaired turns of each conversation as a list of {role, text}."""
    n = len(role)
    roles, texts = pa.concat_arrays([role, pa.array(["user", "assistant"], role.type)]), pa.concat_arrays([text, pa.array([""], text.type)])
    row = start[:, None] + np.cumsum((letter >= 0) & (letter != 1), 1) - 1
    stays = letter >= 1
    who = np.where(letter == 2, row, n + (_DUE[state] == 3))[stays]
    what = np.where(letter == 1, n, row)[stays]
    offsets = np.append(0, np.cumsum(stays.sum(1))).astype(np.int32)
    turns = pa.StructArray.from_arrays([roles.take(pa.array(who)), texts.take(pa.array(what))], ["role", "text"])
    return pa.ListArray.from_arrays(pa.array(offsets), turns)


def _strings(letter: np.ndarray) -> pa.Array:
    size = (letter >= 0).sum(1)
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(_LETTERS[letter[letter >= 0]].tobytes())])


_TURNS = "array<struct<role: string, text: string>>"
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _whole(rows: DataFrame, conv_type: str) -> DataFrame:
    """Conversations that fit: streamed from partitions sorted by conversation and order."""
    schema = f"conv {conv_type}, {_COUNTS}, audit string, turns {_TURNS}"

    def solve(table: pa.Table) -> list[pa.RecordBatch]:
        code = pc.dictionary_encode(table["conv"], null_encoding="encode").combine_chunks()
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy(zero_copy_only=False)
        new = np.append(True, code[1:] != code[:-1])
        which = np.cumsum(new) - 1
        conv, many = table["conv"].combine_chunks().take(pa.array(np.flatnonzero(new))), int(new.sum())
        there = table["there"].to_numpy()
        own, rows = which[there], table.filter(pa.array(there)).combine_chunks()
        length = np.bincount(own, minlength=many)
        start = np.cumsum(length) - length
        n = rows.num_rows
        count = lambda mask: np.bincount(own[mask], minlength=many)
        if n:
            initial, blank, short = _texts(rows)
            key = [own] + [rows[c].dictionary_encode().combine_chunks().indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("role", "text")]
            key = _dense(*key)
            again = np.ones(n, bool)
            again[np.unique(key, return_index=True)[1]] = False
            again &= ~blank
            short &= ~again
            fault = np.where(blank | again, GONE, np.where(short, SHORT, SOUND))
            odd = np.append(_odd_pairs(initial) & (own[1:] == own[:-1]), False)
            known = rows["turn"].is_valid().to_numpy(zero_copy_only=False)
            turn = pc.fill_null(rows["turn"], 0).to_numpy()
        else:
            initial = fault = turn = np.empty(0, np.int64)
            blank = again = short = odd = known = np.empty(0, bool)
        t, o = turn[known], own[known]
        low, high = np.zeros(many, np.int64), np.zeros(many, np.int64)
        at = np.flatnonzero(np.append(True, o[1:] != o[:-1])) if len(o) else np.empty(0, int)
        low[o[at]], high[o[at]] = t[at], t[np.append(at[1:], len(o)) - 1] if len(o) else 0
        fresh_turn = np.append(True, (t[1:] != t[:-1]) | (o[1:] != o[:-1]))[: len(t)]
        distinct = np.bincount(o[fresh_turn], minlength=many)
        gaps = np.where(distinct > 0, high - low + 1 - distinct, 0)
        numbers = np.stack([gaps, count(blank), count(again), count(short), count(odd)]).astype(np.int64)
        out = []
        for pick in _by_length(length):
            size = length[pick]
            cost, letter, state, _ = least_paths(_matrix(initial, start[pick], size, 3), _matrix(fault, start[pick], size, 0), size, np.zeros(len(pick), int), END, True)
            turns = _messages(*(pc.cast(rows[c].combine_chunks(), pa.string()) for c in ("role", "text")), letter, state, start[pick])
            out.append(pa.RecordBatch.from_arrays([conv.take(pa.array(pick)), *map(pa.array, numbers[:, pick]), pa.array(cost), _strings(letter), turns],
                                                  names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turns"]))
        return out

    def stream(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([*held, batch])
            last = part["conv"][part.num_rows - 1]
            same = pc.is_null(part["conv"]) if not last.is_valid else pc.fill_null(pc.equal(part["conv"], last), False)
            begin = pc.index(same.combine_chunks() if isinstance(same, pa.ChunkedArray) else same, True).as_py()
            if begin:
                yield from solve(part.slice(0, begin))
            held = part.slice(begin).to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(stream, schema)


def _long(rows: DataFrame, big: DataFrame, bits: int) -> DataFrame:
    """Conversations beyond the bound, in chunks of their order: key, chunk, counts and audit of
    each chunk with its repaired turns (counts of the whole conversation are in its first chunk)."""
    order = ["key", "turn", "role", "text", "salt"]
    rows = materialize(rows.join(maybe_broadcast(big, BROADCAST_IDS), rows["conv"].eqNullSafe(big["big"])).filter("there")
                       .select("key", "turn", "role", "text", F.monotonically_increasing_id().alias("salt")))
    parts = max(1, -(-rows.count() >> bits + 3))
    ordered = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                          .select("key", "turn", "role", "text", F.monotonically_increasing_id().alias("at"))
                          .withColumn("chunk", F.shiftright("at", bits)).withColumn("sha", F.unhex(F.sha2("text", 256))))
    first = materialize(ordered.groupBy("key", "role", "sha").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    # only what the costs need travels; the text's last characters are read where the text is
    marks = ordered.select("key", "chunk", "at", "role", "sha", F.regexp_extract("text", r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\z)", 0).alias("text"))
    marks = marks.join(maybe_broadcast(first, BROADCAST_IDS), ["key", "role", "sha"], "left").withColumn("again", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))

    def chunk(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        initial, blank, short = _texts(table)
        again = table["again"].to_numpy() & ~blank
        short &= ~again
        fault = np.where(blank | again, GONE, np.where(short, SHORT, SOUND))
        goals = np.where(np.eye(4, dtype=bool), 0, _FAR)  # from each state to each state
        wide = lambda a: np.repeat(a[None].astype(np.int64), 4, 0)
        through = costs(wide(initial), wide(fault), np.full(4, len(initial)), goals)[0].T
        cells = [table["key"][0].as_py(), table["chunk"][0].as_py(), int(blank.sum()), int(again.sum()), int(short.sum()), int(_odd_pairs(initial).sum()),
                 int(initial[0]), int(initial[-1]), (initial * 3 + fault).astype(np.uint8).tobytes(), through.ravel().tolist()]
        return pa.Table.from_pylist([dict(zip(names, cells))], schema=arrow)

    names = ["key", "chunk", "blank", "duplicate", "truncated", "illegal", "first", "last", "codes", "through"]
    arrow = pa.schema([(n, pa.binary() if n == "codes" else pa.list_(pa.int64()) if n == "through" else pa.int64()) for n in names])
    spark_schema = ", ".join(f"{n} {'binary' if n == 'codes' else 'array<long>' if n == 'through' else 'long'}" for n in names)
    chunks = materialize(marks.select("key", "chunk", "at", "role", "text", "again").groupBy("key", "chunk").applyInArrow(chunk, spark_schema))

    def backwards(table: pa.Table) -> pa.Table:
        """Cost behind each chunk, from the last to the first, and pairs across borders."""
        table = table.sort_by("chunk")
        through = np.array(table["through"].to_pylist(), np.int64).reshape(-1, 4, 4)
        goals, goal = np.empty((len(through), 4), np.int64), END
        for k in range(len(through) - 1, -1, -1):
            goals[k] = goal
            goal = np.minimum((through[k] + goal).min(1), _FAR)
        first, last = table["first"].to_numpy(), table["last"].to_numpy()
        border = [False, *(_odd_pairs(np.array([a, b]))[0] for a, b in zip(last, first[1:]))]
        return pa.table({"key": table["key"], "chunk": table["chunk"], "goal": pa.array(goals.tolist(), pa.list_(pa.int64())),
                         "closing": pa.array(np.arange(len(through)) == len(through) - 1), "border": pa.array(np.array(border, np.int64))})

    goals = chunks.select("key", "chunk", "through", "first", "last").groupBy("key").applyInArrow(backwards, "key long, chunk long, goal array<long>, closing boolean, border long")

    def each_entry(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.uint8).astype(np.int64)
                four = np.repeat(codes[None], 4, 0)
                cost, letter, _, out = least_paths(four // 3, four % 3, np.full(4, len(codes)), np.arange(4), np.array(row["goal"]), row["closing"])
                yield pa.RecordBatch.from_pylist([{"key": row["key"], "chunk": row["chunk"], "costs": cost.tolist(), "audits": _strings(letter).to_pylist(), "exits": out.tolist()}], schema=entry_schema)

    entry_schema = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int64()))])
    paths = materialize(chunks.select("key", "chunk", "codes").join(goals, ["key", "chunk"])
                        .mapInArrow(each_entry, "key long, chunk long, costs array<long>, audits array<string>, exits array<long>"))

    def forwards(table: pa.Table) -> pa.Table:
        """State in which the path enters each chunk."""
        table = table.sort_by("chunk")
        entry = [0]
        for out in table["exits"].to_pylist()[:-1]:
            entry.append(out[entry[-1]])
        return pa.table({"key": table["key"], "chunk": table["chunk"], "entry": pa.array(entry, pa.int32())})

    entries = paths.select("key", "chunk", "exits").groupBy("key").applyInArrow(forwards, "key long, chunk long, entry int")
    audits = paths.join(entries, ["key", "chunk"]).select("key", "chunk", "entry", F.col("audits")[F.col("entry")].alias("audit"), F.col("costs")[F.col("entry")].alias("cost"))

    def turns(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at").combine_chunks()
        audit, state, states = right["audit"][0].as_py(), right["entry"][0].as_py(), []
        initial = _texts(left)[0]
        row = 0
        for c in audit:  # at most some thousand letters
            states.append(state)
            state = state if c == "D" else _DUE[state] if c in "IR" else _KEPT[initial[row], state]
            row += c != "I"
        letter = np.array([["DIKR".index(c) for c in audit]], np.int64).reshape(1, -1)
        turns = _messages(*(pc.cast(left[c].combine_chunks(), pa.string()) for c in ("role", "text")), letter, np.array([states], np.int64).reshape(1, -1), np.zeros(1, int))
        return pa.table({"key": right["key"].slice(0, 1), "chunk": right["chunk"].slice(0, 1), "turns": turns})

    texts = ordered.select("key", "chunk", "at", "role", "text").groupBy("key", "chunk").cogroup(audits.groupBy("key", "chunk")).applyInArrow(
        turns, f"key long, chunk long, turns {_TURNS}")
    seen = goals.groupBy("key").agg(F.sum("border").alias("border"), F.min("chunk").alias("chunk"))
    gaps = ordered.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    total = (chunks.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
             .join(seen, "key").join(gaps, "key").withColumn("illegal", F.col("illegal") + F.col("border")).drop("border"))
    got = audits.join(texts, ["key", "chunk"]).join(total, ["key", "chunk"], "left")
    zero = lambda c: F.when(F.col("blank").isNull(), F.lit(0)).otherwise(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c)
    return got.select("key", "chunk", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), "audit", "turns")


def _standard(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"),
                       F.lit(True).alias("there"))


def _repaired(rows: DataFrame, whole_rows: int, whole_chars: int, bits: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(conversations that fit, chunks of the others or None, their keys)."""
    size = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    big = materialize(size.filter((F.col("n") > whole_rows) | (F.col("chars") > whole_chars))
                      .select(F.col("conv").alias("big"), F.monotonically_increasing_id().alias("key")))
    kind = rows.schema["conv"].dataType.simpleString()
    if big.isEmpty():
        return _whole(rows, kind), None, None
    small = rows.join(maybe_broadcast(big, BROADCAST_IDS), rows["conv"].eqNullSafe(big["big"]), "left_anti")
    return _whole(small, kind), _long(rows, big, bits), big


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           whole_rows: int = WHOLE_ROWS, whole_chars: int = WHOLE_CHARS, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The repaired conversations: the conversation's id, chunk (0 for those in one), the counts of
    faults, the cost, the audit and ``turns``, a list of {role, text}.  A long conversation has one row a
    chunk, in order; its counts are in the first and its cost is that from the chunk on."""
    small, long, big = _repaired(_standard(rows, conv_col, turn_col, role_col, text_col), whole_rows, whole_chars, chunk_bits)
    out = small.withColumn("chunk", F.lit(0).cast("long"))
    if long is not None:
        out = out.unionByName(long.join(maybe_broadcast(big, BROADCAST_IDS), "key").withColumnRenamed("big", "conv").drop("key"))
    return out.select(F.col("conv").alias(conv_col), *[c for c in out.columns if c != "conv"])


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults planted by the CRC-32 of ``conversation:turn`` modulo 20: 0 drops the row
    (``there`` is false), 1 empties its text, 2 takes out sentence ends, 3 repeats it, 4 makes its role user."""
    rows = _standard(rows, conv_col, turn_col, role_col, text_col)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("there"))


def _hashed(chunks: DataFrame) -> DataFrame:
    """One row per long conversation: chunks are read in order and hashed as they
    come (SHA-256 has no parts), so only its audit is held."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def read(batches):
        key, sha, audit, numbers = None, None, [], None
        row = lambda: pa.RecordBatch.from_pylist([{"key": key, **dict(zip(names, numbers)), "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema=schema)
        any_turn = False
        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != key:
                    if key is not None:
                        yield row()
                    key, sha, audit, numbers, any_turn = r["key"], hashlib.sha256(), [], [r[n] for n in names], False
                audit.append(r["audit"])
                for t in r["turns"]:
                    sha.update((("\n" if any_turn else "") + t["role"] + ":" + t["text"]).encode())
                    any_turn = True
        if key is not None:
            yield row()

    schema = pa.schema([("key", pa.int64()), *[(n, pa.int64()) for n in names], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(read, f"key long, {_COUNTS}, audit string, repaired_sha256 string")


def digest(rows: DataFrame, conv_col: str = "conv_id", whole_rows: int = WHOLE_ROWS, whole_chars: int = WHOLE_CHARS, chunk_bits: int = CHUNK_BITS, **columns) -> DataFrame:
    """Damage the rows, repair them, and give counts, audit and the hash of the repaired turns of every conversation."""
    small, long, big = _repaired(damage(rows, conv_col, **columns), whole_rows, whole_chars, chunk_bits)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    out = small.withColumn("repaired_sha256", F.sha2(lines.cast("binary"), 256)).drop("turns")
    if long is not None:
        out = out.unionByName(_hashed(long).join(maybe_broadcast(big, BROADCAST_IDS), "key").withColumnRenamed("big", "conv").drop("key"))
    return out.select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
