"""Token ids of Arrow text columns with a public tokenizer file.

Tokenizers that drop white space encode a text as the ids of its words, one
after the other.  For those, a batch is split into words by Arrow, each
distinct word is encoded once (and remembered by the Python worker, up to
``REMEMBER`` words) and numpy puts the ids together.  Others encode each text.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers (some 50 bytes each, in Arrow and numpy), and pieces of words that aren't plain (some 250 bytes each).
REMEMBER, REMEMBER_PIECES = 400_000, 50_000

#: A splitter that never joins an ASCII letter and a mark other than an apostrophe.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes: 1 an ASCII letter, 2 an ASCII mark but the apostrophe, 0 any other.
_KIND = np.array([1 if chr(b).isalpha() else 2 if 32 < b < 127 and not chr(b).isdigit() and b != 39 else 0 for b in range(128)] + [0] * 128, np.uint8)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def apart(column: pa.Array) -> pa.Array:
    """Texts without nulls, with a space wherever an ASCII letter and a mark meet, and ASCII letters in lower case
    but where a combining character may follow."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    offsets = offsets.astype(np.int64) - offsets[0]
    kind = _KIND[data]
    meet = np.zeros(len(data), bool)
    meet[1:] = kind[1:] + kind[:-1] == 3
    meet[1:] &= kind[1:] != kind[:-1]  # 1 and 2, never 0 and 3
    low = _LOWER[data]
    before = np.flatnonzero(data[1:] >= 128)
    low[before] = data[before]
    place = np.flatnonzero(meet)
    out = np.insert(low, place, 32)
    moved = offsets + np.searchsorted(place, offsets, side="right")
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(moved), pa.py_buffer(out))


class Encoder:
    def __init__(self, file: str):
        from tokenizers import Tokenizer

        if not os.path.isabs(file):
            import public_tokenizers

            file = public_tokenizers.path(file)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        ids = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        self.by_word = bool(self.tokenizer.normalizer and self.tokenizer.pre_tokenizer) and ids(" a\né, \t") == ids("a") + ids("é,")
        self.by_marks = self.by_word and self._splits_at_marks()
        self.known = pa.array([], pa.large_string())  # the remembered words, with their numbers of ids and the ids one after the other
        self.size, self.flat = np.empty(0, np.int64), np.empty(0, "<u4")
        self.pieces: dict[str, list[int]] = {}

    @property
    def words(self) -> dict[str, list[int]]:
        """The remembered words with their ids."""
        end = np.cumsum(self.size)
        return {w: self.flat[a:b].tolist() for w, a, b in zip(self.known.to_pylist(), end - self.size, end)}

    def _splits_at_marks(self) -> bool:
        """Whether the file's normaliser lowers case (behind NFC alone) and ``_SPLIT`` is its splitter."""
        spec = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in spec["normalizer"].get("normalizers", [])]
        split = spec["pre_tokenizer"].get("pretokenizers", [{}])
        bytes_ = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        return (normal == ["NFC", "Replace", "Lowercase"] and split[0].get("pattern") == {"Regex": _SPLIT} and split[0]["behavior"] == "Removed" and split[0]["invert"]
                and len(split) == 2 and bytes_.items() <= split[1].items())

    def _learn(self, new: list[str]) -> list[list[int]]:
        """Ids of words, from the tokenizer's own normaliser, splitter and model."""
        if not self.by_marks:
            return self._learn_split(new)
        plain = [w.isascii() and w.isalpha() and w.islower() for w in new]
        rest = iter(self._learn_split([w for w, p in zip(new, plain) if not p]))
        tokenize = self.tokenizer.model.tokenize  # one piece each
        return [[t.id for t in tokenize(w)] if p else next(rest) for w, p in zip(new, plain)]

    def _learn_split(self, new: list[str]) -> list[list[int]]:
        if len(self.pieces) > REMEMBER_PIECES:
            self.pieces.clear()
        normal = self.tokenizer.normalizer.normalize_str
        plain = [w.lower() if w.isascii() else normal(w) for w in new]
        ends = np.cumsum([len(w) + 1 for w in plain])
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(plain))
        out: list[list[int]] = [[] for _ in new]
        owner = np.searchsorted(ends, [span[0] for _, span in split], side="right")
        tokenize, known = self.tokenizer.model.tokenize, self.pieces
        for k, (piece, _) in zip(owner.tolist(), split):
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = [t.id for t in tokenize(piece)]
            out[k] += ids
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, one after the other; row offsets); null rows are empty."""
        column = pc.fill_null(column, "")
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        # Arrow also splits at the four separators 1C to 1F, the tokenizers don't
        if not self.by_word or ((data >= 0x1C) & (data <= 0x1F)).any():
            each = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in column.to_pylist()]
            return np.fromiter((i for e in each for i in e), np.uint32), np.cumsum([0, *map(len, each)])
        words = pc.utf8_split_whitespace(apart(column) if self.by_marks else column)
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_string())
        at = pc.index_in(distinct, value_set=self.known)
        new, at = np.flatnonzero(at.is_null()), at.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            fresh = distinct.take(pa.array(new))
            learned = self._learn(fresh.to_pylist())
            at[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, fresh])
            self.size = np.append(self.size, np.fromiter(map(len, learned), np.int64, len(learned)))
            self.flat = np.append(self.flat, np.fromiter((i for ids in learned for i in ids), "<u4"))
        size, start = self.size[at], (np.cumsum(self.size) - self.size)[at]
        flat = self.flat
        if len(self.known) > REMEMBER:  # begun again with the words of this batch
            self.known, self.size = distinct, size
            self.flat = flat[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        code = coded.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        at = np.repeat(start[code] - (end - n), n) + np.arange(total)
        bounds = np.concatenate([[0], end])[words.offsets.to_numpy()]
        return flat[at], bounds


@lru_cache(maxsize=4)
def encoder(file: str) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(file)
