"""Boolean trigram queries of regular expressions.

``query(regex)`` gives, in disjunctive form, the trigrams that any lower-cased
text with a match must hold: a set of conjunctions, each a set of trigrams.
An empty conjunction says nothing is mandatory.  The expression is read by
Python's own parser; of each part we know all its strings (if they are few)
or else the possible two first and last characters and a query.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass

MOST = 64

Query = frozenset  # of frozensets of trigrams
ANYTHING: Query = frozenset({frozenset()})


def _simplest(q) -> Query:
    return frozenset(c for c in q if not any(o < c for o in q))


def _all(a: Query, b: Query) -> Query:
    both = _simplest({x | y for x in a for y in b})
    return both if len(both) <= MOST else min(a, b, key=len)


def _holds(strings: set[str]) -> Query:
    return _simplest({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


@dataclass
class Part:
    exact: set[str] | None
    first: set[str]
    last: set[str]
    query: Query

    @staticmethod
    def of(strings: set[str]) -> Part:
        return Part(strings, {s[:2] for s in strings}, {s[-2:] for s in strings}, _holds(strings))


def _any() -> Part:
    return Part(None, {""}, {""}, ANYTHING)


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Part.of({x + y for x in a.exact for y in b.exact})
    q = _all(_all(a.query, b.query), _holds({x + y for x in a.last for y in b.first}))
    first = {(x + y)[:2] for x in a.exact for y in b.first} if a.exact is not None else a.first
    last = {(x + y)[-2:] for x in a.last for y in b.exact} if b.exact is not None else b.last
    return Part(None, first if len(first) <= MOST else {""}, last if len(last) <= MOST else {""}, q)


def _either(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= MOST:
        return Part.of(set().union(*(p.exact for p in parts)))
    return Part(None, set().union(*(p.first for p in parts)), set().union(*(p.last for p in parts)),
                _simplest(frozenset().union(*(p.query for p in parts))))


def _class(items) -> Part:
    chars: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            chars.add(chr(arg).lower())
        elif name == "RANGE" and arg[1] - arg[0] < MOST:
            chars |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return _any()
    return Part.of(chars) if len(chars) <= 8 else _any()


def _sequence(nodes) -> Part:
    out = Part.of({""})
    for op, arg in nodes:
        out = _then(out, _part(str(op), arg))
    return out


def _part(op: str, arg) -> Part:
    if op == "LITERAL":
        return Part.of({chr(arg).lower()})
    if op == "IN":
        return _class(arg)
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "ATOMIC_GROUP":
        return _sequence(arg)
    if op == "BRANCH":
        return _either([_sequence(b) for b in arg[1]])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, body = arg
        one = _sequence(body)
        if (int(least), int(most)) == (0, 1):
            return _either([Part.of({""}), one])
        out = Part.of({""})
        for _ in range(min(int(least), 8)):
            out = _then(out, one)
        return out if least == most and least <= 8 else _then(out, _any())
    if op in ("AT", "ASSERT", "ASSERT_NOT"):
        return Part.of({""})
    return _any()


def query(regex: str) -> Query:
    return _sequence(parser.parse(regex)).query
