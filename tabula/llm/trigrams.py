"""Boolean trigram queries from regular expressions.

``trigram_query(pattern)`` returns clauses in conjunctive form: every text
that matches the pattern contains, for each clause, all trigrams of at least
one of the clause's alternatives. Trigrams are lower case, so the query also
covers case-insensitive patterns. No clauses: the pattern has no mandatory
trigram and its rule must scan every text.
"""

from __future__ import annotations

import re

from re import _constants as C, _parser

Clause = frozenset[frozenset[str]]
#: Strings carried side by side before a run of literals is closed.
MAX_STRINGS = 64
#: Classes of up to this many characters are spelled out.
MAX_CLASS = 8


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _close(strings: set[str], clauses: set[Clause]) -> None:
    alternatives = {_trigrams(s) for s in strings}
    if alternatives and all(alternatives):  # one without trigrams demands nothing
        # an alternative that holds all of another's trigrams adds nothing
        clauses.add(frozenset(a for a in alternatives if not any(b < a for b in alternatives)))


def _class(members) -> list[str] | None:
    out = []
    for op, value in members:
        if op is C.LITERAL:
            out.append(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < MAX_CLASS:
            out += [chr(c).lower() for c in range(value[0], value[1] + 1)]
        else:
            return None
    return sorted(set(out)) if len(set(out)) <= MAX_CLASS else None


def _alternatives(node) -> list[str] | None:
    """All (lower-case) strings that a node can match, if they are few."""
    op, value = node
    if op is C.LITERAL:
        return [chr(value).lower()]
    if op is C.IN:
        return _class(value)
    if op is C.SUBPATTERN:
        return _sequence(value[3])
    if op is C.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        return None if any(p is None for p in parts) else [s for p in parts for s in p]
    if op is C.MAX_REPEAT and value[1] <= 3:
        one = _sequence(value[2])
        if one is None:
            return None
        out, level = [], [""]
        for k in range(int(value[1]) + 1):
            if k >= value[0]:
                out += level
            level = [a + b for a in level for b in one]
            if len(level) > MAX_STRINGS:
                return None
        return out
    return None


def _sequence(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        parts = _alternatives(node)
        if parts is None or len(out) * len(parts) > MAX_STRINGS:
            return None
        out = [a + b for a in out for b in parts]
    return out


def _walk(nodes, clauses: set[Clause]) -> None:
    strings = {""}
    for node in nodes:
        parts = _alternatives(node)
        if parts is not None and len(strings) * len(parts) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in parts}
            continue
        _close(strings, clauses)
        strings = {""}
        op, value = node
        if parts is not None:
            strings = set(parts)
        elif op is C.SUBPATTERN:
            _walk(value[3], clauses)
        elif op is C.MAX_REPEAT and value[0] >= 1:
            _walk(value[2], clauses)
        elif op is C.BRANCH:
            found = []
            for branch in value[1]:
                own: set[Clause] = set()
                _walk(branch, own)
                found.append(own)
            if all(found):  # one clause of each branch, as alternatives
                clauses.add(frozenset(x for own in found for x in min(own, key=lambda c: (len(c), sorted(map(sorted, c))))))
    _close(strings, clauses)


def trigram_query(pattern: str) -> list[Clause]:
    clauses: set[Clause] = set()
    _walk(_parser.parse(re.sub(r"\(\?i:", "(?:", pattern)), clauses)
    return sorted(clauses, key=lambda c: sorted(map(sorted, c)))
