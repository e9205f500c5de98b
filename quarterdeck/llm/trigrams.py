"""Boolean trigram queries of regular expressions.

``alternatives(pattern)`` gives a list of trigram sets such that every text in which the pattern
matches contains, in lower case, all trigrams of at least one of the sets. An empty set among them
means that the pattern has no mandatory trigram, so every text has to be scanned.

The pattern is read by Python's own parser. Stretches with few spellings are spelt out and give
their trigrams; what lies between (classes, long repetitions) gives none.
"""

from __future__ import annotations

from itertools import product

from re import _constants as code
from re import _parser as parser

SPELLINGS = 64  # more spellings of a stretch than this are not written out

Query = list[frozenset[str]]


def alternatives(pattern: str) -> Query:
    query: Query = [frozenset()]
    for stretch in _stretches(parser.parse(pattern)):
        query = _and(query, _least([_trigrams(s) for s in stretch]))
    return query


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _least(sets: Query) -> Query:
    """Without the sets that hold another one."""
    kept: Query = []
    for s in sorted(set(sets), key=lambda s: (len(s), sorted(s))):
        if not any(k <= s for k in kept):
            kept.append(s)
    return kept


def _and(a: Query, b: Query) -> Query:
    if len(a) * len(b) > SPELLINGS:
        return a  # a weaker condition is still a necessary one
    return _least([x | y for x, y in product(a, b)])


def _stretches(items) -> list[set[str]]:
    """Runs of the pattern that are spelt in few ways, as sets of lower-case spellings."""
    found: list[set[str]] = []
    now = {""}
    for item in items:
        spelt = _spellings(item)
        joined = spelt and {a + b for a, b in product(now, spelt)}
        if joined and len(joined) <= SPELLINGS:
            now = joined
            continue
        found.append(now)
        now = spelt if spelt and len(spelt) <= SPELLINGS else {""}
        if not spelt:
            found += _inside(item)
    return [s for s in [*found, now] if min(map(len, s)) >= 3]


def _spellings(item) -> set[str] | None:
    """All strings that the item can match, in lower case; None if they are too many."""
    kind, value = item
    if kind is code.LITERAL:
        return {chr(value).lower()}
    if kind is code.AT:
        return {""}
    if kind is code.IN and all(k is code.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is code.SUBPATTERN:
        return _of_sequence(value[-1])
    if kind is code.BRANCH:
        parts = [_of_sequence(branch) for branch in value[1]]
        return set().union(*parts) if all(parts) else None
    if kind in (code.MAX_REPEAT, code.MIN_REPEAT) and value[1] <= 3:
        one = _of_sequence(value[2])
        if one is None:
            return None
        out, power = set(), {""}
        for n in range(value[1] + 1):
            out |= power if n >= value[0] else set()
            power = {a + b for a, b in product(power, one)}
            if len(power) > SPELLINGS:
                return None
        return out
    return None


def _of_sequence(items) -> set[str] | None:
    now = {""}
    for item in items:
        spelt = _spellings(item)
        if spelt is None:
            return None
        now = {a + b for a, b in product(now, spelt)}
        if len(now) > SPELLINGS:
            return None
    return now


def _inside(item) -> list[set[str]]:
    """Stretches within a group or a repetition that has to occur."""
    kind, value = item
    if kind is code.SUBPATTERN:
        return _stretches(value[-1])
    if kind in (code.MAX_REPEAT, code.MIN_REPEAT) and value[0] >= 1:
        return _stretches(value[2])
    return []
