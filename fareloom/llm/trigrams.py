"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

import re._constants as K
import re._parser as parser

#: Strings that are followed side by side; a part with more is taken as "anything".
MOST = 64
#: A query in disjunctive form: one of the sets has to occur whole. [frozenset()] demands nothing.
Query = list[frozenset[str]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _least(query: Query) -> Query:
    """Without the sets that contain another one."""
    kept: Query = []
    for s in sorted(set(query), key=lambda s: (len(s), sorted(s))):
        if not any(k <= s for k in kept):
            kept.append(s)
    return kept


def _both(a: Query, b: Query) -> Query:
    return _least([x | y for x in a for y in b])


def _strings(op: object, arg: object) -> set[str] | None:
    """All strings that an element can stand for, in lower case; None if they are many or unbounded."""
    if op is K.LITERAL:
        return {chr(arg).lower()}
    if op is K.AT:
        return {""}
    if op is K.IN:
        out = set()
        for kind, what in arg:
            if kind is K.LITERAL:
                out.add(chr(what).lower())
            elif kind is K.RANGE and what[1] - what[0] < MOST:
                out |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is K.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is K.BRANCH:
        parts = [_sequence_strings(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[:2] == (0, 1):
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_strings(items: object) -> set[str] | None:
    run = {""}
    for op, arg in items:
        more = _strings(op, arg)
        if more is None or len(run) * len(more) > MOST:
            return None
        run = {a + b for a in run for b in more}
    return run


def _sequence(items: object) -> Query:
    query: Query = [frozenset()]
    run = {""}

    def demanded() -> Query:
        return _least([_trigrams(s) for s in run])

    for op, arg in items:
        more = _strings(op, arg)
        if more is not None and len(run) * len(more) <= MOST:
            run = {a + b for a in run for b in more}
            continue
        query, run = _both(query, demanded()), {""}
        if op is K.SUBPATTERN:
            query = _both(query, _sequence(arg[3]))
        elif op is K.BRANCH:
            query = _both(query, _least([s for p in arg[1] for s in _sequence(p)]))
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
            query = _both(query, _sequence(arg[2]))
        elif more is not None:
            run = more
    return _both(query, demanded())


def query(pattern: str) -> Query | None:
    """Sets of lower-case trigrams, one of which every match of ``pattern`` holds whole; None if there is none."""
    found = _sequence(parser.parse(pattern))
    return None if frozenset() in found else found
