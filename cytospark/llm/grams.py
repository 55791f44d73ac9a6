"""Boolean trigram queries derived from regular expressions.

A query is in disjunctive form: a set of clauses, each a set of trigrams. A text
can match the expression only if it holds all trigrams of some clause. ``None``
means that the expression has no mandatory trigram: every text is a candidate.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser

Query = frozenset | None

#: Alternatives of a piece of text beyond which it counts as unknown.
MOST_TEXTS = 64
#: Characters of a class that are still spelled out.
MOST_CHARACTERS = 8


def _clause(texts: set[str]) -> Query:
    """Clauses of 'one of these texts occurs'; unknown if one is too short."""
    if not texts or any(len(t) < 3 for t in texts):
        return None
    return frozenset(frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts)


def _simpler(clauses: frozenset) -> frozenset:
    """Without clauses that hold all of another's trigrams."""
    return frozenset(c for c in clauses if not any(other < c for other in clauses))


def both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MOST_TEXTS:
        return min(a, b, key=len)
    return _simpler(frozenset(x | y for x in a for y in b))


def either(queries: list[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    return _simpler(frozenset(c for q in queries for c in q))


def _characters(items: list) -> set[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MOST_CHARACTERS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CHARACTERS else None


def _sequence(parts) -> tuple[set[str] | None, Query]:
    """(all texts that the parts can match, if few; else None) and their query."""
    run: set[str] = {""}      # texts of the parts read since the last unknown one
    whole, query = True, None
    for part in parts:
        texts, inner = _part(part)
        if texts is not None and len(run) * len(texts) <= MOST_TEXTS:
            run = {a + b for a in run for b in texts}
            continue
        whole = False
        query = both(query, _clause(run))
        query = both(query, inner if texts is None else None)
        run = {""} if texts is None else texts
    return (run if whole else None), both(query, _clause(run))


def _part(part) -> tuple[set[str] | None, Query]:
    kind, value = part
    if kind is op.LITERAL:
        return {chr(value).lower()}, None
    if kind is op.IN:
        return _characters(value), None
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        found = [_sequence(p) for p in value[1]]
        texts = None
        if all(t is not None for t, _ in found):
            texts = set().union(*(t for t, _ in found))
        if texts is not None and len(texts) <= MOST_TEXTS:
            return texts, _clause(texts)
        return None, either([q if t is None else _clause(t) for t, q in found])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        texts, query = _sequence(inner)
        if texts is not None and most is not op.MAXREPEAT and len(texts) ** int(most) <= MOST_TEXTS and most <= 8:
            out, power = ({""} if least == 0 else set()), {""}
            for n in range(1, int(most) + 1):
                power = {a + b for a in power for b in texts}
                if n >= least:
                    out |= power
            return out, None
        if least == 0:
            return None, None
        if texts is not None:
            power = {""}
            for _ in range(int(least)):
                if len(power) * len(texts) > MOST_TEXTS:
                    break
                power = {a + b for a in power for b in texts}
            return None, _clause(power)
        return None, query
    if kind is op.AT:
        return {""}, None
    return None, None


def trigram_query(pattern: str) -> Query:
    """The query of an expression, over lower-cased text (so case never excludes a text)."""
    texts, query = _sequence(parser.parse(pattern, re.ASCII))
    return _simpler(query) if query else query


def holds(query: Query, text: str) -> bool:
    """Whether a text is a candidate; for tests."""
    low = text.lower()
    return query is None or any(all(g in low for g in clause) for clause in query)
