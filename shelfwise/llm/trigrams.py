"""Boolean trigram queries that every text matched by a regular expression satisfies."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser

MOST_STRINGS = 64
MOST_CHOICES = 8

Clause = frozenset  # of alternatives, each a frozenset of trigrams that all occur


@dataclass(frozen=True)
class Query:
    """All clauses hold; a clause holds if all trigrams of one of its alternatives occur."""

    clauses: frozenset

    @property
    def trigrams(self) -> list[str]:
        return sorted({t for clause in self.clauses for alternative in clause for t in alternative})


def _clause(strings: set[str]) -> frozenset[Clause]:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:  # a string too short to ask for anything
        return frozenset()
    return frozenset([frozenset(s for s in sets if not any(other < s for other in sets))])


def _walk(items) -> tuple[set[str] | None, frozenset[Clause]]:
    """The strings an expression can match, if they are few, and its clauses."""
    exact: set[str] = {""}
    clauses: frozenset[Clause] = frozenset()
    whole = True
    for kind, value in items:
        part, more = _item(kind, value)
        clauses |= more
        if part is not None and len(exact) * len(part) <= MOST_STRINGS:
            exact = {a + b for a, b in product(exact, part)}
            continue
        whole = False
        clauses |= _clause(exact)
        exact = part or {""}
    return (exact, clauses) if whole else (None, clauses | _clause(exact))


def _item(kind, value) -> tuple[set[str] | None, frozenset[Clause]]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, frozenset()
    if kind is op.IN:
        chars = {chr(v).lower() for k, v in value if k is op.LITERAL}
        return (chars if all(k is op.LITERAL for k, _ in value) and len(chars) <= MOST_CHOICES else None), frozenset()
    if kind is op.SUBPATTERN:
        return _walk(value[3])
    if kind is op.BRANCH:
        found = [_walk(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in found):
            return set().union(*[exact for exact, _ in found]), frozenset()
        # each branch is asked for by one clause of its own, if it has any
        chosen = [min(clauses | _clause(exact or {""}), key=len, default=None) for exact, clauses in found]
        return None, frozenset() if None in chosen else frozenset([frozenset().union(*chosen)])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        exact, clauses = _walk(inner)
        if (least, most) == (0, 1):
            return (None if exact is None else exact | {""}), frozenset()
        if least == 0:
            return None, frozenset()
        if least == most and exact is not None and len(exact) ** least <= MOST_STRINGS:
            return {"".join(p) for p in product(exact, repeat=least)}, clauses
        return None, clauses | _clause(exact or {""})
    return None, frozenset()


def trigram_query(pattern: str) -> Query:
    """The query of lower-cased trigrams; without clauses, any text may match."""
    exact, clauses = _walk(_parser.parse(pattern))
    return Query(clauses | _clause(exact or {""}))
