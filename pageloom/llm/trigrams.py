"""Boolean trigram queries that every match of a regular expression satisfies.

A query is True (nothing is known), a trigram, or ("and" | "or", parts). It is derived
bottom-up from the parsed expression: a node has either a small set of the exact strings it
can match, or a query. Strings grow across a sequence until a node without such a set ends
them; each of them then asks for all of its trigrams. Case is folded.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from re import _constants as N
from re import _parser as P

from pyspark.sql import Column
from pyspark.sql import functions as F

Query = bool | str | tuple
# More exact strings than this are not followed further.
MOST_STRINGS = 64


def _join(kind: str, parts: list[Query]) -> Query:
    neutral = kind == "and"
    if kind == "or" and any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(p for p in parts if p is not neutral))
    return neutral if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _asked(strings: set[str]) -> Query:
    each = {frozenset(s[i : i + 3] for i in range(len(s) - 2)): s for s in sorted(strings)}
    # Who asks for more than another alternative adds nothing.
    least = [s for grams, s in each.items() if not any(other < grams for other in each)]
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in least])


def _sequence(items) -> tuple[set[str] | None, Query]:
    strings, found, exact = {""}, [], True
    for op, arg in items:
        own, query = _node(op, arg)
        found.append(query)
        if own is not None and len(strings) * len(own) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in own}
        else:
            found.append(_asked(strings))
            strings, exact = (own or {""}), False
    if exact:
        return strings, True
    return None, _join("and", [*found, _asked(strings)])


def _node(op, arg) -> tuple[set[str] | None, Query]:
    if op is N.LITERAL:
        return {chr(arg).lower()}, True
    if op is N.AT:
        return {""}, True
    if op is N.IN and len(arg) <= 4 and all(k is N.LITERAL for k, _ in arg):
        return {chr(c).lower() for _, c in arg}, True
    if op is N.SUBPATTERN:
        return _sequence(arg[-1])
    if op is N.BRANCH:
        branches = [_sequence(b) for b in arg[1]]
        if all(s is not None for s, _ in branches) and sum(len(s) for s, _ in branches) <= MOST_STRINGS:
            return set().union(*(s for s, _ in branches)), True
        return None, _join("or", [q if s is None else _asked(s) for s, q in branches])
    if op in (N.MAX_REPEAT, N.MIN_REPEAT, N.POSSESSIVE_REPEAT):
        least, most, item = arg
        own, query = _sequence(item)
        if own is not None and most == 1:
            return own | ({""} if least == 0 else set()), True
        if least == 0:
            return None, True
        return None, query if own is None else _asked(own)
    return None, True


def trigram_query(pattern: str) -> Query:
    strings, query = _sequence(P.parse(pattern, re.ASCII))
    return query if strings is None else _asked(strings)


def grams_of(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*(grams_of(p) for p in query[1]))


def evaluate(query: Query, has: Callable[[str], Column]) -> Column:
    """The query over posting bitmaps: `has` gives the one of a trigram."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return has(query)
    first, *rest = [evaluate(p, has) for p in query[1]]
    for other in rest:
        first = first & other if query[0] == "and" else first | other
    return first
