"""Boolean trigram queries derived from regular expressions.

``derive(pattern)`` returns a query that every text with a match satisfies: a set of
alternatives, each a set of trigrams that must all occur in the ASCII lower-cased text.
``None`` means that nothing is mandatory and the rule has to scan every text.

The pattern is walked as a sequence. While the possible literal texts of a stretch are
few they are kept exactly (their cross product); when a stretch ends, each of its texts
contributes the conjunction of its trigrams and the stretch their disjunction. Queries
of successive stretches are conjoined, those of branches disjoined, and alternatives
that another one implies are dropped.
"""

from __future__ import annotations

import re
from re import _parser as rx

#: Literal texts kept exactly for one stretch, and alternatives kept in a query.
MAX_TEXTS = 64
MAX_ALTERNATIVES = 64

Query = frozenset  # of frozensets of trigrams; ANY is the one empty conjunction
ANY: Query = frozenset([frozenset()])


def derive(pattern: str) -> list[list[str]] | None:
    """Alternatives of mandatory trigrams, or ``None`` if nothing is mandatory."""
    tree = rx.parse(pattern)
    ignore = bool(tree.state.flags & re.IGNORECASE)
    query = _close(*_walk(list(tree), ignore))
    return None if query == ANY else sorted(sorted(c) for c in query)


def _absorb(q) -> Query:
    kept = frozenset(c for c in q if not any(o < c for o in q))
    return kept if len(kept) <= MAX_ALTERNATIVES else ANY


def _either(a: Query, b: Query) -> Query:
    return _absorb(a | b)


def _both(a: Query, b: Query) -> Query:
    return _absorb(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= 4096 else a


def _of_texts(texts: frozenset[str]) -> Query:
    return _absorb(frozenset(frozenset(t[i:i + 3] for i in range(len(t) - 2)) for t in texts))


def _close(texts: frozenset[str] | None, query: Query) -> Query:
    return query if texts is None else _both(query, _of_texts(texts))


def _lower(ch: int) -> str | None:
    """The lower-case form the index holds; a letter whose case folds outside ASCII is no literal."""
    return chr(ch + 32) if 65 <= ch <= 90 else chr(ch)


def _walk(items, ignore: bool) -> tuple[frozenset[str] | None, Query]:
    """(texts, query) of a sequence: texts is set while the whole sequence is exact."""
    run: frozenset[str] = frozenset([""])
    exact, query = True, ANY
    for op, arg in items:
        texts, inner = _node(op, arg, ignore)
        query = _both(query, inner)
        if texts is not None and len(run) * len(texts) <= MAX_TEXTS:
            run = frozenset(a + b for a in run for b in texts)
            continue
        query = _both(query, _of_texts(run))
        exact = False
        run = texts if texts is not None else frozenset([""])
    if exact:
        return run, query
    return None, _both(query, _of_texts(run))


def _node(op, arg, ignore: bool) -> tuple[frozenset[str] | None, Query]:
    name = str(op)
    if name == "LITERAL":
        # Case folding outside ASCII (K with the Kelvin sign) makes a letter uncertain.
        if ignore and chr(arg).isalpha() and (arg > 127 or chr(arg).lower() in "ks"):
            return None, ANY
        return frozenset([_lower(arg)]), ANY
    if name == "IN":
        chars: set[str] = set()
        for o, a in arg:
            if str(o) == "LITERAL" and not (ignore and chr(a).isalpha()):
                chars.add(_lower(a))
            elif str(o) == "RANGE" and not ignore and a[1] - a[0] < 8:
                chars.update(_lower(x) for x in range(a[0], a[1] + 1))
            else:
                return None, ANY
        return frozenset(chars), ANY
    if name == "SUBPATTERN":
        _, add, drop, body = arg
        inner = (ignore or bool(add & re.IGNORECASE)) and not drop & re.IGNORECASE
        return _walk(list(body), inner)
    if name == "BRANCH":
        parts = [_walk(list(b), ignore) for b in arg[1]]
        if all(t is not None for t, _ in parts):
            texts = frozenset().union(*[t for t, _ in parts])
            if len(texts) <= MAX_TEXTS:
                return texts, ANY
        query = _close(*parts[0])
        for p in parts[1:]:
            query = _either(query, _close(*p))
        return None, query
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = arg
        texts, query = _walk(list(body), ignore)
        if high == 1 and low == 0 and texts is not None:
            return texts | {""}, ANY
        if low == high == 1:
            return texts, query
        if low == high and texts is not None and len(texts) == 1 and high <= MAX_TEXTS:
            return frozenset([next(iter(texts)) * low]), query
        return None, (_close(texts, query) if low >= 1 else ANY)
    if name == "AT":
        return frozenset([""]), ANY
    return None, ANY
