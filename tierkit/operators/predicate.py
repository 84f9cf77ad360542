"""Merge predicates: what a condition text says about keys.

Spark's own parser reads the text, so quotes, parentheses, ``BETWEEN`` and
``CASE`` are what SQL says they are.  Only conjuncts at the top of the parsed
expression are taken apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession

# The aliases a merge predicate uses for the two sides.
SOURCE_ALIAS = "source"
TARGET_ALIAS = "target"


class KeyPair(NamedTuple):
    target: str
    source: str
    null_safe: bool


class MergePredicate(NamedTuple):
    """Key pairs; the whole condition if it says more than that, else ``None``;
    and the target columns that the condition reads."""

    keys: list[KeyPair]
    condition: str | None
    target_columns: list[str]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _children(node) -> Iterator:
    below = node.children()
    return (below.apply(i) for i in range(below.size()))


def _conjuncts(node) -> Iterator:
    if _kind(node) == "And":
        for child in _children(node):
            yield from _conjuncts(child)
    else:
        yield node


def _attributes(node) -> Iterator[list[str]]:
    if _kind(node) == "UnresolvedAttribute":
        parts = node.nameParts()
        yield [parts.apply(i) for i in range(parts.size())]
    for child in _children(node):
        yield from _attributes(child)


def _key(node) -> KeyPair | None:
    """The pair of an equality between one column of either side."""
    if _kind(node) not in ("EqualTo", "EqualNullSafe"):
        return None
    sides = {}
    for child in _children(node):
        names = list(_attributes(child)) if _kind(child) == "UnresolvedAttribute" else []
        if len(names) != 1 or len(names[0]) != 2:
            return None
        sides[names[0][0].lower()] = names[0][1]
    if set(sides) != {SOURCE_ALIAS, TARGET_ALIAS}:
        return None
    return KeyPair(sides[TARGET_ALIAS], sides[SOURCE_ALIAS], _kind(node) == "EqualNullSafe")


def parse_predicate(spark: SparkSession, predicate: str | Sequence[str] | Sequence[tuple[str, str]]) -> MergePredicate:
    """What a merge predicate asks for.

    A text is any SQL condition whose top conjuncts hold at least one
    ``target.a = source.b`` (or ``<=>``); a list holds column names present on
    both sides, or ``(target, source)`` name pairs.  A condition without such an
    equality is refused: it would compare every source row with every target row.
    """
    if not isinstance(predicate, str):
        pairs = [KeyPair(*((p, p) if isinstance(p, str) else p), False) for p in predicate]
        if not pairs:
            raise ValueError("a merge needs at least one key")
        return MergePredicate(pairs, None, [k.target for k in pairs])
    if not predicate.strip():
        raise ValueError("a merge needs at least one key")
    tree = spark._jsparkSession.sessionState().sqlParser().parseExpression(predicate)
    terms = list(_conjuncts(tree))
    keys = [k for k in map(_key, terms) if k is not None]
    if not keys:
        raise ValueError(
            f"unsupported merge predicate {predicate!r}: among its terms joined by AND it needs an equality "
            f"'{TARGET_ALIAS}.col = {SOURCE_ALIAS}.col' (or <=>)"
        )
    if len(keys) == len(terms):
        return MergePredicate(keys, None, [k.target for k in keys])
    # A name without a side may be the target's.
    read = [n[1] if n[0].lower() == TARGET_ALIAS and len(n) > 1 else n[0] for n in _attributes(tree) if n[0].lower() != SOURCE_ALIAS]
    return MergePredicate(keys, predicate, list(dict.fromkeys(read)))
