"""Ordered text classification: the first arm whose test holds names the group.

A :class:`Ladder` is data.  It becomes one Spark ``CASE`` column that stays inside whole-stage
codegen; ``%word%`` tests are turned into ``contains`` by the optimizer.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Names:
    """Exact, case-sensitive membership."""

    values: tuple[str, ...]


@dataclass(frozen=True)
class Except:
    """A wildcard pattern that holds unless another one does."""

    pattern: str
    unless: str


Test = str | Names | Except


def _literal(value: str | None) -> str:
    """A string literal; one parsed CASE text per ladder is far cheaper to build than its tree."""
    if value is None:
        return "CAST(NULL AS STRING)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Ladder:
    """``arms`` are tried in order; a NULL input takes ``if_null``, a leftover ``otherwise``."""

    arms: tuple[tuple[str, tuple[Test, ...]], ...]
    if_null: str | None = None
    otherwise: str | None = None
    case_sensitive: bool = field(default=False, kw_only=True)

    def column(self, text: str, folded: str | None = None) -> Column:
        """The group of the text column named ``text``.

        ``folded`` names a column that holds ``lower(text)``: folding once per row instead of once
        per pattern is most of the cost of a long ladder.
        """
        if self.case_sensitive:
            folded = text
        folded = folded or f"lower({text})"
        arms = [f"WHEN {text} IS NULL THEN {_literal(self.if_null)}"]
        for label, tests in self.arms:
            hit = " OR ".join(self._holds(t, text, folded) for t in tests)
            arms.append(f"WHEN {hit} THEN {_literal(label)}")
        return F.expr(f"CASE {' '.join(arms)} ELSE {_literal(self.otherwise)} END")

    def _holds(self, test: Test, text: str, folded: str) -> str:
        if isinstance(test, Names):
            return f"{text} IN ({', '.join(map(_literal, test.values))})"
        if isinstance(test, Except):
            wanted, unless = self._fold(test.pattern), self._fold(test.unless)
            return f"({folded} LIKE {wanted} AND {folded} NOT LIKE {unless})"
        return f"{folded} LIKE {self._fold(test)}"

    def _fold(self, pattern: str) -> str:
        return _literal(pattern if self.case_sensitive else pattern.lower())

    def labels(self) -> list[str | None]:
        """Every value the column can take."""
        found = [label for label, _ in self.arms] + [self.if_null, self.otherwise]
        return list(dict.fromkeys(found))


def ilike_any(text: Column, *patterns: str) -> Column:
    """Case-insensitive match of any wildcard pattern."""
    return reduce(Column.__or__, [text.ilike(p) for p in patterns])


def like_any(text: Column, *patterns: str) -> Column:
    """Case-sensitive match of any wildcard pattern."""
    return reduce(Column.__or__, [text.like(p) for p in patterns])


def not_ilike(text: Column, pattern: str) -> Column:
    """True when the case-insensitive pattern does not match; NULL stays NULL."""
    return ~text.ilike(pattern)
