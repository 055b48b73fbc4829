"""Expressions as SQL text.

A wide rule table is hundreds of expressions, and each call on a ``Column`` is a call
into the JVM; Spark parses the same expressions from text in one call. ``Sql``
has those methods of ``Column`` that rules use, and the functions below take a
``Column`` or an ``Sql`` and return the same kind, so a rule is written once
and can be rendered as either. Texts mean the same with every parser setting: what holds a
quote or a backslash is written by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's plain name, whatever signs it holds, as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | float | bool | None) -> str:
    """A constant as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if any(c in value for c in "'\\\"") or not value.isprintable():
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    return f"'{value}'"


@dataclass(frozen=True, eq=False)
class Sql:
    """A piece of SQL that stands for a column."""

    text: str

    @staticmethod
    def name(column: str) -> Sql:
        return Sql(quoted(column))

    def _with(self, op: str, other: Sql | str | float | bool) -> Sql:
        return Sql(f"({self.text} {op} {sql(other).text})")

    def __and__(self, other: Sql) -> Sql:
        return self._with("AND", other)

    def __or__(self, other: Sql) -> Sql:
        return self._with("OR", other)

    def __invert__(self) -> Sql:
        return Sql(f"(NOT {self.text})")

    def __ge__(self, other: Sql | float) -> Sql:
        return self._with(">=", other)

    def __le__(self, other: Sql | float) -> Sql:
        return self._with("<=", other)

    def __eq__(self, other: Sql | str | float) -> Sql:     # type: ignore[override]
        return self._with("=", other)

    def isNull(self) -> Sql:  # noqa: N802
        return Sql(f"({self.text} IS NULL)")

    def isNotNull(self) -> Sql:  # noqa: N802
        return Sql(f"({self.text} IS NOT NULL)")

    def isin(self, values: Iterable[str | int]) -> Sql:
        return Sql(f"({self.text} IN ({', '.join(literal(v) for v in values)}))")

    def rlike(self, pattern: str) -> Sql:
        return self._with("RLIKE", pattern)

    def like(self, pattern: str) -> Sql:
        return self._with("LIKE", pattern)

    def contains(self, part: str) -> Sql:
        return Sql(f"contains({self.text}, {literal(part)})")

    def cast(self, kind: str) -> Sql:
        return Sql(f"CAST({self.text} AS {kind})")

    def try_cast(self, kind: str) -> Sql:
        return Sql(f"TRY_CAST({self.text} AS {kind})")


class Case(Sql):
    """CASE ... END, to which further branches can be added."""

    def when(self, condition: Sql, value: Sql | str) -> Case:
        return Case(f"{self.text[:-4]} WHEN {condition.text} THEN {sql(value).text} END")

    def otherwise(self, value: Sql | str) -> Sql:
        return Sql(f"{self.text[:-4]} ELSE {sql(value).text} END")


Expression = Column | Sql


def sql(value: Sql | str | float | bool | None) -> Sql:
    return value if isinstance(value, Sql) else Sql(literal(value))


def same(like: Expression, value: str | float | bool | None) -> Expression:
    """A constant of the kind of ``like``."""
    return sql(value) if isinstance(like, Sql) else F.lit(value)


def when(condition: Expression, value: Expression | str) -> Case | Column:
    return Case(f"CASE WHEN {condition.text} THEN {sql(value).text} END") if isinstance(condition, Sql) else F.when(condition, value)


def _call(name: str, first: Expression, *rest: Expression | str | int) -> Expression:
    if isinstance(first, Sql):
        return Sql(f"{name}({', '.join(sql(x).text for x in (first, *rest))})")
    return F.call_function(name, first, *[x if isinstance(x, Column) else F.lit(x) for x in rest])


def length(s: Expression) -> Expression:
    return _call("length", s)


def lower(s: Expression) -> Expression:
    return _call("lower", s)


def trim(s: Expression) -> Expression:
    return _call("trim", s)


def strip_left(s: Expression, sign: str) -> Expression:
    return _call("ltrim", same(s, sign), s)


def strip_right(s: Expression, sign: str) -> Expression:
    return _call("rtrim", same(s, sign), s)


def pad_left(s: Expression, width: int, sign: str) -> Expression:
    return _call("lpad", s, width, sign)


def pad_right(s: Expression, width: int, sign: str) -> Expression:
    return _call("rpad", s, width, sign)


def part_before(s: Expression, sign: str, count: int) -> Expression:
    return _call("substring_index", s, sign, count)


def concat(first: Expression, *rest: Expression) -> Expression:
    return _call("concat", first, *rest)
