"""Column rules: each keeps a value or turns it into NULL.

A rule is a small value object. ``RuleSet`` (see ``raw2clean.plans.ruleset``)
maps output column names to rules and applies them all in one ``select``.
A rule can also be used on its own: ``keep_codes(["1", "2"])("loan_type")``
returns a ``Column``.

Every rule is a built-in Spark expression (no UDF), so the whole rule table
compiles into one whole-stage-codegen projection. Rules compare text with
text and parse numbers with ``try_cast``, so results are the same with
``spark.sql.ansi.enabled`` on or off: bad input becomes NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column
from pyspark.sql import functions as F

from raw2clean.functions import sqltext as S
from raw2clean.functions.sqltext import Expression, Sql, quoted

ColumnLike = str | Column | Sql


def as_column(c: ColumnLike) -> Expression:
    """A column by its plain name, whatever signs it holds, or the expression itself."""
    if isinstance(c, (Column, Sql)):
        return c
    return F.col(quoted(c))


def text(c: ColumnLike) -> Expression:
    """The column as text; a no-op on string columns."""
    return as_column(c).cast("string")


# Text that Spark's cast to double can read starts, after blanks and control
# characters and an optional sign, with a digit, a point, "inf" or "nan" (any
# case). Text that does not is not a number: it skips the cast, which would
# raise and catch a Java exception inside the JVM for every such value.
MAYBE_NUMBER = r"^[\x00-\x20]*[+-]?([0-9.]|[Ii][Nn][Ff]|[Nn][Aa][Nn])"


def number(c: ColumnLike) -> Expression:
    """The column parsed as a double, NULL where it is not a number."""
    s = text(c)
    return S.when(s.rlike(MAYBE_NUMBER), s.try_cast("double"))


@dataclass(frozen=True)
class Rule:
    """A named keep-or-NULL expression over one or more input columns.

    ``inputs`` is empty when the rule reads the column it writes; otherwise
    it names the input columns (for instance the three parts of a tract code).
    """

    kind: str
    build: Callable[..., Expression] = field(compare=False, repr=False)
    inputs: tuple[str, ...] = ()
    args: tuple = ()

    def __call__(self, *columns: ColumnLike) -> Column:
        if all(isinstance(c, str) for c in columns) and (rendered := self._render(columns)) is not None:
            return F.expr(rendered)
        return self.build(*columns)

    def input_columns(self, output: str) -> tuple[str, ...]:
        return self.inputs or (output,)

    def _render(self, columns: Iterable[str]) -> str | None:
        try:
            out = self.build(*[Sql.name(c) for c in columns])
        except (TypeError, AttributeError, PySparkException):   # a rule of one's own that only knows Columns
            return None
        return out.text if isinstance(out, Sql) else None

    def sql(self, output: str) -> str | None:
        """The expression for output column ``output`` as SQL text; None where the rule is a ``Column`` only."""
        return self._render(self.input_columns(output))

    def column(self, output: str) -> Column:
        """The expression for output column ``output``, aliased to it."""
        return self(*self.input_columns(output)).alias(output)


def _keep_if(cond: Expression, value: Expression) -> Expression:
    # CASE WHEN cond THEN value ELSE NULL END: a NULL condition gives NULL.
    return S.when(cond, value)


def _in(s: Expression, values: Iterable[str]) -> Expression:
    values = [str(v) for v in values]
    return s.isin(values) if values else S.same(s, False)


# R1 ---------------------------------------------------------------------

def passthrough() -> Rule:
    """Keep the column as it is."""
    return Rule("passthrough", lambda c: as_column(c))


# R2 ---------------------------------------------------------------------

def keep_codes(values: Iterable[str], ignore_case: bool = False) -> Rule:
    """R2: keep values found in a list of codes or labels."""
    values = tuple(str(v) for v in values)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        if ignore_case:
            return _keep_if(S.lower(s).isin([v.lower() for v in values]), as_column(c))
        return _keep_if(_in(s, values), as_column(c))

    return Rule("keep_codes", build, args=(values, ignore_case))


# R3 ---------------------------------------------------------------------

def keep_and_relabel(values: Iterable[str], relabel: Mapping[str, str]) -> Rule:
    """Keep listed labels, replace each label in ``relabel`` by its new text."""
    values = tuple(str(v) for v in values)
    relabel = dict(relabel)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        out = S.when(_in(s, values), s)
        for old, new in relabel.items():
            out = out.when(s == S.same(s, old), S.same(s, new))
        return out

    return Rule("keep_and_relabel", build, args=(values, tuple(relabel.items())))


# R4, R5 -----------------------------------------------------------------

NO_DIGITS = "^[^0-9]+$"
DIGITS = "^[0-9]+$"


def text_without_digits() -> Rule:
    """Keep text that holds no digit."""
    return Rule("text_without_digits",
                lambda c: _keep_if(text(c).rlike(NO_DIGITS), as_column(c)))


def digits(sentinels: Iterable[str] = ()) -> Rule:
    """Keep text of digits only, or one of the sentinel values."""
    sentinels = tuple(sentinels)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        return _keep_if(s.rlike(DIGITS) | _in(s, sentinels), as_column(c))

    return Rule("digits", build, args=(sentinels,))


# R6-R10 -----------------------------------------------------------------

def numeric(low: float | None = None, high: float | None = None,
            sentinels: Iterable[str] = ()) -> Rule:
    """Keep numbers, optionally within ``low <= x <= high``, or sentinels.

    R6 ``numeric()``, R7 ``numeric(low=0)``, R8 ``numeric(sentinels=...)``,
    R9 ``numeric(low=0, sentinels=...)``, R10 ``numeric(high=100)``.
    """
    sentinels = tuple(sentinels)

    def build(c: ColumnLike) -> Expression:
        d = number(c)
        cond = d.isNotNull()
        if low is not None:
            cond = cond & (d >= S.same(d, float(low)))
        if high is not None:
            cond = cond & (d <= S.same(d, float(high)))
        if sentinels:
            cond = cond | _in(text(c), sentinels)
        return _keep_if(cond, as_column(c))

    return Rule("numeric", build, args=(low, high, sentinels))


# R11 --------------------------------------------------------------------

WHOLE_NUMBER = r"^[+-]?[0-9]+([.][0-9]*)?$"


def integer_text(lengths: Iterable[int]) -> Rule:
    """Keep whole numbers whose text has one of the given lengths.

    A fractional part is cut before the check, as a legacy (non-ANSI) cast
    to bigint does: ``'12.7'`` counts as a whole number. Blanks around the
    text are allowed; the whole part must fit a bigint.
    """
    lengths = tuple(int(n) for n in lengths)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        t = S.trim(s)
        whole = t.rlike(WHOLE_NUMBER) & S.part_before(t, ".", 1).try_cast("bigint").isNotNull()
        return _keep_if(S.length(s).isin(list(lengths)) & whole, as_column(c))

    return Rule("integer_text", build, args=(lengths,))


# R12, R12b --------------------------------------------------------------

def text_length(min_length: int | None = None, exact: int | None = None,
                sentinels: Iterable[str] = (), charset: str | None = None,
                like: str | None = None, not_like: str | None = None) -> Rule:
    """Keep text by length; optionally only characters of ``charset``.

    ``like`` / ``not_like`` add a SQL LIKE test on the text as given. Spark's
    LIKE has no bracket classes, so ``not_like='%[^A-Za-z]%'`` only rejects
    text that holds those nine characters literally.
    """
    sentinels = tuple(sentinels)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        n = S.length(s)
        cond = S.same(s, True)
        if min_length is not None:
            cond = cond & (n >= min_length)
        if exact is not None:
            cond = cond & (n == exact)
        if charset is not None:
            cond = cond & s.rlike(f"^[{charset}]+$")
        if like is not None:
            cond = cond & s.like(like)
        if not_like is not None:
            cond = cond & ~s.like(not_like)
        if sentinels:
            cond = cond | _in(s, sentinels)
        return _keep_if(cond, as_column(c))

    return Rule("text_length", build, args=(min_length, exact, sentinels, charset, like, not_like))


# R13 --------------------------------------------------------------------

RANGE = "^[0-9]+-[0-9]+$"


def range_or_number(sentinels: Iterable[str] = (), exclude: Iterable[str] = ()) -> Rule:
    """Keep a range ``n-m``, a number or a sentinel, unless excluded."""
    sentinels, exclude = tuple(sentinels), tuple(exclude)

    def build(c: ColumnLike) -> Expression:
        s = text(c)
        cond = s.rlike(RANGE) | number(c).isNotNull()
        if sentinels:
            cond = cond | _in(s, sentinels)
        if exclude:
            cond = cond & ~_in(s, exclude)
        return _keep_if(cond, as_column(c))

    return Rule("range_or_number", build, args=(sentinels, exclude))


# R14 --------------------------------------------------------------------

DECIMAL = "^[0-9]+([.][0-9]*)?$"


def _padded(s: Expression, width: int) -> Expression:
    """Zeros before text up to ``width``; longer text gives NULL instead of losing its end."""
    return S.when(S.length(s) <= width, S.pad_left(s, width, "0"))


def tract_code(state: str, county: str, tract: str, style: str = "fixed2") -> Rule:
    """An 11-character tract code: state (2) + county (3) + tract (6).

    NULL if any part is NULL. Styles for the tract part:

    * ``"fixed2"`` (default): the tract is a number of at most 4 digits with at
      most 2 decimals (further zeros at either end don't count), written as
      4 + 2 digits: ``1234.01`` -> ``123401``, ``9.1`` -> ``000910``. Text
      without a point is such a number too if it has up to 4 digits
      (``1234`` -> ``123400``, the code of ``1234.00``); 5 or 6 digits are the
      code itself (``12345`` -> ``012345``, its leading zero lost). Whatever
      doesn't fit, a state of more than 2 or a county of more than 3
      characters too, gives NULL: nothing is cut, so no two tracts share a code.
    * ``"truncate"``: the legacy result, in which the fraction is lost:
      text with a point becomes its whole part (``1234.01`` -> ``001234``),
      other text is padded as it is (``NA`` -> ``0000NA``); ``lpad`` cuts
      text longer than its width, in both engines.
    """
    if style not in ("fixed2", "truncate"):
        raise ValueError(f"unknown tract style {style!r}")

    def build(st: ColumnLike, co: ColumnLike, tr: ColumnLike) -> Expression:
        s, c, t = text(st), text(co), text(tr)
        has_point = t.contains(".")
        if style == "truncate":
            part = S.when(has_point, number(t).try_cast("bigint").cast("string")).otherwise(t)
            code = S.concat(S.pad_left(s, 2, "0"), S.pad_left(c, 3, "0"), S.pad_left(part, 6, "0"))
            return S.when(~(s.isNull() | c.isNull() | t.isNull()), code)
        whole = S.strip_left(S.part_before(t, ".", 1), "0")
        decimals = S.when(has_point, S.strip_right(S.part_before(t, ".", -1), "0")).otherwise(S.same(t, ""))
        number_code = S.when(S.length(decimals) <= 2, S.concat(_padded(whole, 4), S.pad_right(decimals, 2, "0")))
        part = S.when(t.rlike(DECIMAL), S.when(has_point | (S.length(t) <= 4), number_code).otherwise(_padded(t, 6)))
        return S.concat(_padded(s, 2), _padded(c, 3), part)

    return Rule("tract_code", build, inputs=(state, county, tract), args=(style,))
