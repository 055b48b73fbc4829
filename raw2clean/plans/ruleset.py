"""Rule tables and the table-wide rules R16-R21.

``RuleSet.apply`` turns a whole rule table into ONE ``select``: Catalyst
collapses it with the scan's projection, prunes unread input columns from the
read schema, and runs every rule inside one generated function.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from raw2clean.functions.rules import Rule, numeric
from raw2clean.functions.sqltext import quoted


class MissingColumnsError(ValueError):
    pass


class RuleSet:
    """An ordered mapping of output column -> ``Rule``.

    Rules read input columns, never outputs of other rules: a tract code built
    from ``state_code`` reads the raw ``state_code``, as a SQL SELECT list does.
    """

    def __init__(self, rules: Mapping[str, Rule] | Iterable[tuple[str, Rule]], name: str = ""):
        items = list(rules.items()) if isinstance(rules, Mapping) else list(rules)
        names = [n for n, _ in items]
        dup = sorted({n for n in names if names.count(n) > 1})
        if dup:
            raise ValueError(f"output columns given twice: {dup}")
        self._rules = dict(items)
        self.name = name

    def __len__(self) -> int:
        return len(self._rules)

    def __iter__(self):
        return iter(self._rules)

    def __getitem__(self, k: str) -> Rule:
        return self._rules[k]

    def items(self):
        return self._rules.items()

    @property
    def outputs(self) -> list[str]:
        return list(self._rules)

    @property
    def inputs(self) -> list[str]:
        seen: dict[str, None] = {}
        for out, rule in self._rules.items():
            for c in rule.input_columns(out):
                seen.setdefault(c, None)
        return list(seen)

    def missing(self, df: DataFrame) -> list[str]:
        """Input columns the rules need that ``df`` lacks."""
        have = set(df.columns)
        return [c for c in self.inputs if c not in have]

    def columns(self, df: DataFrame | None = None, on_missing: str = "raise"):
        """The list of output ``Column`` expressions.

        ``on_missing``: ``"raise"`` (default), ``"null"`` (a missing input gives
        a NULL output column) or ``"skip"`` (the output column is left out).
        """
        missing = set(self.missing(df)) if df is not None else set()
        if missing and on_missing == "raise":
            raise MissingColumnsError(f"input columns missing: {sorted(missing)}")
        return [F.expr(e) if isinstance(e, str) else e for e in self._expressions(missing, on_missing)]

    def _expressions(self, missing: set[str], on_missing: str) -> list[str | Column]:
        out: list[str | Column] = []
        for name, rule in self._rules.items():
            if missing and missing & set(rule.input_columns(name)):
                if on_missing == "skip":
                    continue
                out.append(f"CAST(NULL AS STRING) AS {quoted(name)}")
            else:
                text = rule.sql(name)
                out.append(rule.column(name) if text is None else f"{text} AS {quoted(name)}")
        return out

    def apply(self, df: DataFrame, on_missing: str = "raise", keep: Iterable[str] = ()) -> DataFrame:
        """The rule table as one projection; unlisted columns are dropped
        unless named in ``keep`` (kept before the rule outputs).

        Rules go to Spark as SQL text, all in one call; only rules of one's own that build a ``Column`` are built one by one.
        """
        missing = set(self.missing(df))
        if missing and on_missing == "raise":
            raise MissingColumnsError(f"input columns missing: {sorted(missing)}")
        all_ = [quoted(c) for c in keep if c not in self._rules] + self._expressions(missing, on_missing)
        if all(isinstance(e, str) for e in all_):
            return df.selectExpr(*all_)
        return df.select(*[F.expr(e) if isinstance(e, str) else e for e in all_])

    def __repr__(self) -> str:
        return f"RuleSet({self.name!r}, {len(self)} columns)"


# Rules over every column (or a named set) of a table -----------

def cast_to_string(df: DataFrame) -> DataFrame:
    """Every column as text, in one projection."""
    return df.selectExpr(*[f"CAST({quoted(c)} AS STRING) AS {quoted(c)}" for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim blanks of every string column; other columns unchanged."""
    return df.selectExpr(*[
        f"trim({quoted(f.name)}) AS {quoted(f.name)}" if isinstance(f.dataType, StringType) else quoted(f.name)
        for f in df.schema.fields
    ])


def numeric_except(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Non-numbers become NULL in every column not in ``exclude``."""
    exclude = set(exclude)
    rule = numeric()
    return df.selectExpr(*[quoted(c) if c in exclude else f"{rule.sql(c)} AS {quoted(c)}" for c in df.columns])


def non_negative(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Values below zero (and non-numbers) become NULL in the named columns."""
    columns = list(columns)
    rule = numeric(low=0)
    return df.withColumns({c: rule(c) for c in columns}) if columns else df


def keep_one_column(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """One column, values outside ``allowed`` set to NULL."""
    from raw2clean.functions.rules import keep_codes
    return df.select(keep_codes(allowed).column(column))
