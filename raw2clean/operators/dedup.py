"""Duplicate removal: whole rows (G5), by key with a fixed survivor (G6) and
top rows per group (W1, W2).

Scale notes. All three are one shuffle on their keys. Each aggregates
partially before the shuffle (HashAggregate partial for ``distinct``; partial
``min(struct)`` for the key dedup; ``WindowGroupLimit`` for the top rows), so
a key that holds a third of all rows sends at most one row (or ``n`` rows)
per map partition across the network, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from raw2clean.functions.rules import as_column
from raw2clean.functions.sqltext import literal, quoted
from raw2clean.sources.io import work_dir

_SURVIVOR = "__survivor"
_KEY = "__key"
_HASH = "__hash"
_COUNT = "__rows"
_RANK = "__rank"
_LEAD = "__lead"
_BY = "__by"
_PACKED = "__packed"
_ODD = "__odd"
_CELLS = "__cells"

#: What stands between the cells of a packed row, and what for an empty text; a NULL is no sign at all.
_NEXT, _EMPTY = "\x01", "\x02"

#: Rows of a group beyond which ``top_n_per_group`` doesn't look for a bound first.
_MOST_FIRST = 1000


#: xxhash64 of a row of NULLs alone: its seed.
_HASH_OF_NULLS = 42


def distinct_rows(df: DataFrame, drop_all_null: bool = False, method: str = "rows", most_repeated: int = 500_000) -> DataFrame:
    """One row per distinct row.

    ``drop_all_null=True`` also drops the row in which every column is NULL
    (P1), after the aggregate: all such rows fall into one group. The filter
    reads the group's row count, so Catalyst keeps it above the aggregate
    instead of pushing it through the projection below, where it would
    evaluate every column expression (every cleaning rule) a second time.

    Methods, of equal result:

    * ``"rows"`` (default): one aggregate, which shuffles each row whole;
    * ``"hashes"``: for wide tables in which few rows repeat. A first pass shuffles a 64-bit hash of each row
      and stores those found more than once; rows of other hashes stay where they lie, and only those of repeated
      hashes are shuffled and compared whole, so equal hashes of different rows do no harm. ``df`` is
      evaluated three times and must give the same rows each time. Beyond ``most_repeated`` hashes (8 bytes each, sent to all tasks)
      the rows are shuffled as by ``"rows"``. The first pass runs when the function is called;
    * ``"packed"``: for wide tables of text. A row is shuffled as one text of its cells, without the 8 to 16 bytes
      and more that Spark's rows spend on each cell. Tables that hold other types are shuffled as by ``"rows"``.
    """
    if method not in ("rows", "hashes", "packed"):
        raise ValueError(f"unknown method {method!r}")
    cols = [quoted(c) for c in df.columns]
    if method == "packed" and cols and all(f.dataType == StringType() for f in df.schema.fields):
        return _distinct_packed(df, drop_all_null)
    if method == "hashes" and cols:
        hashed = df.selectExpr(*cols, f"xxhash64({', '.join(cols)}) AS {_HASH}")
        path = work_dir(df.sparkSession, "repeated-rows")
        hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_COUNT) > 1).select(_HASH).write.parquet(path)
        repeated = df.sparkSession.read.schema(f"{_HASH} long").parquet(path)
        if repeated.count() <= most_repeated:
            # a row of NULLs alone always goes to the aggregate, which knows whether to drop it
            few = F.broadcast(repeated.union(df.sparkSession.range(1).select(F.lit(_HASH_OF_NULLS).cast("long"))))
            once = hashed.join(few, _HASH, "left_anti").selectExpr(*cols)
            return once.unionByName(distinct_rows(hashed.join(few, _HASH, "left_semi").selectExpr(*cols), drop_all_null))
    if not drop_all_null:
        return df.distinct()
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_COUNT))
    return groups.where(" OR ".join([f"{c} IS NOT NULL" for c in cols] + [f"{_COUNT} < 0"])).selectExpr(*cols)


def _distinct_packed(df: DataFrame, drop_all_null: bool) -> DataFrame:
    """``distinct_rows`` of text columns, each row as one text. Rows of which a text can't be split again (a cell
    holds one of the two signs, or is no valid UTF-8) are kept as arrays beside it, so every row is compared whole."""
    cols, after, empty = [quoted(c) for c in df.columns], literal(_NEXT), literal(_EMPTY)
    cells = ", ".join(f"CASE WHEN {c} IS NULL THEN '' WHEN {c} = '' THEN {empty} ELSE {c} END" for c in cols)
    odd = f"contains({_CELLS}, {after}) OR contains({_CELLS}, {empty}) OR NOT is_valid_utf8({_PACKED})"
    rows = (df.selectExpr(*cols, f"concat_ws({after}, {cells}) AS {_PACKED}", f"concat_ws('', {', '.join(cols)}) AS {_CELLS}")
            .selectExpr(f"CASE WHEN {odd} THEN NULL ELSE {_PACKED} END AS {_PACKED}", f"CASE WHEN {odd} THEN array({', '.join(cols)}) END AS {_ODD}"))
    groups = rows.groupBy(_PACKED, _ODD).agg(F.count(F.lit(1)).alias(_COUNT))
    if drop_all_null:   # a row of NULLs alone is nothing but the signs between its cells
        groups = groups.where(f"{_PACKED} IS NULL OR {_PACKED} <> {literal(_NEXT * (len(cols) - 1))} OR {_COUNT} < 0")
    # cells depend on the count too: Catalyst would push a filter on them below the aggregate and into the packing of all rules
    split = groups.selectExpr(f"IF({_COUNT} > 0, {_PACKED}, NULL) AS {_PACKED}", f"IF({_COUNT} > 0, {_ODD}, NULL) AS {_ODD}").selectExpr(
        _PACKED, _ODD, f"split({_PACKED}, {after}) AS {_CELLS}")
    cell = f"CASE WHEN {_PACKED} IS NULL THEN {_ODD}[{{i}}] WHEN {_CELLS}[{{i}}] = '' THEN NULL WHEN {_CELLS}[{{i}}] = {empty} THEN '' ELSE {_CELLS}[{{i}}] END AS {{c}}"
    return split.selectExpr(*[cell.replace("{i}", str(i)).replace("{c}", c) for i, c in enumerate(cols)])


def dedup_by_key(df: DataFrame, keys: Iterable[str], order: Iterable[str] | None = None,
                 method: str = "min_struct", drop_all_null: bool = False) -> DataFrame:
    """One row per distinct key.

    The survivor is fixed: the row whose other columns (in ``order``, by
    default the table's column order) are smallest, NULLs first. Methods:

    * ``"min_struct"`` (default): ``groupBy(hash, struct(keys)).agg(min(struct(rest)))``,
      with a partial aggregate before the shuffle; its sorts compare the hash
      first, and all keys only where hashes are equal;
    * ``"row_number"``: ``row_number()`` over the same hash and struct, equal survivor (over
      dozens of single key columns Catalyst's constraint propagation would stall planning);
    * ``"any"``: ``dropDuplicates`` as the legacy job did; which row survives
      is not defined.
    ``drop_all_null=True`` first leaves out rows in which every column is NULL (P1): not by a
    filter, which Catalyst would push below a rule projection (every rule runs twice, and the constraints
    it derives from dozens of rules stall planning), but by ordering such rows last and dropping groups of nothing else.
    Output columns keep the input order.
    """
    keys = list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns missing: {missing}")
    if method == "any":
        return (df.dropna(how="all") if drop_all_null else df).dropDuplicates(keys)
    rest = [c for c in (list(order) if order is not None else df.columns) if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return distinct_rows(df.selectExpr(*[quoted(k) for k in keys]), drop_all_null).selectExpr(*[quoted(c) for c in df.columns])
    if method not in ("min_struct", "row_number"):
        raise ValueError(f"unknown method {method!r}")
    # struct field names are positional to stay clear of odd column names
    pack = lambda names: "named_struct(" + ", ".join(f"'f{i}', {quoted(c)}" for i, c in enumerate(names)) + ")"
    empty = "(" + " AND ".join(f"{quoted(c)} IS NULL" for c in df.columns) + ")" if drop_all_null else "false"
    packed = df.selectExpr(f"xxhash64({', '.join(quoted(k) for k in keys)}) AS {_HASH}", f"{pack(keys)} AS {_KEY}",
                           f"named_struct('empty', {empty}, 'row', {pack(rest)}) AS {_SURVIVOR}")
    if method == "min_struct":
        first = packed.groupBy(_HASH, _KEY).agg(F.min(_SURVIVOR).alias(_SURVIVOR))
    else:
        w = Window.partitionBy(_HASH, _KEY).orderBy(_SURVIVOR)
        first = packed.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1)
    if drop_all_null:
        first = first.where(f"NOT {_SURVIVOR}.empty")
    at = {c: f"{_KEY}.f{i}" for i, c in enumerate(keys)} | {c: f"{_SURVIVOR}.row.f{i}" for i, c in enumerate(rest)}
    return first.selectExpr(*[f"{at[c]} AS {quoted(c)}" for c in df.columns])


def _order_expr(c: str, null_as: str | None) -> Column:
    e = as_column(c).cast("string") if null_as is not None else as_column(c)
    if null_as is not None:
        e = F.coalesce(e, F.lit(str(null_as)))
    return e.asc_nulls_first()


def _leading(df: DataFrame, c: str, null_as: str | None) -> Column | None:
    """A long that never falls as the order of ``_order_expr`` rises, smallest for NULL; None for types without one."""
    kind, value = df.schema[c].dataType.simpleString(), as_column(c)
    if null_as is not None:
        kind, value = "string", F.coalesce(value.cast("string"), F.lit(str(null_as)))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        lead = value.cast("long")
    elif kind in ("date", "timestamp"):
        lead = F.unix_date(value).cast("long") if kind == "date" else F.unix_micros(value)
    elif kind == "string":   # in the order of bytes: the first seven are a number
        lead = F.conv(F.hex(F.rpad(F.substring(value.cast("binary"), 1, 7), 7, F.lit(b"\x00"))), 16, 10).cast("long")
    else:
        return None
    return F.coalesce(lead, F.lit(-1 << 63))


def _may_be_first(df: DataFrame, by: list[Column], lead: Column, n: int, most_groups: int) -> DataFrame:
    """The rows of ``df`` but for some that have ``n`` rows of their group before them."""
    spread = F.monotonically_increasing_id() % (2 * n) if n > 1 else F.lit(0)
    names = [f"{_BY}{i}" for i in range(len(by))]
    # rows are dealt to 2 n heaps of a group; the n smallest minima of heaps are n rows, so none behind the last of these comes first
    least = (df.select(*[b.alias(c) for b, c in zip(by, names, strict=True)], lead.alias(_LEAD), spread.alias(_HASH))
             .groupBy(*names, _HASH).agg(F.min(_LEAD).alias(_LEAD)))
    if n > 1:
        least = least.groupBy(*names).agg(F.try_element_at(F.sort_array(F.collect_list(_LEAD)), F.lit(n)).alias(_LEAD))
    else:
        least = least.drop(_HASH)
    path = work_dir(df.sparkSession, "last-of-first")
    least.write.parquet(path)
    last = df.sparkSession.read.schema(least.schema).parquet(path)
    if last.count() > most_groups:
        return df
    at = (lead <= F.col(_LEAD)) | F.col(_LEAD).isNull()
    for b, c in zip(by, names, strict=True):
        at = at & b.eqNullSafe(F.col(c))
    return df.join(F.broadcast(last), at, "left_semi")


def top_n_per_group(df: DataFrame, by: str | Iterable[str], order: Iterable[str] | None = None,
                    n: int = 1, null_as: str | None = None, most_groups: int = 100_000) -> DataFrame:
    """The first ``n`` rows of each group by ``row_number()``.

    ``order``: columns to sort by (W2: names absent from ``df`` are left out;
    by default all columns). ``null_as``: text a NULL sorts as (the legacy job
    sorted NULL as ``999999``); otherwise NULLs sort first.

    Catalyst plans ``WindowGroupLimit`` before the shuffle, so each map task
    ships at most ``n`` rows per group; but a task sorts all its rows for that, on disk where they are many. So a first pass,
    which runs when the function is called and reads the group and the first order column alone, finds for each group
    a value that at least ``n`` rows don't exceed, and rows beyond it aren't sorted. ``df`` is evaluated twice and must give the same rows each time.
    With more than ``most_groups`` groups (their values are sent to all tasks) all rows are sorted, and where
    the first column of a group has one value throughout.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [c for c in (list(order) if order is not None else df.columns) if c in df.columns]
    lead = _leading(df, order[0], null_as) if order and by and 0 < n <= _MOST_FIRST else None
    if lead is not None:
        df = _may_be_first(df, [as_column(b) for b in by], lead, n, most_groups)
    w = Window.partitionBy(*[as_column(b) for b in by]).orderBy(*[_order_expr(c, null_as) for c in order])
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) <= n).drop(_RANK)
