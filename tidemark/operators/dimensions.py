"""Slowly changing dimensions, merges, surrogate keys and derived dimensions.

A staging table is first reduced to one row per key. That grouping combines copies before its
shuffle, so a key with very many staged rows does no harm, and the join after it uses the same
partitioning. Keys are compared with plain equality: a NULL key never matches, so staged rows
with a NULL key are rejected (``rejected_rows``) and change nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.dates import moment
from tidemark.functions.text import email_first_name, email_last_name, initial_capital
from tidemark.functions.values import quoted, row_hash
from tidemark.operators.windows import number_rows
from tidemark.session import cut

KEEP, CLOSE, INSERT = "keep", "close", "insert"

# Load types of a control table.
SCD1, SCD2 = "SCD1", "SCD2"
# Fixed values end.


def _has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys])


def rejected_rows(stg: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows that no load takes: a part of their key is NULL."""
    return stg.filter(~_has_key(keys))


def one_per_key(stg: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One staged row per key: the last by ``order``, or the only one.

    Without an order, exact copies are merged and different rows for one key are an error. Rows with
    a NULL key are left out.
    """
    stg = stg.filter(_has_key(keys))
    rest = [c for c in stg.columns if c not in keys]
    if not rest:
        return stg.distinct()
    row = F.struct(*[quoted(c) for c in rest])
    if order:
        last = F.max(F.struct(F.struct(*[quoted(c) for c in order]).alias("o"), row.alias("r")))
        picked = stg.groupBy(*keys).agg(last.alias("_last")).select(*keys, F.col("_last.r").alias("_row"))
    else:
        span = stg.groupBy(*keys).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
        clash = F.raise_error(F.lit("several different staged rows for one key"))
        picked = span.select(*keys, F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(clash).alias("_row"))
    return picked.select(*keys, "_row.*").select(*stg.columns)


def _differs(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(False)
    for a, b in zip(left, right):
        out = out | ~a.eqNullSafe(b)
    return out


def scd1(
    dim: DataFrame,
    stg: DataFrame,
    keys: list[str],
    matched: str = "update",
    unmatched: str = "keep",
    order: list[str] | None = None,
) -> DataFrame:
    """Type 1: new keys appended, matched keys updated in place.

    ``matched="keep_target"`` leaves matched rows as they are; ``unmatched="drop"`` loses the rows
    whose key is not staged. Dimension columns that are not staged are kept, NULL for new rows.
    """
    staged = one_per_key(stg.select(*[c for c in dim.columns if c in stg.columns]), keys, order)
    d = dim.select("*", F.lit(True).alias("_old")).alias("d")
    s = staged.select("*", F.lit(True).alias("_new")).alias("s")
    joined = d.join(s, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys], "full" if unmatched == "keep" else "right")
    old, new = F.col("d._old").isNotNull(), F.col("s._new").isNotNull()
    from_stage = new if matched == "update" else new & ~old
    return joined.select(
        *[
            F.when(from_stage, F.col(f"s.`{c}`")).otherwise(F.col(f"d.`{c}`")).alias(c)
            if c in staged.columns
            else F.col(f"d.`{c}`").alias(c)
            for c in dim.columns
        ]
    )


@dataclass(frozen=True)
class History:
    """Names and marker of a type 2 dimension."""

    start: str = "start_date"
    end: str = "end_date"
    active: str | None = None
    open_end: dt.date | dt.datetime | None = None
    active_yes: str = "Y"
    active_no: str = "N"

    def is_open(self) -> Column:
        end = quoted(self.end)
        return end.isNull() if self.open_end is None else end == moment(self.open_end)


def scd2_tagged(dim: DataFrame, stg: DataFrame, keys: list[str], tracked: list[str], as_of: dt.datetime | dt.date, **options) -> DataFrame:
    """Type 2 as one plan, each result row with its ``_action``: keep, close or insert."""
    closed, current = scd2_parts(dim, stg, keys, tracked, as_of, **options)
    return closed.unionByName(current)


def scd2_parts(
    dim: DataFrame,
    stg: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of: dt.datetime | dt.date,
    history: History = History(),
    by_hash: bool = False,
    order: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The tagged rows in two parts: versions closed earlier, and everything that was or becomes open.

    Closed rows pass through without a shuffle; a table partitioned by open and closed rows need not
    rewrite them. Open rows meet the staged rows in one full join, and a changed key yields two rows:
    the closed old one and the open new one. All comparisons of tracked columns are null-safe.
    ``by_hash`` compares 64-bit hashes of the tracked columns.
    """
    attributes = [c for c in dim.columns if c in stg.columns]
    staged = one_per_key(stg.select(*attributes), keys, order)
    is_open = F.coalesce(history.is_open(), F.lit(False))
    closed = dim.filter(~is_open).select("*", F.lit(KEEP).alias("_action"))
    d = dim.filter(is_open).select("*", F.lit(True).alias("_old")).alias("d")
    s = staged.select("*", F.lit(True).alias("_new")).alias("s")
    joined = d.join(s, [F.col(f"d.`{k}`") == F.col(f"s.`{k}`") for k in keys], "full")

    mine, theirs = [F.col(f"d.`{c}`") for c in tracked], [F.col(f"s.`{c}`") for c in tracked]
    changed = row_hash(*mine) != row_hash(*theirs) if by_hash else _differs(mine, theirs)
    old, new = F.col("d._old").isNotNull(), F.col("s._new").isNotNull()
    now, opened = moment(as_of), moment(history.open_end)

    def value(c: str, action: str) -> Column:
        kind = dim.schema[c].dataType
        if c == history.start and action == INSERT:
            return now.cast(kind)
        if c == history.end and action != KEEP:
            return (opened if action == INSERT else now).cast(kind)
        if c == history.active and action != KEEP:
            return F.lit(history.active_yes if action == INSERT else history.active_no).cast(kind)
        if action == INSERT:
            return F.col(f"s.`{c}`") if c in attributes else F.lit(None).cast(kind)
        return F.col(f"d.`{c}`")

    def row(action: str) -> Column:
        return F.struct(*[value(c, action).alias(c) for c in dim.columns], F.lit(action).alias("_action"))

    rows = (
        F.when(~old, F.array(row(INSERT)))
        .when(new & changed, F.array(row(CLOSE), row(INSERT)))
        .otherwise(F.array(row(KEEP)))
    )
    # Never empty, so the outer form only spares the size filter that ``inline`` adds below itself.
    return closed, joined.select(F.inline_outer(rows))


def scd2(dim: DataFrame, stg: DataFrame, keys: list[str], tracked: list[str], as_of: dt.datetime | dt.date, **options) -> DataFrame:
    """Type 2 dimension after applying the staged rows."""
    return scd2_tagged(dim, stg, keys, tracked, as_of, **options).drop("_action")


def scd2_static(
    dim: DataFrame,
    stg: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of: dt.datetime | dt.date,
    history: History = History(),
) -> DataFrame:
    """The same result from its parts: old versions, untouched, closed and opened rows.

    Kept for the equivalence test; it joins three times where ``scd2`` joins once.
    """
    attributes = [c for c in dim.columns if c in stg.columns]
    staged = one_per_key(stg.select(*attributes), keys)
    is_open = F.coalesce(history.is_open(), F.lit(False))
    open_rows, closed_rows = dim.filter(is_open), dim.filter(~is_open)
    seen = staged.select(*keys, F.struct(*[quoted(t) for t in tracked]).alias("_staged"))
    meet = open_rows.join(seen, keys, "left")
    changed = F.col("_staged").isNotNull() & _differs([quoted(t) for t in tracked], [F.col(f"_staged.`{t}`") for t in tracked])
    untouched = meet.filter(~changed).select(*dim.columns)
    end_kind = dim.schema[history.end].dataType
    ended = meet.filter(changed).withColumn(history.end, moment(as_of).cast(end_kind))
    if history.active:
        ended = ended.withColumn(history.active, F.lit(history.active_no))
    current = open_rows.select(*keys, F.struct(*[quoted(t) for t in tracked]).alias("_open"))
    fresh = staged.join(current, keys, "left")
    fresh = fresh.filter(
        F.col("_open").isNull() | _differs([quoted(t) for t in tracked], [F.col(f"_open.`{t}`") for t in tracked])
    )
    fresh = fresh.withColumn(history.start, moment(as_of).cast(dim.schema[history.start].dataType)).withColumn(
        history.end, moment(history.open_end).cast(end_kind)
    )
    if history.active:
        fresh = fresh.withColumn(history.active, F.lit(history.active_yes))
    kinds = {f.name: f.dataType for f in dim.schema.fields}
    fresh = fresh.select(*[quoted(c) if c in fresh.columns else F.lit(None).cast(kinds[c]).alias(c) for c in dim.columns])
    return closed_rows.unionByName(untouched).unionByName(ended.select(*dim.columns)).unionByName(fresh)


@dataclass(frozen=True)
class Roles:
    """Column roles of one dimension, read from its control rows."""

    load_type: str
    source: str
    keys: list[str] = field(default_factory=list)
    tracked: list[str] = field(default_factory=list)
    surrogate: str | None = None
    renames: dict[str, str] = field(default_factory=dict)


def roles_from_control(control: DataFrame, table: str) -> Roles:
    """Read the different control rows of one target table: one for each of its columns."""
    rows = control.filter(F.lower("target_table") == table.lower()).distinct().collect()
    if not rows:
        raise ValueError(f"no control rows for {table}")

    def yes(value: str | None) -> bool:
        return (value or "").strip().upper() == "Y"

    sources = {r["source_table"] for r in rows if (r["source_table"] or "").strip()}
    if len(sources) != 1:
        raise ValueError(f"{table} needs one source table, found {sorted(sources)}")
    kinds = {(r["load_type"] or "").strip().upper() for r in rows}
    if len(kinds) != 1 or not kinds <= {SCD1, SCD2}:
        raise ValueError(f"{table} needs one load type, {SCD1} or {SCD2}, found {sorted(kinds)}")
    surrogate = [r["target_column"] for r in rows if yes(r["is_auto"])]
    return Roles(
        load_type=kinds.pop(),
        source=sources.pop(),
        keys=[r["target_column"] for r in rows if yes(r["is_key"])],
        tracked=[r["target_column"] for r in rows if yes(r["is_tracked"])],
        surrogate=surrogate[0] if surrogate else None,
        renames={r["source_column"]: r["target_column"] for r in rows if (r["source_column"] or "").strip()},
    )


def staged_for(stg: DataFrame, roles: Roles) -> DataFrame:
    return stg.select(*[quoted(s).alias(t) for s, t in roles.renames.items()])


def scd1_from_control(dim: DataFrame, stg: DataFrame, control: DataFrame, table: str) -> DataFrame:
    """Type 1 with keys and columns from control rows; a surrogate column is filled for new rows.

    Control rows that state another load type are an error.
    """
    return _scd1_by_roles(dim, stg, _roles_of_type(control, table, SCD1))


def _roles_of_type(control: DataFrame, table: str, kind: str) -> Roles:
    roles = roles_from_control(control, table)
    if roles.load_type != kind:
        raise ValueError(f"{table} is loaded as {roles.load_type}, not {kind}")
    return roles


def _scd1_by_roles(dim: DataFrame, stg: DataFrame, roles: Roles) -> DataFrame:
    staged = staged_for(stg, roles)
    merged = scd1(dim, staged, roles.keys)
    if not roles.surrogate:
        return merged
    # Only the narrow keys of rows without a number are sorted: new ones, and old ones that never had one.
    keys = [quoted(k) for k in roles.keys]
    new = staged.select(*keys).dropna().distinct().join(dim.select(*keys), roles.keys, "left_anti")
    fresh = new.unionByName(dim.filter(quoted(roles.surrogate).isNull()).select(*keys))
    numbers = assign_keys(fresh, roles.keys, "_number", next_key(dim, roles.surrogate))
    numbers = numbers.select(*[quoted(k).alias(f"_key_{k}") for k in roles.keys], "_number")
    same = [quoted(k).eqNullSafe(quoted(f"_key_{k}")) for k in roles.keys] + [quoted(roles.surrogate).isNull()]
    kind = dim.schema[roles.surrogate].dataType
    number = F.coalesce(quoted(roles.surrogate), F.col("_number").cast(kind)).alias(roles.surrogate)
    return merged.join(numbers, same, "left").select(*[number if c == roles.surrogate else quoted(c) for c in merged.columns])


def scd2_from_control(
    dims: dict[str, DataFrame],
    stgs: dict[str, DataFrame],
    control: DataFrame,
    as_of: dt.datetime | dt.date,
    history: History = History(),
) -> dict[str, DataFrame]:
    """Type 2 for several target tables in one run, each by its own control rows.

    Control rows that state another load type are an error; ``load_by_control`` takes both.
    """
    roles = {table: _roles_of_type(control, table, SCD2) for table in dims}
    return {table: _scd2_by_roles(dim, stgs[roles[table].source], roles[table], as_of, history) for table, dim in dims.items()}


def load_by_control(
    dims: dict[str, DataFrame],
    stgs: dict[str, DataFrame],
    control: DataFrame,
    as_of: dt.datetime | dt.date,
    history: History = History(),
) -> dict[str, DataFrame]:
    """Every target table by the load type, keys and columns that its control rows state."""
    out = {}
    for table, dim in dims.items():
        roles = roles_from_control(control, table)
        stg = stgs[roles.source]
        out[table] = _scd1_by_roles(dim, stg, roles) if roles.load_type == SCD1 else _scd2_by_roles(dim, stg, roles, as_of, history)
    return out


def _scd2_by_roles(dim: DataFrame, stg: DataFrame, roles: Roles, as_of: dt.datetime | dt.date, history: History) -> DataFrame:
    closed, current = scd2_parts(dim, staged_for(stg, roles), roles.keys, roles.tracked, as_of, history=history)
    if roles.surrogate:
        # only new versions get a number, by their unique key: the sort takes the narrow keys of those rows alone
        current = cut(current)
        fresh = current.filter(quoted(roles.surrogate).isNull()).select(*roles.keys)
        numbers = assign_keys(fresh, roles.keys, "_number", next_key(dim, roles.surrogate))
        numbers = numbers.select(*[quoted(k).alias(f"_key_{k}") for k in roles.keys], "_number")
        same = [quoted(k) == quoted(f"_key_{k}") for k in roles.keys]
        new = reduce(lambda a, b: a & b, same) & (F.col("_action") == INSERT)
        kind = dim.schema[roles.surrogate].dataType
        number = F.coalesce(quoted(roles.surrogate), F.col("_number").cast(kind)).alias(roles.surrogate)
        current = current.join(numbers, new, "left").select(
            *[number if c == roles.surrogate else quoted(c) for c in current.columns]
        )
    return closed.unionByName(current).drop("_action")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: dict[str, Column] | None = None,
    insert: dict[str, Column] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Matched rows take ``update``, unmatched source rows take ``insert``; expressions use ``t`` and ``s``.

    ``insert=None`` inserts nothing: an update from a join.
    """
    t = target.select("*", F.lit(True).alias("_old")).alias("t")
    s = one_per_key(source, keys, order).select("*", F.lit(True).alias("_new")).alias("s")
    joined = t.join(s, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys], "left" if insert is None else "full")
    old, new = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    update, insert = update or {}, insert or {}
    out = []
    for f in target.schema.fields:
        mine = F.col(f"t.`{f.name}`")
        value = F.when(old & new, update[f.name]).otherwise(mine) if f.name in update else mine
        added = insert.get(f.name, F.lit(None))
        out.append(F.when(~old, added).otherwise(value).cast(f.dataType).alias(f.name))
    return joined.select(*out)


def assign_keys(df: DataFrame, order: list[str], name: str, start: int | Column = 1) -> DataFrame:
    """Dense surrogate keys by a unique order, beginning at ``start``."""
    return number_rows(df, order, name, start=start, unique=True)


def next_key(dim: DataFrame, name: str) -> Column:
    """One more than the largest key, as a scalar subquery."""
    return dim.agg((F.coalesce(F.max(name), F.lit(0)) + 1).alias("next_key")).scalar()


def fill_surrogates(df: DataFrame, name: str, order: list[str], start: int | Column) -> DataFrame:
    """Give rows without a surrogate key the next ones from ``start``; only those rows are sorted.

    ``df`` is read several times: cut its lineage first when it is the result of a join.
    """
    columns = df.columns
    known, fresh = df.filter(quoted(name).isNotNull()), df.filter(quoted(name).isNull())
    numbered = assign_keys(fresh.drop(name), order, name, start=start)
    kind = df.schema[name].dataType
    return known.unionByName(numbered.withColumn(name, quoted(name).cast(kind)).select(*columns))


def date_dim(spark: SparkSession, start: dt.date, days: int, existing: DataFrame | None = None) -> DataFrame:
    """Calendar rows from ``start``; dates already present in ``existing`` (column ``date``) are skipped."""
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    calendar = spark.range(days).select(day.alias("date"))
    if existing is not None:
        calendar = calendar.join(existing.select("date"), "date", "left_anti")
    return calendar.select("date", *[c.alias(n) for n, c in dates.date_parts("date").items()])


def person_dim(stg: DataFrame, email_columns: list[str], existing: DataFrame | None = None) -> DataFrame:
    """Distinct people of several email columns, names parsed from the address, not yet known."""
    emails = stg.select(F.explode(F.array(*[quoted(c) for c in email_columns])).alias("email"))
    people = emails.filter("email IS NOT NULL").distinct()
    if existing is not None:
        people = people.join(existing.select("email"), "email", "left_anti")
    return people.select(
        initial_capital(email_first_name("email")).alias("first_name"),
        initial_capital(email_last_name("email")).alias("last_name"),
        "email",
    )


def text_dim(stg: DataFrame, value: Column, name: str, existing: DataFrame | None = None) -> DataFrame:
    """Distinct values of a text expression that are not yet known."""
    values = stg.select(value.alias(name)).filter(quoted(name).isNotNull()).distinct()
    return values if existing is None else values.join(existing.select(name), name, "left_anti")


def ensure_rows(dim: DataFrame, rows: list[dict[str, object]], keys: list[str]) -> DataFrame:
    """Add constant rows whose key is missing."""
    kinds = {f.name: f.dataType for f in dim.schema.fields}
    names = dim.columns
    wanted = dim.sparkSession.createDataFrame([tuple(r.get(c) for c in names) for r in rows], dim.schema)
    absent = wanted.join(dim.select(*keys), keys, "left_anti")
    return dim.unionByName(absent.select(*[quoted(c).cast(kinds[c]).alias(c) for c in names]))
