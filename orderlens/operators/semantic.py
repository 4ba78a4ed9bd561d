"""Relationship graph and filter context of the measures (JN7, JN8, AG15, AG17).

A model is a set of tables and many-to-one relations between them.  A slicer or
a filter names a column of any table, ``"dim_customers.city"``; it reaches the
tables from which that table can be reached along relations, and leaves the
others whole: filters flow from the one side to the many side only.

Measures are trees: a base aggregate of one table, a ratio, or another measure
in a changed filter context (``Calc``: added filters, removed filters).  All
measures of a call are planned together:

* each table is aggregated once, at the finest grain that any context of its
  measures needs: slicer columns, columns that only some contexts filter, and
  the key of a distinct count.  The lines are reduced to a row per foreign key
  before a dimension is joined, so no line-grain join takes place, and a
  filtered dimension is joined as its remaining keys;
* each context is a roll-up of those cells, which are stored first (``Model.store``)
  where a table has several contexts: their roll-ups read different columns, so
  Spark would make the cells once for each;
* the small results meet null-safely on the slicer columns they have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import exprs as E


@dataclass(frozen=True)
class Relation:
    """``many.many_key`` looks up ``one.one_key``, which is unique.  ``prune``
    names a partition column of ``many`` and how it follows from the key."""
    many: str
    many_key: str
    one: str
    one_key: str
    prune: tuple[str, Callable[[Column], Column]] | None = None


@dataclass(frozen=True)
class Filter:
    """Rows whose column is one of ``values`` (None: blank)."""
    ref: str
    values: tuple

    def holds(self, c: Column) -> Column:
        known = [v for v in self.values if v is not None]
        out = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
        return out | c.isNull() if None in self.values else out


def one_of(ref: str, *values) -> Filter:
    return Filter(ref, tuple(values))


@dataclass(frozen=True)
class Leaf:
    """Base aggregate of a table in three steps: ``partial`` over rows, ``again``
    over partial results, ``final`` over the rows that differ in ``distinct``.
    ``related`` is a column of the one side that ``final`` reads (RELATED)."""
    table: str
    partial: Callable[[], Column]
    final: Callable[[str], Column]
    again: Callable[[str], Column] = F.sum
    distinct: str | None = None
    related: str | None = None
    zero: bool = False


@dataclass(frozen=True)
class Base:
    name: str


@dataclass(frozen=True)
class Ratio:
    top: object
    bottom: object


@dataclass(frozen=True)
class Minus:
    """``constant - measure``."""
    constant: float
    node: object


@dataclass(frozen=True)
class Calc:
    """A measure in a changed context.  ``where`` replaces the slicers and
    filters of its columns, or narrows them with ``keep``; ``remove`` drops
    those of columns or of whole tables (ALL)."""
    node: object
    where: tuple[Filter, ...] = ()
    remove: tuple[str, ...] = ()
    keep: bool = False


@dataclass(frozen=True)
class _Context:
    filters: frozenset = frozenset()
    removed: frozenset = frozenset()

    def without(self, refs: Iterable[str]) -> _Context:
        gone = set(refs)

        def hit(ref: str) -> bool:
            return ref in gone or ref.split(".")[0] in gone
        return _Context(frozenset(f for f in self.filters if not hit(f.ref)), self.removed | gone)

    def drops(self, ref: str) -> bool:
        return ref in self.removed or ref.split(".")[0] in self.removed


@dataclass
class Model:
    tables: Mapping[str, DataFrame]
    relations: Sequence[Relation] = ()
    leaves: Mapping[str, Leaf] = field(default_factory=dict)
    measures: Mapping[str, object] = field(default_factory=dict)
    #: Writes a frame that several plans read, and reads it back.
    store: Callable[[DataFrame, str], DataFrame] | None = None

    def path(self, table: str, to: str) -> list[Relation] | None:
        """Relations from ``table`` to ``to``; None if there is no way."""
        if table == to:
            return []
        for r in self.relations:
            if r.many == table:
                rest = self.path(r.one, to)
                if rest is not None:
                    return [r, *rest]
        return None

    def reaches(self, table: str, ref: str) -> bool:
        return self.path(table, ref.split(".")[0]) is not None


def column_of(ref: str) -> str:
    return "_k_" + ref.replace(".", "_")


def _looked_up(model: Model, df: DataFrame, table: str, refs: Sequence[str], common: Sequence[Filter]) -> DataFrame:
    """Columns ``refs`` of one-side tables joined to reduced rows of ``table``,
    which hold their foreign keys as ``_f_<key>``; rows that a common filter of
    a one-side table excludes go."""
    firsts = {r: None for r in model.relations if r.many == table}
    for relation in firsts:
        below = [r for r in refs if (p := model.path(table, r.split(".")[0])) and p[0] == relation]
        mine = [f for f in common if (p := model.path(table, f.ref.split(".")[0])) and p[0] == relation]
        if not below and not mine:
            continue
        one = model.tables[relation.one]
        for f in mine:
            if f.ref.split(".")[0] == relation.one:
                one = one.where(f.holds(F.col(f.ref.split(".")[1])))
        own = {r for r in below if r.split(".")[0] == relation.one}
        further = [r for r in below if r not in own]
        deep = [f for f in mine if f.ref.split(".")[0] != relation.one]
        keys = {r.many_key for r in model.relations if r.many == relation.one} if further or deep else set()
        one = one.select(F.col(relation.one_key).alias(f"_one_{relation.one}"), *[F.col(r.split(".")[1]).alias(column_of(r)) for r in own],
                         *[F.col(k).alias(f"_f_{k}") for k in keys])
        if further or deep:
            one = _looked_up(model, one, relation.one, further, deep).drop(*[f"_f_{k}" for k in keys])
        df = df.join(one, F.col(f"_f_{relation.many_key}") == F.col(f"_one_{relation.one}"),
                     "inner" if mine else "left").drop(f"_one_{relation.one}")
    return df


def _cells(model: Model, table: str, leaves: Mapping[str, Leaf], refs: Sequence[str], common: Sequence[Filter],
           distinct: str | None) -> DataFrame:
    """One aggregate of ``table`` by ``refs`` and the distinct key, with the
    partial result of each leaf."""
    df = model.tables[table]
    own = [r for r in refs if r.split(".")[0] == table]
    related = sorted({x.related for x in leaves.values() if x.related})
    far = [r for r in refs if r not in own] + [r for r in related if r not in refs]
    for f in common:
        if f.ref.split(".")[0] == table:
            df = df.where(f.holds(F.col(f.ref.split(".")[1])))
    keys = []
    for relation in (r for r in model.relations if r.many == table):
        below = [x for x in [*far, *(f.ref for f in common)]
                 if (p := model.path(table, x.split(".")[0])) and p[0] == relation]
        if below:
            keys.append(relation.many_key)
        mine = [f for f in common if f.ref.split(".")[0] == relation.one]
        if relation.prune and mine:
            # the partitions that the filtered keys can lie in, found at run time
            column, follows = relation.prune
            left = model.tables[relation.one]
            for f in mine:
                left = left.where(f.holds(F.col(f.ref.split(".")[1])))
            ends = left.select(follows(F.col(relation.one_key)).alias("p"))
            df = df.where((F.col(column) >= ends.agg(F.min("p")).scalar())
                          & (F.col(column) <= ends.agg(F.max("p")).scalar()))
    group = [*[F.col(r.split(".")[1]).alias(column_of(r)) for r in own], *[F.col(k).alias(f"_f_{k}") for k in keys]]
    if distinct:
        group.append(F.col(distinct).alias("_distinct"))
    partials = [x.partial().alias(n) for n, x in leaves.items()]
    rows = df.groupBy(*group).agg(*partials)
    if not keys:
        return rows
    rows = _looked_up(model, rows, table, far, common)
    names = [column_of(r) for r in [*refs, *[x for x in related if x not in refs]]] + (["_distinct"] if distinct else [])
    return rows.groupBy(*names).agg(*[x.again(n).alias(n) for n, x in leaves.items()])


def _rolled_up(cells: DataFrame, leaves: Mapping[str, Leaf], keys: Sequence[str], conditions: Sequence[Filter],
               distinct: str | None) -> DataFrame:
    """One context: cells that hold under ``conditions``, by ``keys``."""
    for f in conditions:
        cells = cells.where(f.holds(F.col(column_of(f.ref))))
    names = [column_of(k) for k in keys]
    if distinct:
        related = [c for c in {column_of(x.related) for x in leaves.values() if x.related} if c not in names]
        cells = cells.groupBy(*names, *related, "_distinct").agg(*[x.again(n).alias(n) for n, x in leaves.items()])
    return cells.groupBy(*names).agg(*[x.final(n).alias(n) for n, x in leaves.items()])


def evaluate(model: Model, names: Sequence[str], by: Sequence[str] | Mapping[str, str] = (),
             where: Sequence[Filter] = ()) -> DataFrame:
    """Measures of any tables under shared slicers and filters.

    ``by`` lists slicer columns (or maps output names to them).  A row appears
    for every combination that some table reaching all slicers has, blanks
    included; a measure whose table a slicer does not reach is not divided by
    it.  Counts without rows are 0, other aggregates blank."""
    out_names = dict(by) if isinstance(by, Mapping) else {r.split(".")[1]: r for r in by}
    slicers = list(out_names.values())
    # leaf columns by (leaf, context)
    columns: dict[tuple[str, _Context], str] = {}

    def compiled(node, ctx: _Context) -> Callable[[], Column]:
        if isinstance(node, str):
            return compiled(model.measures[node] if node in model.measures else Base(node), ctx)
        if isinstance(node, Base):
            if node.name not in model.leaves:
                raise KeyError(f"unknown measure {node.name}")
            column = columns.setdefault((node.name, ctx), f"_m{len(columns)}")
            return lambda: F.col(column)
        if isinstance(node, Ratio):
            top, bottom = compiled(node.top, ctx), compiled(node.bottom, ctx)
            return lambda: E.safe_div(top(), bottom())
        if isinstance(node, Minus):
            inner = compiled(node.node, ctx)
            return lambda: F.lit(node.constant) - inner()
        if isinstance(node, Calc):
            changed = ctx.without(node.remove)
            if not node.keep:
                changed = changed.without(f.ref for f in node.where)
            return compiled(node.node, _Context(changed.filters | frozenset(node.where), changed.removed))
        raise TypeError(node)

    wanted = {n: compiled(n, _Context(frozenset(where))) for n in names}
    results: list[tuple[tuple[str, ...], DataFrame, list[str]]] = []
    zeros = [c for (leaf, _), c in columns.items() if model.leaves[leaf].zero]
    for table in dict.fromkeys(model.leaves[leaf].table for leaf, _ in columns):
        here = [(leaf, ctx) for leaf, ctx in columns if model.leaves[leaf].table == table]
        contexts = list(dict.fromkeys(ctx for _, ctx in here))
        reached = {ctx: [f for f in sorted(ctx.filters, key=str) if model.reaches(table, f.ref)] for ctx in contexts}
        keys = {ctx: tuple(r for r in slicers if model.reaches(table, r) and not ctx.drops(r)) for ctx in contexts}
        common = [f for f in reached[contexts[0]] if all(f in reached[c] for c in contexts)]
        refs = list(dict.fromkeys([r for c in contexts for r in keys[c]]
                                  + [f.ref for c in contexts for f in reached[c] if f not in common]))
        leaves = {leaf: model.leaves[leaf] for leaf in dict.fromkeys(leaf for leaf, _ in here)}
        counted = {x.distinct for x in leaves.values() if x.distinct}
        if len(counted) > 1:
            raise ValueError(f"measures of {table} count different keys: {sorted(counted)}")
        distinct = next(iter(counted), None)
        cells = _cells(model, table, leaves, refs, common, distinct)
        if len(contexts) > 1 and model.store:
            cells = model.store(cells, f"cells-{table}")
        for ctx in contexts:
            mine = {leaf: x for leaf, x in leaves.items() if (leaf, ctx) in columns}
            rows = _rolled_up(cells, mine, keys[ctx], [f for f in reached[ctx] if f not in common],
                              distinct if any(x.distinct for x in mine.values()) else None)
            got = [columns[(leaf, ctx)] for leaf in mine]
            results.append((keys[ctx], rows.select(*[column_of(k) for k in keys[ctx]],
                                                   *[F.col(leaf).alias(columns[(leaf, ctx)]) for leaf in mine]), got))

    whole = tuple(slicers)
    full = [r for r in results if r[0] == whole]
    if not full:
        raise ValueError("no table of these measures reaches all slicers")
    out = full[0][1]
    for keys, rows, got in full[1:] if slicers else []:
        out = _null_safe(out, rows, keys, got, "full_outer")
    for keys, rows, got in [r for r in results if r[0] != whole] if slicers else full[1:]:
        if keys:
            out = _null_safe(out, rows, keys, got, "left")
        else:
            one = rows.select(F.struct("*")).scalar()
            out = out.withColumns({c: one.getField(c) for c in got})
    out = out.na.fill(0, zeros)
    return out.select(*[F.col(column_of(r)).alias(n) for n, r in out_names.items()],
                      *[build().alias(n) for n, build in wanted.items()])


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], got: Sequence[str], how: str) -> DataFrame:
    names = [column_of(k) for k in keys]
    right = right.select(*[F.col(n).alias(f"{n}_r") for n in names], *got)
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"{n}_r"))
    out = left.join(right, on, how)
    if how == "full_outer":
        out = out.withColumns({n: F.coalesce(F.col(n), F.col(f"{n}_r")) for n in names})
    return out.drop(*[f"{n}_r" for n in names])


def shifted(model: Model, names: Sequence[str], key: str, days: int, by: Sequence[str] = (),
            where: Sequence[Filter] = (), last_by: str | None = None) -> DataFrame:
    """Time offset: measures at every ``key`` date under the slicers and, as
    ``prev_<name>``, at the date ``days`` later or earlier (blank where there is
    none).  Both are readings of one aggregate.

    With ``last_by`` only the last date of each slicer value at which that
    measure is neither blank nor zero is kept (``current``)."""
    cells = evaluate(model, names, [*by, key], where)
    date, slicers = key.split(".")[1], [r.split(".")[1] for r in by]
    before = cells.select(*[F.col(c).alias(f"_b_{c}") for c in slicers], F.date_add(date, -days).alias("_b_date"),
                          *[F.col(n).alias(f"prev_{n}") for n in names])
    now = cells
    if last_by:
        last = F.max_by(F.struct(date, *names), F.when(F.coalesce(F.col(last_by), F.lit(0)) != 0, F.col(date)))
        now = (cells.groupBy(*slicers).agg(last.alias("_last")).where(F.col("_last").isNotNull())
               .select(*slicers, "_last.*"))
    on = F.col(date) == F.col("_b_date")
    for c in slicers:
        on = on & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return now.join(before, on, "left").drop("_b_date", *[f"_b_{c}" for c in slicers])
