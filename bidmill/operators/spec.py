"""Declarative query specs: select, where, group by, order by.

A spec is a dict such as::

    {"select": ["publisher_id", {"COUNT": "*"}],
     "where": [{"col": "type", "op": "eq", "val": "click"}],
     "group_by": ["publisher_id"],
     "order_by": [{"col": "COUNT(*)", "dir": "desc"}]}
"""

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.functions.timekeys import with_time_keys
from bidmill.operators.aggregates import Aggregate, over_events
from bidmill.operators.median import with_medians
from bidmill.operators.predicates import where_all

_FIELDS = {"select", "from", "where", "group_by", "order_by"}


@dataclass(frozen=True)
class Spec:
    """A checked query spec; plain columns are strings, aggregates are ``Aggregate``."""

    select: tuple[str | Aggregate, ...]
    where: tuple[dict, ...] = ()
    group_by: tuple[str, ...] = ()
    order_by: tuple[tuple[str | Aggregate, bool], ...] = ()  # (what, descending)

    @classmethod
    def of(cls, spec: "dict | Spec") -> "Spec":
        if isinstance(spec, Spec):
            return spec
        if unknown := set(spec) - _FIELDS:
            raise ValueError(f"unknown spec fields {sorted(unknown)}")
        select = []
        for item in spec.get("select") or ():
            calls = [item] if isinstance(item, str) else [Aggregate.of(*c) for c in item.items()]
            select += calls
        if not select:
            raise ValueError("nothing is selected")
        order_by = []
        for order in spec.get("order_by") or ():
            direction = order.get("dir", "asc").lower()
            if direction not in ("asc", "desc"):
                raise ValueError(f"unknown direction {direction!r}")
            what = Aggregate.from_text(order["col"]) or order["col"]
            order_by.append((what, direction == "desc"))
        out = cls(
            tuple(select),
            tuple(spec.get("where") or ()),
            tuple(spec.get("group_by") or ()),
            tuple(order_by),
        )
        out._check()
        return out

    @property
    def aggregates(self) -> tuple[Aggregate, ...]:
        """The distinct aggregates that select and order by need."""
        wanted = [*self.select, *(what for what, _ in self.order_by)]
        return tuple(dict.fromkeys(w for w in wanted if isinstance(w, Aggregate)))

    @property
    def is_grouped(self) -> bool:
        return bool(self.group_by or self.aggregates)

    @property
    def plain_columns(self) -> tuple[str, ...]:
        wanted = [*self.select, *(what for what, _ in self.order_by)]
        return tuple(w for w in wanted if isinstance(w, str))

    @property
    def columns(self) -> set[str]:
        """All columns named anywhere, ``*`` excepted."""
        out = {*self.plain_columns, *self.group_by, *(c["col"] for c in self.where)}
        return (out | {a.column for a in self.aggregates}) - {"*"}

    def without_conditions_on(self, column: str) -> "Spec":
        return replace(self, where=tuple(c for c in self.where if c["col"] != column))

    def _check(self) -> None:
        stray = [c for c in self.plain_columns if c not in self.group_by]
        if self.is_grouped and stray:
            raise ValueError(f"{stray} must be grouped by to be selected or sorted by")


def run_spec(events: DataFrame, spec: dict | Spec) -> DataFrame:
    """The result of a spec over events."""
    return evaluate(events, Spec.of(spec), over_events)


def evaluate(
    rows: DataFrame,
    spec: Spec,
    measure: Callable[[Aggregate, T.StructType], str],
    one_row: bool = False,
) -> DataFrame:
    """A spec over ``rows``; ``measure`` gives the SQL that works out an aggregate there.

    With ``one_row`` each row is a whole group already: nothing is grouped, so nothing moves.
    """
    rows = with_time_keys(rows, sorted(spec.columns))
    known = set(rows.columns) | {a.column for a in spec.aggregates}
    if missing := spec.columns - known:
        raise ValueError(f"no columns {sorted(missing)}; there are {rows.columns}")
    kept = where_all(rows, spec.where)
    if not spec.is_grouped:
        names = [n for item in spec.select for n in (rows.columns if item == "*" else [item])]
        return _ordered(kept, spec, {}).selectExpr(*[_reported(n, rows.schema) for n in names])
    slots = {a: f"_a{i}" for i, a in enumerate(spec.aggregates)}
    if one_row:
        measures = [f"{measure(a, rows.schema)} AS {s}" for a, s in slots.items()]
        grouped = kept.selectExpr(*spec.group_by, *measures)
    elif slots:
        medians = {s: a.column for a, s in slots.items() if a.function == "MEDIAN"}
        plain = {s: measure(a, rows.schema) for a, s in slots.items() if s not in medians}
        measures = [f"{sql} AS {s}" for s, sql in plain.items()] or ["count(1) AS _n"]
        grouped = kept.groupBy(*spec.group_by).agg(*[F.expr(m) for m in measures])
        if medians:
            grouped = with_medians(grouped, kept, spec.group_by, medians)
    else:
        grouped = kept.select(*spec.group_by).distinct()
    result = [
        f"{slots[item]} AS `{item.label}`" if item in slots else _reported(item, rows.schema)
        for item in spec.select
    ]
    return _ordered(grouped, spec, slots).selectExpr(*result)


def _ordered(df: DataFrame, spec: Spec, slots: dict) -> DataFrame:
    """Sorted by all the given keys at once, NULLs last in both directions.

    Ties are settled by the group keys, or by row position. So many rows with one sort value
    can be cut into several ranges, and need not fit into one task.
    """
    if not spec.order_by:
        return df
    keys = [
        (F.desc_nulls_last if descending else F.asc_nulls_last)(slots.get(what, what))
        for what, descending in spec.order_by
    ]
    if spec.is_grouped:
        given = {what for what, _ in spec.order_by}
        return df.orderBy(*keys, *[F.asc_nulls_last(k) for k in spec.group_by if k not in given])
    return df.withColumn("_position", F.monotonically_increasing_id()).orderBy(*keys, "_position")


def _reported(name: str, schema: T.StructType) -> str:
    """A plain result column; decimal prices are reported as doubles."""
    if isinstance(schema[name].dataType, T.DecimalType):
        return f"cast({name} AS double) AS {name}"
    return name
