"""Answering specs from stored tables."""

from dataclasses import replace

from pyspark.sql import DataFrame

from bidmill.functions.timekeys import source_of, with_time_keys
from bidmill.operators.aggregates import Aggregate, over_partials
from bidmill.operators.predicates import asked_days, where_all
from bidmill.operators.rollups import BY_NAME, GLOBAL_STATS, Rollup, merged_sets
from bidmill.operators.spec import Spec, evaluate, run_spec
from bidmill.plans.store import Store
from bidmill.schema import PRICES


def rollup_covers(spec: dict | Spec, table: Rollup | str, approximate: bool = False) -> bool:
    """Whether a table's partials give the very result that the events would give.

    With ``approximate``, what merges only nearly counts as well: variances, whose last bits
    depend on the order of merging, and sketches, whose approximate distinct counts can differ from
    those of the events within their error.
    """
    spec, table = Spec.of(spec), _table(table)
    if not spec.is_grouped:
        return False
    if table.type is not None:
        conditions = [(c["op"], c["val"]) for c in spec.where if c["col"] == "type"]
        if conditions != [("eq", table.type)]:
            return False
        spec = spec.without_conditions_on("type")
    if table is GLOBAL_STATS and (spec.where or spec.group_by):
        return False
    if not approximate and any(_merges_nearly(a, table) for a in spec.aggregates):
        return False
    if _counts_sets(spec, table):
        # Rows are merged by group and bucket first, so no other key may be looked at.
        others = [a for a in spec.aggregates if not _of_set(a, table)]
        if any(a.column != "*" and a.column not in PRICES for a in others):
            return False
    used = {*spec.group_by, *(c["col"] for c in spec.where)}
    return all(source_of(column, table.keys) for column in used) and all(
        over_partials(aggregate, table) is not None for aggregate in spec.aggregates
    )


def answer_from_rollup(
    store: Store, name: str, spec: dict | Spec, approximate: bool = False
) -> DataFrame:
    """The result of a spec from one stored table: filter, regroup, merge partials, sort.

    Where every row of the table is one group of the spec, there is no regrouping.
    """
    spec, table = Spec.of(spec), _table(name)
    if not rollup_covers(spec, table, approximate):
        raise ValueError(f"{name} does not hold what the spec asks for")
    if table.type is not None:  # the table holds no other type
        spec = spec.without_conditions_on("type")
    if _counts_sets(spec, table):
        rows = where_all(with_time_keys(store.partials(name), sorted(spec.columns)), spec.where)
        merged = merged_sets(rows, spec.group_by)
        return evaluate(merged, replace(spec, where=()), lambda a, _: over_partials(a, table))
    one_row = _rows_are_groups(spec, table)
    return evaluate(
        store.partials(name), spec, lambda a, _: over_partials(a, table, one_row), one_row
    )


def covering_tables(store: Store, spec: dict | Spec, approximate: bool = False) -> list[str]:
    """Stored tables that can answer a spec, fewest rows first.

    Among equals, filters on stored columns come before filters on derived ones, as only the
    former reach the Parquet scan.
    """
    spec = Spec.of(spec)

    def rank(name: str):
        keys = BY_NAME[name].keys
        derived = sum(c["col"] not in (*keys, "type") for c in spec.where)
        return rows_to_read(store, spec, name), derived, len(keys), name

    names = [n for n in store.tables | store.sets if rollup_covers(spec, n, approximate)]
    return sorted(names, key=rank)


def rows_to_read(store: Store, spec: dict | Spec, name: str | None) -> int:
    """About how many rows of a stored table (or of the events) a spec has to read.

    Types are known exactly. Days are taken to be alike, and count where rows are ordered by
    them, behind at most the type or a column that the spec sets to one value.
    """
    spec = Spec.of(spec)
    asked = asked_days(spec.where)
    fixed = {"type", *(c["col"] for c in spec.where if c["op"] == "eq")} - {"day"}
    if name is None:
        rows, order = store.event_rows(_only_type(spec)), ("day",)
    else:
        table = BY_NAME[name]
        rows, order = store.table_rows(name, _only_type(spec)), table.order or table.keys
    first = next((key for key in order if key not in fixed), None)
    if first == "day" and asked is not None and store.days > asked:
        rows = -(-rows * asked // store.days)
    return rows


def source_for(store: Store, spec: dict | Spec, approximate: bool = False) -> str | None:
    """The stored table that answers a spec with the fewest rows; None if the events do."""
    spec = Spec.of(spec)
    names = covering_tables(store, spec, approximate)
    if names and rows_to_read(store, spec, names[0]) <= rows_to_read(store, spec, None):
        return names[0]
    return None


def answer(store: Store, spec: dict | Spec, approximate: bool = False) -> DataFrame:
    """The result of a spec from whatever holds the fewest rows: a stored table or the events."""
    spec = Spec.of(spec)
    name = source_for(store, spec, approximate)
    if name is not None:
        return answer_from_rollup(store, name, spec, approximate)
    return run_spec(store.events(), spec)


def _rows_are_groups(spec: Spec, table: Rollup) -> bool:
    """Whether the group keys are stored keys that settle all the other keys of the table."""
    return not table.sets and set(spec.group_by) <= set(table.keys) and all(
        source_of(key, spec.group_by) for key in table.keys
    )


def _of_set(aggregate: Aggregate, table: Rollup) -> bool:
    counts = aggregate.distinct or aggregate.function == "APPROX_COUNT_DISTINCT"
    return counts and table.sets is not None and aggregate.column == table.sets


def _merges_nearly(aggregate: Aggregate, table: Rollup) -> bool:
    if aggregate.function == "APPROX_COUNT_DISTINCT":
        return _of_set(aggregate, table)
    return aggregate.function in ("STDDEV", "VARIANCE")


def _counts_sets(spec: Spec, table: Rollup) -> bool:
    return any(_of_set(aggregate, table) for aggregate in spec.aggregates)


def _only_type(spec: Spec) -> str | None:
    """The one event type a spec reads, if it asks for just one."""
    types = [c["val"] for c in spec.where if c["col"] == "type" and c["op"] == "eq"]
    return types[0] if types else None


def _table(table: Rollup | str) -> Rollup:
    return BY_NAME[table] if isinstance(table, str) else table
