"""Several specs over one source in one scan.

Each row is matched with the specs whose conditions it meets, and partial measures are grouped by
spec and by that spec's keys. What comes out is small: the partial rows of each spec's groups, from
which its result is read off.
"""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidmill.functions.timekeys import with_time_keys
from bidmill.operators.aggregates import over_partials
from bidmill.operators.predicates import all_of
from bidmill.operators.rollups import Rollup
from bidmill.operators.spec import Spec, evaluate
from bidmill.schema import PRICES

SPEC = "_spec"


def shareable(spec: Spec) -> bool:
    """Whether a grouped spec needs only measures that all partial rows keep and that merge exactly."""
    return spec.is_grouped and all(
        a.function in ("COUNT", "SUM", "AVG", "MIN", "MAX") and not a.distinct
        and (a.column == "*" or a.column in PRICES)
        for a in spec.aggregates
    )


def shared_partials(rows: DataFrame, specs: dict[int, Spec], measures: list[str]) -> DataFrame:
    """Partial rows of the numbered specs over ``rows``: number, keys (others NULL), measures."""
    rows = with_time_keys(rows, sorted({c for spec in specs.values() for c in spec.columns}))
    meets = {number: all_of(rows.schema, spec.where) for number, spec in specs.items()}
    met = [f"if({condition}, {number}, NULL)" for number, condition in meets.items()]
    # The filter repeats the conditions, so that what they have in common reaches the scan.
    kept = rows.where(" OR ".join(f"({condition})" for condition in meets.values()))
    kept = kept.withColumn(SPEC, F.explode(F.expr(f"array_compact(array({', '.join(met)}))")))
    keys = sorted({key for spec in specs.values() for key in spec.group_by})
    own = []
    for key in keys:
        numbers = ", ".join(str(n) for n, spec in specs.items() if key in spec.group_by)
        own.append(F.expr(f"CASE WHEN {SPEC} IN ({numbers}) THEN {key} END").alias(key))
    return kept.groupBy(SPEC, *own).agg(*[F.expr(m) for m in measures])


def result_of(partial_rows: DataFrame, number: int, spec: Spec) -> DataFrame:
    """The result of one of the specs from the partial rows of all."""
    own = partial_rows.where(F.col(SPEC) == number)
    one_row = bool(spec.group_by)  # a total is one row even if nothing matched
    bare = replace(spec, where=())
    return evaluate(own, bare, lambda a, _: over_partials(a, _like(spec), one_row), one_row)


def _like(spec: Spec) -> Rollup:
    return Rollup("shared", None, spec.group_by)
