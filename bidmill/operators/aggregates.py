"""Aggregate functions of a query spec, over events and over stored partials."""

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from bidmill.functions.measures import (
    exact,
    mean,
    merged_deviations,
    remainder,
    sample_variance,
    total,
)
from bidmill.functions.timekeys import source_of
from bidmill.operators.rollups import GLOBAL_EXTRAS, GLOBAL_STATS, Rollup
from bidmill.schema import PRICES

FUNCTIONS = (
    "COUNT", "SUM", "AVG", "MIN", "MAX",
    "STDDEV", "VARIANCE", "MEDIAN", "APPROX_COUNT_DISTINCT",
)


@dataclass(frozen=True)
class Aggregate:
    """``function(column)``; ``column`` is ``*`` for the row count."""

    function: str
    column: str
    distinct: bool = False

    @classmethod
    def of(cls, function: str, argument: str) -> "Aggregate":
        name, argument = function.strip().upper(), argument.strip()
        distinct = re.match(r"distinct\s+(.+)", argument, re.IGNORECASE)
        out = cls(name, distinct[1] if distinct else argument, bool(distinct))
        if name not in FUNCTIONS:
            raise ValueError(f"unknown aggregate {function!r}; there are {FUNCTIONS}")
        if name != "COUNT" and (out.column == "*" or out.distinct):
            raise ValueError(f"{function}({argument}) is not supported")
        return out

    @classmethod
    def from_text(cls, text: str) -> "Aggregate | None":
        """The aggregate that text such as ``COUNT(*)`` names, or None for a plain column."""
        call = re.fullmatch(r"\s*(\w+)\s*\((.*)\)\s*", text)
        return cls.of(call[1], call[2]) if call else None

    @property
    def label(self) -> str:
        """Result column name: ``COUNT(*)``, otherwise lower case as in ``sum(bid_price)``."""
        if self.column == "*":
            return f"{self.function}(*)"
        return f"{self.function.lower()}({'DISTINCT ' if self.distinct else ''}{self.column})"


def over_events(aggregate: Aggregate, schema: T.StructType) -> str:
    """The aggregate as SQL over event rows (MEDIAN is not a single expression)."""
    name, column = aggregate.function, aggregate.column
    if column == "*":
        return "count(1)"
    if column not in schema.names:
        raise ValueError(f"no column {column!r} to aggregate; there are {schema.names}")
    data_type = schema[column].dataType
    if name == "COUNT":
        return f"count({'DISTINCT ' if aggregate.distinct else ''}{column})"
    if name == "APPROX_COUNT_DISTINCT":
        return f"approx_count_distinct({column})"
    if name in ("MIN", "MAX"):
        whole = isinstance(data_type, T.DecimalType)
        return f"cast({name}({column}) AS double)" if whole else f"{name}({column})"
    if not isinstance(data_type, T.NumericType):
        raise ValueError(f"{aggregate.label}: {column} is not a number")
    if name in ("STDDEV", "VARIANCE"):
        return f"{name}(cast({column} AS double))"
    if isinstance(data_type, T.IntegralType) and name == "SUM":
        return f"sum({column})"
    if isinstance(data_type, T.DecimalType):  # nothing is left beside the exact sum
        whole = f"cast(sum({column}) AS double)"
    else:
        whole = total(f"sum({exact(column, data_type)})", f"sum({remainder(column, data_type)})")
    return mean(whole, f"count({column})") if name == "AVG" else whole


def over_partials(aggregate: Aggregate, table: Rollup, one_row: bool = False) -> str | None:
    """The aggregate as SQL over a table's partial rows; None where it does not follow.

    With ``one_row`` every group is a single partial row, and the SQL is over that row. Rows
    of a table with sets must be merged by group and bucket first.
    """
    name, column = aggregate.function, aggregate.column

    def merged(function: str, value: str) -> str:
        return value if one_row else f"{function}({value})"

    def count_of(value: str) -> str:
        return f"coalesce({merged('sum', value)}, 0)"

    if table is GLOBAL_STATS:
        return _over_global_stats(aggregate, merged, count_of)
    if column == "*":
        return count_of("n_events")
    if column in PRICES and not aggregate.distinct:
        count = count_of(f"n_{column}")
        whole = total(merged("sum", f"sum_{column}"), merged("sum", f"rest_{column}"))
        deviations = f"m2_{column}" if one_row else merged_deviations(column)
        variance = sample_variance(deviations, count)
        return {
            "COUNT": count,
            "SUM": whole,
            "AVG": mean(whole, count),
            "VARIANCE": variance,
            "STDDEV": f"sqrt({variance})",
            "MIN": f"cast({merged('min', f'min_{column}')} AS double)",
            "MAX": f"cast({merged('max', f'max_{column}')} AS double)",
        }.get(name)
    if column == table.sets:
        if aggregate.distinct:
            return f"coalesce({merged('sum', 'bitmap_count(bits)')}, 0L)"
        if name == "APPROX_COUNT_DISTINCT":
            return f"hll_sketch_estimate({merged('hll_union_agg', 'sketch')})"
    if not source_of(column, table.keys):
        return None
    if name == "COUNT" and not aggregate.distinct:
        return count_of(f"CASE WHEN {column} IS NOT NULL THEN n_events END")
    # These see each value once or many times alike, so the keys are as good as the events.
    different = f"if({column} IS NULL, 0L, 1L)"
    return {
        "COUNT": different if one_row else f"count(DISTINCT {column})",
        "MIN": merged("min", column),
        "MAX": merged("max", column),
        "APPROX_COUNT_DISTINCT": different if one_row else f"approx_count_distinct({column})",
    }.get(name)


def _over_global_stats(aggregate: Aggregate, merged, count_of) -> str | None:
    if aggregate.column == "*":
        return count_of("n_events")
    for stored, column, call in GLOBAL_EXTRAS:
        if aggregate == Aggregate.from_text(call.format(column)):
            return merged("max", stored)
    return None
