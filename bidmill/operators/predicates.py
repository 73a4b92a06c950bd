"""Row conditions of a query spec as typed SQL predicates."""

from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bidmill.functions.timekeys import SPAN_DAYS

_COMPARE = {"eq": "=", "neq": "<>", "lt": "<", "lte": "<=", "gt": ">", "gte": ">="}
OPERATORS = (*_COMPARE, "in", "between")

# Which ends of the day range a condition fixes.
_BOUNDS_BELOW = ("eq", "in", "between", "gt", "gte")
_BOUNDS_ABOVE = ("eq", "in", "between", "lt", "lte")


def where_all(df: DataFrame, conditions: tuple[dict, ...]) -> DataFrame:
    """Keep the rows for which every condition is true."""
    return df.where(all_of(df.schema, conditions)) if conditions else df


def all_of(schema: T.StructType, conditions: tuple[dict, ...]) -> str:
    """All conditions, and the bounds on the day that they imply, as one predicate."""
    texts = []
    for condition in conditions:
        texts += [predicate(schema, condition), *_implied_day_bounds(schema, condition)]
    return " AND ".join(texts) or "true"


def asked_days(conditions: tuple[dict, ...]) -> int | None:
    """How many days the conditions on the day leave; None if one end is open."""
    least = None
    for condition in conditions:
        if condition["col"] != "day" or condition["op"] not in ("eq", "in", "between"):
            continue
        values = condition["val"] if condition["op"] != "eq" else [condition["val"]]
        days = [_naive_time(value, "day").date() for value in values]
        if condition["op"] == "between" and len(days) == 2:
            n = max(0, (days[1] - days[0]).days + 1)
        else:
            n = len(set(days))
        least = n if least is None else min(least, n)
    return least


def predicate(schema: T.StructType, condition: dict) -> str:
    """One ``{"col", "op", "val"}`` condition over columns of ``schema``."""
    name, op, value = condition["col"], condition["op"], condition["val"]
    if name not in schema.names:
        raise ValueError(f"no column {name!r} to filter; there are {schema.names}")
    data_type = schema[name].dataType
    if op == "in":
        values = [_literal(v, data_type, name) for v in _many(value, op)]
        return f"{name} IN ({', '.join(values)})" if values else "false"
    if op == "between":
        ends = [_literal(v, data_type, name) for v in _many(value, op)]
        if len(ends) != 2:
            raise ValueError(f"between needs two values, got {value!r}")
        return f"{name} BETWEEN {ends[0]} AND {ends[1]}"
    if op not in _COMPARE:
        raise ValueError(f"unknown operator {op!r}; there are {OPERATORS}")
    return f"{name} {_COMPARE[op]} {_literal(value, data_type, name)}"


def _many(value, op: str) -> list:
    if not isinstance(value, (list, tuple, set, frozenset)):
        raise ValueError(f"{op} needs a list, got {value!r}")
    return list(value)


def _literal(value, data_type: T.DataType, name: str) -> str:
    """``value`` as a literal of the column's own type, so that no column cast hides it."""
    if value is None or isinstance(value, bool):
        raise ValueError(f"{value!r} cannot be compared with {name}")
    if isinstance(data_type, T.TimestampNTZType):
        return _naive_literal(_naive_time(value, name))
    if isinstance(data_type, T.TimestampType):
        time = _time(value, name)  # without an offset it is UTC, whatever the session's zone
        return f"timestamp'{time if time.tzinfo else time.replace(tzinfo=UTC)}'"
    if isinstance(data_type, T.StringType):
        if not isinstance(value, str):
            raise ValueError(f"{name} is text, got {value!r}")
        return _text_literal(value)
    try:
        number = Decimal(str(value))
    except ArithmeticError:
        raise ValueError(f"{name} is a number, got {value!r}") from None
    if not number.is_finite():
        raise ValueError(f"{name} is a finite number, got {value!r}")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"{float(number)!r}D"
    return f"{number:f}"


def _text_literal(value: str) -> str:
    """Quoted text. Anything a parser setting could read otherwise goes in as its bytes."""
    if "'" in value or "\\" in value:
        return f"decode(X'{value.encode().hex()}', 'UTF-8')"
    return f"'{value}'"


def _time(value, name: str) -> datetime:
    try:
        if isinstance(value, str):
            return datetime.fromisoformat(value.strip())
        if isinstance(value, datetime):
            return value
        if isinstance(value, date):
            return datetime(value.year, value.month, value.day)
    except ValueError:
        pass
    raise ValueError(f"{name} is a time, got {value!r}")


def _naive_time(value, name: str) -> datetime:
    time = _time(value, name)
    if time.tzinfo is not None:
        raise ValueError(f"{name} is a local time without a zone, got {value}")
    return time


def _naive_literal(time: datetime) -> str:
    return f"timestamp_ntz'{time}'"


def _implied_day_bounds(schema: T.StructType, condition: dict) -> list[str]:
    """Day bounds that follow from a condition on a time key.

    They change no result. Stored days are dates, the one time key whose Parquet statistics
    are used, so bounds on them let hour, minute, week and month filters skip row groups too.
    """
    name, op, value = condition["col"], condition["op"], condition["val"]
    if name not in SPAN_DAYS or "day" not in schema.names or (name == "day" and op != "in"):
        return []
    times = [_naive_time(v, name) for v in (value if op in ("in", "between") else [value])]
    if not times:
        return []
    bounds = []
    if op in _BOUNDS_BELOW:
        bounds.append(f"day >= {_midnight(min(times))}")
    if op in _BOUNDS_ABOVE:
        last = max(times)
        if datetime.max - last >= timedelta(SPAN_DAYS[name]):  # else there is no later day
            bounds.append(f"day <= {_midnight(last + timedelta(SPAN_DAYS[name]))}")
    return bounds


def _midnight(time: datetime) -> str:
    return _naive_literal(datetime(time.year, time.month, time.day))
