"""Local-time keys: minute, hour, day, week, month, weekday, as SQL expressions.

All keys but ``weekday`` are TIMESTAMP_NTZ. Nothing here depends on the session time zone:
``date_trunc`` would send a naive time through it and move times that the zone skips.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame

NTZ = "timestamp_ntz"

# A key can be worked out from any of the keys listed, coarsest (fewest distinct values) first.
FINER = {
    "minute": (),
    "hour": ("minute",),
    "day": ("hour", "minute"),
    "week": ("day", "hour", "minute"),
    "month": ("day", "hour", "minute"),
    "weekday": ("day", "hour", "minute"),
}

# Days from a key's value to the last day it holds.
SPAN_DAYS = {"minute": 0, "hour": 0, "day": 0, "week": 6, "month": 30}

# Keys of a naive time; Sunday is weekday 0.
_KEYS = {
    "minute": "cast(cast({0} AS date) AS timestamp_ntz)"
              " + make_dt_interval(0, hour({0}), minute({0}))",
    "hour": "cast(cast({0} AS date) AS timestamp_ntz) + make_dt_interval(0, hour({0}))",
    "day": "cast(cast({0} AS date) AS timestamp_ntz)",
    "week": "cast(trunc(cast({0} AS date), 'week') AS timestamp_ntz)",
    "month": "cast(trunc(cast({0} AS date), 'month') AS timestamp_ntz)",
    "weekday": "cast(dayofweek(cast({0} AS date)) - 1 AS bigint)",
}


def local_time(instant: str, zone: str) -> str:
    """Wall-clock time of an instant in ``zone``, as a naive time."""
    if "'" in zone or "\\" in zone:
        raise ValueError(f"not a time zone: {zone!r}")
    shifted = f"unix_micros(from_utc_timestamp({instant}, '{zone}'))"
    return f"timestampadd(MICROSECOND, {shifted}, timestamp_ntz'1970-01-01 00:00:00')"


def time_key(key: str, time: str) -> str:
    """The value of ``key`` for a naive time column (or for a finer key)."""
    return _KEYS[key].format(time)


def source_of(key: str, columns: Iterable[str]) -> str | None:
    """The column among ``columns`` that gives ``key``: itself, else the coarsest finer one."""
    if key in columns:
        return key
    return next((finer for finer in FINER.get(key, ()) if finer in columns), None)


def with_time_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Add those of ``keys`` that are missing and can be worked out from a finer key."""
    sources = {key: source_of(key, df.columns) for key in keys if key not in df.columns}
    added = [f"{time_key(key, source)} AS {key}" for key, source in sources.items() if source]
    return df.selectExpr("*", *added) if added else df


def as_text(key: str) -> str:
    """Output text: whole dates for day, week and month; no seconds for minute."""
    width = {"minute": 16, "hour": 19}.get(key, 10)
    return f"substring(cast({key} AS string), 1, {width})"
