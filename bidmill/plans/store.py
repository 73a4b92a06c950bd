"""The store: typed events, pre-aggregated tables and a manifest, under one folder."""

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.operators.rollups import (
    BASES,
    BY_NAME,
    GLOBAL_STATS,
    GLOBAL_STATS_PARENTS,
    ROLLUPS,
    SETS,
    Rollup,
    derives_from,
    global_stats,
    merge,
    partials,
    public_table,
    stored_order,
)
from bidmill.schema import EVENT_TYPES, LOCAL_ZONE
from bidmill.sources.csv_events import clean_events, read_raw_events
from bidmill.sources.layout import (
    read_by_type,
    read_table,
    remove,
    write_by_type,
    write_once,
    write_table,
)

ALL_TABLES = tuple(r.name for r in BASES + SETS + ROLLUPS)

_MANIFEST = (
    "kind string, name string, type string, keys array<string>, rows bigint, schema string, "
    "by_type map<string,bigint>"
)

# Its rows tell how many days the events span.
_DAILY = "agg_daily_type"

# Independent tables written at the same time, so that small jobs share the cluster.
_WRITERS = 8


@dataclass(frozen=True)
class Written:
    """A written table: its row count, its rows of each event type, and its file schema."""

    rows: int
    by_type: dict[str, int]
    schema: T.StructType


def prepare(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    zone: str = LOCAL_ZONE,
    by_name: bool = False,
    price_type: str = "double",
) -> "Store":
    """Build a whole store from the ``events_part_*.csv`` files of a folder.

    The text is parsed once: typed events are written as they come, and sampled and sorted from
    those files, which are removed afterwards.
    """
    raw = read_raw_events(spark, f"{in_dir}/events_part_*.csv", by_name)
    typed, rows = write_once(clean_events(raw, zone, price_type), f"{out_dir}/typed")
    store = build_store(typed, out_dir, rows=rows)
    remove(spark, f"{out_dir}/typed")
    return store


def build_store(
    events: DataFrame,
    out_dir: str,
    names: tuple[str, ...] = ALL_TABLES,
    rows: int | None = None,
) -> "Store":
    """Write events, the named tables, and last the manifest that makes the store readable."""
    spark = events.sparkSession
    # An earlier manifest must not describe a half-rebuilt store.
    spark.createDataFrame([], _MANIFEST).write.mode("overwrite").json(_manifest_path(out_dir))
    write_by_type(events, f"{out_dir}/events", rows=rows)
    written = write_rollups(read_by_type(spark, f"{out_dir}/events"), out_dir, names)
    write_manifest(spark, out_dir, written)
    return Store(spark, out_dir)


def write_rollups(
    events: DataFrame, out_dir: str, names: tuple[str, ...] = ALL_TABLES
) -> dict[str, Written]:
    """Write the partials of the named tables.

    Finer tables come first; each further table is merged from the smallest one already
    written that holds what it needs, and only those without such a table scan the events.
    """
    spark = events.sparkSession
    wanted = [BY_NAME[name] for name in dict.fromkeys(names)]
    written: dict[str, Written] = {}

    def write(table: Rollup) -> tuple[str, Written]:
        merged = _merged_from_written(spark, out_dir, table, written)
        df, at_most = merged or (partials(events, table), None)
        path = _table_path(out_dir, table.name)
        return table.name, Written(*write_table(df, path, stored_order(table), at_most))

    with ThreadPoolExecutor(_WRITERS) as pool:
        for _, level in groupby(sorted(wanted, key=_level), key=_level):
            written.update(list(pool.map(write, level)))
    return written


def _level(table: Rollup) -> tuple[bool, bool, int]:
    """Bases first, then tables with more keys before tables with fewer, sets before others."""
    return table not in BASES, table not in SETS, -len(table.keys)


def _merged_from_written(
    spark: SparkSession, out_dir: str, table: Rollup, written: dict[str, Written]
) -> tuple[DataFrame, int] | None:
    """A table merged from tables already written and a bound on its rows; or None."""

    def read(name: str) -> DataFrame:
        return read_table(spark, _table_path(out_dir, name), written[name].schema)

    if table is GLOBAL_STATS:
        if not all(name in written for name in GLOBAL_STATS_PARENTS):
            return None
        return global_stats({name: read(name) for name in GLOBAL_STATS_PARENTS}), 1
    finer = [n for n in written if derives_from(table, BY_NAME[n])]
    if not finer:
        return None
    smallest = min(finer, key=lambda n: written[n].rows)
    return merge(read(smallest), BY_NAME[smallest], table), max(1, written[smallest].rows)


def write_manifest(spark: SparkSession, out_dir: str, written: dict[str, Written]) -> None:
    """One JSON row per table, per event type and for the events as a whole."""
    events = read_by_type(spark, f"{out_dir}/events")
    counts = "agg_type_counts"
    if counts in written:
        by_type = read_table(spark, _table_path(out_dir, counts), written[counts].schema)
    else:
        by_type = partials(events, BY_NAME[counts])
    types = by_type.select(
        F.lit("type").alias("kind"), F.col("type").alias("name"), "type",
        F.col("n_events").alias("rows"),
    )
    days = by_type.sparkSession.range(0).select(F.lit(0).alias("n"))
    if _DAILY in written:
        daily = read_table(spark, _table_path(out_dir, _DAILY), written[_DAILY].schema)
        days = daily.agg(F.count_distinct("day").alias("n"))
    rows = [("events", "events", None, [], events.count(), None, None)]
    rows += [("days", "days", None, [], r["n"], None, None) for r in days.collect()]
    for name, table in written.items():
        kind = "sets" if BY_NAME[name] in SETS else "base" if BY_NAME[name] in BASES else "rollup"
        keys = list(BY_NAME[name].keys)
        about = (table.rows, table.schema.json(), table.by_type)
        rows.append((kind, name, BY_NAME[name].type, keys, *about))
    (
        spark.createDataFrame(rows, _MANIFEST)
        .unionByName(types, allowMissingColumns=True)
        .coalesce(1)  # some sixty short rows
        .write.mode("overwrite")
        .json(_manifest_path(out_dir))
    )


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(_manifest_path(out_dir))


def read_rollup(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A stored table with its reported columns; filters on it reach the Parquet scan."""
    return public_table(read_table(spark, _table_path(out_dir, name)), BY_NAME[name])


class Store:
    """A written store, opened for reading. Tables are opened once and stay lazy."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        known = read_manifest(spark, path).where(
            (F.col("kind") != "type") | F.col("name").isin(*EVENT_TYPES)
        )
        entries = known.collect()  # at most one per table and known type
        self._rows = {(e["kind"], e["name"]): e["rows"] for e in entries}
        if ("events", "events") not in self._rows:
            raise ValueError(f"the store at {path} was not finished")
        self._schemas = {
            e["name"]: T.StructType.fromJson(json.loads(e["schema"]))
            for e in entries if e["schema"]
        }
        self._by_type = {e["name"]: e["by_type"] or {} for e in entries}
        self._open: dict[str, DataFrame] = {}

    @property
    def tables(self) -> dict[str, int]:
        """Stored tables and their row counts."""
        return {n: rows for (kind, n), rows in self._rows.items() if kind in ("rollup", "base")}

    @property
    def sets(self) -> dict[str, int]:
        """Stored tables of sets of ids and their row counts."""
        return {n: rows for (kind, n), rows in self._rows.items() if kind == "sets"}

    @property
    def days(self) -> int:
        """How many days the events span; 0 if that is not known."""
        return self._rows.get(("days", "days"), 0)

    def table_rows(self, name: str, event_type: str | None = None) -> int:
        """Rows of a stored table, or those of one event type where it tells types apart."""
        whole = (self.tables | self.sets)[name]
        return self._by_type[name].get(event_type, whole) if event_type else whole

    def event_rows(self, event_type: str | None = None) -> int:
        """Rows that a scan of one type's events, or of all, has to read."""
        everything = self._rows["events", "events"]
        if event_type is None:
            return everything
        return self._rows.get(("type", event_type), everything)

    def events(self) -> DataFrame:
        return self._opened("events", lambda: read_by_type(self.spark, f"{self.path}/events"))

    def partials(self, name: str) -> DataFrame:
        if name not in self.tables | self.sets:
            raise ValueError(f"table {name!r} is not in the store at {self.path}")
        path = _table_path(self.path, name)
        return self._opened(name, lambda: read_table(self.spark, path, self._schemas[name]))

    def rollup(self, name: str) -> DataFrame:
        return public_table(self.partials(name), BY_NAME[name])

    def _opened(self, name: str, read) -> DataFrame:
        if name not in self._open:
            self._open[name] = read()
        return self._open[name]


def _table_path(out_dir: str, name: str) -> str:
    return f"{out_dir}/rollups/{name}"


def _manifest_path(out_dir: str) -> str:
    return f"{out_dir}/manifest"
