"""Parquet layout: events split by type and sorted, and day-like keys kept as dates.

Parquet row groups are skipped on DATE statistics but not on TIMESTAMP_NTZ ones, so day,
week and month are stored as DATE and read back as naive midnights. Catalyst turns a
comparison on the read-back column into one on the stored date.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.functions.timekeys import NTZ
from bidmill.schema import EVENT_TYPES, POSITION

DATE_KEYS = ("week", "day", "month")

SORT_KEYS = ("type", "day", "country", "advertiser_id")

# Rows of pre-aggregated tables in each file, some 100 MB.
ROWS_PER_FILE = 1_000_000

# Rows of events in each range of their order; each type of a range has its own file.
ROWS_PER_RANGE = 4_000_000

# Ids have Bloom filters in event files: the order of the files does not help to find an id on all days.
_ID_FILTERS = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.enabled#advertiser_id": "true",
    "parquet.bloom.filter.enabled#publisher_id": "true",
}


def write_once(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The frame written as it comes and read back, and its row count."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_by_type(
    events: DataFrame, path: str, mode: str = "overwrite", rows: int | None = None
) -> None:
    """Write events to ``path/type=...`` in the order of day, country and advertiser.

    Rows are range-partitioned, so each file covers a short stretch of that order and a
    filter on day (and country) leaves most files and row groups unread. The row position
    comes last in the range key: equal keys, even whole copies of one row, may then fall
    into different ranges, and no hot group has to fit into one task. Positions repeat when
    a task is run again as long as ``events`` starts from files, not from another shuffle; rows that
    were dealt out since bring theirs in the column ``POSITION``.
    Events of any type are kept, NULL included. With the number of ``rows`` known, the number of
    ranges follows from it; otherwise it is that of the session's shuffles.
    """
    ranges = []
    if rows is not None:
        at_least = min(events.sparkSession.sparkContext.defaultParallelism, -(-rows // 10_000))
        ranges = [max(1, at_least, -(-rows // ROWS_PER_RANGE))]
    placed = _dates_stored(events)
    if POSITION not in events.columns:
        placed = placed.withColumn(POSITION, F.monotonically_increasing_id())
    (
        placed.repartitionByRange(*ranges, *SORT_KEYS, POSITION)
        .sortWithinPartitions(*SORT_KEYS)
        .drop(POSITION)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")  # no folder of an earlier write survives
        .options(**_ID_FILTERS)
        .partitionBy("type")
        .parquet(path)
    )


def read_by_type(spark: SparkSession, path: str, event_type: str | None = None) -> DataFrame:
    """Events of one type (only its folder is read), or of all types."""
    events = spark.read.parquet(path)
    if not isinstance(events.schema["type"].dataType, T.StringType):
        # Type names that all look like numbers: keep them as text.
        fields = [
            T.StructField("type", T.StringType()) if f.name == "type" else f
            for f in events.schema.fields
        ]
        events = spark.read.schema(T.StructType(fields)).parquet(path)
    events = _dates_restored(events)
    return events if event_type is None else events.where(F.col("type") == event_type)


def write_table(
    df: DataFrame, path: str, order: list, at_most: int | None = None
) -> tuple[int, dict[str, int], T.StructType]:
    """Write one pre-aggregated table in the given row order; its row count, its rows of each
    known event type (if it tells types apart), and its file schema.

    The rows are cut into ranges of the order, about one for each ``ROWS_PER_FILE`` of the known
    bound ``at_most`` (without a bound, as many as the session's shuffles have), and counted
    while they are written, not by reading them again.
    """
    stored = _dates_stored(df)
    if order:
        ranges = [] if at_most is None else [max(1, -(-at_most // ROWS_PER_FILE))]
        stored = stored.repartitionByRange(*ranges, *order).sortWithinPartitions(*order)
    seen = Observation()
    kinds = EVENT_TYPES if "type" in df.columns else ()
    typed = [F.count(F.when(F.col("type") == kind, 1)).alias(kind) for kind in kinds]
    counted = stored.observe(seen, F.count(F.lit(1)).alias("rows"), *typed)
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"], {kind: seen.get[kind] for kind in kinds}, stored.schema


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A written table; with its schema given, no file is opened to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _dates_restored(reader.parquet(path))


def _dates_stored(df: DataFrame) -> DataFrame:
    return _cast_date_keys(df, "date")


def _dates_restored(df: DataFrame) -> DataFrame:
    return _cast_date_keys(df, NTZ)


def _cast_date_keys(df: DataFrame, to: str) -> DataFrame:
    casts = {key: F.col(key).cast(to) for key in DATE_KEYS if key in df.columns}
    return df.withColumns(casts) if casts else df
