"""Raw event CSV files: scan, and typing into ad events."""

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.functions.casts import epoch_millis, lenient_int, strict_number
from bidmill.functions.timekeys import local_time, time_key
from bidmill.schema import EVENT_COLUMNS, LOCAL_ZONE, POSITION, RAW_COLUMNS, RAW_SCHEMA


# Files whose first lines are read at the same time.
_OPENED = 32


def read_raw_events(spark: SparkSession, path: str, by_name: bool = False) -> DataFrame:
    """All raw columns as text from the CSV files at ``path`` (a folder or a glob).

    Columns are taken by position unless ``by_name`` is set; then each file's own header
    decides, in any case of letters, and columns a file lacks are NULL; only the first line
    of each file is read beforehand. A row of the wrong width, a header that names a column
    twice and one without any known column fail the job.
    """
    if not by_name:
        return _reader(spark).schema(RAW_SCHEMA).csv(path)
    parts = [
        _reader(spark).schema(_text_schema(header)).csv(files)
        for header, files in _files_by_header(spark, path).items()
    ]
    if not parts:
        return _reader(spark).schema(RAW_SCHEMA).csv(path)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = {c: F.lit(None).cast("string") for c in RAW_COLUMNS if c not in whole.columns}
    return whole.withColumns(absent).select(*RAW_COLUMNS)


def clean_events(
    raw: DataFrame, zone: str = LOCAL_ZONE, price_type: str = "double"
) -> DataFrame:
    """Typed events with local week, day, hour and minute; auction and user ids are dropped.

    Bad times and ids become NULL, a bad price fails the job. A decimal ``price_type``
    (such as ``decimal(18,6)``) makes later price sums about three times faster, as doubles
    are turned into decimals every time they are summed.
    """
    typed = raw.select(
        epoch_millis(F.col("ts")).alias("ts"),
        "type",
        lenient_int(F.col("advertiser_id")).alias("advertiser_id"),
        lenient_int(F.col("publisher_id")).alias("publisher_id"),
        strict_number(F.col("bid_price"), price_type).alias("bid_price"),
        strict_number(F.col("total_price"), price_type).alias("total_price"),
        "country",
    )
    return add_time_keys(typed, zone)


def add_time_keys(typed: DataFrame, zone: str) -> DataFrame:
    """Events with the time keys of ``ts`` in ``zone``, in event column order; positions stay."""
    keys = [f"{time_key(key, '_local')} AS {key}" for key in ("week", "day", "hour", "minute")]
    timed = typed.selectExpr("*", f"{local_time('ts', zone)} AS _local")
    position = [POSITION] if POSITION in typed.columns else []
    return timed.selectExpr("*", *keys).select(*EVENT_COLUMNS, *position)


def _reader(spark: SparkSession):
    # Pruned CSV columns are not checked for row width, so pruning is off.
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
    )


def _text_schema(header: tuple[str, ...]) -> T.StructType:
    """The columns of a header, known ones under their own names."""
    known = {name.lower(): name for name in RAW_COLUMNS}
    names = [known.get(name.lower(), name) for name in header]
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"a header names a column twice: {header}")
    if not set(names) & set(RAW_COLUMNS):
        raise ValueError(f"a header has no known column: {header}")
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """File paths by header. Of each file one line is read, as by a reader that takes names from it."""
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(_OPENED) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            header = tuple(name.strip().strip('"') for name in line.split(","))
            out.setdefault(header, []).append(_as_path(file))
    return out


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file in any file system and with any known compression."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()
    return line and line.removeprefix("\ufeff")


def _as_path(uri: str) -> str:
    """A file's URI as a path that a reader takes literally."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", unquote(uri))
