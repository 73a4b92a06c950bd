"""Ad events derived from the star-schema test tables ``events`` and ``nation``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.schema import LOCAL_ZONE, POSITION, RAW_COLUMNS
from bidmill.sources.csv_events import add_time_keys

# The file holds naive UTC times; read as instants they need no further conversion.
_EVENTS = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)
_NATION = "n_nationkey int, n_name string"

# Names of the raw columns, worked out from both tables.
_JOINED = (
    "event_id",
    "ts",
    "user_id",
    "CASE event_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'serve'"
    " ELSE event_type END AS type",
    "get_json_object(props, '$.k') AS publisher_id",
    "CASE WHEN event_type IN ('view', 'signup')"
    " THEN cast(value AS decimal(18,2)) END AS bid_price",
    "CASE WHEN event_type = 'purchase' AND event_id % 7 <> 0"
    " THEN cast(value AS decimal(18,2)) END AS total_price",
    "CASE WHEN event_id % 31 <> 0 THEN n_name END AS country",
)


def ad_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Typed ad events, one per row of the ``events`` table, with decimal prices.

    With ``spread``, rows are dealt to all tasks before they are typed, so that a file of few row
    groups is not left to as few tasks. Rows keep their position in the file for ``write_by_type``.
    """
    position = [POSITION] if spread else []
    typed = _joined(spark, sf_dir, spread).selectExpr(
        "ts", "type", "cast(user_id AS int) AS advertiser_id",
        "cast(publisher_id AS int) AS publisher_id", "bid_price", "total_price", "country", *position,
    )
    return add_time_keys(typed, LOCAL_ZONE)


def raw_ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a raw CSV would hold them: nine text columns."""
    text = _joined(spark, sf_dir).selectExpr(
        "unix_millis(ts) AS ts", "type", "concat('a', event_id) AS auction_id",
        "user_id AS advertiser_id", "publisher_id", "bid_price", "user_id", "total_price",
        "country",
    )
    return text.selectExpr(*[f"cast({c} AS string) AS {c}" for c in RAW_COLUMNS])


def _joined(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")
    if spread:
        events = events.withColumn(POSITION, F.monotonically_increasing_id()).repartition(POSITION)
    nation = spark.read.schema(_NATION).parquet(f"{sf_dir}/nation.parquet")
    # No broadcast hint: Spark broadcasts nation only if its size is under the threshold.
    joined = events.join(nation, F.expr("n_nationkey = event_id % 25"), "left")
    return joined.selectExpr(*_JOINED, *([POSITION] if spread else []))
