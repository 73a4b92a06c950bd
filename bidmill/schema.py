"""Column layout of raw and typed ad events."""

from pyspark.sql import types as T

# Raw CSV columns (all text), event types, and the zone of the local time keys.
RAW_COLUMNS = (
    "ts", "type", "auction_id", "advertiser_id", "publisher_id",
    "bid_price", "user_id", "total_price", "country",
)
EVENT_TYPES = ("impression", "click", "purchase", "serve")
LOCAL_ZONE = "America/Los_Angeles"

EVENT_COLUMNS = (
    "ts", "week", "day", "hour", "minute", "type",
    "advertiser_id", "publisher_id", "bid_price", "total_price", "country",
)
PRICES = ("bid_price", "total_price")

# Where a row stood in its source, if it was dealt to another task since; not a column of events.
POSITION = "_position"

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


def event_schema(price_type: T.DataType | None = None) -> T.StructType:
    """Schema of typed events; prices are doubles unless another type is asked for."""
    price = price_type or T.DoubleType()
    by_name = {
        "ts": T.TimestampType(),
        "type": T.StringType(),
        "country": T.StringType(),
        "advertiser_id": T.IntegerType(),
        "publisher_id": T.IntegerType(),
        "bid_price": price,
        "total_price": price,
    }
    return T.StructType(
        [T.StructField(name, by_name.get(name, T.TimestampNTZType())) for name in EVENT_COLUMNS]
    )
