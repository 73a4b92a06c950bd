import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A session zone with its own clock changes: no result may depend on it.
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "5000")  # whole pushed filters in plan text
        .config("spark.sql.session.timeZone", "Europe/Berlin")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    from bidmill import ad_events

    # The filter keeps other queries on the same files from reading this cached copy.
    return ad_events(spark, SF_DIR).where("1 = 1").cache()


@pytest.fixture(scope="session")
def store(spark):
    from bidmill.checks import workspace

    return workspace.store(spark, SF_DIR)


@pytest.fixture(scope="session")
def tiny(spark):
    """Hand-made typed events from rows of (minute, type, adv, pub, bid, total, country)."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from bidmill.functions.timekeys import time_key
    from bidmill.schema import EVENT_COLUMNS

    schema = (
        "minute timestamp_ntz, type string, advertiser_id int, publisher_id int, "
        "bid_price double, total_price double, country string"
    )

    def build(rows):
        rows = [(datetime.fromisoformat(r[0]) if r[0] else None, *r[1:]) for r in rows]
        df = spark.createDataFrame(rows, schema)
        keys = [f"{time_key(k, 'minute')} AS {k}" for k in ("week", "day", "hour")]
        return df.selectExpr("*", "cast(NULL AS timestamp) AS ts", *keys).select(
            *[F.col(c) for c in EVENT_COLUMNS]
        )

    return build
