"""Raw CSV files and their typing."""

from datetime import UTC, datetime

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bidmill import clean_events, read_raw_events
from bidmill.schema import EVENT_COLUMNS, RAW_COLUMNS, event_schema

HEADER = ",".join(RAW_COLUMNS)


def _millis(*args):
    return int(datetime(*args, tzinfo=UTC).timestamp() * 1000)


def _write(folder, name, lines, header=HEADER):
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def _typed(spark, tmp_path, lines, **options):
    _write(tmp_path, "events_part_0.csv", lines)
    return clean_events(read_raw_events(spark, f"{tmp_path}/events_part_*.csv"), **options)


def test_schema_and_dropped_columns(spark, tmp_path):
    events = _typed(spark, tmp_path, ["0,click,a,1,2,,u,,US"])
    assert events.columns == list(EVENT_COLUMNS)
    assert [f.dataType for f in events.schema] == [f.dataType for f in event_schema()]


@pytest.mark.parametrize(
    ("text", "value"),
    [("7", 7), ("12.6", 13), ("12.5", 13), ("-12.5", -13), ("1e3", 1000), (" 12 ", 12), ("", None),
     ("x", None), ("12d", None), ("0x1p3", None), ("inf", None), ("NaN", None),
     ("2147483647", 2147483647), ("2147483647.6", None), ("99999999999", None)],
)
def test_ids_are_cast_leniently(spark, tmp_path, text, value):
    events = _typed(spark, tmp_path, [f"0,click,a,{text},2,,u,,US"])
    assert rows(events.select("advertiser_id")) == [(value,)]


def test_times(spark, tmp_path):
    lines = [f"{t},click,a,1,1,,u,,US" for t in ("1704067200123", "1704067200123.4567", "bad", "")]
    events = _typed(spark, tmp_path, lines).select(F.unix_micros("ts"), "hour")
    start = datetime(2023, 12, 31, 16)
    assert rows(events) == [
        (1704067200123000, start), (1704067200123457, start), (None, None), (None, None),
    ]


def test_local_keys_over_both_clock_changes(spark, tmp_path):
    instants = [
        _millis(2024, 3, 10, 9, 59), _millis(2024, 3, 10, 10, 0),   # 01:59 then 03:00
        _millis(2024, 3, 31, 9, 30),                                # 02:30, a gap elsewhere
        _millis(2024, 11, 3, 8, 30), _millis(2024, 11, 3, 9, 30),   # 01:30 twice
        _millis(2024, 1, 1, 7, 59), _millis(2024, 1, 8, 8, 0),      # Sunday 23:59, Monday 00:00
    ]
    events = _typed(spark, tmp_path, [f"{t},click,a,1,1,,u,,US" for t in instants])
    assert rows(events.select("minute", "hour", "day", "week")) == [
        (datetime(2024, 3, 10, 1, 59), datetime(2024, 3, 10, 1), datetime(2024, 3, 10),
         datetime(2024, 3, 4)),
        (datetime(2024, 3, 10, 3, 0), datetime(2024, 3, 10, 3), datetime(2024, 3, 10),
         datetime(2024, 3, 4)),
        (datetime(2024, 3, 31, 2, 30), datetime(2024, 3, 31, 2), datetime(2024, 3, 31),
         datetime(2024, 3, 25)),
        (datetime(2024, 11, 3, 1, 30), datetime(2024, 11, 3, 1), datetime(2024, 11, 3),
         datetime(2024, 10, 28)),
        (datetime(2024, 11, 3, 1, 30), datetime(2024, 11, 3, 1), datetime(2024, 11, 3),
         datetime(2024, 10, 28)),
        (datetime(2023, 12, 31, 23, 59), datetime(2023, 12, 31, 23), datetime(2023, 12, 31),
         datetime(2023, 12, 25)),
        (datetime(2024, 1, 8, 0, 0), datetime(2024, 1, 8), datetime(2024, 1, 8),
         datetime(2024, 1, 8)),
    ]


def test_other_zone(spark, tmp_path):
    events = _typed(spark, tmp_path, ["0,click,a,1,1,,u,,US"], zone="Asia/Tokyo")
    assert rows(events.select("hour")) == [(datetime(1970, 1, 1, 9),)]


def test_prices(spark, tmp_path):
    lines = ["0,click,a,1,1,,u,1.5,US", '0,click,a,1,1,"",u,1e2,US', "0,click,a,1,1,0.1,u,,US"]
    assert rows(_typed(spark, tmp_path, lines).select("bid_price", "total_price")) == [
        (None, 1.5), (None, 100.0), (0.1, None),
    ]
    decimal = _typed(spark, tmp_path, lines, price_type="decimal(18,6)")
    assert dict(decimal.dtypes)["bid_price"] == "decimal(18,6)"


@pytest.mark.parametrize("price", ["x", "12d", "NaN", "1,5"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_price_fails(spark, tmp_path, price, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        events = _typed(spark, tmp_path, [f'0,click,a,1,1,"{price}",u,,US'])
        with pytest.raises(PySparkException, match="not a price"):
            events.collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_unknown_type_and_null_country_are_kept(spark, tmp_path):
    events = _typed(spark, tmp_path, ["0,swipe,a,1,1,,u,,", "0,,a,1,1,,u,,US"])
    assert rows(events.select("type", "country")) == [("swipe", None), (None, "US")]


def test_quotes_and_commas(spark, tmp_path):
    events = _typed(spark, tmp_path, ['0,click,"a""b",1,1,,u,,"x,y"'])
    assert rows(events.select("country")) == [("x,y",)]


def test_a_short_row_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        _typed(spark, tmp_path, ["0,click,a"]).select("type").collect()


def test_all_parts_are_read_and_others_are_not(spark, tmp_path):
    _write(tmp_path, "events_part_1.csv", ["0,click,a,2,1,,u,,US"])
    _write(tmp_path, "other.csv", ["0,click,a,3,1,,u,,US"])
    events = _typed(spark, tmp_path, ["0,click,a,1,1,,u,,US"])
    assert sorted(rows(events.select("advertiser_id"))) == [(1,), (2,)]


def test_by_name_follows_each_header(spark, tmp_path):
    _write(tmp_path, "events_part_0.csv", ["0,click,a,1,2,0.5,u,,US"])
    turned = tuple(reversed(RAW_COLUMNS))
    _write(tmp_path, "events_part_1.csv", ["GB,9.5,u,,4,3,a,purchase,0"], ",".join(turned))
    _write(tmp_path, "events_part_2.csv", ["serve,5,more"], "type,advertiser_id,extra")
    raw = read_raw_events(spark, f"{tmp_path}/events_part_*.csv", by_name=True)
    assert raw.columns == list(RAW_COLUMNS)
    typed = clean_events(raw).select(
        "type", "advertiser_id", "publisher_id", "bid_price", "total_price", "country"
    )
    assert sorted(rows(typed)) == [
        ("click", 1, 2, 0.5, None, "US"),
        ("purchase", 3, 4, None, 9.5, "GB"),
        ("serve", 5, None, None, None, None),
    ]
