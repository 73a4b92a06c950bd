"""Prices and times far from the usual ones, and headers and paths that differ."""

import pytest

from bidmill import clean_events, read_raw_events, run_spec
from bidmill.operators.rollups import BY_NAME, merge, partials, public_table
from bidmill.schema import RAW_COLUMNS
from helpers import condition, rows

TOTALS = {"select": [{"SUM": "bid_price"}, {"AVG": "bid_price"}, {"COUNT": "bid_price"}]}


def _raw(spark, values):
    """Raw rows from dicts of column values."""
    text = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame([tuple(v.get(c) for c in RAW_COLUMNS) for v in values], text)


def _prices(spark, prices):
    return clean_events(_raw(spark, [{"ts": "1705000000000", "type": "impression", "country": "US", "bid_price": p} for p in prices]))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("prices", "total"),
    [(["2e-11", "2e-11"], 4e-11), (["1e19", "1"], 1e19 + 1), (["0.1", "0.2", ""], 0.3), (["1e300", "0.1"], 1e300)],
)
def test_sums_lose_no_price(spark, prices, total, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        events = _prices(spark, prices)
        n = sum(p != "" for p in prices)
        [(found, mean, count)] = rows(run_spec(events, TOTALS))
        assert (found, mean, count) == (pytest.approx(total), pytest.approx(total / n), n)
        fine, coarse = BY_NAME["base_minute"], BY_NAME["agg_impressions_summary"]
        for part in (partials(events, coarse), merge(partials(events, fine), fine, coarse)):
            [row] = public_table(part, coarse).collect()
            assert (row.sum_bid_price, row.avg_bid_price) == (pytest.approx(total), pytest.approx(total / n))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_decimal_price_type_drops_no_digits(spark):
    raw = _raw(spark, [{"bid_price": "1.2345678"}])
    with pytest.raises(Exception, match="not a price"):
        clean_events(raw, price_type="decimal(18,6)").collect()
    assert clean_events(_raw(spark, [{"bid_price": "1.234500"}]), price_type="decimal(18,4)").count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_times_that_do_not_fit_are_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        events = clean_events(_raw(spark, [{"ts": t} for t in ("99999999999999999", "1705000000000000000", "1e30", "-1e30", "1705000000000")]))
        assert [r.ts is None for r in events.collect()] == [True, True, True, True, False]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("col", ["week", "month"])
def test_open_ended_filters(spark, col):
    events = _prices(spark, ["1"])
    for where in (condition(col, "lte", "9999-12-31"), condition(col, "between", ["2000-01-01", "9999-12-31"])):
        assert rows(run_spec(events, {"select": [{"COUNT": "*"}], "where": [where]})) == [(1,)]


def test_time_filters_do_not_follow_the_session(spark):
    events = _prices(spark, ["1"])  # 2024-01-11 19:06:40 UTC
    spec = {"select": [{"COUNT": "*"}], "where": [condition("ts", "gte", "2024-01-11 19:00:00"), condition("ts", "lt", "2024-01-11 19:30:00")]}
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert rows(run_spec(events, spec)) == [(1,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_headers_in_other_case_and_paths_with_blanks(spark, tmp_path):
    folder = tmp_path / "c d"
    folder.mkdir()
    (folder / "events_part_0.csv").write_text("TS,TYPE,COUNTRY\n1705000000000,click,US\n")
    (folder / "events_part_[1].csv").write_text("country,ts,type\nDE,1705000000000,serve\n")
    found = read_raw_events(spark, str(folder), by_name=True).select("ts", "type", "country")
    assert sorted(rows(found)) == [("1705000000000", "click", "US"), ("1705000000000", "serve", "DE")]


@pytest.mark.parametrize("header", ["ts,TS,type", "a,b"])
def test_bad_headers_fail(spark, tmp_path, header):
    (tmp_path / "events_part_0.csv").write_text(header + "\n")
    with pytest.raises(ValueError, match="header"):
        read_raw_events(spark, str(tmp_path), by_name=True)
