"""Specs over events: predicates, aggregates, order, and refusing what cannot be meant."""

import statistics
from datetime import date, datetime

import pytest
from helpers import CLICKS, IMPRESSIONS, condition, plan_text, rows
from pyspark.sql import functions as F

from bidmill import run_spec
from bidmill.operators.aggregates import Aggregate

ROWS = [
    ("2024-01-03 10:00", "impression", 1, 1, 0.1, None, "US"),
    ("2024-01-03 10:05", "impression", 1, 2, 0.2, None, None),
    ("2024-01-04 00:00", "impression", 2, 1, 0.3, None, "GB"),
    ("2024-01-07 23:59", "click", 2, 1, None, None, "O'Br\\ien"),
    ("2024-01-08 00:00", "click", 3, None, None, None, "US"),
    ("2024-02-01 12:30", "purchase", 1, 1, None, 5.0, "US"),
    ("2024-02-01 12:30", "purchase", 1, 1, None, None, "US"),
    (None, "swipe", None, 9, None, None, "FR"),
]


@pytest.fixture(scope="module")
def small(tiny):
    return tiny(ROWS).cache()


def _count(df, *where):
    return rows(run_spec(df, {"select": [{"COUNT": "*"}], "where": list(where)}))[0][0]


@pytest.mark.parametrize(
    ("col", "op", "val", "matches"),
    [
        ("country", "eq", "US", 4), ("country", "neq", "US", 3), ("country", "eq", "O'Br\\ien", 1),
        ("country", "eq", "x' OR '1'='1", 0), ("country", "in", ["US", "FR"], 5),
        ("country", "in", [] , 0), ("country", "gte", "US", 4),
        ("advertiser_id", "eq", 1, 4), ("advertiser_id", "eq", "1", 4),
        ("advertiser_id", "eq", 1.5, 0), ("advertiser_id", "lt", 1.5, 4),
        ("advertiser_id", "between", [2, 3], 3), ("advertiser_id", "in", (1, 3), 5),
        ("advertiser_id", "gt", 10**12, 0),
        ("bid_price", "gte", 0.2, 2), ("bid_price", "between", [0.1, 0.2], 2),
        ("bid_price", "in", [0.1, 0.3], 2), ("total_price", "lte", 5, 1),
        ("day", "eq", "2024-01-03", 2), ("day", "eq", date(2024, 1, 3), 2),
        ("day", "eq", "2024-01-03 10:00", 0), ("day", "neq", "2024-01-03", 5),
        ("day", "lt", "2024-01-04", 2), ("day", "lte", "2024-01-04", 3),
        ("day", "in", ["2024-01-03", "2024-02-01"], 4),
        ("day", "between", ["2024-01-03", "2024-01-07"], 4),
        ("week", "eq", "2024-01-01", 4), ("week", "gt", "2024-01-01", 3),
        ("week", "lt", "2024-01-08", 4), ("week", "lte", "2024-01-02", 4),
        ("week", "in", ["2024-01-01", "2024-01-29"], 6),
        ("hour", "eq", "2024-01-03 10:00:00", 2), ("hour", "gt", datetime(2024, 1, 4), 4),
        ("minute", "lt", "2024-01-03 10:05", 1), ("minute", "gte", "2024-01-08", 3),
        ("month", "eq", "2024-01-01", 5), ("month", "between", ["2024-01-15", "2024-02-01"], 2),
        ("weekday", "eq", 0, 1), ("weekday", "in", [3, 4], 5),
    ],
)
def test_predicates(small, col, op, val, matches):
    assert _count(small, condition(col, op, val)) == matches


def test_two_conditions_on_one_column_both_hold(small):
    between = condition("advertiser_id", "gte", 2), condition("advertiser_id", "lt", 3)
    assert _count(small, *between) == 2


@pytest.mark.parametrize(
    "bad",
    [
        condition("country", "like", "U%"), condition("nothing", "eq", 1),
        condition("country", "eq", 5), condition("country", "eq", None),
        condition("advertiser_id", "eq", "x"), condition("advertiser_id", "eq", True),
        condition("bid_price", "lt", "NaN"), condition("day", "eq", "someday"),
        condition("day", "lt", 7), condition("day", "eq", "2024-01-01T00:00:00+01:00"),
        condition("day", "between", ["2024-01-01"]), condition("country", "in", "US"),
    ],
)
def test_bad_conditions_are_refused(small, bad):
    with pytest.raises(ValueError):
        _count(small, bad)


@pytest.mark.parametrize(
    "bad",
    [
        {"select": []}, {"select": ["country"], "limit": 3},
        {"select": ["country", {"COUNT": "*"}]},
        {"select": ["country"], "group_by": ["day"]},
        {"select": [{"SUM": "country"}]}, {"select": [{"SUM": "*"}]},
        {"select": [{"NOSUCH": "bid_price"}]}, {"select": [{"SUM": "nothing"}]},
        {"select": [{"MEDIAN": "nothing"}]}, {"select": [{"MEDIAN": "country"}]},
        {"select": ["nothing"]}, {"select": ["country"], "group_by": ["country", "nothing"]},
        {"select": ["country"], "order_by": [{"col": "country", "dir": "up"}]},
        {"select": ["country"], "group_by": ["country"], "order_by": [{"col": "day"}]},
    ],
)
def test_bad_specs_are_refused(small, bad):
    with pytest.raises(ValueError):
        run_spec(small, bad)


def test_no_match_still_gives_one_row(small):
    spec = {
        "select": [{"COUNT": "*", "SUM": "total_price"}, {"AVG": "total_price"}],
        "where": [condition("advertiser_id", "eq", 999999)],
    }
    assert rows(run_spec(small, spec)) == [(0, None, None)]


def test_names_follow_the_select_list(small):
    spec = {"select": ["country", {"count": "*"}, {"Sum": "bid_price"}, {"COUNT": "distinct day"}],
            "group_by": ["country"]}
    assert run_spec(small, spec).columns == [
        "country", "COUNT(*)", "sum(bid_price)", "count(DISTINCT day)",
    ]
    assert Aggregate.from_text("Sum( bid_price )").label == "sum(bid_price)"


def test_sums_are_exact(small):
    spec = {"select": [{"SUM": "bid_price"}, {"AVG": "bid_price"}], "where": [IMPRESSIONS]}
    assert rows(run_spec(small, spec)) == [(0.6, 0.6 / 3)]


def test_null_keys_are_a_group(small):
    spec = {"select": ["publisher_id", {"COUNT": "*"}], "where": [CLICKS],
            "group_by": ["publisher_id"], "order_by": [{"col": "publisher_id"}]}
    assert rows(run_spec(small, spec)) == [(1, 1), (None, 1)]


def test_nulls_last_in_both_directions(small):
    spec = {"select": ["country"], "group_by": ["country"], "order_by": [{"col": "country"}]}
    assert rows(run_spec(small, spec)) == [("FR",), ("GB",), ("O'Br\\ien",), ("US",), (None,)]
    spec["order_by"] = [{"col": "country", "dir": "desc"}]
    assert rows(run_spec(small, spec)) == [("US",), ("O'Br\\ien",), ("GB",), ("FR",), (None,)]


def test_first_sort_key_leads(small):
    spec = {
        "select": ["advertiser_id", "country", {"COUNT": "*"}],
        "group_by": ["advertiser_id", "country"],
        "order_by": [{"col": "COUNT(*)", "dir": "desc"}, {"col": "advertiser_id"},
                     {"col": "country"}],
    }
    assert rows(run_spec(small, spec)) == [
        (1, "US", 3), (1, None, 1), (2, "GB", 1), (2, "O'Br\\ien", 1), (3, "US", 1),
        (None, "FR", 1),
    ]


def test_ties_are_settled_by_the_group_keys(small):
    spec = {"select": ["publisher_id", "type"], "group_by": ["publisher_id", "type"],
            "order_by": [{"col": "publisher_id", "dir": "desc"}]}
    assert rows(run_spec(small, spec)) == [
        (9, "swipe"), (2, "impression"), (1, "click"), (1, "impression"), (1, "purchase"),
        (None, "click"),
    ]


@pytest.mark.parametrize("grouped", [True, False])
def test_rows_with_one_sort_value_are_cut_into_ranges(spark, grouped):
    many = spark.range(0, 40_000, 1, 8).selectExpr(
        "'click' AS type", "cast(id AS int) AS advertiser_id"
    )
    spec = {"select": ["type", "advertiser_id"], "order_by": [{"col": "type"}]}
    if grouped:
        spec["group_by"] = spec["select"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = run_spec(many, spec)
        parts = result.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts) == 40_000 and max(parts) < 15_000


@pytest.mark.parametrize("written", ["SUM(bid_price)", "sum(bid_price)"])
def test_order_by_an_aggregate_that_is_not_selected(small, written):
    spec = {"select": ["publisher_id"], "group_by": ["publisher_id"], "where": [IMPRESSIONS],
            "order_by": [{"col": written, "dir": "desc"}]}
    assert rows(run_spec(small, spec)) == [(1,), (2,)]


def test_plain_rows_keep_copies_and_order(small):
    spec = {"select": ["type", "total_price"], "where": [condition("type", "eq", "purchase")],
            "order_by": [{"col": "total_price"}]}
    assert rows(run_spec(small, spec)) == [("purchase", 5.0), ("purchase", None)]
    assert run_spec(small, {"select": ["*"]}).columns == small.columns


def test_spread_and_distinct_counts(small):
    spec = {"select": [{"STDDEV": "bid_price"}, {"VARIANCE": "bid_price"},
                       {"APPROX_COUNT_DISTINCT": "country"}]}
    spread, variance, about = rows(run_spec(small, spec))[0]
    assert spread == pytest.approx(0.1) and variance == pytest.approx(0.01) and about == 4


def test_medians_match_brute_force(spark, tiny):
    values = [(i * 7919) % 1009 / 8 for i in range(3000)]
    copies = [5.0] * 1500  # a third of all rows is one value, in one group
    data = [("2024-01-01", "click", i % 3, 1, v, None, "A" if i % 5 else None)
            for i, v in enumerate(values)]
    data += [("2024-01-01", "click", 0, 1, v, None, "A") for v in copies]
    data += [("2024-01-01", "click", 9, 1, None, None, "A")]
    df = tiny(data)
    for keys in ((), ("country",), ("advertiser_id", "country")):
        groups = {}
        for _, _, adv, _, bid, _, country in data:
            key = tuple({"country": country, "advertiser_id": adv}[k] for k in keys)
            groups.setdefault(key, []).append(bid)
        expected = {
            key: (statistics.median(bids) if (bids := [b for b in g if b is not None]) else None,
                  len(g))
            for key, g in groups.items()
        }
        spec = {"select": [*keys, {"MEDIAN": "bid_price"}, {"COUNT": "*"}], "group_by": list(keys)}
        found = {tuple(r[:-2]): tuple(r[-2:]) for r in rows(run_spec(df, spec))}
        assert found == expected


def test_median_of_nothing(small):
    spec = {"select": [{"MEDIAN": "bid_price"}], "where": [condition("type", "eq", "none")]}
    assert rows(run_spec(small, spec)) == [(None,)]


def test_no_session_zone_in_time_filters(small, spark):
    """02:30 does not exist in the session's zone on this day, and is still found."""
    late = small.limit(1).withColumn("minute", F.expr("timestamp_ntz'2024-03-31 02:30:00'"))
    spec = {"select": ["minute"], "where": [condition("minute", "eq", "2024-03-31 02:30")]}
    frame = late.drop("hour", "day", "week")
    assert rows(run_spec(frame, spec)) == [(datetime(2024, 3, 31, 2, 30),)]
    spec = {"select": ["hour", {"COUNT": "*"}], "group_by": ["hour"]}
    assert rows(run_spec(frame, spec)) == [(datetime(2024, 3, 31, 2), 1)]


def test_only_needed_columns_are_read(spark):
    from conftest import SF_DIR

    from bidmill import ad_events

    spec = {"select": ["type", {"COUNT": "*"}], "group_by": ["type"]}
    plan = plan_text(run_spec(ad_events(spark, SF_DIR), spec))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
