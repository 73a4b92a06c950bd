"""Answers from stored tables equal answers from events."""

import pytest
from helpers import CLICKS, IMPRESSIONS, PURCHASES, condition, plan_text, rows, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bidmill import (
    BASES,
    ROLLUPS,
    answer,
    answer_from_rollup,
    covering_tables,
    rollup,
    rollup_covers,
    run_spec,
)
from bidmill.checks.specs import SPECS

DAILY = {"select": ["day", {"COUNT": "*"}], "group_by": ["day"]}


def _spec(select, *where, group_by=()):
    return {"select": select, "where": list(where), "group_by": list(group_by)}


@pytest.mark.parametrize("table", [r.name for r in ROLLUPS])
def test_stored_table_equals_direct_one(store, events, table):
    stored, direct = store.rollup(table), rollup(events, table)
    assert stored.dtypes == direct.dtypes
    same_rows(stored, direct)


@pytest.mark.parametrize("name", SPECS)
def test_every_covering_table_gives_the_same_answer(store, events, name):
    expected = run_spec(events, SPECS[name])
    for table in covering_tables(store, SPECS[name]):
        same_rows(answer_from_rollup(store, table, SPECS[name]), expected)
    same_rows(answer(store, SPECS[name]), expected)


KEYS = ["type", "country", "advertiser_id", "publisher_id",
        "minute", "hour", "day", "week", "month", "weekday"]
AGGREGATES = [("COUNT", "*"), ("COUNT", "bid_price"), ("COUNT", "country"), ("SUM", "bid_price"),
              ("SUM", "total_price"), ("AVG", "bid_price"), ("AVG", "total_price"),
              ("MIN", "bid_price"), ("MAX", "total_price"), ("MIN", "day"), ("MAX", "hour"),
              ("COUNT", "DISTINCT country"), ("COUNT", "DISTINCT day"),
              ("COUNT", "DISTINCT advertiser_id"), ("APPROX_COUNT_DISTINCT", "publisher_id")]
CONDITIONS = [IMPRESSIONS, CLICKS, PURCHASES, condition("type", "neq", "impression"),
              condition("type", "in", ["click", "serve"]), condition("country", "eq", "NATION_3"),
              condition("country", "neq", "NATION_7"), condition("advertiser_id", "lt", 8),
              condition("publisher_id", "between", [10, 60]), condition("day", "gte", "2024-01-20"),
              condition("week", "eq", "2024-01-08"), condition("hour", "lt", "2024-01-09 12:00"),
              condition("month", "eq", "2024-01-01"), condition("weekday", "in", [0, 6]),
              condition("bid_price", "gt", 10)]


@settings(max_examples=25, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.sampled_from(KEYS), max_size=2, unique=True),
    aggregates=st.lists(st.sampled_from(AGGREGATES), max_size=3, unique=True),
    where=st.lists(st.sampled_from(CONDITIONS), max_size=2, unique_by=str),
)
def test_any_spec_has_one_answer(store, events, keys, aggregates, where):
    if not keys and not aggregates:
        aggregates = [("COUNT", "*")]
    spec = _spec([*keys, *({f: c} for f, c in aggregates)], *where, group_by=keys)
    expected = run_spec(events, spec)
    same_rows(answer(store, spec), expected)
    for table in covering_tables(store, spec)[:3]:
        same_rows(answer_from_rollup(store, table, spec), expected)


def test_rows_that_are_groups_are_not_shuffled(store):
    direct = _spec(["minute", {"SUM": "bid_price"}], IMPRESSIONS,
                   condition("day", "eq", "2024-01-10"), group_by=["minute"])
    for table in ("agg_minute_impressions", "agg_daily_minute_impressions"):
        assert "Exchange" not in plan_text(answer_from_rollup(store, table, direct))
    # The table that stores the filtered day is taken, and the day reaches its scan.
    assert covering_tables(store, direct)[0] == "agg_daily_minute_impressions"
    assert "EqualTo(day,2024-01-10)" in plan_text(answer(store, direct))
    merged = _spec(["week", {"SUM": "bid_price"}], IMPRESSIONS, group_by=["week"])
    assert "Exchange" in plan_text(answer_from_rollup(store, "agg_daily_impressions", merged))


def test_distinct_counts_of_single_rows(store, events):
    spec = _spec(["country", {"COUNT": "DISTINCT country"}, {"COUNT": "country"},
                  {"APPROX_COUNT_DISTINCT": "country"}, {"MIN": "country"}, {"AVG": "bid_price"}],
                 IMPRESSIONS, group_by=["country"])
    found = answer_from_rollup(store, "agg_country_impressions", spec)
    assert "Exchange" not in plan_text(found)
    assert found.dtypes == run_spec(events, spec).dtypes
    same_rows(found, run_spec(events, spec))


def test_total_of_a_time_range_is_one_row(store):
    assert len(rows(answer(store, SPECS["q01"]))) == 1


def test_zero_matches_give_a_zero(store):
    spec = _spec([{"COUNT": "*"}, {"SUM": "bid_price"}], IMPRESSIONS,
                 condition("country", "eq", "NOWHERE"))
    assert covering_tables(store, spec)
    assert rows(answer(store, spec)) == [(0, None)]


def test_clicks_per_day_of_a_country_are_only_clicks(store, events):
    assert "agg_country_type_daily" in covering_tables(store, SPECS["q13"])
    assert rows(answer_from_rollup(store, "agg_country_type_daily", SPECS["q13"])) == rows(
        run_spec(events, SPECS["q13"])
    )


def test_no_type_condition_means_all_types(store):
    tables = covering_tables(store, DAILY)
    assert "agg_daily_type" in tables and "agg_daily_impressions" not in tables


def test_other_type_operators_do_not_pick_a_one_type_table():
    for op, val in (("neq", "impression"), ("in", ["impression"]), ("gte", "impression")):
        spec = _spec([{"COUNT": "*"}], condition("type", op, val))
        assert not rollup_covers(spec, "agg_daily_impressions")
    both = _spec([{"COUNT": "*"}], IMPRESSIONS, condition("type", "neq", "click"))
    assert not rollup_covers(both, "agg_daily_impressions")


def test_global_stats_never_answer_a_filtered_count(store, events):
    spec = _spec([{"COUNT": "*"}], CLICKS)
    assert not rollup_covers(spec, "agg_global_stats")
    same_rows(answer(store, spec), run_spec(events, spec))
    whole = _spec([{"COUNT": "*"}, {"COUNT": "DISTINCT publisher_id"},
                   {"COUNT": "DISTINCT advertiser_id"}, {"MAX": "day"}])
    assert covering_tables(store, whole)[0] == "agg_global_stats"
    same_rows(answer(store, whole), run_spec(events, whole))


def test_unpriced_purchases_are_counted(store, events):
    spec = _spec(["advertiser_id", {"COUNT": "*"}], PURCHASES, group_by=["advertiser_id"])
    same_rows(answer_from_rollup(store, "agg_advertiser_purchases", spec), run_spec(events, spec))


def test_measures_that_do_not_merge_are_not_covered():
    for select in ({"STDDEV": "bid_price"}, {"MEDIAN": "bid_price"}, {"SUM": "advertiser_id"},
                   {"COUNT": "DISTINCT bid_price"}, {"COUNT": "DISTINCT publisher_id"}):
        assert not rollup_covers(_spec([select], IMPRESSIONS), "agg_daily_impressions")


def test_coarser_time_from_finer_time():
    for key, covered in (("week", True), ("month", True), ("weekday", True), ("hour", False)):
        spec = _spec([key, {"COUNT": "*"}], IMPRESSIONS, group_by=[key])
        assert rollup_covers(spec, "agg_daily_impressions") is covered
    monthly = _spec(["month", {"COUNT": "*"}], IMPRESSIONS, group_by=["month"])
    assert not rollup_covers(monthly, "agg_weekly_impressions")


def test_plain_rows_are_never_covered():
    spec = _spec(["country"], IMPRESSIONS)
    assert not any(rollup_covers(spec, table) for table in ROLLUPS + BASES)


def test_refused_table(store):
    with pytest.raises(ValueError, match="does not hold"):
        answer_from_rollup(store, "agg_daily_clicks", SPECS["q01"])


def test_a_table_left_out_of_the_store_is_not_used(spark, events, tmp_path):
    from bidmill import build_store

    part = build_store(events, str(tmp_path), ("agg_daily_clicks",))
    assert covering_tables(part, SPECS["q01"]) == []
    same_rows(answer(part, SPECS["q01"]), run_spec(events, SPECS["q01"]))
    with pytest.raises(ValueError, match="not in the store"):
        part.partials("agg_daily_impressions")
