"""Medians by narrowing, merged sets, sketches and moments, shared scans, and what is read."""

import itertools
import math
import statistics

import pyarrow.parquet as pq
import pytest
from helpers import CLICKS, IMPRESSIONS, condition, plan_text, rows, same_rows
from pyspark.sql import functions as F

from bidmill import (
    answer,
    answer_from_rollup,
    covering_tables,
    prepare,
    raw_ad_events,
    rollup,
    rollup_covers,
    run_batch,
    run_spec,
    write_by_type,
)
from bidmill.checks.specs import SPECS
from bidmill.operators import median
from bidmill.operators.predicates import all_of, asked_days
from bidmill.operators.rollups import BY_NAME
from bidmill.operators.spec import Spec
from bidmill.plans import store as store_module
from bidmill.plans.answer import rows_to_read, source_for
from bidmill.plans.batch import shared_sources
from conftest import SF_DIR


def _medians_of(df, keys):
    grouped = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return {tuple(r[k] for k in keys): r["m"] for r in median.with_medians(grouped, df, keys, {"m": "v"}).collect()}


def _expected(df, keys):
    out = {}
    for r in df.where("v IS NOT NULL").collect():
        out.setdefault(tuple(r[k] for k in keys), []).append(float(r["v"]))
    return {k: statistics.median(v) for k, v in out.items()}


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_medians_of_continuous_and_tied_values(spark, keys):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 997 == 0, None).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.when(F.col("id") % 7 == 0, 1.5).when(F.col("id") % 11 == 0, None).otherwise(F.hash("id") / 1000.0).alias("v"),
    )
    expected = _expected(df, keys)
    found = _medians_of(df, keys)
    assert {k: v for k, v in found.items() if v is not None} == expected


@pytest.mark.parametrize("ranks", [(0.9, 0.95), (0.0, 0.001, 0.002), (0.5,)])
def test_bounds_beside_the_middle_change_nothing(spark, monkeypatch, ranks):
    monkeypatch.setattr(median, "_ROUNDS", (ranks, ranks))
    df = spark.range(3_001).select((F.col("id") % 2).alias("k"), F.hash("id").alias("v"))
    assert _medians_of(df, ("k",)) == _expected(df, ("k",))


def test_few_values_are_left_to_be_ordered(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.rand(3).alias("v"))
    df.createOrReplaceTempView("continuous")
    counts = df.groupBy("k", "v").agg(F.count("*").alias("_n")).withColumnRenamed("v", "_v")
    bounds = df.groupBy("k").agg(F.percentile_approx("v", list(median._MIDDLE), 10_000).alias("_ends"))
    left = median._middle_parts(counts, bounds, ("k",), ("k",), len(median._MIDDLE))
    assert 1 <= left.count() <= 200_000 * 0.001


def test_distinct_ids_come_from_merged_sets(store, events):
    for table, column in (("sets_advertiser", "advertiser_id"), ("sets_publisher", "publisher_id")):
        for keys, where in ((["day"], []), (["week", "country"], []), ([], [IMPRESSIONS]), (["type"], [condition("day", "gte", "2024-01-20")]),
                            (["country"], [condition("country", "eq", "NOWHERE")]), ([], [condition("country", "eq", "NOWHERE")])):
            spec = {"select": [*keys, {"COUNT": f"DISTINCT {column}"}, {"COUNT": "*"}, {"SUM": "bid_price"}], "where": where, "group_by": keys}
            assert rollup_covers(spec, table)
            same_rows(answer_from_rollup(store, table, spec), run_spec(events, spec))
            same_rows(answer(store, spec), run_spec(events, spec))
    mixed = {"select": [{"COUNT": "DISTINCT advertiser_id"}, {"COUNT": "DISTINCT country"}]}
    assert not rollup_covers(mixed, "sets_advertiser") and not rollup_covers(mixed, "sets_publisher")


def test_sets_hold_ids_of_any_size_and_sign(spark, tiny, tmp_path):
    ids = [0, 1, -1, 32767, 32768, 32769, 65536, -32768, -32769, 2**31 - 1, -(2**31), None, 1]
    from bidmill import build_store

    built = build_store(tiny([("2024-01-01", "click", i, 1, None, None, "A") for i in ids]), str(tmp_path / "s"))
    spec = {"select": [{"COUNT": "DISTINCT advertiser_id"}, {"COUNT": "*"}]}
    assert rows(answer_from_rollup(built, "sets_advertiser", spec)) == [(11, 13)]


def test_sketches_and_moments_only_where_asked_for(store, events):
    spec = {"select": ["day", {"APPROX_COUNT_DISTINCT": "advertiser_id"}, {"STDDEV": "bid_price"}], "group_by": ["day"]}
    assert not rollup_covers(spec, "sets_advertiser") and rollup_covers(spec, "sets_advertiser", approximate=True)
    assert source_for(store, spec) is None or BY_NAME[source_for(store, spec)].sets is None
    exact = {r[0]: r[1:] for r in rows(run_spec(events, {**spec, "select": ["day", {"COUNT": "DISTINCT advertiser_id"}, {"STDDEV": "bid_price"}]}))}
    for day, n, spread in rows(answer_from_rollup(store, "sets_advertiser", spec, approximate=True)):
        assert abs(n - exact[day][0]) <= 0.05 * exact[day][0]
        assert math.isclose(spread, exact[day][1], rel_tol=1e-9)


@pytest.mark.parametrize("table", ["agg_country_impressions", "agg_country_daily_impressions", "base_minute", "agg_impressions_summary"])
def test_variances_merge(store, events, table):
    keys = ["country"] if "country" in BY_NAME[table].keys else []
    spec = {"select": [*keys, {"VARIANCE": "bid_price"}, {"STDDEV": "bid_price"}, {"VARIANCE": "total_price"}], "where": [IMPRESSIONS], "group_by": keys}
    found = {r[: len(keys)]: r[len(keys) :] for r in rows(answer_from_rollup(store, table, spec, approximate=True))}
    expected = {r[: len(keys)]: r[len(keys) :] for r in rows(run_spec(events, spec))}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        for a, b in zip(found[key], values, strict=True):
            assert a is b is None or math.isclose(a, b, rel_tol=1e-9)


def test_global_stats_expand_nothing(events):
    assert "Expand" not in plan_text(rollup(events, "agg_global_stats"))


def test_the_choice_of_table_is_that_of_counting(store):
    """Rows of each covering table that lie in the asked types and days, counted."""
    for name, given in SPECS.items():
        spec = Spec.of(given)
        counted = {}
        for table in covering_tables(store, spec):
            keys, order = BY_NAME[table].keys, BY_NAME[table].order or BY_NAME[table].keys
            fixed = {"type", *(c["col"] for c in spec.where if c["op"] == "eq")} - {"day"}
            first = next((k for k in order if k not in fixed), None)
            read = tuple(c for c in spec.where if (c["col"] == "type" and "type" in keys) or (c["col"] == "day" and first == "day"))
            partials = store.partials(table)
            counted[table] = partials.where(all_of(partials.schema, read)).count()
        chosen = source_for(store, spec)
        if counted:
            best = min(counted.values())
            assert chosen is None or counted[chosen] <= max(1.2 * best, best + 10), (name, chosen, counted)


def test_days_asked_for():
    def days(*conditions):
        return asked_days(tuple(condition(*c) for c in conditions))

    assert days(("day", "eq", "2024-01-10")) == 1 and days(("day", "between", ["2024-01-01", "2024-01-28"])) == 28
    assert days(("day", "in", ["2024-01-01", "2024-01-03", "2024-01-01"])) == 2
    assert days(("day", "gte", "2024-01-01"), ("country", "eq", "A")) is None
    assert days(("day", "between", ["2024-02-01", "2024-01-28"])) == 0


def test_specs_of_one_source_share_a_scan(spark, store, events, tmp_path):
    specs = dict(enumerate(SPECS.values(), 1))
    sources = shared_sources(store, specs)
    assert sum(len(some) for some in sources.values()) >= 2
    zero = {"select": [{"COUNT": "*"}, {"SUM": "bid_price"}], "where": [IMPRESSIONS, condition("day", "eq", "1999-01-01")]}
    daily = [{"select": ["day", {"COUNT": "*"}, {"AVG": "bid_price"}], "where": [kind], "group_by": ["day"], "order_by": [{"col": "COUNT(*)", "dir": "desc"}]} for kind in (IMPRESSIONS, CLICKS)]
    rare = [{"select": ["advertiser_id", "publisher_id", "country", {"SUM": "bid_price"}], "where": [c], "group_by": ["advertiser_id", "publisher_id", "country"],
             "order_by": [{"col": "advertiser_id"}]} for c in (IMPRESSIONS, condition("bid_price", "gt", 50))]
    given = [*SPECS.values(), zero, *daily, *rare, {"select": ["no_such_column"]}, {"select": [{"MEDIAN": "bid_price"}]}]
    assert None in shared_sources(store, dict(enumerate(given, 1)))  # the events, too
    records = run_batch(store, given, str(tmp_path))
    assert [r.status for r in records.orderBy("query").collect()] == ["success"] * (len(given) - 2) + ["failed", "success"]
    for number, spec in enumerate(given[:-2], 1):
        wanted = run_spec(events, spec)
        schema = ", ".join(f"`{n}` {'string' if t.startswith('timestamp') else t}" for n, t in wanted.dtypes)
        found = spark.read.schema(schema).option("header", True).csv(f"{tmp_path}/q{number}")
        from bidmill import format_times

        same_rows(found, format_times(wanted))


def test_text_is_parsed_once(spark, tmp_path, monkeypatch):
    raw_ad_events(spark, SF_DIR).write.option("header", True).csv(f"{tmp_path}/in/events_part_0.csv")
    seen = []
    whole = store_module.write_by_type

    def noted(events, *args, **kwargs):
        seen.append(plan_text(events))
        whole(events, *args, **kwargs)

    monkeypatch.setattr(store_module, "write_by_type", noted)
    prepare(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert len(seen) == 1 and "parquet" in seen[0].lower() and "FileScan csv" not in seen[0]
    assert not (tmp_path / "out" / "typed").exists()


def test_absent_ids_read_no_row_group(spark, tiny, tmp_path):
    events = tiny([(f"2024-01-{1 + i % 28:02}", "click", 2 * i, 1, None, None, "A") for i in range(30_000)])
    write_by_type(events, str(tmp_path / "e"), rows=30_000)
    files = sorted((tmp_path / "e").rglob("*.parquet"))

    def read(advertiser):
        df = spark.read.parquet(str(tmp_path / "e")).where(F.col("advertiser_id") == advertiser).select("advertiser_id", "country")
        n = len(df.collect())
        nodes, total = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith(("Scan", "ColumnarToRow")) and node.metrics().contains("numOutputRows") and "Scan" in node.nodeName():
                total += node.metrics().apply("numOutputRows").value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
        return n, total

    assert read(2 * 17) == (1, read(2 * 17)[1]) and read(2 * 17)[1] > 0
    assert read(2 * 17 + 1) == (0, 0)
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 30_000


def test_first_lines_of_files(spark, tmp_path):
    import gzip

    from bidmill import read_raw_events

    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("TYPE,COUNTRY\nclick,US\n")
    (tmp_path / "b [x].csv").write_text('﻿"country","type"\nGB,serve\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("")
    found = read_raw_events(spark, str(tmp_path), by_name=True).select("type", "country")
    assert sorted(rows(found)) == [("click", "US"), ("serve", "GB")]


def test_rows_to_read_count_types_and_days(store):
    spec = {"select": [{"COUNT": "*"}], "where": [CLICKS, condition("day", "eq", "2024-01-10")]}
    whole = store.table_rows("base_minute")
    kinds = [store.table_rows("base_minute", kind) for kind in ("impression", "click", "purchase", "serve")]
    assert 0 < sum(kinds) <= whole and all(kinds)
    assert rows_to_read(store, spec, "base_minute") == -(-kinds[1] // store.days)
    assert all(a <= b for a, b in itertools.pairwise(rows_to_read(store, spec, n) for n in covering_tables(store, spec)))
