"""The store on disk: manifest, tables and how they are built."""

import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from helpers import rows, same_rows

from bidmill import (
    BASES,
    ROLLUPS,
    Store,
    prepare,
    raw_ad_events,
    read_manifest,
    read_rollup,
    rollup,
    run_spec,
)
from bidmill.checks.specs import SPECS
from bidmill.operators.rollups import BY_NAME, GLOBAL_STATS, derives_from
from bidmill.plans import store as store_module


def test_catalogue():
    assert len(ROLLUPS) == 51 and len({r.name for r in ROLLUPS}) == 51
    assert sum(r.priced for r in ROLLUPS) == 7
    assert sum(r.type is None for r in ROLLUPS) == 7


def test_only_four_tables_need_the_events():
    """Every other one derives from a finer table, which is written before it."""
    level = store_module._level
    scanning = [
        t.name for t in BASES + ROLLUPS
        if t is not GLOBAL_STATS
        and not any(derives_from(t, f) and level(f) < level(t) for f in BASES + ROLLUPS)
    ]
    assert scanning == [b.name for b in BASES] + ["agg_advertiser_publisher"]


def test_prepare_from_csv(spark, events, tmp_path):
    for part in range(2):
        (raw_ad_events(spark, SF_DIR).where(f"pmod(hash(auction_id), 2) = {part}")
         .write.option("header", True).csv(f"{tmp_path}/in/events_part_{part}.csv"))
    built = prepare(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert set(built.tables) == {r.name for r in BASES + ROLLUPS}
    assert built.event_rows() == events.count()
    assert dict(built.events().dtypes)["bid_price"] == "double"
    for name in ("agg_country_daily_impressions", "agg_weekly_purchases", "agg_global_stats",
                 "agg_purchases_summary"):
        same_rows(built.rollup(name), rollup(events, name))
    same_rows(run_spec(built.events(), SPECS["q11"]), run_spec(events, SPECS["q11"]))


def test_decimal_prices_give_the_same_tables(spark, events, tmp_path):
    raw = raw_ad_events(spark, SF_DIR)
    raw.write.option("header", True).csv(f"{tmp_path}/in/events_part_0.csv")
    built = prepare(spark, f"{tmp_path}/in", f"{tmp_path}/out", price_type="decimal(18,6)")
    for name in ("agg_country_impressions", "agg_country_purchases", "agg_impressions_summary"):
        same_rows(built.rollup(name), rollup(events, name))


def test_manifest(spark, store, events):
    manifest = read_manifest(spark, store.path)
    found = {(r["kind"], r["name"]): r for r in manifest.collect()}
    assert found["events", "events"]["rows"] == events.count()
    by_type = dict(rows(events.groupBy("type").count()))
    assert {n: r["rows"] for (k, n), r in found.items() if k == "type"} == by_type
    for table in ROLLUPS + BASES:
        row = found["base" if table in BASES else "rollup", table.name]
        assert tuple(row["keys"]) == table.keys and row["type"] == table.type
        assert row["rows"] == spark.read.parquet(f"{store.path}/rollups/{table.name}").count()
    for line in Path(store.path, "manifest").glob("*.json"):
        assert all(json.loads(text) for text in line.read_text().splitlines())


def test_a_store_without_a_manifest_does_not_open(spark, store, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Store(spark, str(tmp_path))


def test_an_unfinished_rebuild_does_not_open(spark, events, tmp_path, monkeypatch):
    path = str(tmp_path)
    store_module.build_store(events, path, ("agg_type_counts",))
    monkeypatch.setattr(store_module, "write_rollups", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store_module.build_store(events, path, ("agg_type_counts",))
    with pytest.raises(ValueError, match="not finished"):
        Store(spark, path)


@pytest.mark.parametrize("name", ["agg_country_impressions", "agg_country_purchases",
                                  "agg_country_daily_impressions", "agg_advertiser_type"])
def test_stored_row_order(spark, store, name):
    table = BY_NAME[name]
    found = read_rollup(spark, store.path, name).collect()
    if table.order:
        values = [r[table.order[0][1:]] for r in found]
        assert values == sorted(values, reverse=True)
    else:
        keys = [tuple((r[k] is None, r[k]) for k in table.keys) for r in found]
        assert keys == sorted(keys)


def test_a_large_table_is_sorted_across_files(events, tmp_path, monkeypatch):
    """More rows than a file takes are range-partitioned, still in order."""
    monkeypatch.setattr("bidmill.sources.layout.ROWS_PER_FILE", 100)
    spark = events.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = ("agg_advertiser_country_daily", "agg_advertiser_daily")
        store_module.write_rollups(events, str(tmp_path), names)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(Path(tmp_path, "rollups", "agg_advertiser_daily").glob("*.parquet"))
    assert len(files) > 1
    keys = [tuple(r.values()) for f in files
            for r in pq.read_table(f, columns=["advertiser_id", "day"]).to_pylist()]
    assert keys == sorted(keys)
    same_rows(read_rollup(spark, str(tmp_path), "agg_advertiser_daily"),
              rollup(events, "agg_advertiser_daily"))


def test_empty_events(spark, events, tmp_path):
    names = ("agg_type_counts", "agg_purchases_summary", "agg_global_stats", "agg_daily_clicks")
    store_module.write_rollups(events.where("false"), str(tmp_path), names)
    assert rows(read_rollup(spark, str(tmp_path), "agg_daily_clicks")) == []
    assert rows(read_rollup(spark, str(tmp_path), "agg_purchases_summary")) == [
        (0, None, None, None, None)
    ]
    assert rows(read_rollup(spark, str(tmp_path), "agg_global_stats")) == [
        (0, 0, 0, 0, None, None)
    ]


def test_a_group_with_no_price_is_not_a_priced_row(tiny):
    df = tiny([("2024-01-01", "purchase", 1, 1, None, None, "US"),
               ("2024-01-01", "purchase", 1, 1, None, 2.0, "GB"),
               ("2024-01-01", "purchase", 1, 1, None, None, "GB")])
    assert rows(rollup(df, "agg_country_purchases")) == [("GB", 2.0, 2.0, 1)]
    assert rows(rollup(df, "agg_advertiser_purchases")) == [(1, 1, 2.0)]


def test_shared_folder_is_the_one_the_session_names(spark, store):
    assert store.path.startswith(spark.conf.get("spark.checkpoint.dir"))
