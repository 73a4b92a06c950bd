"""Type-split event files: what is kept, what a scan skips, and hot groups."""

from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import IMPRESSIONS, condition, plan_text, rows, same_rows
from pyspark.sql import functions as F

from bidmill import ad_events, read_by_type, run_spec, write_by_type
from bidmill.schema import POSITION


@pytest.fixture(scope="module")
def written(events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "events")
    write_by_type(events, path)
    return path


def test_round_trip(spark, events, written):
    back = read_by_type(spark, written)
    assert set(back.dtypes) == set(events.dtypes)
    same_rows(back.select(*events.columns), events)


def test_one_type_reads_one_folder(spark, events, written):
    clicks = read_by_type(spark, written, "click")
    same_rows(clicks.select(*events.columns), events.where("type = 'click'"))
    assert "PartitionFilters: [isnotnull(type" in plan_text(clicks)
    assert all("type=click" in f for f in _files_read(clicks))


def test_a_spec_prunes_by_type_and_by_stored_date(spark, written):
    spec = {"select": [{"SUM": "bid_price"}],
            "where": [IMPRESSIONS, condition("day", "eq", "2024-01-10")]}
    plan = plan_text(run_spec(read_by_type(spark, written), spec))
    assert "(type" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "EqualTo(day,2024-01-10)" in plan
    assert "ReadSchema: struct<day:date,bid_price:decimal(18,2)>" in plan


@pytest.mark.parametrize(
    ("col", "op", "val", "pushed"),
    [("minute", "eq", "2024-01-10 09:30", "GreaterThanOrEqual(day,2024-01-10)"),
     ("hour", "lt", "2024-01-10 09:00", "LessThanOrEqual(day,2024-01-10)"),
     ("week", "eq", "2024-01-08", "LessThanOrEqual(day,2024-01-14)"),
     ("month", "gte", "2024-01-01", "GreaterThanOrEqual(day,2024-01-01)"),
     ("day", "in", ["2024-01-03", "2024-01-09"], "LessThanOrEqual(day,2024-01-09)")],
)
def test_time_filters_bound_the_stored_date(spark, written, col, op, val, pushed):
    spec = {"select": [{"COUNT": "*"}], "where": [condition(col, op, val)]}
    assert pushed in plan_text(run_spec(read_by_type(spark, written), spec))


def test_files_are_sorted_and_snappy(written):
    for file in Path(written).rglob("*.parquet"):
        table = pq.ParquetFile(file)
        assert table.metadata.row_group(0).column(0).compression == "SNAPPY"
        keys = [tuple((v is not None, v) for v in row.values())
                for row in table.read(["day", "country", "advertiser_id"]).to_pylist()]
        assert keys == sorted(keys)


def test_files_hold_separate_stretches_of_days(spark, events, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_by_type(events, str(tmp_path / "e"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "e" / "type=error").glob("*.parquet"))
    spans = [(min(d), max(d)) for f in files
             for d in [pq.read_table(f, columns=["day"])["day"].to_pylist()]]
    assert len(files) > 1
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_a_second_write_leaves_no_old_types(spark, tiny, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for kind in ("click", "serve"):
            write_by_type(tiny([("2024-01-01", kind, 1, 1, None, None, "A")]), str(tmp_path / "e"))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_by_type(spark, str(tmp_path / "e")).select("type")) == [("serve",)]


def test_unknown_and_missing_types_survive(spark, tiny, tmp_path):
    df = tiny([("2024-01-01", t, 1, 1, None, None, "A") for t in ("swipe", None, "001", "a=b/c")])
    write_by_type(df, str(tmp_path / "e"))
    back = read_by_type(spark, str(tmp_path / "e"))
    assert sorted(rows(back.select("type")), key=str) == [("001",), ("a=b/c",), ("swipe",), (None,)]


def test_types_that_look_like_numbers_stay_text(spark, tiny, tmp_path):
    df = tiny([("2024-01-01", t, 1, 1, None, None, "A") for t in ("001", "2")])
    write_by_type(df, str(tmp_path / "e"))
    back = read_by_type(spark, str(tmp_path / "e"))
    assert sorted(rows(back.select("type"))) == [("001",), ("2",)]
    assert rows(read_by_type(spark, str(tmp_path / "e"), "001").select("type")) == [("001",)]


def test_a_hot_group_is_cut_into_several_files(spark, tmp_path):
    """All rows share type, day and country, and a third of them are copies of one row."""
    hot = spark.range(0, 60_000, 1, 8).select(
        F.lit("click").alias("type"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("day"),
        F.lit("US").alias("country"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("advertiser_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("padding"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "400k")
    try:
        write_by_type(hot, str(tmp_path / "hot"))
    finally:
        spark.conf.unset(size)
    counts = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").rglob("*.parquet")]
    assert sum(counts) == 60_000
    assert len(counts) >= 4 and max(counts) < 30_000


def _files_read(df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_rows_that_were_dealt_out_bring_their_positions(spark, events, tmp_path):
    """Copies of a row are cut by the position in the source, which is not written."""
    path = str(tmp_path / "dealt")
    copies = events.limit(1).crossJoin(spark.range(40_000)).withColumn(POSITION, F.col("id")).drop("id")
    write_by_type(copies, path, rows=40_000)
    assert len(list(Path(path).rglob("*.parquet"))) > 1
    back = read_by_type(spark, path)
    assert set(back.columns) == set(events.columns)
    assert back.count() == 40_000


def test_one_row_group_is_typed_by_several_tasks(spark, tmp_path):
    """The store's events are dealt to all tasks before they are typed."""
    n = 500
    table = pa.table({
        "event_id": [None if i % 50 == 0 else i for i in range(n)],
        "ts": pa.array([datetime(2024, 1, 1 + i % 28, i % 24) for i in range(n)], pa.timestamp("us")),
        "user_id": [i % 9 for i in range(n)],
        "event_type": [("view", "signup", "click", None)[i % 4] for i in range(n)],
        "value": [i / 4 for i in range(n)],
        "props": [f'{{"k": {i % 7}}}' for i in range(n)],
    })
    pq.write_table(table, tmp_path / "events.parquet", row_group_size=n)
    nations = {"n_nationkey": pa.array(range(25), pa.int32()), "n_name": [f"N{i}" for i in range(25)]}
    pq.write_table(pa.table(nations), tmp_path / "nation.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would join small partitions
    try:
        spread = ad_events(spark, str(tmp_path), spread=True)
        tasks = spread.groupBy(F.spark_partition_id()).count().count()
        whole = ad_events(spark, str(tmp_path))
        same_rows(spread.drop(POSITION), whole)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1
    assert spread.select(POSITION).distinct().count() == n
