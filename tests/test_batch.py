"""Result files and batches."""

from datetime import datetime
from pathlib import Path

from helpers import IMPRESSIONS, condition, rows

from bidmill import format_times, run_batch, write_result
from bidmill.checks.specs import SPECS


def test_time_texts(spark):
    at = datetime(2024, 3, 31, 2, 30)  # skipped by the session's clocks
    df = spark.sql(f"SELECT timestamp_ntz'{at}' AS minute, timestamp_ntz'2024-03-31 02:00' AS hour,"
                   " timestamp_ntz'2024-03-31' AS day, timestamp_ntz'2024-03-25' AS week, 1 AS n")
    assert rows(format_times(df)) == [
        ("2024-03-31 02:30", "2024-03-31 02:00:00", "2024-03-31", "2024-03-25", 1)
    ]


def test_result_file_has_a_header_and_keeps_order(spark, tmp_path):
    df = spark.createDataFrame([(3, None), (1, "x,y")], "a int, `sum(b)` string").coalesce(1)
    assert write_result(df, str(tmp_path / "r")) == 2
    text = "".join(f.read_text() for f in (tmp_path / "r").glob("*.csv"))
    assert text == 'a,sum(b)\n3,\n1,"x,y"\n'


def test_empty_result_has_a_header(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    assert write_result(df, str(tmp_path / "r")) == 0
    assert "".join(f.read_text() for f in (tmp_path / "r").glob("*.csv")) == "a,b\n"


def test_batch_records_every_spec_and_goes_on_after_a_failure(spark, store, tmp_path):
    bad = {"select": [{"COUNT": "*"}], "where": [condition("country", "like", "U%")]}
    late = {"select": ["day", {"COUNT": "*"}], "where": [IMPRESSIONS], "group_by": ["day"],
            "order_by": [{"col": "day"}]}
    records = run_batch(store, [SPECS["q06"], bad, late], str(tmp_path))
    found = [tuple(r) for r in records.orderBy("query").collect()]
    assert [r[:3] for r in found] == [
        (1, 1, "success"), (2, None, "failed"), (3, found[2][1], "success"),
    ]
    assert "unknown operator 'like'" in found[1][3]
    assert spark.read.json(f"{tmp_path}/records").count() == 3
    days = [line for f in sorted(Path(tmp_path, "q3").glob("*.csv"))
            for line in f.read_text().splitlines()]
    assert days[0] == "day,COUNT(*)" and days[1].startswith("2024-01-") or "2023-12-31" in days[1]
    assert len(days) - 1 == found[2][1] and days[1:] == sorted(days[1:])
