"""Headline timings: each benchmark spec by a scan of the events and from a stored table.

Prints one JSON line. Building the whole store from raw CSV text (typed events, 54 tables and
the manifest) is timed once. Every spec is warmed up and then timed five times, from its dict
to its last row; the median counts.
"""

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from bidmill import ad_events, answer, prepare, raw_ad_events, run_spec
from bidmill.checks.specs import SPECS
from bidmill.checks.workspace import new_folder

RUNS = 5
WARM_UPS = 2


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # No call sites in error messages: they cost a millisecond per column expression.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(build) -> float:
    """Median seconds from building a query to its last row."""
    seconds = []
    for _ in range(WARM_UPS + RUNS):
        start = time.perf_counter()
        _run(build())
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[WARM_UPS:])


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    events = ad_events(spark, sf_dir)
    seconds = {f"spec_{n}": timed(lambda s=s: run_spec(events, s)) for n, s in SPECS.items()}

    csv = new_folder(spark, "csv")
    for part in range(int(cpus)):
        some = raw_ad_events(spark, sf_dir).where(f"pmod(hash(auction_id), {cpus}) = {part}")
        some.write.option("header", True).csv(f"{csv}/events_part_{part}.csv")
    start = time.perf_counter()
    store = prepare(spark, csv, new_folder(spark, "store"))
    seconds["prepare"] = time.perf_counter() - start
    seconds |= {f"answer_{n}": timed(lambda s=s: answer(store, s)) for n, s in SPECS.items()}

    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 4) for name, s in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
