"""Registered queries: name -> function of (spark, test-data folder)."""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidmill.checks.specs import SPECS
from bidmill.checks.workspace import new_folder, store
from bidmill.operators.rollups import ROLLUPS, rollup
from bidmill.operators.spec import Spec, run_spec
from bidmill.plans.answer import answer, answer_from_rollup, rollup_covers
from bidmill.plans.batch import format_times, run_batch, write_result
from bidmill.plans.store import prepare, read_manifest, read_rollup
from bidmill.schema import EVENT_TYPES
from bidmill.sources.csv_events import clean_events, read_raw_events
from bidmill.sources.layout import read_by_type
from bidmill.sources.tables import ad_events, raw_ad_events

Query = Callable[[SparkSession, str], DataFrame]


def _on_events(spec: dict) -> Query:
    return lambda spark, sf_dir: run_spec(ad_events(spark, sf_dir), spec)


def _counts_where(column: str, op: str, value, *more: dict) -> Query:
    """Events per type under conditions."""
    return _on_events({
        "select": ["type", {"COUNT": "*"}],
        "where": [{"col": column, "op": op, "val": value}, *more],
        "group_by": ["type"],
    })


def _per_country(function: str, column: str) -> Query:
    return _on_events({"select": ["country", {function: column}], "group_by": ["country"]})


def _per_time(key: str) -> Query:
    return _on_events({
        "select": [key, {"COUNT": "*"}, {"SUM": "bid_price"}],
        "group_by": [key],
        "order_by": [{"col": key}],
    })


def _to_six_places(query: Query, column: str) -> Query:
    """Spread measures differ between engines in the last bits."""
    return lambda spark, sf_dir: query(spark, sf_dir).withColumn(
        column, F.col(column).cast("decimal(24,6)").cast("double")
    )


def _with_millis(events: DataFrame) -> DataFrame:
    """Typed events with the instant as epoch milliseconds."""
    return events.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "ts_ms")


def _typed_events(spark, sf_dir):
    return _with_millis(clean_events(raw_ad_events(spark, sf_dir)))


def _csv_events(spark, sf_dir):
    """Through CSV files, matched by position."""
    folder = new_folder(spark, "csv")
    raw_ad_events(spark, sf_dir).write.option("header", True).csv(folder)
    return _with_millis(clean_events(read_raw_events(spark, f"{folder}/*.csv")))


def _csv_events_by_name(spark, sf_dir):
    """Through two sets of CSV files: one with its columns turned round, one without ids."""
    folder = new_folder(spark, "csv")
    raw = raw_ad_events(spark, sf_dir)
    turned = raw.where(F.col("type") == "purchase").select(*reversed(raw.columns))
    short = raw.where(F.col("type") != "purchase").drop("auction_id", "user_id", "total_price")
    turned.write.option("header", True).csv(f"{folder}/turned")
    short.write.option("header", True).csv(f"{folder}/short")
    return _with_millis(clean_events(read_raw_events(spark, f"{folder}/*/*.csv", by_name=True)))


def _one_type(spark, sf_dir):
    events = read_by_type(spark, f"{store(spark, sf_dir).path}/events", "impression")
    return _with_millis(_prices_as_doubles(events))


def _all_types(spark, sf_dir):
    events = read_by_type(spark, f"{store(spark, sf_dir).path}/events")
    return _with_millis(_prices_as_doubles(events))


def _prices_as_doubles(events: DataFrame) -> DataFrame:
    return events.withColumns({p: F.col(p).cast("double") for p in ("bid_price", "total_price")})


def _answered(spec: dict) -> Query:
    return lambda spark, sf_dir: answer(store(spark, sf_dir), spec)


def _stored_rollups(spark, sf_dir):
    return _long_rollups(spark, store(spark, sf_dir).path)


def _long_rollups(spark: SparkSession, path: str) -> DataFrame:
    """All 51 stored tables in one long table: keys as text, measures side by side."""
    parts = []
    for table in ROLLUPS:
        rows = read_rollup(spark, path, table.name)
        keys = [
            F.coalesce(F.col(k).cast("string"), F.lit("-")).alias(f"key_{i}")
            for i, k in enumerate(table.keys, 1)
        ]
        parts.append(rows.select(F.lit(table.name).alias("table_name"), *keys, *table.measures))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(
        "table_name", "key_1", "key_2", "key_3", "n_events",
        "sum_bid_price", "avg_bid_price", "min_bid_price", "max_bid_price",
        "sum_total_price", "avg_total_price", "min_total_price", "max_total_price",
        "n_advertisers", "n_publishers", "n_countries", "first_day", "last_day",
    )


def _filtered_rollup(spark, sf_dir):
    """A stored table with a filter that reaches its scan."""
    rows = read_rollup(spark, store(spark, sf_dir).path, "agg_country_daily_impressions")
    return rows.where(F.col("day") == F.lit("2024-01-10").cast("timestamp_ntz"))


def _manifest_counts(spark, sf_dir):
    manifest = read_manifest(spark, store(spark, sf_dir).path)
    known = manifest.where(F.col("kind").isin("events", "type", "rollup"))
    return known.select("kind", "name", "type", "rows")


def _formatted_times(spark, sf_dir):
    keys = ["minute", "hour", "day", "week"]
    spec = {"select": [*keys, {"COUNT": "*"}], "group_by": keys}
    return format_times(run_spec(ad_events(spark, sf_dir), spec))


def _result_file(spark, sf_dir):
    path = new_folder(spark, "result")
    write_result(answer(store(spark, sf_dir), SPECS["q04"]), path)
    schema = "minute string, `sum(bid_price)` double"
    return spark.read.schema(schema).option("header", True).csv(path)


def _batch_records(spark, sf_dir):
    out = new_folder(spark, "batch")
    records = run_batch(store(spark, sf_dir), SPECS.values(), out)
    return records.select("query", "rows", "status")


def _prepared_rollups(spark, sf_dir):
    """All 51 tables of a store that was prepared from CSV files, with double prices."""
    folder, out = new_folder(spark, "csv"), new_folder(spark, "store")
    raw = raw_ad_events(spark, sf_dir).repartition(4)
    raw.write.option("header", True).csv(f"{folder}/events_part_0.csv")
    return _long_rollups(spark, prepare(spark, folder, out).path)


def _batch_results(spark, sf_dir):
    """All result files of a batch, row by row in their order: keys as text, and the measure."""
    out = new_folder(spark, "batch")
    run_batch(store(spark, sf_dir), SPECS.values(), out)
    parts = []
    for number, spec in enumerate(SPECS.values(), 1):
        spec = Spec.of(spec)
        names = [item if isinstance(item, str) else item.label for item in spec.select]
        schema = ", ".join(f"`{n}` {'double' if '(' in n else 'string'}" for n in names)
        rows = spark.read.schema(schema).option("header", True).csv(f"{out}/q{number}")
        keys = [F.col(n) for n in names if "(" not in n]
        keys += [F.lit(None).cast("string")] * (2 - len(keys))
        value = next((F.col(f"`{n}`") for n in names if "(" in n), F.lit(None).cast("double"))
        columns = [k.alias(f"key_{i}") for i, k in enumerate(keys, 1)] + [value.alias("value")]
        at = [F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line")]
        parts.append(rows.select(F.lit(number).alias("query"), *columns, *at))
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    place = F.row_number().over(Window.partitionBy("query").orderBy("file", "line"))
    return whole.select("query", place.alias("place"), "key_1", "key_2", "value")


def _cover_matrix(spark, sf_dir):
    """Which of the 51 tables can answer which benchmark spec."""
    rows = [(name, t.name, rollup_covers(spec, t)) for name, spec in SPECS.items() for t in ROLLUPS]
    known = read_manifest(spark, store(spark, sf_dir).path).where("kind = 'rollup'").select("name")
    covers = spark.createDataFrame(rows, "spec string, table_name string, covered boolean")
    return covers.join(known, F.col("name") == F.col("table_name"), "left_semi")


def _base_counts(spark, sf_dir):
    """Rows, whole and by event type, of the tables that the others are merged from."""
    manifest = read_manifest(spark, store(spark, sf_dir).path)
    kinds = [F.col("by_type")[kind].alias(kind) for kind in EVENT_TYPES]
    return manifest.where(F.col("kind").isin("base", "sets")).select("kind", "name", "rows", *kinds)


def _from_sets(key: str) -> Query:
    """Distinct ids merged from stored bitmaps."""
    spec = {"select": [key, {"COUNT": "DISTINCT advertiser_id"}, {"COUNT": "*"}], "group_by": [key]}
    return lambda spark, sf_dir: answer_from_rollup(store(spark, sf_dir), "sets_advertiser", spec)


def _approximate_and_exact(spark, sf_dir):
    """Distinct publishers per country, and whether merged sketches come within three errors of it."""
    built = store(spark, sf_dir)
    counts = [{"COUNT": "DISTINCT publisher_id"}, {"APPROX_COUNT_DISTINCT": "publisher_id"}]
    spec = {"select": ["country", *counts], "group_by": ["country"]}
    found = answer_from_rollup(built, "sets_publisher", spec, approximate=True)
    exact, near = F.col("`count(DISTINCT publisher_id)`"), F.col("`approx_count_distinct(publisher_id)`")
    error = 3 * 1.04 / 2**6  # of a sketch of 2**12 registers
    return found.select("country", exact.alias("exact"), (F.abs(near - exact) <= exact * error).alias("close"))


def _stored_spread(spark, sf_dir):
    """Variances merged from stored moments."""
    names = ("stddev(bid_price)", "variance(bid_price)")
    spec = {
        "select": ["country", {"STDDEV": "bid_price"}, {"VARIANCE": "bid_price"}],
        "where": [{"col": "type", "op": "eq", "val": "impression"}],
        "group_by": ["country"],
    }
    found = answer_from_rollup(
        store(spark, sf_dir), "agg_country_daily_impressions", spec, approximate=True
    )
    return found.withColumns({n: F.col(f"`{n}`").cast("decimal(24,6)").cast("double") for n in names})


def _capital_headers(spark, sf_dir):
    """By name, through files with headers in capitals, and one whose file has no type at all."""
    folder = new_folder(spark, "csv")
    raw = raw_ad_events(spark, sf_dir)
    capitals = raw.select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)])
    capitals.where("TYPE <> 'serve'").write.option("header", True).csv(f"{folder}/capitals")
    raw.where("type = 'serve'").drop("type").write.option("header", True).csv(f"{folder}/untyped")
    return _with_millis(clean_events(read_raw_events(spark, f"{folder}/*/*.csv", by_name=True)))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for table in ROLLUPS:
        out[f"rollup_{table.name}"] = partial(_rollup, table.name)
    for name, spec in SPECS.items():
        out[f"spec_{name}"] = _on_events(spec)
    for name, spec in SPECS.items():
        out[f"answer_{name}"] = _answered(spec)
    return out | {
        "pred_eq": _counts_where("advertiser_id", "eq", 7),
        "pred_neq": _counts_where("country", "neq", "NATION_7"),
        "pred_in": _counts_where("country", "in", ["NATION_1", "NATION_2", "NATION_9"]),
        "pred_in_empty": _counts_where("country", "in", []),
        "pred_in_days": _counts_where("day", "in", ["2024-01-03", "2024-01-20"]),
        "pred_between": _counts_where("bid_price", "between", [10, 20.5]),
        "pred_lt": _counts_where("day", "lt", "2024-01-05"),
        "pred_lte": _counts_where("hour", "lte", "2024-01-10 12:00:00"),
        "pred_gt": _counts_where("minute", "gt", "2024-01-20 06:30:00"),
        "pred_gte": _counts_where("week", "gte", "2024-01-15"),
        "pred_ts": _counts_where("ts", "gte", "2024-01-15T08:00:00+00:00"),
        "pred_month": _counts_where("month", "eq", "2024-01-01"),
        "pred_all_of": _counts_where(
            "publisher_id", "gte", 20, {"col": "publisher_id", "op": "lt", "val": 40}
        ),
        "agg_count_rows": _per_country("COUNT", "*"),
        "agg_count_values": _per_country("COUNT", "bid_price"),
        "agg_count_distinct": _per_country("COUNT", "DISTINCT advertiser_id"),
        "agg_sum": _per_country("SUM", "total_price"),
        "agg_avg": _per_country("AVG", "total_price"),
        "agg_min": _per_country("MIN", "bid_price"),
        "agg_max": _per_country("MAX", "bid_price"),
        "agg_stddev": _to_six_places(_per_country("STDDEV", "bid_price"), "stddev(bid_price)"),
        "agg_variance": _to_six_places(
            _per_country("VARIANCE", "bid_price"), "variance(bid_price)"
        ),
        "agg_median": _per_country("MEDIAN", "bid_price"),
        "agg_median_overall": _on_events({"select": [{"MEDIAN": "bid_price"}, {"COUNT": "*"}]}),
        "agg_approx_count_distinct": _per_country("APPROX_COUNT_DISTINCT", "advertiser_id"),
        "time_minute": _per_time("minute"),
        "time_hour": _per_time("hour"),
        "time_day": _per_time("day"),
        "time_week": _per_time("week"),
        "time_month": _per_time("month"),
        "time_weekday": _per_time("weekday"),
        "select_rows": _on_events({
            "select": ["minute", "type", "advertiser_id", "country", "bid_price"],
            "where": [{"col": "type", "op": "neq", "val": "click"}],
            "order_by": [{"col": "minute"}, {"col": "bid_price", "dir": "desc"}],
        }),
        "distinct_keys": _on_events({
            "select": ["advertiser_id", "type"], "group_by": ["advertiser_id", "type"],
        }),
        "ingest_typed_events": _typed_events,
        "ingest_csv": _csv_events,
        "ingest_csv_by_name": _csv_events_by_name,
        "scan_by_type": _one_type,
        "scan_all_types": _all_types,
        "stored_rollups": _stored_rollups,
        "stored_rollup_filtered": _filtered_rollup,
        "manifest_counts": _manifest_counts,
        "format_times": _formatted_times,
        "result_csv": _result_file,
        "batch_records": _batch_records,
        "batch_results": _batch_results,
        "prepare_rollups": _prepared_rollups,
        "cover_matrix": _cover_matrix,
        "manifest_bases": _base_counts,
        "distinct_by_day": _from_sets("day"),
        "distinct_by_week": _from_sets("week"),
        "distinct_by_country": _from_sets("country"),
        "approx_distinct_close": _approximate_and_exact,
        "answer_spread": _stored_spread,
        "ingest_csv_capitals": _capital_headers,
    }


def _rollup(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(ad_events(spark, sf_dir), name)
