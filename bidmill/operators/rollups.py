"""The 51 pre-aggregated tables, and the four finer tables most of them are built from."""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.functions.measures import first_partials, merged_partials, public_measure
from bidmill.functions.timekeys import source_of, with_time_keys

_N = ("n_events",)
_BID = ("sum_bid_price", "n_events")
_SUM_BID = ("sum_bid_price",)


@dataclass(frozen=True)
class Rollup:
    """A named group-by over events.

    ``type`` is the only event type counted, or None for all. ``priced`` tables report only
    rows with a total price. ``measures`` are the reported columns, in order; ``order`` is
    the stored row order where it is not the keys, ``-`` meaning descending. A table with
    ``sets`` keeps, for each stretch of ids (``bucket``) of that column, the set of ids seen as a
    bitmap (``bits``) and as a sketch (``sketch``), both of which merge.
    """

    name: str
    type: str | None
    keys: tuple[str, ...]
    measures: tuple[str, ...] = ()
    order: tuple[str, ...] | None = None
    priced: bool = False
    sets: str | None = None


def _impressions(name, *keys, measures=_BID, order=None):
    return Rollup(name, "impression", keys, measures, order)


def _counts(name, event_type, *keys, order=None):
    return Rollup(name, event_type, keys, _N, order)


def _purchases(name, *keys, measures, order=None):
    return Rollup(name, "purchase", keys, measures, order, priced=True)


_GLOBAL_MEASURES = (
    "n_events", "n_advertisers", "n_publishers", "n_countries", "first_day", "last_day",
)

# Names, event types, keys, measures and stored order of the 51 tables.
ROLLUPS = (
    _impressions("agg_daily_impressions", "day"),
    _counts("agg_daily_clicks", "click", "day"),
    _purchases("agg_daily_purchases", "day",
               measures=("n_events", "sum_total_price", "avg_total_price")),
    _counts("agg_daily_serves", "serve", "day"),
    _impressions("agg_weekly_impressions", "week"),
    _impressions("agg_hourly_impressions", "hour"),
    _impressions("agg_minute_impressions", "minute", measures=_SUM_BID),
    _impressions("agg_daily_minute_impressions", "day", "minute", measures=_SUM_BID),
    _counts("agg_daily_minute_clicks", "click", "day", "minute"),
    _impressions("agg_daily_hourly_impressions", "day", "hour"),
    _impressions("agg_country_impressions", "country", order=("-sum_bid_price",)),
    _counts("agg_country_clicks", "click", "country", order=("-n_events",)),
    _purchases("agg_country_purchases", "country",
               measures=("avg_total_price", "sum_total_price", "n_events"),
               order=("-avg_total_price",)),
    _impressions("agg_country_daily_impressions", "country", "day"),
    _impressions("agg_publisher_impressions", "publisher_id", order=("-sum_bid_price",)),
    _impressions("agg_publisher_country", "publisher_id", "country"),
    _impressions("agg_publisher_daily", "publisher_id", "day"),
    _impressions("agg_publisher_country_daily", "publisher_id", "country", "day",
                 measures=_SUM_BID),
    _counts("agg_publisher_type", None, "publisher_id", "type"),
    _impressions("agg_advertiser_impressions", "advertiser_id", order=("-sum_bid_price",)),
    _counts("agg_advertiser_type", None, "advertiser_id", "type", order=("-n_events",)),
    _impressions("agg_advertiser_daily", "advertiser_id", "day"),
    _impressions("agg_advertiser_country", "advertiser_id", "country"),
    _impressions("agg_advertiser_country_daily", "advertiser_id", "country", "day"),
    _purchases("agg_advertiser_purchases", "advertiser_id",
               measures=("n_events", "sum_total_price"), order=("-sum_total_price",)),
    _counts("agg_type_counts", None, "type"),
    _counts("agg_daily_type", None, "day", "type"),
    _counts("agg_country_type", None, "country", "type", order=("-n_events",)),
    _counts("agg_country_type_daily", None, "country", "type", "day"),
    _counts("agg_weekly_clicks", "click", "week"),
    _purchases("agg_weekly_purchases", "week",
               measures=("sum_total_price", "avg_total_price", "n_events")),
    _counts("agg_weekly_serves", "serve", "week"),
    _counts("agg_hourly_clicks", "click", "hour"),
    _purchases("agg_hourly_purchases", "hour", measures=("sum_total_price", "n_events")),
    _counts("agg_hourly_serves", "serve", "hour"),
    _impressions("agg_country_weekly_impressions", "country", "week"),
    _counts("agg_country_weekly_clicks", "click", "country", "week"),
    _purchases("agg_country_weekly_purchases", "country", "week",
               measures=("sum_total_price", "n_events")),
    _impressions("agg_country_hourly_impressions", "country", "hour"),
    _counts("agg_country_hourly_clicks", "click", "country", "hour"),
    _impressions("agg_publisher_weekly", "publisher_id", "week"),
    _impressions("agg_publisher_hourly", "publisher_id", "hour"),
    _impressions("agg_advertiser_weekly", "advertiser_id", "week"),
    _impressions("agg_advertiser_hourly", "advertiser_id", "hour"),
    _impressions("agg_advertiser_publisher", "advertiser_id", "publisher_id",
                 order=("-sum_bid_price",)),
    Rollup("agg_global_stats", None, (), _GLOBAL_MEASURES),
    _impressions("agg_impressions_summary",
                 measures=("n_events", "sum_bid_price", "avg_bid_price",
                           "min_bid_price", "max_bid_price")),
    _purchases("agg_purchases_summary",
               measures=("n_events", "sum_total_price", "avg_total_price",
                         "min_total_price", "max_total_price")),
    _impressions("agg_monthly_impressions", "month"),
    _impressions("agg_weekday_impressions", "weekday"),
    _counts("agg_weekday_clicks", "click", "weekday"),
)

# Built from events; with agg_advertiser_publisher they are the only tables that scan them.
# ``day`` rides along with ``hour`` (it adds no groups) so that day filters reach the file.
BASES = (
    Rollup("base_advertiser_country_hour", None,
           ("type", "day", "country", "advertiser_id", "hour")),
    Rollup("base_publisher_country_hour", None,
           ("type", "day", "country", "publisher_id", "hour")),
    Rollup("base_minute", None, ("type", "day", "hour", "minute")),
)

# Merged from the bases: which ids were seen, so that distinct counts merge to any coarser group.
SETS = (
    Rollup("sets_advertiser", None, ("type", "day", "country"), sets="advertiser_id"),
    Rollup("sets_publisher", None, ("type", "day", "country"), sets="publisher_id"),
)

BY_NAME = {r.name: r for r in ROLLUPS + BASES + SETS}

GLOBAL_STATS = BY_NAME["agg_global_stats"]

# What agg_global_stats keeps beside the usual partials: (column, event column, aggregate).
GLOBAL_EXTRAS = (
    ("n_advertisers", "advertiser_id", "count(DISTINCT {})"),
    ("n_publishers", "publisher_id", "count(DISTINCT {})"),
    ("n_countries", "country", "count(DISTINCT {})"),
    ("first_day", "day", "min({})"),
    ("last_day", "day", "max({})"),
)


def rollup(events: DataFrame, name: str) -> DataFrame:
    """The named table straight from events, with its reported columns."""
    table = BY_NAME[name]
    if table.priced:  # rows without a price cannot count; dropping them early saves work
        events = events.where("total_price IS NOT NULL")
    return public_table(partials(events, table), table)


def partials(events: DataFrame, table: Rollup) -> DataFrame:
    """Keys and mergeable partial measures of a table, from events."""
    if table is GLOBAL_STATS:
        return global_stats({n: partials(events, BY_NAME[n]) for n in GLOBAL_STATS_PARENTS})
    if table.sets:  # sets of the few ids of a group, not of its many events
        finer = replace(table, keys=(*table.keys, table.sets), sets=None)
        return merge(partials(events, finer), finer, table)
    return _grouped(_of_type(events, table), table, first_partials(events.schema))


def derives_from(table: Rollup, finer: Rollup) -> bool:
    """Whether the partials of ``finer`` can be merged into those of ``table``."""
    if GLOBAL_STATS in (table, finer):
        return False
    same_events = finer.type == table.type or (finer.type is None and "type" in finer.keys)
    same_sets = table.sets in (None, finer.sets) or table.sets in finer.keys
    return same_events and same_sets and all(source_of(key, finer.keys) for key in table.keys)


def merge(finer: DataFrame, finer_table: Rollup, table: Rollup) -> DataFrame:
    """The partials of ``table`` from those of a finer table."""
    rows = finer if finer_table.type == table.type else _of_type(finer, table)
    if not table.sets:
        return _grouped(rows, table, merged_partials())
    if finer_table.sets == table.sets:
        return merged_sets(with_time_keys(rows, table.keys), table.keys)
    ids = table.sets
    measures = [
        *merged_partials(),
        f"bitmap_construct_agg(bitmap_bit_position({ids})) AS bits",
        f"hll_sketch_agg({ids}) AS sketch",
    ]
    rows = rows.withColumn("bucket", F.expr(f"bitmap_bucket_number({ids})"))
    return _aggregated(with_time_keys(rows, table.keys), measures, (*table.keys, "bucket"))


def merged_sets(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows with sets by coarser keys: one row for each bucket of a group."""
    sets = ["bitmap_or_agg(bits) AS bits", "hll_union_agg(sketch) AS sketch"]
    return _aggregated(rows, [*merged_partials(), *sets], (*keys, "bucket"))


def public_table(partial_rows: DataFrame, table: Rollup) -> DataFrame:
    """The reported columns of a table from its partials."""
    if table.priced and table.keys:  # with no keys there is always one row
        partial_rows = partial_rows.where("n_total_price > 0")
    measures = [f"{public_measure(m, table.priced)} AS {m}" for m in table.measures]
    return partial_rows.selectExpr(*table.keys, *measures)


def stored_order(table: Rollup) -> list[Column]:
    """Sort columns of the stored table, over its partials.

    Keys settle ties, so that rows with equal measures can be cut into several ranges.
    """
    out = []
    for name in (*(table.order or ()), *table.keys, *(["bucket"] if table.sets else [])):
        column = F.expr(public_measure(name.removeprefix("-"), table.priced))
        out.append(column.desc_nulls_last() if name[0] == "-" else column.asc_nulls_last())
    return out


def global_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """The partials of agg_global_stats from type-split tables.

    Each distinct count is the number of distinct keys of a small table that covers all
    events; the one-row answers are put together by maxima. So events are never expanded for
    several distinct counts at once.
    """
    parts = [_aggregated(tables["agg_country_type_daily"], merged_partials())]
    for name, column, call in GLOBAL_EXTRAS:
        parts.append(
            _aggregated(tables[_GLOBAL_SOURCES[column]], [f"{call.format(column)} AS {name}"])
        )
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _aggregated(whole, [f"max({c}) AS {c}" for c in whole.columns])


_GLOBAL_SOURCES = {
    "advertiser_id": "agg_advertiser_type",
    "publisher_id": "agg_publisher_type",
    "country": "agg_country_type_daily",
    "day": "agg_country_type_daily",
}
GLOBAL_STATS_PARENTS = tuple(dict.fromkeys(_GLOBAL_SOURCES.values()))


def _grouped(rows: DataFrame, table: Rollup, measures: list[str]) -> DataFrame:
    return _aggregated(with_time_keys(rows, table.keys), measures, table.keys)


def _aggregated(rows: DataFrame, measures: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.expr(m) for m in measures])


def _of_type(rows: DataFrame, table: Rollup) -> DataFrame:
    return rows if table.type is None else rows.where(f"type = '{table.type}'")
