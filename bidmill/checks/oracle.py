"""Plain SQL over the test tables for each registered query, written on its own."""

_AD = """WITH local AS (
    SELECT e.*, n_name,
           (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS lt
    FROM events e LEFT JOIN nation ON n_nationkey = event_id % 25
),
ad AS (
    SELECT epoch_us(ts) // 1000 AS ts_ms,
           CAST(date_trunc('week', lt) AS TIMESTAMP) AS week,
           CAST(date_trunc('day', lt) AS TIMESTAMP) AS day,
           CAST(date_trunc('hour', lt) AS TIMESTAMP) AS hour,
           CAST(date_trunc('minute', lt) AS TIMESTAMP) AS minute,
           CAST(date_trunc('month', lt) AS TIMESTAMP) AS month,
           CAST(dayofweek(lt) AS BIGINT) AS weekday,
           CASE event_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'serve'
                ELSE event_type END AS type,
           CAST(user_id AS INTEGER) AS advertiser_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS publisher_id,
           CASE WHEN event_type IN ('view', 'signup')
                THEN CAST(value AS DECIMAL(18,2)) END AS bid_price,
           CASE WHEN event_type = 'purchase' AND event_id % 7 <> 0
                THEN CAST(value AS DECIMAL(18,2)) END AS total_price,
           CASE WHEN event_id % 31 <> 0 THEN n_name END AS country
    FROM local
)
"""

_N = "COUNT(*) AS n_events"
_SB = "CAST(SUM(bid_price) AS DOUBLE) AS sum_bid_price"
_AB = "CAST(SUM(bid_price) AS DOUBLE) / COUNT(bid_price) AS avg_bid_price"
_LB = "CAST(MIN(bid_price) AS DOUBLE) AS min_bid_price"
_HB = "CAST(MAX(bid_price) AS DOUBLE) AS max_bid_price"
_ST = "CAST(SUM(total_price) AS DOUBLE) AS sum_total_price"
_AT = "CAST(SUM(total_price) AS DOUBLE) / COUNT(total_price) AS avg_total_price"
_LT = "CAST(MIN(total_price) AS DOUBLE) AS min_total_price"
_HT = "CAST(MAX(total_price) AS DOUBLE) AS max_total_price"
_STATS = (
    _N,
    "COUNT(DISTINCT advertiser_id) AS n_advertisers",
    "COUNT(DISTINCT publisher_id) AS n_publishers",
    "COUNT(DISTINCT country) AS n_countries",
    "MIN(day) AS first_day",
    "MAX(day) AS last_day",
)

_IMPRESSION = "type = 'impression'"
_CLICK = "type = 'click'"
_SERVE = "type = 'serve'"
_PURCHASE = "type = 'purchase' AND total_price IS NOT NULL"
_ANY = "TRUE"

# Name -> (filter, keys, measures).
_ROLLUPS = {
    "agg_daily_impressions": (_IMPRESSION, "day", (_SB, _N)),
    "agg_daily_clicks": (_CLICK, "day", (_N,)),
    "agg_daily_purchases": (_PURCHASE, "day", (_N, _ST, _AT)),
    "agg_daily_serves": (_SERVE, "day", (_N,)),
    "agg_weekly_impressions": (_IMPRESSION, "week", (_SB, _N)),
    "agg_hourly_impressions": (_IMPRESSION, "hour", (_SB, _N)),
    "agg_minute_impressions": (_IMPRESSION, "minute", (_SB,)),
    "agg_daily_minute_impressions": (_IMPRESSION, "day, minute", (_SB,)),
    "agg_daily_minute_clicks": (_CLICK, "day, minute", (_N,)),
    "agg_daily_hourly_impressions": (_IMPRESSION, "day, hour", (_SB, _N)),
    "agg_country_impressions": (_IMPRESSION, "country", (_SB, _N)),
    "agg_country_clicks": (_CLICK, "country", (_N,)),
    "agg_country_purchases": (_PURCHASE, "country", (_AT, _ST, _N)),
    "agg_country_daily_impressions": (_IMPRESSION, "country, day", (_SB, _N)),
    "agg_publisher_impressions": (_IMPRESSION, "publisher_id", (_SB, _N)),
    "agg_publisher_country": (_IMPRESSION, "publisher_id, country", (_SB, _N)),
    "agg_publisher_daily": (_IMPRESSION, "publisher_id, day", (_SB, _N)),
    "agg_publisher_country_daily": (_IMPRESSION, "publisher_id, country, day", (_SB,)),
    "agg_publisher_type": (_ANY, "publisher_id, type", (_N,)),
    "agg_advertiser_impressions": (_IMPRESSION, "advertiser_id", (_SB, _N)),
    "agg_advertiser_type": (_ANY, "advertiser_id, type", (_N,)),
    "agg_advertiser_daily": (_IMPRESSION, "advertiser_id, day", (_SB, _N)),
    "agg_advertiser_country": (_IMPRESSION, "advertiser_id, country", (_SB, _N)),
    "agg_advertiser_country_daily": (_IMPRESSION, "advertiser_id, country, day", (_SB, _N)),
    "agg_advertiser_purchases": (_PURCHASE, "advertiser_id", (_N, _ST)),
    "agg_type_counts": (_ANY, "type", (_N,)),
    "agg_daily_type": (_ANY, "day, type", (_N,)),
    "agg_country_type": (_ANY, "country, type", (_N,)),
    "agg_country_type_daily": (_ANY, "country, type, day", (_N,)),
    "agg_weekly_clicks": (_CLICK, "week", (_N,)),
    "agg_weekly_purchases": (_PURCHASE, "week", (_ST, _AT, _N)),
    "agg_weekly_serves": (_SERVE, "week", (_N,)),
    "agg_hourly_clicks": (_CLICK, "hour", (_N,)),
    "agg_hourly_purchases": (_PURCHASE, "hour", (_ST, _N)),
    "agg_hourly_serves": (_SERVE, "hour", (_N,)),
    "agg_country_weekly_impressions": (_IMPRESSION, "country, week", (_SB, _N)),
    "agg_country_weekly_clicks": (_CLICK, "country, week", (_N,)),
    "agg_country_weekly_purchases": (_PURCHASE, "country, week", (_ST, _N)),
    "agg_country_hourly_impressions": (_IMPRESSION, "country, hour", (_SB, _N)),
    "agg_country_hourly_clicks": (_CLICK, "country, hour", (_N,)),
    "agg_publisher_weekly": (_IMPRESSION, "publisher_id, week", (_SB, _N)),
    "agg_publisher_hourly": (_IMPRESSION, "publisher_id, hour", (_SB, _N)),
    "agg_advertiser_weekly": (_IMPRESSION, "advertiser_id, week", (_SB, _N)),
    "agg_advertiser_hourly": (_IMPRESSION, "advertiser_id, hour", (_SB, _N)),
    "agg_advertiser_publisher": (_IMPRESSION, "advertiser_id, publisher_id", (_SB, _N)),
    "agg_global_stats": (_ANY, "", _STATS),
    "agg_impressions_summary": (_IMPRESSION, "", (_N, _SB, _AB, _LB, _HB)),
    "agg_purchases_summary": (_PURCHASE, "", (_N, _ST, _AT, _LT, _HT)),
    "agg_monthly_impressions": (_IMPRESSION, "month", (_SB, _N)),
    "agg_weekday_impressions": (_IMPRESSION, "weekday", (_SB, _N)),
    "agg_weekday_clicks": (_CLICK, "weekday", (_N,)),
}

_COUNT = 'COUNT(*) AS "COUNT(*)"'
_BID = 'CAST(SUM(bid_price) AS DOUBLE) AS "sum(bid_price)"'
_TOTAL = 'CAST(SUM(total_price) AS DOUBLE) AS "sum(total_price)"'
_MEAN_TOTAL = 'CAST(SUM(total_price) AS DOUBLE) / COUNT(total_price) AS "avg(total_price)"'
_DAY = "day = TIMESTAMP '2024-01-10'"
_FOUR_WEEKS = "day BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-28'"
_ONE_WEEK = "day BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-14'"

_Q04 = f"SELECT minute, {_BID} FROM ad WHERE {_IMPRESSION} AND {_DAY} GROUP BY minute"
_SPECS = {
    "q01": f"SELECT {_COUNT} FROM ad WHERE {_IMPRESSION} AND {_ONE_WEEK}",
    "q02": f"SELECT {_COUNT} FROM ad WHERE {_IMPRESSION} AND country = 'NATION_3' AND {_DAY}",
    "q03": f"SELECT publisher_id, {_COUNT} FROM ad WHERE {_CLICK} AND {_FOUR_WEEKS} "
           "GROUP BY publisher_id",
    "q04": _Q04,
    "q05": _Q04,
    "q06": f"SELECT {_BID} FROM ad WHERE {_IMPRESSION}",
    "q07": f"SELECT {_COUNT} FROM ad WHERE type = 'purchase' AND advertiser_id = 7",
    "q08": f"SELECT advertiser_id, {_BID} FROM ad WHERE {_IMPRESSION} GROUP BY advertiser_id",
    "q09": f"SELECT country, {_COUNT} FROM ad WHERE {_IMPRESSION} GROUP BY country",
    "q10": f"SELECT country, {_TOTAL} FROM ad WHERE type = 'purchase' GROUP BY country",
    "q11": f"SELECT advertiser_id, country, {_MEAN_TOTAL} FROM ad "
           f"WHERE type = 'purchase' AND {_DAY} GROUP BY advertiser_id, country",
    "q12": f"SELECT week, {_BID} FROM ad WHERE {_IMPRESSION} AND {_FOUR_WEEKS} GROUP BY week",
    "q13": f"SELECT day, {_COUNT} FROM ad WHERE {_CLICK} AND country = 'NATION_5' GROUP BY day",
    "q14": f"SELECT country, {_COUNT} FROM ad WHERE {_CLICK} GROUP BY country",
    "q15": "SELECT DISTINCT publisher_id FROM ad "
           f"WHERE {_IMPRESSION} AND country <> 'NATION_7' AND {_DAY}",
}

_PREDICATES = {
    "eq": "advertiser_id = 7",
    "neq": "country <> 'NATION_7'",
    "in": "country IN ('NATION_1', 'NATION_2', 'NATION_9')",
    "in_empty": "FALSE",
    "in_days": "day IN (TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20')",
    "between": "bid_price BETWEEN 10 AND 20.5",
    "lt": "day < TIMESTAMP '2024-01-05'",
    "lte": "hour <= TIMESTAMP '2024-01-10 12:00:00'",
    "gt": "minute > TIMESTAMP '2024-01-20 06:30:00'",
    "gte": "week >= TIMESTAMP '2024-01-15'",
    "ts": "ts_ms >= epoch_ms(TIMESTAMP '2024-01-15 08:00:00')",
    "month": "month = TIMESTAMP '2024-01-01'",
    "all_of": "publisher_id >= 20 AND publisher_id < 40",
}

_AGGREGATES = {
    "count_rows": _COUNT,
    "count_values": 'COUNT(bid_price) AS "count(bid_price)"',
    "count_distinct": 'COUNT(DISTINCT advertiser_id) AS "count(DISTINCT advertiser_id)"',
    "sum": _TOTAL,
    "avg": _MEAN_TOTAL,
    "min": 'CAST(MIN(bid_price) AS DOUBLE) AS "min(bid_price)"',
    "max": 'CAST(MAX(bid_price) AS DOUBLE) AS "max(bid_price)"',
    "stddev": "CAST(CAST(STDDEV_SAMP(CAST(bid_price AS DOUBLE)) AS DECIMAL(24,6)) AS DOUBLE) "
              'AS "stddev(bid_price)"',
    "variance": "CAST(CAST(VAR_SAMP(CAST(bid_price AS DOUBLE)) AS DECIMAL(24,6)) AS DOUBLE) "
                'AS "variance(bid_price)"',
    "median": 'MEDIAN(CAST(bid_price AS DOUBLE)) AS "median(bid_price)"',
}

_TYPED = """ts_ms, {week} AS week, {day} AS day, {hour} AS hour, {minute} AS minute, type,
    advertiser_id, publisher_id, CAST(bid_price AS DOUBLE) AS bid_price,
    {total_price} AS total_price, country FROM ad"""
_KEYS = {k: k for k in ("week", "day", "hour", "minute")}
_ALL_TYPED = "SELECT " + _TYPED.format(total_price="CAST(total_price AS DOUBLE)", **_KEYS)


def _rollup(name: str) -> str:
    where, keys, measures = _ROLLUPS[name]
    columns = ", ".join(([keys] if keys else []) + list(measures))
    return f"SELECT {columns} FROM ad WHERE {where}" + (f" GROUP BY {keys}" if keys else "")


_LONG = (
    "n_events", "sum_bid_price", "avg_bid_price", "min_bid_price", "max_bid_price",
    "sum_total_price", "avg_total_price", "min_total_price", "max_total_price",
    "n_advertisers", "n_publishers", "n_countries", "first_day", "last_day",
)


def _long_rollup(name: str) -> str:
    _, keys, measures = _ROLLUPS[name]
    names = keys.split(", ") if keys else []
    have = {m.rsplit(" AS ", 1)[1] for m in measures}
    columns = [f"'{name}' AS table_name"]
    for i in range(3):
        text = f"coalesce(CAST({names[i]} AS VARCHAR), '-')" if i < len(names) else "NULL"
        columns.append(f"CAST({text} AS VARCHAR) AS key_{i + 1}")
    for measure in _LONG:
        kind = "TIMESTAMP" if "_day" in measure else "BIGINT" if measure[0] == "n" else "DOUBLE"
        columns.append(measure if measure in have else f"CAST(NULL AS {kind}) AS {measure}")
    return f"SELECT {', '.join(columns)} FROM ({_rollup(name)})"


def _manifest() -> str:
    parts = [
        "SELECT 'events' AS kind, 'events' AS name, CAST(NULL AS VARCHAR) AS type, "
        "COUNT(*) AS rows FROM ad",
        "SELECT 'type', type, type, COUNT(*) FROM ad GROUP BY type",
    ]
    for name, (where, keys, _) in _ROLLUPS.items():
        word = where.split("'")
        kind = f"'{word[1]}'" if len(word) > 1 else "NULL"
        rows = f"SELECT DISTINCT {keys} FROM ad WHERE {where.split(' AND ')[0]}"
        count = f"(SELECT COUNT(*) FROM ({rows}))" if keys else "1"
        parts.append(f"SELECT 'rollup', '{name}', {kind}, {count}")
    return " UNION ALL ".join(parts)


# Result files: keys, measure and order of each spec.
_FILES = {
    "q01": ("", "COUNT(*)", ""),
    "q02": ("", "COUNT(*)", ""),
    "q03": ("publisher_id", "COUNT(*)", "\"COUNT(*)\" DESC, publisher_id"),
    "q04": ("minute", "sum(bid_price)", "minute"),
    "q05": ("minute", "sum(bid_price)", "minute"),
    "q06": ("", "sum(bid_price)", ""),
    "q07": ("", "COUNT(*)", ""),
    "q08": ("advertiser_id", "sum(bid_price)", "advertiser_id"),
    "q09": ("country", "COUNT(*)", "country"),
    "q10": ("country", "sum(total_price)", "country"),
    "q11": ("advertiser_id country", "avg(total_price)", "advertiser_id, country"),
    "q12": ("week", "sum(bid_price)", "week"),
    "q13": ("day", "COUNT(*)", "day"),
    "q14": ("country", "COUNT(*)", "country"),
    "q15": ("publisher_id", "", "publisher_id"),
}
_TIME_TEXT = {"minute": "%Y-%m-%d %H:%M", "day": "%Y-%m-%d", "week": "%Y-%m-%d"}


def _result_file(number: int, name: str) -> str:
    keys, value, order = _FILES[name]
    texts = [f"strftime({k}, '{_TIME_TEXT[k]}')" if k in _TIME_TEXT else f"CAST({k} AS VARCHAR)" for k in keys.split()]
    texts += ["CAST(NULL AS VARCHAR)"] * (2 - len(texts))
    place = f"row_number() OVER ({'ORDER BY ' + order if order else ''})"
    measure = f'CAST("{value}" AS DOUBLE)' if value else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT CAST({number} AS INTEGER) AS query, CAST({place} AS INTEGER) AS place, "
        f"{texts[0]} AS key_1, {texts[1]} AS key_2, {measure} AS value FROM ({_SPECS[name]})"
    )


# Keys of the tables that others are merged from, and what else tells their rows apart.
_BASE_KEYS = {
    "base_advertiser_country_hour": "type, day, country, advertiser_id, hour",
    "base_publisher_country_hour": "type, day, country, publisher_id, hour",
    "base_minute": "type, day, hour, minute",
    "sets_advertiser": "type, day, country, CASE WHEN advertiser_id > 0 THEN 1 + (advertiser_id - 1) // 32768 ELSE advertiser_id // 32768 END",
    "sets_publisher": "type, day, country, CASE WHEN publisher_id > 0 THEN 1 + (publisher_id - 1) // 32768 ELSE publisher_id // 32768 END",
}


def _base_count(name: str) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (type = '{t}') AS {t}" for t in ("impression", "click", "purchase", "serve"))
    return (
        f"SELECT '{name.split('_')[0]}' AS kind, '{name}' AS name, COUNT(*) AS rows, {counts} "
        f"FROM (SELECT DISTINCT {_BASE_KEYS[name]} FROM ad)"
    )


# The event type and the columns that each spec needs, written out from its SQL.
_NEEDS = {
    "q01": (_IMPRESSION, "day"),
    "q02": (_IMPRESSION, "country day"),
    "q03": (_CLICK, "publisher_id day"),
    "q04": (_IMPRESSION, "minute day"),
    "q05": (_IMPRESSION, "minute day"),
    "q06": (_IMPRESSION, ""),
    "q07": ("type = 'purchase'", "advertiser_id"),
    "q08": (_IMPRESSION, "advertiser_id"),
    "q09": (_IMPRESSION, "country"),
    "q10": ("type = 'purchase'", "country"),
    "q11": ("type = 'purchase'", "advertiser_id country day"),
    "q12": (_IMPRESSION, "week day"),
    "q13": (_CLICK, "day country"),
    "q14": (_CLICK, "country"),
    "q15": (_IMPRESSION, "publisher_id country day"),
}
_COARSER = {"day": ("day", "hour", "minute"), "week": ("week", "day", "hour", "minute"), "minute": ("minute",)}


def _covered(spec: str, table: str) -> bool:
    """A table covers a spec if it holds its type and, as fine or finer, each of its columns."""
    where, keys, _ = _ROLLUPS[table]
    kept = keys.split(", ") if keys else []
    kind, needs = _NEEDS[spec]
    same_type = where.split(" AND ")[0] == kind or (where == _ANY and "type" in kept)
    return same_type and all(set(_COARSER.get(n, (n,))) & set(kept) for n in needs.split())


def _cover_matrix() -> str:
    rows = [f"('{s}', '{t}', {_covered(s, t)})" for s in _NEEDS for t in _ROLLUPS]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS m(spec, table_name, covered)"


def oracle_sql() -> dict[str, str]:
    bodies = {f"rollup_{name}": _rollup(name) for name in _ROLLUPS}
    for name, sql in _SPECS.items():
        bodies[f"spec_{name}"] = bodies[f"answer_{name}"] = sql
    for name, where in _PREDICATES.items():
        bodies[f"pred_{name}"] = f"SELECT type, {_COUNT} FROM ad WHERE {where} GROUP BY type"
    for name, measure in _AGGREGATES.items():
        bodies[f"agg_{name}"] = f"SELECT country, {measure} FROM ad GROUP BY country"
    for key in ("minute", "hour", "day", "week", "month", "weekday"):
        bodies[f"time_{key}"] = f"SELECT {key}, {_COUNT}, {_BID} FROM ad GROUP BY {key}"
    bodies |= {
        "agg_median_overall": f"SELECT {_AGGREGATES['median']}, {_COUNT} FROM ad",
        "select_rows": "SELECT minute, type, advertiser_id, country, "
                       "CAST(bid_price AS DOUBLE) AS bid_price FROM ad WHERE type <> 'click'",
        "distinct_keys": "SELECT DISTINCT advertiser_id, type FROM ad",
        "ingest_typed_events": _ALL_TYPED,
        "ingest_csv": _ALL_TYPED,
        "ingest_csv_by_name": _ALL_TYPED,
        "scan_all_types": _ALL_TYPED,
        "scan_by_type": f"{_ALL_TYPED} WHERE {_IMPRESSION}",
        "stored_rollups": " UNION ALL ".join(_long_rollup(name) for name in _ROLLUPS),
        "stored_rollup_filtered":
            f"SELECT country, day, {_SB}, {_N} FROM ad WHERE {_IMPRESSION} AND {_DAY} "
            "GROUP BY country, day",
        "manifest_counts": _manifest(),
        "prepare_rollups": " UNION ALL ".join(_long_rollup(name) for name in _ROLLUPS),
        "batch_results": " UNION ALL ".join(
            _result_file(i, name) for i, name in enumerate(_SPECS, 1)
        ),
        "cover_matrix": _cover_matrix(),
        "manifest_bases": " UNION ALL ".join(map(_base_count, _BASE_KEYS)),
        **{
            f"distinct_by_{key}":
                f'SELECT {key}, COUNT(DISTINCT advertiser_id) AS "count(DISTINCT advertiser_id)", '
                f"{_COUNT} FROM ad GROUP BY {key}"
            for key in ("day", "week", "country")
        },
        "approx_distinct_close":
            "SELECT country, COUNT(DISTINCT publisher_id) AS exact, TRUE AS close "
            "FROM ad GROUP BY country",
        "answer_spread":
            f"SELECT country, {_AGGREGATES['stddev']}, {_AGGREGATES['variance']} FROM ad "
            f"WHERE {_IMPRESSION} GROUP BY country",
        "ingest_csv_capitals":
            f"SELECT * REPLACE (CASE WHEN type = 'serve' THEN NULL ELSE type END AS type) FROM ({_ALL_TYPED})",
        "format_times":
            "SELECT strftime(minute, '%Y-%m-%d %H:%M') AS minute, "
            "strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, strftime(day, '%Y-%m-%d') AS day, "
            f"strftime(week, '%Y-%m-%d') AS week, {_COUNT} FROM ad "
            "GROUP BY minute, hour, day, week",
        "result_csv":
            f"SELECT strftime(minute, '%Y-%m-%d %H:%M') AS minute, \"sum(bid_price)\" "
            f"FROM ({_Q04})",
        "batch_records": " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS query, COUNT(*) AS rows, 'success' AS status "
            f"FROM ({sql})"
            for i, sql in enumerate(_SPECS.values(), 1)
        ),
    }
    return {name: _AD + sql for name, sql in bodies.items()}
