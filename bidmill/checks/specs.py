"""The fifteen benchmark specs, with constants that fit the test tables."""

_DAY = "2024-01-10"
_FOUR_WEEKS = ["2024-01-01", "2024-01-28"]


def _where(event_type: str, **columns) -> list[dict]:
    """Conditions on one event type and on columns given as ``name=(op, value)``."""
    out = [{"col": "type", "op": "eq", "val": event_type}]
    return out + [{"col": c, "op": op, "val": v} for c, (op, v) in columns.items()]


def _by(*columns: str) -> list[dict]:
    return [{"col": c, "dir": "asc"} for c in columns]


_COUNT, _BID, _TOTAL = {"COUNT": "*"}, {"SUM": "bid_price"}, {"SUM": "total_price"}

# What each spec selects, its conditions, keys and order.
SPECS = {
    "q01": {
        "select": [_COUNT],
        "from": "events",
        "where": _where("impression", day=("between", ["2024-01-08", "2024-01-14"])),
    },
    "q02": {
        "select": [_COUNT],
        "from": "events",
        "where": _where("impression", country=("eq", "NATION_3"), day=("eq", _DAY)),
    },
    "q03": {
        "select": ["publisher_id", _COUNT],
        "from": "events",
        "where": _where("click", day=("between", _FOUR_WEEKS)),
        "group_by": ["publisher_id"],
        "order_by": [{"col": "COUNT(*)", "dir": "desc"}],
    },
    "q04": {
        "select": ["minute", _BID],
        "from": "events",
        "where": _where("impression", day=("eq", _DAY)),
        "group_by": ["minute"],
        "order_by": _by("minute"),
    },
    "q05": {  # q04 asked again
        "select": ["minute", _BID],
        "from": "events",
        "where": _where("impression", day=("eq", _DAY)),
        "group_by": ["minute"],
        "order_by": _by("minute"),
    },
    "q06": {"select": [_BID], "from": "events", "where": _where("impression")},
    "q07": {
        "select": [_COUNT],
        "from": "events",
        "where": _where("purchase", advertiser_id=("eq", 7)),
    },
    "q08": {
        "select": ["advertiser_id", _BID],
        "from": "events",
        "where": _where("impression"),
        "group_by": ["advertiser_id"],
        "order_by": _by("advertiser_id"),
    },
    "q09": {
        "select": ["country", _COUNT],
        "from": "events",
        "where": _where("impression"),
        "group_by": ["country"],
        "order_by": _by("country"),
    },
    "q10": {
        "select": ["country", _TOTAL],
        "from": "events",
        "where": _where("purchase"),
        "group_by": ["country"],
        "order_by": _by("country"),
    },
    "q11": {
        "select": ["advertiser_id", "country", {"AVG": "total_price"}],
        "from": "events",
        "where": _where("purchase", day=("eq", _DAY)),
        "group_by": ["advertiser_id", "country"],
        "order_by": _by("advertiser_id"),
    },
    "q12": {
        "select": ["week", _BID],
        "from": "events",
        "where": _where("impression", day=("between", _FOUR_WEEKS)),
        "group_by": ["week"],
        "order_by": _by("week"),
    },
    "q13": {
        "select": ["day", _COUNT],
        "from": "events",
        "where": _where("click", country=("eq", "NATION_5")),
        "group_by": ["day"],
        "order_by": _by("day"),
    },
    "q14": {
        "select": ["country", _COUNT],
        "from": "events",
        "where": _where("click"),
        "group_by": ["country"],
        "order_by": _by("country"),
    },
    "q15": {
        "select": ["publisher_id"],
        "from": "events",
        "where": _where("impression", country=("neq", "NATION_7"), day=("eq", _DAY)),
        "group_by": ["publisher_id"],
        "order_by": _by("publisher_id"),
    },
}
