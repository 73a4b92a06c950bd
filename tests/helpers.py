"""Small helpers for tests."""


def rows(df):
    return [tuple(r) for r in df.collect()]


def same_rows(left, right):
    """Both frames hold the same columns and rows, in any order."""
    assert left.columns == right.columns
    assert sorted(map(repr, rows(left))) == sorted(map(repr, rows(right)))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def condition(col, op, val):
    return {"col": col, "op": op, "val": val}


IMPRESSIONS = condition("type", "eq", "impression")
CLICKS = condition("type", "eq", "click")
PURCHASES = condition("type", "eq", "purchase")
