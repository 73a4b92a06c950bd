"""URL filtering by a temporal list join.

A list has dated entries: from a day on, a rule (a host, a domain above it, or a host with a path)
is blocked, allowed, or no longer listed. Each entry holds until the next dated entry of its rule,
which gives validity intervals. Every capture is judged by the intervals that hold on the day it was
fetched; the most specific rule decides (host with path, then the longest domain).

The as-of join meets on (rule, month): intervals are cut at months, so no rule brings more than the
days of a month together. Captures are first reduced to different (target, day), and the verdicts
are joined back, so a host with a third of all captures is split by target and day.

Defined cases: of several entries of a rule on one day the strictest counts (block, allow, remove).
Entries with a null rule, day or unknown action, and captures with a null or unparsable URL or null
day, match nothing: not blocked, null rule. Repeated rows stay. No entries: nothing is blocked. A
new column whose name is taken replaces that column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidmill.llm.common import stored, unused

#: Strictness of actions.
ACTIONS = {"remove": 0, "allow": 1, "block": 2}


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def target_of(url: Column) -> Column:
    """Host and path: the most specific rule that can match a URL."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.concat(host_of(url), path)


def intervals(entries: DataFrame) -> DataFrame:
    """(rule, action, listed_on, until) of entries (rule, action, listed_on); until is null while open."""
    rank = F.lit(None).cast("int")
    for name, value in ACTIONS.items():
        rank = F.when(F.lower("action") == name, value).otherwise(rank)
    known = entries.select(F.lower("rule").alias("rule"), F.to_date("listed_on").alias("listed_on"), rank.alias("rank"))
    daily = known.dropna().groupBy("rule", "listed_on").agg(F.max("rank").alias("rank"))  # at most one row a day
    until = F.lead("listed_on").over(Window.partitionBy("rule").orderBy("listed_on"))
    return daily.withColumn("until", until).where("rank > 0").select("rule", (F.col("rank") == ACTIONS["block"]).alias("blocks"), "listed_on", "until")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """The captures with blocked, rule and listed_on of the deciding entry."""
    spark = captures.sparkSession
    kept = [c for c in captures.columns if c.lower() not in ("blocked", "rule", "listed_on")]
    target, day, t, d, best = (unused(captures, n) for n in ("target", "day", "_t", "_d", "best"))
    rows = captures.select(*kept, target_of(F.col(url)).alias(target), F.to_date(fetched_on).alias(day))
    asked = rows.select(F.col(target).alias("target"), F.col(day).alias("day")).dropna().distinct()
    # The target itself, its host, and each domain above the host.
    labels = F.split(F.substring_index("target", "/", 1), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    rule = F.explode(F.array_distinct(F.concat(F.array("target"), above)))
    asked = asked.select("target", "day", rule.alias("rule")).withColumn("month", F.trunc("day", "month"))
    last = captures.agg(F.max(F.to_date(fetched_on)).alias("last")).first()["last"]
    if last is None:
        nothing = F.lit(None)
        return rows.select(*kept, F.lit(False).alias("blocked"), nothing.cast("string").alias("rule"), nothing.cast("date").alias("listed_on"))
    end = F.least(F.coalesce(F.date_sub("until", 1), F.lit(last)), F.lit(last))
    months = F.sequence(F.trunc("listed_on", "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    listed = intervals(entries).where(F.col("listed_on") <= end).withColumn("month", F.explode(months))
    holds = (F.col("a.rule") == F.col("b.rule")) & (F.col("a.month") == F.col("b.month")) & (F.col("b.listed_on") <= F.col("a.day"))
    holds &= F.col("b.until").isNull() | (F.col("a.day") < F.col("b.until"))
    met = asked.alias("a").join(listed.alias("b"), holds).select("target", "day", "b.rule", "blocks", "listed_on")
    decided = met.groupBy("target", "day").agg(F.max(F.struct(F.length("rule").alias("size"), "rule", "listed_on", "blocks")).alias("best"))
    verdicts = stored(spark, decided.select(F.col("target").alias(t), F.col("day").alias(d), F.col("best").alias(best)), "verdicts")
    joined = rows.join(verdicts, (F.col(target) == F.col(t)) & (F.col(day) == F.col(d)), "left")
    return joined.select(*kept, F.coalesce(F.col(best)["blocks"], F.lit(False)).alias("blocked"), F.col(best)["rule"].alias("rule"), F.col(best)["listed_on"].alias("listed_on"))
