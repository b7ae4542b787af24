"""Per-source fetch state: gates, transitions, back-off, robots rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days and limits of the fetch policy.
DEFAULT_DAYS, MAX_DAYS, LOW_YIELD, LOW_RUNS = 7, 60, 3, 3


def failure_streaks(events: DataFrame, key: str, order: list[Column], failed: Column) -> DataFrame:
    """``key, …, streak``: failures in a row up to each event, 0 after a success."""
    w = Window.partitionBy(key).orderBy(*order)
    island = F.sum(F.when(failed, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    e = events.withColumn("__island", island).withColumn("__failed", failed)
    inside = Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("streak", F.sum(F.col("__failed").cast("int")).over(inside)).drop("__island", "__failed")


def backoff_days(failures: Column) -> Column:
    """Days to wait after two failures in a row or more; doubles, with a cap."""
    days = F.least(F.lit(DEFAULT_DAYS) * F.pow(F.lit(2.0), F.least(failures, F.lit(12)) - 2), F.lit(MAX_DAYS))
    return F.when(failures >= 2, days.cast("int")).otherwise(F.lit(0))


def interval_fold(runs: DataFrame, key: str, order: Column, found: Column, base: int = DEFAULT_DAYS) -> DataFrame:
    """``key, low_runs, interval_days``: the state after all runs of a source in order.

    A productive run resets both; from the third low one in a row on the
    interval doubles, up to the cap. The fold is sequential by nature: what is
    folded per source is its compressed run list, one small integer a run.
    """
    lists = runs.select(F.col(key), order.alias("o"), F.coalesce(found, F.lit(0)).cast("int").alias("f")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("o", "f"))).alias("l"))
    start = F.struct(F.lit(0).alias("low"), F.lit(base).alias("days"))

    def step(s: Column, x: Column) -> Column:
        low = F.when(x["f"] >= LOW_YIELD, 0).otherwise(s["low"] + 1)
        days = F.when(x["f"] >= LOW_YIELD, F.lit(base)).when(low >= LOW_RUNS, F.least(s["days"] * 2, F.lit(MAX_DAYS))).otherwise(s["days"])
        return F.struct(low.cast("int").alias("low"), days.cast("int").alias("days"))

    done = lists.select(key, F.aggregate("l", start, step).alias("s"))
    return done.select(key, F.col("s.low").alias("low_runs"), F.col("s.days").alias("interval_days"))


def gate(state: DataFrame, domains: DataFrame, now: str) -> DataFrame:
    """``label, decision``: whether a source may be fetched at ``now``, else why not.

    ``state``: ``label, domain, cooldown_until, robots_allowed, failures,
    last_failure, last_fetch, interval_days, low_runs``; ``domains``: ``domain,
    rate_limit_until, last_request``. The hardest reason wins.
    """
    t = F.lit(now).cast("timestamp")
    s = state.join(domains, "domain", "left")
    wait = F.make_interval(days=backoff_days(F.col("failures")))
    decision = (
        F.when(F.col("cooldown_until") > t, "in_cooldown")
        .when(F.col("rate_limit_until") > t, "domain_rate_limited")
        .when(~F.coalesce("robots_allowed", F.lit(True)), "robots_disallow")
        .when((F.col("failures") >= 2) & (F.col("last_failure") + wait > t), "failure_backoff")
        .when((F.col("last_fetch") + F.make_interval(days=F.col("interval_days")) > t) & (F.col("low_runs") >= LOW_RUNS), "low_yield_cooldown")
        .when(F.col("last_fetch") + F.make_interval(days=F.col("interval_days")) > t, "ttl_not_elapsed")
        .when(F.col("last_request") + F.expr("interval 60 seconds") > t, "domain_polite_wait")
        .otherwise("ok")
    )
    return s.select("label", decision.alias("decision"))


def cooldown_hours(status: Column) -> Column:
    """Hours a source rests after a response status."""
    return F.when(status.isin(429, 503), 24).when(status == 403, 7 * 24).otherwise(0)


def robots_rules(robots: str, agent: str) -> list[str]:
    """Path prefixes closed to ``agent``; rules with wildcards are not counted.

    Agent lines before a rule form one group; an agent line after a rule opens
    the next one. A group applies if it names the agent or ``*``.
    """
    closed: list[str] = []
    named: set[str] = set()
    ruled = False
    for raw in robots.splitlines():
        field, colon, value = raw.partition("#")[0].partition(":")
        field, value = field.strip().lower(), value.strip()
        if not colon:
            continue
        if field == "user-agent":
            if ruled:
                named, ruled = set(), False
            named.add(value.lower())
        elif field in ("allow", "disallow"):
            ruled = True
            if field == "disallow" and value and not set("*$") & set(value) and named & {"*", agent.lower()}:
                closed.append(value)
    return closed


def allowed(path: Column, closed: Column) -> Column:
    return ~F.exists(closed, lambda p: F.startswith(path, p))
