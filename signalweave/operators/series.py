"""Series and snapshots: dense windows, outliers, share shifts, carry-forward and comparison of states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def two_window_means(df: DataFrame, group: str, day: str, value: str, end: str, days: int = 7) -> DataFrame:
    """Means of the last ``days`` days up to ``end`` and of as many before, a missing day counting 0, and their ratio."""
    last = F.lit(end).cast("date")
    age = F.datediff(last, F.col(day))
    part = lambda lo, hi: F.coalesce(F.sum(F.when(age.between(lo, hi), F.col(value))), F.lit(0)).cast("double") / days
    out = df.groupBy(group).agg(part(0, days - 1).alias("recent"), part(days, 2 * days - 1).alias("previous"))
    return out.withColumn("ratio", F.when(F.col("previous") != 0, F.col("recent") / F.col("previous")))


def dense_days(df: DataFrame, group: str, day: str, value: str, start: str, end: str) -> DataFrame:
    """A row for each group and day from start to end; days without rows have 0."""
    calendar = df.select(group).distinct().select(group, F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(day))
    return calendar.join(df.groupBy(group, day).agg(F.sum(value).alias(value)), [group, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def same_weekday_outliers(daily: DataFrame, group: str, day: str, value: str, least_diff: float, least_rel: float, peers: int = 3) -> DataFrame:
    """The latest day of each group against the median of its earlier same weekdays (``peers`` at least)."""
    latest = daily.groupBy(group).agg(F.max(day).alias("__last"))
    d = daily.join(latest, group).filter(F.weekday(day) == F.weekday("__last"))
    out = d.groupBy(group).agg(
        F.max("__last").alias("latest_day"),
        F.max(F.when(F.col(day) == F.col("__last"), F.col(value))).alias("latest"),
        F.median(F.when(F.col(day) < F.col("__last"), F.col(value))).alias("peer_median"),
        F.count_if(F.col(day) < F.col("__last")).alias("n_peers"),
    )
    diff = F.col("latest") - F.col("peer_median")
    enough = (F.col("n_peers") >= peers) & (F.col("peer_median") != 0)
    return out.withColumn("outlier", F.when(enough, (F.abs(diff) >= least_diff) & (F.abs(diff) / F.col("peer_median") >= least_rel)).otherwise(F.lit(False)))


def lag_change(df: DataFrame, key: Sequence[str], at: str, value: str) -> DataFrame:
    """Each row with the value before it in its key's order and the difference."""
    w = W.partitionBy(*key).orderBy(at)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("delta", F.col(value) - F.col("previous"))


def share_shift(now: DataFrame, then: DataFrame, axis: str, item: str, value: str, least_pp: float = 1.0, per_axis: int = 2, cap: int = 5) -> DataFrame:
    """Items whose share of their axis moved by ``least_pp`` points or more: the largest of each axis, then ``cap`` in all.

    An item that is absent on one side has share 0 there, if the axis has a total.
    """

    def shares(df: DataFrame, name: str) -> DataFrame:
        s = df.groupBy(axis, item).agg(F.sum(value).alias("v"))
        t = s.groupBy(axis).agg(F.sum("v").alias("t"))
        return s.join(t, axis).select(axis, item, F.when(F.col("t") != 0, F.col("v") * 100 / F.col("t")).otherwise(0.0).alias(name))

    both = shares(now, "share_now").join(shares(then, "share_then"), [axis, item], "full").na.fill(0.0, ["share_now", "share_then"])
    both = both.withColumn("shift_pp", F.col("share_now") - F.col("share_then")).filter(F.abs("shift_pp") >= least_pp)
    order = [F.desc(F.abs("shift_pp")), F.desc(item)]
    top = both.withColumn("__r", F.row_number().over(W.partitionBy(axis).orderBy(*order))).filter(F.col("__r") <= per_axis)
    return top.orderBy(*order, axis).limit(cap).drop("__r")


def carry_forward(df: DataFrame, key: Sequence[str], at: str, value: Column, name: str, reach: int) -> DataFrame:
    """The nearest earlier non-null ``value`` within ``reach`` rows, this row included."""
    w = W.partitionBy(*key).orderBy(at).rowsBetween(-reach, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def neighbours(df: DataFrame, key: Sequence[str], at: str, text: str, sep: str = " · ") -> DataFrame:
    w = W.partitionBy(*key).orderBy(at)
    return df.withColumn("context", F.concat_ws(sep, F.lag(text).over(w), F.col(text), F.lead(text).over(w)))


def span_metrics(df: DataFrame, group: Sequence[str], day: str) -> DataFrame:
    """Distinct days, and days from the first to the last, both counted."""
    return df.groupBy(*group).agg(F.countDistinct(day).alias("days"), (F.datediff(F.max(day), F.min(day)) + 1).alias("span_days"))


# --- comparison of a stored state with what is observed now


def compare_state(prior: DataFrame, observed: DataFrame, key: Sequence[str], now: str, baseline: bool = False, refresh: Sequence[str] = ()) -> DataFrame:
    """The next state: key, first_seen, last_seen, refreshed fields and ``status``.

    NEW for keys that the state does not have (BASELINE in the first run: it gives no signals), SEEN for known ones, whose
    fields are refreshed but which are not new, ABSENT for those not observed, which stay as they are.
    """
    p = prior.select(*key, F.col("first_seen"), F.col("last_seen"), *[F.col(c).alias(f"__p_{c}") for c in refresh])
    o = observed.select(*key, *[F.col(c).alias(f"__o_{c}") for c in refresh]).withColumn("__now", F.lit(now).cast("date"))
    both = p.join(o, list(key), "full")
    known, seen = F.col("last_seen").isNotNull(), F.col("__now").isNotNull()
    status = F.when(known & seen, "SEEN").when(known, "ABSENT").otherwise("BASELINE" if baseline else "NEW")
    return both.select(*key, F.coalesce("first_seen", "__now").alias("first_seen"), F.coalesce("__now", "last_seen").alias("last_seen"), *[F.when(seen, F.col(f"__o_{c}")).otherwise(F.col(f"__p_{c}")).alias(c) for c in refresh], status.alias("status"))


def window_diff(prior: DataFrame, observed: DataFrame, source: str, keys: str = "keys", failed: str = "failed", route: str = "route") -> DataFrame:
    """Per source, what a visible window of keys says against the one before.

    FAILED keeps the state and counts nothing (null, not 0); BASELINE without a prior window; BASELINE_ROUTE_CHANGED if
    the route differs; POSSIBLE_GAP if no key is in both windows; NEW or NO_NEW else.
    """
    p = prior.select(F.col(source), F.col(keys).alias("old"), F.col(route).alias("old_route"))
    j = observed.join(p, source, "left")
    new = F.size(F.array_except(keys, "old"))
    status = (
        F.when(F.col(failed), "FAILED")
        .when(F.col("old").isNull() | (F.size("old") == 0), "BASELINE")
        .when(F.col(route) != F.col("old_route"), "BASELINE_ROUTE_CHANGED")
        .when(F.size(F.array_intersect(keys, "old")) == 0, "POSSIBLE_GAP")
        .when(new > 0, "NEW")
        .otherwise("NO_NEW")
    )
    j = j.withColumn("status", status)
    return j.select(source, "status", F.when(F.col("status").isin("NEW", "NO_NEW"), new).alias("n_new"), F.when(F.col("status") == "FAILED", F.col("old")).otherwise(F.array_sort(keys)).alias("kept_keys"))


def series_append(series: DataFrame, snapshot: DataFrame, key: Sequence[str], at: str, keep: int) -> DataFrame:
    """Snapshots by key and reference date: the same date is replaced, a later one appended, an earlier one marked LATE
    and left out; the newest ``keep`` stay. Returns all kept rows with ``status``."""
    latest = series.groupBy(*key).agg(F.max(at).alias("__last"))
    judged = snapshot.join(latest, list(key), "left").withColumn("status", F.when(F.col("__last").isNull(), "FIRST").when(F.col(at) < F.col("__last"), "LATE").when(F.col(at) == F.col("__last"), "REPLACED").otherwise("APPENDED")).drop("__last")
    good = judged.filter("status <> 'LATE'")
    old = series.join(good.select(*key, at), [*key, at], "left_anti").withColumn("status", F.lit("KEPT"))
    ranked = old.unionByName(good).withColumn("__r", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(at)))).filter(F.col("__r") <= keep).drop("__r")
    return ranked.unionByName(judged.filter("status = 'LATE'"))


def retain_newest(df: DataFrame, key: Sequence[str], order: Sequence[Column], keep: int) -> DataFrame:
    """The first ``keep`` rows of each key by ``order``; of the whole table without a key, by a distributed top-k."""
    if not key:
        return df.orderBy(*order).limit(keep)
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter(F.col("__r") <= keep).drop("__r")


def merge_counters(stored: DataFrame, delta: DataFrame, key: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Stored counters plus those of a run; keys of either side."""
    both = stored.select(*key, *counters).unionByName(delta.select(*key, *counters))
    return both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in counters])


def consume_selected(candidates: DataFrame, ledger: DataFrame, key: str, order: Sequence[Column], room: int) -> DataFrame:
    """Unseen candidates; the first ``room`` of them are QUEUED and only those enter the ledger, the others stay OPEN."""
    fresh = candidates.join(ledger.select(key).distinct(), key, "left_anti")
    top = fresh.orderBy(*order).limit(room).select(key).withColumn("__q", F.lit(True))
    return fresh.join(F.broadcast(top), key, "left").withColumn("status", F.when(F.col("__q"), "QUEUED").otherwise("OPEN")).drop("__q")
