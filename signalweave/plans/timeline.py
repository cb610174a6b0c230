"""Queries on series, snapshots and states."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import dates, numbers as num
from ..operators import series as ops
from .base import query, table


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))


def _daily(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type", "d").agg(F.count(F.lit(1)).alias("n"))


_DAILY = "daily AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)"


@query(
    "two_window_means",
    f"""WITH {_DAILY}, w AS (SELECT event_type, CAST(coalesce(sum(n) FILTER (date_diff('day', d, DATE '2024-01-30') BETWEEN 0 AND 6), 0) AS DOUBLE) / 7 AS recent, CAST(coalesce(sum(n) FILTER (date_diff('day', d, DATE '2024-01-30') BETWEEN 7 AND 13), 0) AS DOUBLE) / 7 AS previous FROM daily GROUP BY event_type)
SELECT *, CASE WHEN previous <> 0 THEN recent / previous END AS ratio FROM w""",
)
def two_window_means(spark, sf_dir):
    return ops.two_window_means(_daily(spark, sf_dir), "event_type", "d", "n", "2024-01-30")


@query(
    "dense_days",
    """WITH c AS (SELECT u.user_id, CAST(x.d AS DATE) AS d FROM (SELECT DISTINCT user_id FROM events) u, (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-01-16', INTERVAL 1 DAY)) AS d) x),
n AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)
SELECT c.user_id, c.d, CAST(coalesce(n.n, 0) AS BIGINT) AS n FROM c LEFT JOIN n USING (user_id, d)""",
)
def dense_days(spark, sf_dir):
    daily = events(spark, sf_dir).groupBy("user_id", "d").agg(F.count(F.lit(1)).alias("n"))
    return ops.dense_days(daily, "user_id", "d", "n", "2024-01-10", "2024-01-16")


@query(
    "same_weekday_outliers",
    f"""WITH {_DAILY}, l AS (SELECT event_type, max(d) AS last FROM daily GROUP BY 1), g AS (SELECT event_type, max(last) AS latest_day, max(n) FILTER (d = last) AS latest, CAST(median(n) FILTER (d < last) AS DOUBLE) AS peer_median, count(*) FILTER (d < last) AS n_peers
FROM daily JOIN l USING (event_type) WHERE isodow(d) = isodow(last) GROUP BY event_type)
SELECT *, CASE WHEN n_peers >= 3 AND peer_median <> 0 THEN abs(latest - peer_median) >= 5 AND abs(latest - peer_median) / peer_median >= 0.1 ELSE FALSE END AS outlier FROM g""",
)
def same_weekday_outliers(spark, sf_dir):
    return ops.same_weekday_outliers(_daily(spark, sf_dir), "event_type", "d", "n", 5, 0.1)


@query("snapshot_lag_change", f"WITH {_DAILY} SELECT event_type, d, n, lag(n) OVER w AS previous, n - lag(n) OVER w AS delta FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY d)")
def snapshot_lag_change(spark, sf_dir):
    return ops.lag_change(_daily(spark, sf_dir), ["event_type"], "d", "n")


_AXIS = "e AS (SELECT 'hour' AS axis, CAST(hour(ts) // 6 AS VARCHAR) AS item, CAST(ts AS DATE) AS d FROM events UNION ALL SELECT 'kind', event_type, CAST(ts AS DATE) FROM events)"


@query(
    "share_shift",
    f"""WITH {_AXIS}, s AS (SELECT axis, item, count(*) FILTER (d >= DATE '2024-01-16') AS a, count(*) FILTER (d < DATE '2024-01-16') AS b FROM e GROUP BY ALL),
t AS (SELECT axis, item, CAST(a AS DOUBLE) * 100 / sum(a) OVER (PARTITION BY axis) AS share_now, CAST(b AS DOUBLE) * 100 / sum(b) OVER (PARTITION BY axis) AS share_then FROM s),
r AS (SELECT *, share_now - share_then AS shift_pp, row_number() OVER (PARTITION BY axis ORDER BY abs(share_now - share_then) DESC, item DESC) AS r FROM t WHERE abs(share_now - share_then) >= 0.2)
SELECT axis, item, share_now, share_then, shift_pp FROM r WHERE r <= 2 ORDER BY abs(shift_pp) DESC, item DESC LIMIT 5""",
)
def share_shift(spark, sf_dir):
    e = events(spark, sf_dir)
    a = e.select(F.lit("hour").alias("axis"), F.floor(F.hour("ts") / 6).cast("string").alias("item"), "d").unionByName(e.select(F.lit("kind").alias("axis"), F.col("event_type").alias("item"), "d")).withColumn("v", F.lit(1.0))
    return ops.share_shift(a.filter("d >= '2024-01-16'"), a.filter("d < '2024-01-16'"), "axis", "item", "v", 0.2)


@query("share_vector", f"WITH {_DAILY} SELECT event_type, d, CAST(n AS DOUBLE) * 100 / sum(n) OVER (PARTITION BY d) AS share FROM daily")
def share_vector(spark, sf_dir):
    d = _daily(spark, sf_dir)
    t = d.groupBy("d").agg(F.sum("n").alias("t"))
    return d.join(t, "d").select("event_type", "d", (F.col("n").cast("double") * 100 / F.col("t")).alias("share"))


@query("peak_and_latest", f"WITH {_DAILY} SELECT event_type, arg_min(d, {{'x': -n, 'd': d}}) AS peak_day, max(n) AS peak, max(d) AS latest_day, arg_max(n, d) AS latest FROM daily GROUP BY event_type")
def peak_and_latest(spark, sf_dir):
    return _daily(spark, sf_dir).groupBy("event_type").agg(F.min_by("d", F.struct((-F.col("n")).alias("x"), "d")).alias("peak_day"), F.max("n").alias("peak"), F.max("d").alias("latest_day"), F.max_by("n", "d").alias("latest"))


@query("run_span_metrics", "SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days, date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS span_days FROM events GROUP BY user_id")
def run_span_metrics(spark, sf_dir):
    return ops.span_metrics(events(spark, sf_dir), ["user_id"], "d")


def _state(spark, sf_dir):
    e = events(spark, sf_dir)
    prior = e.filter("d <= '2024-01-03'").groupBy("user_id", "event_type").agg(F.min("d").alias("first_seen"), F.max("d").alias("last_seen"), F.count(F.lit(1)).alias("n"))
    observed = e.filter("d = '2024-01-04'").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return prior, observed


_STATE = """p AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, count(*) AS n FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-03' GROUP BY ALL),
o AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-04' GROUP BY ALL)"""


@query(
    "state_compare",
    f"""WITH {_STATE} SELECT coalesce(p.user_id, o.user_id) AS user_id, coalesce(p.event_type, o.event_type) AS event_type, coalesce(p.first_seen, DATE '2024-01-04') AS first_seen,
CASE WHEN o.n IS NOT NULL THEN DATE '2024-01-04' ELSE p.last_seen END AS last_seen, coalesce(o.n, p.n) AS n, CASE WHEN p.n IS NOT NULL AND o.n IS NOT NULL THEN 'SEEN' WHEN p.n IS NOT NULL THEN 'ABSENT' ELSE 'NEW' END AS status
FROM p FULL JOIN o ON p.user_id = o.user_id AND p.event_type = o.event_type""",
)
def state_compare(spark, sf_dir):
    prior, observed = _state(spark, sf_dir)
    return ops.compare_state(prior, observed, ["user_id", "event_type"], "2024-01-04", refresh=["n"])


@query("state_baseline", f"WITH {_STATE} SELECT user_id, event_type, DATE '2024-01-04' AS first_seen, DATE '2024-01-04' AS last_seen, n, 'BASELINE' AS status FROM o")
def state_baseline(spark, sf_dir):
    prior, observed = _state(spark, sf_dir)
    return ops.compare_state(prior.limit(0), observed, ["user_id", "event_type"], "2024-01-04", baseline=True, refresh=["n"])


@query(
    "window_diff",
    """WITH o AS (SELECT user_id, list_sort(list(event_id)) AS keys, user_id % 11 = 0 AS failed, CASE WHEN user_id % 7 = 0 THEN 'site' ELSE 'portal' END AS route FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY user_id),
p AS (SELECT user_id, list_sort(list(event_id)) AS old FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-05' AND event_type = 'purchase' GROUP BY user_id),
j AS (SELECT o.*, p.old, 'portal' AS old_route, len(list_filter(o.keys, lambda k: NOT list_contains(p.old, k))) AS fresh, len(list_filter(o.keys, lambda k: list_contains(p.old, k))) AS common FROM o LEFT JOIN p USING (user_id)),
s AS (SELECT *, CASE WHEN failed THEN 'FAILED' WHEN old IS NULL THEN 'BASELINE' WHEN route <> old_route THEN 'BASELINE_ROUTE_CHANGED' WHEN common = 0 THEN 'POSSIBLE_GAP' WHEN fresh > 0 THEN 'NEW' ELSE 'NO_NEW' END AS status FROM j)
SELECT user_id, status, CASE WHEN status IN ('NEW', 'NO_NEW') THEN fresh END AS n_new, CASE WHEN failed THEN old ELSE keys END AS kept_keys FROM s""",
)
def window_diff(spark, sf_dir):
    e = events(spark, sf_dir)
    keys = F.array_sort(F.collect_list("event_id")).alias("keys")
    observed = e.filter("d between '2024-01-05' and '2024-01-12'").groupBy("user_id").agg(keys).withColumns({"failed": F.col("user_id") % 11 == 0, "route": F.when(F.col("user_id") % 7 == 0, "site").otherwise("portal")})
    prior = e.filter("d between '2024-01-03' and '2024-01-05' and event_type = 'purchase'").groupBy("user_id").agg(keys).withColumn("route", F.lit("portal"))
    return ops.window_diff(prior, observed, "user_id")


@query(
    "series_append",
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-10' GROUP BY ALL),
x AS (SELECT event_type, CASE event_type WHEN 'click' THEN DATE '2024-01-09' WHEN 'view' THEN DATE '2024-01-10' ELSE DATE '2024-01-11' END AS d, CAST(1 AS BIGINT) AS n FROM (SELECT DISTINCT event_type FROM s)),
j AS (SELECT x.*, CASE WHEN l.last IS NULL THEN 'FIRST' WHEN x.d < l.last THEN 'LATE' WHEN x.d = l.last THEN 'REPLACED' ELSE 'APPENDED' END AS status FROM x LEFT JOIN (SELECT event_type, max(d) AS last FROM s GROUP BY 1) l USING (event_type)),
u AS (SELECT event_type, d, n, 'KEPT' AS status FROM s WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.event_type = s.event_type AND j.d = s.d AND j.status <> 'LATE') UNION ALL SELECT * FROM j WHERE status <> 'LATE'),
k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS r FROM u)
SELECT event_type, d, n, status FROM k WHERE r <= 5 UNION ALL SELECT * FROM j WHERE status = 'LATE'""",
)
def series_append(spark, sf_dir):
    s = _daily(spark, sf_dir).filter("d <= '2024-01-10'")
    at = F.when(F.col("event_type") == "click", "2024-01-09").when(F.col("event_type") == "view", "2024-01-10").otherwise("2024-01-11").cast("date")
    snapshot = s.select("event_type").distinct().select("event_type", at.alias("d"), F.lit(1).cast("long").alias("n"))
    return ops.series_append(s, snapshot, ["event_type"], "d", 5)


@query("retain_newest", "SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3")
def retain_newest(spark, sf_dir):
    return ops.retain_newest(events(spark, sf_dir), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("event_id", "user_id")


@query(
    "query_health_merge",
    """WITH a AS (SELECT event_type, user_id % 5 AS lane, count(*) AS runs, count(*) FILTER (value > 50) AS hits FROM events WHERE day(ts) <= 20 GROUP BY ALL), b AS (SELECT event_type, user_id % 5 AS lane, count(*) AS runs, count(*) FILTER (value > 50) AS hits FROM events WHERE day(ts) > 20 GROUP BY ALL),
m AS (SELECT event_type, lane, CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(hits) AS BIGINT) AS hits FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL)
SELECT *, CASE WHEN runs < 3 THEN 'ACTIVE' WHEN hits = 0 THEN 'PAUSED' WHEN hits * 10 < runs THEN 'REVIEW' ELSE 'ACTIVE' END AS status FROM m""",
)
def query_health_merge(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("lane", F.col("user_id") % 5)
    part = lambda c: e.filter(c).groupBy("event_type", "lane").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("value") > 50).alias("hits"))
    m = ops.merge_counters(part("day(ts) <= 20"), part("day(ts) > 20"), ["event_type", "lane"], ["runs", "hits"])
    return m.withColumn("status", F.when(F.col("runs") < 3, "ACTIVE").when(F.col("hits") == 0, "PAUSED").when(F.col("hits") * 10 < F.col("runs"), "REVIEW").otherwise("ACTIVE"))


@query("budget_remaining", "SELECT event_type, CAST(ts AS DATE) AS d, greatest(0, 70 - count(*)) AS remaining FROM events GROUP BY ALL")
def budget_remaining(spark, sf_dir):
    return _daily(spark, sf_dir).select("event_type", "d", F.greatest(F.lit(0).cast("long"), 70 - F.col("n")).alias("remaining"))


@query(
    "novelty_consume_selected",
    """WITH f AS (SELECT o_custkey, max(o_totalprice) AS best FROM orders WHERE year(o_orderdate) = 2000 GROUP BY 1), l AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1999 AND o_custkey IS NOT NULL)
SELECT o_custkey, CASE WHEN row_number() OVER (ORDER BY best DESC, o_custkey) <= 30 THEN 'QUEUED' ELSE 'OPEN' END AS status FROM f WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.o_custkey = f.o_custkey)""",
)
def novelty_consume_selected(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ledger = o.filter(F.year("o_orderdate") == 1999).select("o_custkey")
    new = o.filter(F.year("o_orderdate") == 2000).groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))
    return ops.consume_selected(new, ledger, "o_custkey", [F.desc("best"), F.asc("o_custkey")], 30).select("o_custkey", "status")


@query("seen_flag", "SELECT o_orderkey, NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND year(p.o_orderdate) = 1999) AS is_new FROM orders o WHERE year(o_orderdate) = 2000")
def seen_flag(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    seen = o.filter(F.year("o_orderdate") == 1999).select("o_custkey").distinct().withColumn("known", F.lit(True))
    return o.filter(F.year("o_orderdate") == 2000).join(seen, "o_custkey", "left").select("o_orderkey", F.col("known").isNull().alias("is_new"))


_FRESH = "CASE WHEN age < 0 THEN 'FUTURE' " + " ".join(f"WHEN cadence = '{c}' AND age <= {a} THEN 'FRESH' WHEN cadence = '{c}' AND age <= {b} THEN 'CARRY' WHEN cadence = '{c}' THEN 'STALE'" for c, (a, b) in dates.CADENCE.items()) + f" WHEN age <= {dates.CADENCE['continuous'][0]} THEN 'FRESH' WHEN age <= {dates.CADENCE['continuous'][1]} THEN 'CARRY' ELSE 'STALE' END"
_NAMES = ["daily", "continuous", "event", "weekly", "monthly", "quarterly", "never"]


@query("freshness_state", f"WITH x AS (SELECT o_orderkey, {_NAMES!r}[CAST(o_orderkey % 7 AS INT) + 1] AS cadence, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-12-31') AS age FROM orders) SELECT o_orderkey, cadence, age, {_FRESH} AS freshness FROM x")
def freshness_state(spark, sf_dir):
    cadence = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("o_orderkey") % 7 + 1).cast("int"))
    x = table(spark, sf_dir, "orders").select("o_orderkey", cadence.alias("cadence"), F.datediff(F.lit(date(2000, 12, 31)), F.to_date("o_orderdate")).alias("age"))
    return x.withColumn("freshness", dates.freshness(F.col("cadence"), F.col("age")))


@query(
    "due_priority",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS due, 'S' || CAST(o_orderkey % 3 + 1 AS VARCHAR) AS stage, 'E' || CAST(o_orderkey % 4 AS VARCHAR) AS evidence FROM orders),
s AS (SELECT *, CASE WHEN due IS NULL THEN 'UNSCHEDULED' WHEN due < DATE '1998-06-01' THEN 'OVERDUE' WHEN due = DATE '1998-06-01' THEN 'DUE_TODAY' ELSE 'UPCOMING' END AS status FROM x)
SELECT o_orderkey, status, CASE WHEN due IS NOT NULL THEN greatest(date_diff('day', due, DATE '1998-06-01'), 0) ELSE 0 END AS overdue, CASE WHEN stage = 'S1' AND (status IN ('OVERDUE', 'DUE_TODAY') OR evidence = 'E3') THEN 'P1' WHEN stage = 'S1' THEN 'P2' ELSE 'P3' END AS priority FROM s""",
)
def due_priority(spark, sf_dir):
    k, as_of = F.col("o_orderkey"), date(1998, 6, 1)
    x = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 10 != 0, F.to_date("o_orderdate")).alias("due"), F.concat(F.lit("S"), (k % 3 + 1).cast("string")).alias("stage"), F.concat(F.lit("E"), (k % 4).cast("string")).alias("evidence"))
    x = x.withColumn("status", dates.due_status(F.col("due"), as_of))
    return x.select("o_orderkey", "status", F.coalesce(dates.overdue_days(F.col("due"), as_of), F.lit(0)).alias("overdue"), dates.priority(F.col("stage"), F.col("status"), F.col("evidence")).alias("priority"))


@query(
    "month_day_rollover",
    """WITH x AS (SELECT o_orderkey, CAST(o_orderkey % 12 + 1 AS INT) AS m, CAST(o_orderkey % 31 + 1 AS INT) AS dd FROM orders), y AS (SELECT *, TRY_CAST('2024-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(dd AS VARCHAR), 2, '0') AS DATE) AS a, TRY_CAST('2023-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(dd AS VARCHAR), 2, '0') AS DATE) AS b FROM x)
SELECT o_orderkey, CASE WHEN a < DATE '2024-03-15' THEN a ELSE b END AS full_date FROM y""",
)
def month_day_rollover(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.month_day((k % 12 + 1).cast("int"), (k % 31 + 1).cast("int"), date(2024, 3, 15)).alias("full_date"))


@query("per_hour_rate", "SELECT event_id, value / greatest(CAST(epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts) AS DOUBLE) / 3600000000, 1.0) AS per_hour FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'")
def per_hour_rate(spark, sf_dir):
    at = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").filter(F.col("ts") < at).select("event_id", dates.per_hour(F.col("value"), F.col("ts"), at).alias("per_hour"))


@query(
    "lifecycle_status",
    """WITH x AS (SELECT a.o_orderkey, date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) AS g, a.o_orderstatus AS s FROM orders a LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderkey = a.o_orderkey - 1)
SELECT o_orderkey, CASE WHEN g IS NULL THEN 'NO_MATCH' WHEN s = 'F' THEN 'RESOLVED' WHEN s = 'P' THEN 'PARTIAL' WHEN abs(g) >= 270 THEN 'REPEATED_LONG' ELSE 'REPEATED_SHORT' END AS status, CAST(abs(g) AS BIGINT) AS gap_days FROM x""",
)
def lifecycle_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    b = o.select((F.col("o_orderkey") + 1).alias("o_orderkey"), "o_custkey", F.col("o_orderdate").alias("before"))
    x = o.join(b, ["o_orderkey", "o_custkey"], "left").withColumn("gap_days", F.abs(F.datediff("o_orderdate", "before")))
    return x.select("o_orderkey", dates.lifecycle(F.col("gap_days"), F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P").alias("status"), "gap_days")


@query("artifact_expired", "SELECT o_orderkey, TIMESTAMP '1998-06-02 00:00:00' > o_orderdate + INTERVAL 26 HOUR AS expired FROM orders")
def artifact_expired(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.expired(F.lit("1998-06-02 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate")).alias("expired"))


@query(
    "quota_day",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, make_date(year(o_orderdate), 4, 1) AS april, make_date(year(o_orderdate), 10, 31) AS october FROM orders)
SELECT o_orderkey, CASE WHEN d > april + CAST((7 - dayofweek(april)) % 7 AS INTEGER) AND d <= october - CAST(dayofweek(october) AS INTEGER) THEN d ELSE d - 1 END AS quota_day FROM o""",
)
def quota_day(spark, sf_dir):
    # Half past seven in UTC is the same day in summer time, the day before in winter time.
    at = F.col("o_orderdate") + F.expr("interval 7 hours 30 minutes")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.quota_day(at).alias("quota_day"))


@query("iso_duration", "SELECT event_id, (hour(ts) * 3600 + CASE WHEN event_type = 'view' THEN 0 ELSE minute(ts) * 60 END + second(ts))::BIGINT AS seconds FROM events")
def iso_duration(spark, sf_dir):
    text = F.concat(F.date_format("ts", "'PT'H'H'"), F.when(F.col("event_type") == "view", "").otherwise(F.date_format("ts", "m'M'")), F.date_format("ts", "s'S'"))
    return table(spark, sf_dir, "events").select("event_id", dates.iso_seconds(text).alias("seconds"))


@query("recency_filter", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 21 DAY AND ts <= TIMESTAMP '2024-01-30 00:00:00'")
def recency_filter(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("ts >= timestamp_ntz'2024-01-30 00:00:00' - interval 21 days and ts <= timestamp_ntz'2024-01-30 00:00:00'").select("event_id")


@query("first_last_seen", "SELECT user_id, arg_min(value, {'t': ts, 'e': event_id}) AS first_value, arg_max(value, {'t': ts, 'e': event_id}) AS last_value, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY user_id")
def first_last_seen(spark, sf_dir):
    at = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


@query(
    "rolling_label_ledger",
    """SELECT user_id, list_sort(list(DISTINCT event_type)) AS labels, max(ts) AS last_seen, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id""",
)
def rolling_label_ledger(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("ts > timestamp_ntz'2024-01-15 00:00:00'").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("labels"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("n"))


@query(
    "revision_repeat_or_new",
    """WITH r AS (SELECT event_id, user_id, sha256(event_type || '|' || CAST(user_id AS VARCHAR)) AS revision, ts FROM events) SELECT event_id, CASE WHEN EXISTS (SELECT 1 FROM r p WHERE p.revision = r.revision AND p.ts < TIMESTAMP '2024-01-15 00:00:00') THEN 'REPEAT' ELSE 'NEW' END AS status FROM r WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
)
def revision_repeat_or_new(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("event_id", F.sha2(F.concat_ws("|", "event_type", F.col("user_id").cast("string")), 256).alias("revision"), "ts")
    seen = r.filter("ts < timestamp_ntz'2024-01-15 00:00:00'").select("revision").distinct().withColumn("known", F.lit(True))
    return r.filter("ts >= timestamp_ntz'2024-01-15 00:00:00'").join(seen, "revision", "left").select("event_id", F.when(F.col("known"), "REPEAT").otherwise("NEW").alias("status"))


@query(
    "processed_history_advance",
    "WITH u AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE year(o_orderdate) IN (1999, 2000)) SELECT id FROM u ORDER BY id DESC LIMIT 200",
)
def processed_history_advance(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old, new = (o.filter(F.year("o_orderdate") == y).select(F.col("o_custkey").alias("id")) for y in (1999, 2000))
    return old.unionByName(new).distinct().orderBy(F.desc("id")).limit(200)
