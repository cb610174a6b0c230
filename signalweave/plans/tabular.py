"""Queries on sales cells: comparison of periods, floors, directions, shares and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as num
from ..operators import cells as ops
from .base import FACTS, facts, query, table

_CELLS = f"""WITH {FACTS},
cells AS (SELECT industry, area, yr, sum(amount) AS amount, count(DISTINCT okey) AS tx, count(DISTINCT supp) AS stores FROM facts WHERE yr IN (2000, 1999) GROUP BY ALL),
m AS (SELECT n.industry, n.area, CAST(n.amount AS DOUBLE) AS amount_now, CAST(t.amount AS DOUBLE) AS amount_then, n.tx AS tx_now, t.tx AS tx_then, n.stores AS stores_now, t.stores AS stores_then
      FROM cells n JOIN cells t ON n.industry = t.industry AND n.area = t.area AND n.yr = 2000 AND t.yr = 1999),
c AS (SELECT *, CASE WHEN amount_then > 0 THEN (amount_now - amount_then) / amount_then END AS d_amount,
   CASE WHEN tx_then > 0 THEN CAST(tx_now - tx_then AS DOUBLE) / tx_then END AS d_tx,
   CASE WHEN stores_then > 0 THEN CAST(stores_now - stores_then AS DOUBLE) / stores_then END AS d_stores FROM m),
s AS (SELECT *, CASE WHEN d_amount IS NULL OR d_tx IS NULL OR d_stores IS NULL THEN 'UNCOMPARABLE'
   WHEN d_amount >= 0.0 AND d_tx >= 0.0 AND d_stores >= 0.0 THEN 'UP' WHEN d_amount <= 0.0 AND d_tx <= 0.0 AND d_stores <= 0.0 THEN 'DOWN' ELSE 'MIXED' END AS direction FROM c)
"""


def signals(spark, sf_dir):
    """Cells of industry and area, 2000 against 1999, on amount, orders and suppliers."""
    m = ops.matched_cells(facts(spark, sf_dir), ["industry", "area"], "yr", 2000, 1999, {"amount": F.sum("amount"), "tx": F.countDistinct("okey"), "stores": F.countDistinct("supp")})
    m = m.withColumns({"amount_now": F.col("amount_now").cast("double"), "amount_then": F.col("amount_then").cast("double")})
    m = m.withColumns({f"d_{k}": num.change_fraction(F.col(f"{k}_now"), F.col(f"{k}_then")) for k in ("amount", "tx", "stores")})
    return m.withColumn("direction", ops.direction([F.col("d_amount"), F.col("d_tx"), F.col("d_stores")], [0.0] * 3, [0.0] * 3))


@query("matched_cell_yoy", _CELLS + "SELECT * FROM s WHERE stores_now >= 3 AND stores_then >= 3")
def matched_cell_yoy(spark, sf_dir):
    return signals(spark, sf_dir).filter("stores_now >= 3 and stores_then >= 3")


@query("dimension_filter_prefix", f"WITH {FACTS} SELECT industry, area, yr, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM facts WHERE starts_with(industry, 'Brand#1') AND area IN ('1-URGENT', '2-HIGH') AND yr IN (1997, 1999) AND q = 1 GROUP BY ALL")
def dimension_filter_prefix(spark, sf_dir):
    f = facts(spark, sf_dir).filter(F.col("industry").startswith("Brand#1") & F.col("area").isin("1-URGENT", "2-HIGH") & F.col("yr").isin(1997, 1999) & (F.col("q") == 1))
    return f.groupBy("industry", "area", "yr").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("total"))


@query("base_size_floor", _CELLS + "SELECT industry, area, tx_now, stores_now, amount_now FROM c WHERE tx_now >= 20 AND stores_now >= 10 AND abs(d_amount) >= 0.05")
def base_size_floor(spark, sf_dir):
    return signals(spark, sf_dir).filter("tx_now >= 20 and stores_now >= 10 and abs(d_amount) >= 0.05").select("industry", "area", "tx_now", "stores_now", "amount_now")


@query(
    "latest_common_period",
    """WITH a AS (SELECT DISTINCT year(o_orderdate) AS yr, quarter(o_orderdate) AS q FROM orders),
b AS (SELECT DISTINCT year(l_shipdate) AS yr, quarter(l_shipdate) AS q FROM lineitem), c AS (SELECT * FROM a INTERSECT SELECT * FROM b)
SELECT yr, q, yr - 1 AS prior_yr FROM c WHERE EXISTS (SELECT 1 FROM a p WHERE p.yr = c.yr - 1 AND p.q = c.q) ORDER BY yr DESC, q DESC LIMIT 1""",
)
def latest_common_period(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("yr"), F.quarter("o_orderdate").alias("q")).distinct()
    b = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("yr"), F.quarter("l_shipdate").alias("q"))
    prior = a.select((F.col("yr") + 1).alias("yr"), "q")
    return ops.latest_common(a.join(prior, ["yr", "q"], "left_semi"), b, ["yr", "q"]).select("yr", "q", (F.col("yr") - 1).alias("prior_yr"))


@query("last_wins_cells", f"WITH {FACTS} SELECT industry, area, yr, CAST(amount AS DOUBLE) AS amount, okey, CAST(line AS BIGINT) AS line FROM facts QUALIFY row_number() OVER (PARTITION BY industry, area, yr ORDER BY okey DESC, line DESC, amount DESC) = 1")
def last_wins_cells(spark, sf_dir):
    f = facts(spark, sf_dir).select("industry", "area", "yr", F.col("amount").cast("double").alias("amount"), "okey", "line")
    return ops.last_wins(f, ["industry", "area", "yr"], ["okey", "line", "amount"])


@query("first_wins_cells", f"WITH {FACTS} SELECT industry, area, yr, CAST(amount AS DOUBLE) AS amount, okey, CAST(line AS BIGINT) AS line FROM facts QUALIFY row_number() OVER (PARTITION BY industry, area, yr ORDER BY okey, line, amount) = 1")
def first_wins_cells(spark, sf_dir):
    f = facts(spark, sf_dir).select("industry", "area", "yr", F.col("amount").cast("double").alias("amount"), "okey", "line")
    return ops.first_wins(f, ["industry", "area", "yr"], ["okey", "line", "amount"])


@query(
    "change_variants",
    _CELLS
    + """SELECT industry, area, d_amount AS fraction, CASE WHEN tx_then <> 0 THEN CAST(tx_now - tx_then AS DOUBLE) / tx_then END AS signed,
CASE WHEN amount_then <> 0 THEN (amount_now / amount_then - 1) * 100 END AS percent,
(CAST(tx_now AS DOUBLE) / (SELECT sum(tx_now) FROM c) - CAST(tx_then AS DOUBLE) / (SELECT sum(tx_then) FROM c)) * 100 AS share_pp FROM c""",
)
def change_variants(spark, sf_dir):
    s = signals(spark, sf_dir)
    totals = s.agg(F.sum("tx_now").alias("all_now"), F.sum("tx_then").alias("all_then"))
    return s.join(F.broadcast(totals)).select(
        "industry",
        "area",
        F.col("d_amount").alias("fraction"),
        num.change_signed(F.col("tx_now"), F.col("tx_then")).alias("signed"),
        num.change_percent(F.col("amount_now"), F.col("amount_then")).alias("percent"),
        num.share_points(F.col("tx_now"), F.col("all_now"), F.col("tx_then"), F.col("all_then")).alias("share_pp"),
    )


_QUARTILE = """, r AS (SELECT {g} CAST({v} AS DOUBLE) AS v, row_number() OVER ({w} ORDER BY {v}) AS rn, count(*) OVER ({w}) AS n FROM c WHERE {v} > 0),
p AS (SELECT {g} n, greatest(1, least(CAST(floor((n + 1) * 0.25) AS BIGINT), n - 1)) AS j, (n + 1) * 0.25 - greatest(1, least(CAST(floor((n + 1) * 0.25) AS BIGINT), n - 1)) AS d FROM r GROUP BY ALL)
"""


@query(
    "exclusive_quartile_floor",
    _CELLS + _QUARTILE.format(g="", v="tx_now", w="") + "SELECT CAST(lo.v * (1 - p.d) + hi.v * p.d AS DOUBLE) AS floor FROM p JOIN r lo ON lo.rn = p.j JOIN r hi ON hi.rn = p.j + 1",
)
def exclusive_quartile_floor(spark, sf_dir):
    return ops.exclusive_quartile(signals(spark, sf_dir).withColumn("tx_now", F.col("tx_now").cast("double")), "tx_now")


@query(
    "quartile_floor_by_area",
    _CELLS + _QUARTILE.format(g="area,", v="stores_now", w="PARTITION BY area") + "SELECT p.area, CAST(lo.v * (1 - p.d) + hi.v * p.d AS DOUBLE) AS floor FROM p JOIN r lo ON lo.rn = p.j AND lo.area = p.area JOIN r hi ON hi.rn = p.j + 1 AND hi.area = p.area",
)
def quartile_floor_by_area(spark, sf_dir):
    return ops.exclusive_quartile(signals(spark, sf_dir).withColumn("stores_now", F.col("stores_now").cast("double")), "stores_now", ["area"])


@query("group_median", _CELLS + "SELECT area, median(d_amount) AS median_change, count(*) AS n FROM c GROUP BY area")
def group_median(spark, sf_dir):
    return signals(spark, sf_dir).groupBy("area").agg(F.median("d_amount").alias("median_change"), F.count(F.lit(1)).alias("n"))


@query("having_min_groups", _CELLS + "SELECT industry, direction, count(*) AS n_areas FROM s WHERE direction IN ('UP', 'DOWN') GROUP BY ALL HAVING count(*) >= 2")
def having_min_groups(spark, sf_dir):
    s = signals(spark, sf_dir).filter(F.col("direction").isin("UP", "DOWN"))
    return s.groupBy("industry", "direction").agg(F.count(F.lit(1)).alias("n_areas")).filter("n_areas >= 2")


@query(
    "dominance_split",
    _CELLS
    + """, g AS (SELECT area, count(*) FILTER (direction = 'UP') AS n_up, count(*) FILTER (direction = 'DOWN') AS n_down FROM s GROUP BY area)
SELECT *, CASE WHEN n_up >= 5 AND n_down >= 5 THEN 'SPLIT' WHEN n_up >= 5 AND n_up >= greatest(2 * n_down, 5) THEN 'UP' WHEN n_down >= 5 AND n_down >= greatest(2 * n_up, 5) THEN 'DOWN' ELSE 'NONE' END AS verdict FROM g""",
)
def dominance_split(spark, sf_dir):
    return ops.dominance(signals(spark, sf_dir), ["area"], "direction")


@query("top_examples_per_group", _CELLS + ", r AS (SELECT area, industry, d_amount, row_number() OVER (PARTITION BY area ORDER BY abs(d_amount) DESC, industry) AS rank FROM c) SELECT area, list(industry ORDER BY rank) AS examples FROM r WHERE rank <= 4 GROUP BY area")
def top_examples_per_group(spark, sf_dir):
    top = ops.top_in_group(signals(spark, sf_dir), ["area"], [F.desc(F.abs("d_amount")), F.asc("industry")], 4)
    return top.groupBy("area").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "industry"))), lambda x: x["industry"]).alias("examples"))


@query(
    "weighted_totals",
    _CELLS
    + """, g AS (SELECT industry, sum(CAST(amount_now AS DECIMAL(20,4))) AS a, sum(CAST(amount_then AS DECIMAL(20,4))) AS b, count(*) FILTER (d_amount >= 0.1) AS strong_up, count(*) FILTER (d_amount <= -0.1) AS strong_down FROM c GROUP BY industry)
SELECT industry, CAST(a AS DOUBLE) AS now_amount, CAST(b AS DOUBLE) AS then_amount, CASE WHEN b <> 0 THEN (CAST(a AS DOUBLE) - CAST(b AS DOUBLE)) / CAST(b AS DOUBLE) END AS change, strong_up, strong_down,
CASE WHEN strong_up > 0 AND strong_down > 0 THEN FALSE ELSE greatest(strong_up, strong_down) >= 2 END AS priority FROM g""",
)
def weighted_totals(spark, sf_dir):
    g = signals(spark, sf_dir).groupBy("industry").agg(
        F.sum(num.exact(F.col("amount_now"))).cast("double").alias("now_amount"),
        F.sum(num.exact(F.col("amount_then"))).cast("double").alias("then_amount"),
        F.count_if(F.col("d_amount") >= 0.1).alias("strong_up"),
        F.count_if(F.col("d_amount") <= -0.1).alias("strong_down"),
    )
    mixed = (F.col("strong_up") > 0) & (F.col("strong_down") > 0)
    return g.select("industry", "now_amount", "then_amount", num.change_signed(F.col("now_amount"), F.col("then_amount")).alias("change"), "strong_up", "strong_down", (~mixed & (F.greatest("strong_up", "strong_down") >= 2)).alias("priority"))


@query(
    "night_share_completeness",
    """WITH e AS (SELECT user_id % 20 AS area, CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS half, hour(ts) AS h, CAST(value AS DECIMAL(20,4)) AS v, event_type FROM events),
g AS (SELECT area, count(*) FILTER (half = 1) AS n1, count(*) FILTER (half = 2) AS n2, sum(v) FILTER (half = 1) AS t, coalesce(sum(v) FILTER (half = 1 AND h >= 21), 0) AS nt, list_sort(list(DISTINCT event_type)) AS names FROM e GROUP BY area)
SELECT CAST(area AS BIGINT) AS area, CASE WHEN t IS NULL OR t = 0 THEN 0.0 ELSE CAST(nt AS DOUBLE) / CAST(t AS DOUBLE) END AS night_share, names FROM g WHERE n1 > 0 AND n2 > 0""",
)
def night_share_completeness(spark, sf_dir):
    v, first = num.exact(F.col("value")), F.dayofmonth("ts") <= 15
    g = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("area")).agg(
        F.count_if(first).alias("n1"),
        F.count_if(~first).alias("n2"),
        F.sum(F.when(first, v)).cast("double").alias("t"),
        F.coalesce(F.sum(F.when(first & (F.hour("ts") >= 21), v)).cast("double"), F.lit(0.0)).alias("nt"),
        F.array_sort(F.collect_set("event_type")).alias("names"),
    )
    return g.filter("n1 > 0 and n2 > 0").select("area", F.coalesce(num.share_or_zero(F.col("nt"), F.col("t")), F.lit(0.0)).alias("night_share"), "names")


@query("column_family_sum", "SELECT o_orderpriority AS area, CAST(sum(CAST(l_quantity AS DECIMAL(20,4)) + CAST(l_tax AS DECIMAL(20,4))) AS DOUBLE) AS family_a, CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4)) - CAST(l_discount AS DECIMAL(20,4))) AS DOUBLE) AS family_b FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def column_family_sum(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("area")), F.col("l_orderkey") == F.col("o_orderkey"))
    x = lambda c: num.exact(F.col(c))
    return li.groupBy("area").agg(F.sum(x("l_quantity") + x("l_tax")).cast("double").alias("family_a"), F.sum(x("l_extendedprice") - x("l_discount")).cast("double").alias("family_b"))


@query("frequency_table", f"WITH {FACTS} SELECT industry, status, count(*) AS n FROM facts GROUP BY ALL")
def frequency_table(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("industry", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "top_k_per_group",
    f"""WITH {FACTS}, g AS (SELECT area, industry, sum(amount) AS total FROM facts GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY total DESC, industry) AS rank FROM g)
SELECT area, industry, CAST(total AS DOUBLE) AS total, rank FROM r WHERE rank <= 2""",
)
def top_k_per_group(spark, sf_dir):
    g = facts(spark, sf_dir).groupBy("area", "industry").agg(F.sum("amount").alias("total"))
    return ops.top_in_group(g, ["area"], [F.desc("total"), F.asc("industry")], 2).withColumn("total", F.col("total").cast("double"))


@query(
    "trajectory_three_points",
    f"""WITH {FACTS}, g AS (SELECT industry, CAST(sum(amount) FILTER (yr = 1998) AS DOUBLE) AS a, CAST(sum(amount) FILTER (yr = 1999) AS DOUBLE) AS b, CAST(sum(amount) FILTER (yr = 2000) AS DOUBLE) AS c FROM facts GROUP BY industry),
l AS (SELECT *, CASE WHEN a > 0 THEN (b - a) / a END AS x, CASE WHEN b > 0 THEN (c - b) / b END AS y FROM g)
SELECT industry, a, b, c, CASE WHEN x IS NULL OR y IS NULL THEN 'UNCOMPARABLE' WHEN x >= 0.05 AND y >= 0.05 THEN 'RISING' WHEN x <= -0.05 AND y <= -0.05 THEN 'FALLING' WHEN x >= 0.05 AND y <= -0.05 THEN 'PEAK' WHEN x <= -0.05 AND y >= 0.05 THEN 'TROUGH' ELSE 'MIXED' END AS trajectory FROM l""",
)
def trajectory_three_points(spark, sf_dir):
    by = lambda y: F.sum(F.when(F.col("yr") == y, F.col("amount"))).cast("double")
    g = facts(spark, sf_dir).groupBy("industry").agg(by(1998).alias("a"), by(1999).alias("b"), by(2000).alias("c"))
    return g.withColumn("trajectory", ops.trajectory([F.col("a"), F.col("b"), F.col("c")]))


@query(
    "control_group_verdict",
    _CELLS
    + """, g AS (SELECT count(*) FILTER (area = '1-URGENT') AS n_treated, count(*) FILTER (area = '1-URGENT' AND d_amount < 0) AS treated_declining, count(*) FILTER (area <> '1-URGENT') AS n_controls, count(*) FILTER (area <> '1-URGENT' AND d_amount < 0) AS controls_declining FROM c)
SELECT *, CASE WHEN n_treated > 0 AND treated_declining = n_treated AND controls_declining <= greatest(1.0, n_controls / 3) THEN 'STRENGTHENED' WHEN controls_declining >= n_controls * 2 / 3 THEN 'BROAD' ELSE 'MIXED' END AS verdict FROM g""",
)
def control_group_verdict(spark, sf_dir):
    return ops.control_verdict(signals(spark, sf_dir), F.col("area") == "1-URGENT", F.col("d_amount") < 0)


_BANDS = {"work": (9, 17), "evening": (18, 22), "night": (0, 5)}
_BAND_SQL = "(VALUES ('work', 9, 17), ('evening', 18, 22), ('night', 0, 5)) b(band, lo, hi)"


@query(
    "weekday_balanced_mean",
    f"""WITH d AS (SELECT event_type, band, CAST(ts AS DATE) AS d, sum(CAST(value AS DECIMAL(20,4))) AS t FROM events JOIN {_BAND_SQL} ON hour(ts) BETWEEN lo AND hi GROUP BY ALL),
w AS (SELECT event_type, band, isodow(d) AS w, CAST(sum(t) AS DOUBLE) / count(*) AS m FROM d GROUP BY ALL)
SELECT event_type, band, CAST(sum(CAST(m AS DECIMAL(30,8))) AS DOUBLE) / count(*) AS balanced_mean, count(*) AS weekdays FROM w GROUP BY ALL""",
)
def weekday_balanced_mean(spark, sf_dir):
    from ..functions.dates import band

    e = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("d"), F.explode(band(F.hour("ts"), _BANDS)).alias("band"), num.exact(F.col("value")).alias("v"))
    return ops.weekday_balanced(e, ["event_type", "band"], "d", "v")


@query("hour_bands", f"SELECT hour(ts) AS h, band, count(*) AS n FROM events JOIN {_BAND_SQL} ON hour(ts) BETWEEN lo AND hi GROUP BY ALL")
def hour_bands(spark, sf_dir):
    from ..functions.dates import band

    e = table(spark, sf_dir, "events").select(F.hour("ts").alias("h"), F.explode(band(F.hour("ts"), _BANDS)).alias("band"))
    return e.groupBy("h", "band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "coverage_diagnostic",
    """SELECT n_name, count(*) FILTER (s_suppkey IS NOT NULL) AS matched, count(*) FILTER (s_suppkey IS NULL) AS unmatched, list_slice(list_sort(list(c_custkey) FILTER (s_suppkey IS NULL)), 1, 3) AS examples
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_suppkey = c_custkey GROUP BY n_name""",
)
def coverage_diagnostic(spark, sf_dir):
    from pyspark.sql.window import Window as W

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    j = c.join(table(spark, sf_dir, "supplier").select("s_suppkey"), F.col("s_suppkey") == F.col("c_custkey"), "left")
    missing = j.filter("s_suppkey is null").select("n_name", "c_custkey")
    few = missing.withColumn("r", F.row_number().over(W.partitionBy("n_name").orderBy("c_custkey"))).filter("r <= 3").groupBy("n_name").agg(F.array_sort(F.collect_list("c_custkey")).alias("examples"))
    counts = j.groupBy("n_name").agg(F.count("s_suppkey").alias("matched"), F.count_if(F.col("s_suppkey").isNull()).alias("unmatched"))
    return counts.join(few, "n_name", "left")


@query(
    "join_trace_funnel",
    """SELECT count(*) AS total, count(*) FILTER (contains(p_type, 'STEEL') OR contains(p_type, 'type')) AS contains_term, count(*) FILTER (p_brand IN ('Brand#1', 'Brand#11')) AS exact_term, count(*) FILTER (m.k IS NOT NULL) AS mapped, count(*) FILTER (m.k IS NOT NULL AND p_size <= 10) AS in_target
FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem) m ON m.k = p_partkey""",
)
def join_trace_funnel(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k")).distinct()
    j = table(spark, sf_dir, "part").join(m, F.col("k") == F.col("p_partkey"), "left")
    mapped = F.col("k").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.contains("p_type", F.lit("STEEL")) | F.contains("p_type", F.lit("type"))).alias("contains_term"),
        F.count_if(F.col("p_brand").isin("Brand#1", "Brand#11")).alias("exact_term"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(mapped & (F.col("p_size") <= 10)).alias("in_target"),
    )


@query("dimension_lookup", "SELECT r_name, n_name, count(*) AS n, CAST(sum(CAST(s_acctbal AS DECIMAL(20,4))) AS DOUBLE) AS balance FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'AFRICA') GROUP BY ALL")
def dimension_lookup(spark, sf_dir):
    dims = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).filter(F.col("r_name").isin("ASIA", "EUROPE", "AFRICA"))
    return table(spark, sf_dir, "supplier").join(F.broadcast(dims), F.col("n_nationkey") == F.col("s_nationkey")).groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.sum(num.exact(F.col("s_acctbal"))).cast("double").alias("balance"))


@query(
    "safe_number_codes",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' || CAST(o_orderkey AS VARCHAR) || '.0 ' ELSE CAST(o_orderkey AS VARCHAR) END AS raw_code, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) || ',000' END AS raw_num FROM orders)
SELECT o_orderkey, regexp_replace(trim(raw_code), '\\.0$', '') AS code, coalesce(TRY_CAST(replace(raw_num, ',', '') AS DOUBLE), 0.0) AS lenient, TRY_CAST(replace(raw_num, ',', '') AS DOUBLE) AS strict FROM x""".replace("\\\\", "\\"),
)
def safe_number_codes(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    raw_code = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), k, F.lit(".0 "))).otherwise(k)
    raw_num = F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a")).otherwise(F.concat(k, F.lit(",000")))
    return table(spark, sf_dir, "orders").select("o_orderkey", num.code(raw_code).alias("code"), num.safe_number(raw_num).alias("lenient"), num.strict_number(raw_num).alias("strict"))
