"""Queries on joins, selections, gates, labels and violations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import numbers as num
from ..operators import gates, joins, numbering, select as sel
from .base import query, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


@query("anti_join_history", "SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o_orderdate) >= 2000)")
def anti_join_history(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(_orders(spark, sf_dir).filter("year(day) >= 2000").select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "ledger_precedence_join",
    """WITH b AS (SELECT c_custkey, c_mktsegment AS segment, c_name AS name FROM customer), p AS (SELECT o_custkey, CASE WHEN count(*) > 3 THEN 'QUEUED' ELSE '' END AS segment, min(o_orderpriority) AS name FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
o AS (SELECT o_custkey, CASE WHEN count(*) > 10 THEN 'BUSY' ELSE '' END AS segment, CASE WHEN count(*) > 5 THEN max(o_orderpriority) END AS name FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(nullif(o.segment, ''), nullif(p.segment, ''), b.segment) AS segment, coalesce(nullif(o.name, ''), nullif(p.name, ''), b.name) AS name FROM b LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN p ON p.o_custkey = c_custkey""",
)
def ledger_precedence_join(spark, sf_dir):
    """A ledger with two overlays: values of the prior queue stand over it, and those of the audit over both."""
    b = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    o, n = _orders(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey"), F.count(F.lit(1))
    prior = o.filter("o_orderstatus = 'F'").groupBy("c_custkey").agg(F.when(n > 3, "QUEUED").otherwise("").alias("segment"), F.min("o_orderpriority").alias("name"))
    audit = o.groupBy("c_custkey").agg(F.when(n > 10, "BUSY").otherwise("").alias("segment"), F.when(n > 5, F.max("o_orderpriority")).alias("name"))
    return joins.with_precedence(joins.with_precedence(b, prior, ["c_custkey"], ["segment", "name"]), audit, ["c_custkey"], ["segment", "name"])


@query("human_label_join", "SELECT d.doc_id, source, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic, l.doc_id IS NOT NULL AS reviewed FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def human_label_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").withColumn("reviewed", F.lit(True)), "doc_id", "left").select("doc_id", "source", "quality", "toxic", F.coalesce("reviewed", F.lit(False)).alias("reviewed"))


@query("exact_id_join", "SELECT o_orderkey, c_custkey, c_name, 'EXACT' AS basis FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT'")
def exact_id_join(spark, sf_dir):
    return _orders(spark, sf_dir).filter("o_orderpriority = '1-URGENT'").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_custkey", "c_name", F.lit("EXACT").alias("basis"))


@query(
    "sibling_events",
    "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'F') >= 2 AS repeated, count(*) FILTER (o_orderstatus = 'P') > 0 AND count(*) FILTER (o_orderstatus = 'F') > 0 AS penalty_with_change FROM orders GROUP BY o_custkey",
)
def sibling_events(spark, sf_dir):
    s = F.col("o_orderstatus")
    c = joins.sibling_counts(_orders(spark, sf_dir), "o_custkey", {"n_f": s == "F", "n_o": s == "O", "n_p": s == "P"})
    return c.select("o_custkey", "n_f", "n_o", (F.col("n_f") >= 2).alias("repeated"), ((F.col("n_p") > 0) & (F.col("n_f") > 0)).alias("penalty_with_change"))


@query(
    "temporal_pairs",
    """WITH p AS (SELECT a.o_custkey, a.o_orderkey AS seed, b.o_orderkey AS candidate, CAST(a.o_orderdate AS DATE) AS da, CAST(b.o_orderdate AS DATE) AS db FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey WHERE a.o_orderpriority = '1-URGENT')
SELECT seed, candidate, least(da, db) AS earlier, greatest(da, db) AS later, abs(date_diff('day', da, db)) AS gap_days FROM p""",
)
def temporal_pairs(spark, sf_dir):
    o = _orders(spark, sf_dir)
    a = o.filter("o_orderpriority = '1-URGENT'").select("o_custkey", F.col("o_orderkey").alias("seed"), F.col("day").alias("da"))
    b = o.select("o_custkey", F.col("o_orderkey").alias("candidate"), F.col("day").alias("db"))
    return a.join(b, "o_custkey").filter("seed <> candidate").select("seed", "candidate", F.least("da", "db").alias("earlier"), F.greatest("da", "db").alias("later"), F.abs(F.datediff("da", "db")).alias("gap_days"))


@query(
    "freshness_two_sides",
    """WITH a AS (SELECT l_suppkey AS k, max(CAST(l_shipdate AS DATE)) AS x FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT s_suppkey AS k, max(CAST(l_shipdate AS DATE)) AS y FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE l_returnflag = 'A' AND s_acctbal > 2000 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS supp, x AS day_r, y AS day_a, CASE WHEN y IS NULL THEN 'ONLY_LEFT' WHEN x IS NULL THEN 'ONLY_RIGHT' WHEN x < y THEN 'LEFT_STALE' WHEN x > y THEN 'RIGHT_STALE' ELSE 'BOTH_CURRENT' END AS status FROM a FULL JOIN b ON a.k = b.k""",
)
def freshness_two_sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supp"), F.to_date("l_shipdate").alias("d"), "l_returnflag")
    a = li.filter("l_returnflag = 'R'").groupBy("supp").agg(F.max("d").alias("day_r"))
    funded = table(spark, sf_dir, "supplier").filter("s_acctbal > 2000").select(F.col("s_suppkey").alias("supp"))
    b = li.filter("l_returnflag = 'A'").join(funded, "supp", "left_semi").groupBy("supp").agg(F.max("d").alias("day_a"))
    return joins.freshness_sides(a, b, "supp", "day_r", "day_a")


@query(
    "registry_cap_violations",
    """WITH r AS (SELECT p_partkey, CASE WHEN p_size < 20 THEN 'L1' WHEN p_size < 40 THEN 'L2' ELSE 'LX' END AS level, CASE p_size % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'partial' WHEN 2 THEN 'full' ELSE 'other' END AS value FROM part)
SELECT p_partkey, level, value, CASE WHEN level = 'LX' THEN 'UNKNOWN_LEVEL' WHEN value = 'other' THEN 'UNKNOWN_VALUE' ELSE 'ABOVE_CAP' END AS problem FROM r WHERE level = 'LX' OR value = 'other' OR (level = 'L1' AND value IN ('partial', 'full')) OR (level = 'L2' AND value = 'full')""",
)
def registry_cap_violations(spark, sf_dir):
    s = F.col("p_size")
    r = table(spark, sf_dir, "part").select("p_partkey", F.when(s < 20, "L1").when(s < 40, "L2").otherwise("LX").alias("level"), F.when(s % 4 == 0, "none").when(s % 4 == 1, "partial").when(s % 4 == 2, "full").otherwise("other").alias("value"))
    caps = spark.createDataFrame([("L1", "none"), ("L2", "partial")], "level string, cap string")
    return joins.cap_violations(r, caps, "level", "value", ["none", "partial", "full"])


@query("foreign_key_check", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 4000)")
def foreign_key_check(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").filter("s_acctbal > 4000").select("s_suppkey")
    return table(spark, sf_dir, "lineitem").join(s, F.col("s_suppkey") == F.col("l_suppkey"), "left_anti").select("l_orderkey", "l_linenumber", "l_suppkey")


# --- selection


@query("best_wins_dedupe", "SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1")
def best_wins_dedupe(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return sel.best_wins(d, ["source", "lang"], [F.col("n_chars")], ["doc_id"]).select("source", "doc_id", "n_chars")


@query(
    "exact_issue_clusters",
    "WITH k AS (SELECT doc_id, CASE WHEN length(text) >= 4 THEN md5(text) ELSE CAST(doc_id AS VARCHAR) END AS cluster_key FROM documents) SELECT doc_id, cluster_key, min(doc_id) OVER (PARTITION BY cluster_key) AS representative_id FROM k",
)
def exact_issue_clusters(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.length("text") >= 4, F.md5(F.col("text").cast("binary"))).otherwise(F.col("doc_id").cast("string")).alias("k"))
    return sel.with_representative(d, F.col("k"), "doc_id", ["doc_id"]).select("doc_id", "cluster_key", "representative_id")


@query(
    "union_first_wins",
    """WITH a AS (SELECT o_custkey AS id, 'persisted' AS origin FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1), b AS (SELECT c_custkey AS id, 'generated' AS origin FROM customer WHERE c_acctbal > 5000)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE id NOT IN (SELECT id FROM a)""",
)
def union_first_wins(spark, sf_dir):
    a = _orders(spark, sf_dir).filter("year(day) = 1998").select(F.col("o_custkey").alias("id")).distinct().withColumn("origin", F.lit("persisted"))
    b = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("id"), F.lit("generated").alias("origin"))
    return sel.union_first(a, b, key=["id"])


@query(
    "id_contract",
    """WITH e AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 2000), g AS (SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'), n AS (SELECT id, count(*) AS c FROM g GROUP BY id)
SELECT coalesce(e.id, n.id) AS id, CASE WHEN e.id IS NULL THEN 'UNKNOWN' WHEN n.id IS NULL THEN 'MISSING' ELSE 'DUPLICATE' END AS problem FROM e FULL JOIN n ON e.id = n.id WHERE e.id IS NULL OR n.id IS NULL OR c > 1""",
)
def id_contract(spark, sf_dir):
    e = table(spark, sf_dir, "customer").filter("c_acctbal > 2000").select(F.col("c_custkey").alias("id"))
    g = _orders(spark, sf_dir).filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    return sel.id_contract(e, g, "id")


@query(
    "round_robin_interleave",
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn, min(doc_id) OVER (PARTITION BY source) AS g FROM documents)
SELECT doc_id, source, row_number() OVER (ORDER BY rn, g, source) AS position FROM r ORDER BY rn, g, source LIMIT 120""",
)
def round_robin_interleave(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sel.interleave(d, "source", [F.desc("n_chars"), F.asc("doc_id")], F.min("doc_id"), 120).select("doc_id", "source", "position")


@query(
    "preferred_order_round_robin",
    """WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY rn, o_orderpriority) AS position FROM r ORDER BY rn, o_orderpriority LIMIT 10""",
)
def preferred_order_round_robin(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_totalprice")
    return sel.interleave(o, "o_orderpriority", [F.desc("o_totalprice"), F.asc("o_orderkey")], F.min("o_orderpriority"), 10).select("o_orderkey", "o_orderpriority", "position")


_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "overdue_rotation",
    f"""WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS rn, (list_position({_SEG!r}, c_mktsegment) - 1 - 7 + 70) % 5 AS turn FROM customer WHERE c_mktsegment IN {tuple(_SEG)!r})
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY rn, turn) AS position FROM r ORDER BY rn, turn LIMIT 40""",
)
def overdue_rotation(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return sel.rotation(c, "c_mktsegment", [F.asc("c_acctbal"), F.asc("c_custkey")], _SEG, 7, 40).select("c_custkey", "c_mktsegment", "position")


@query(
    "sentinel_slot_selection",
    """WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS rn FROM customer)
SELECT c_custkey, 'sentinel' AS slot FROM r WHERE rn <= 2 UNION ALL SELECT c_custkey, 'audit' FROM (SELECT c_custkey, row_number() OVER (ORDER BY (c_custkey - 5 + 100000) % 100000) AS o FROM r WHERE rn > 2) WHERE o <= 20""",
)
def sentinel_slot_selection(spark, sf_dir):
    key = F.asc_nulls_last("c_custkey")
    r = table(spark, sf_dir, "customer").select("c_custkey", F.row_number().over(W.partitionBy("c_mktsegment").orderBy(F.asc_nulls_last("c_acctbal"), key)).alias("rn"))
    # Keys a multiple of 100,000 apart have one place in the audit's cycle; the smaller key comes first, so that the choice is fixed.
    audit = r.filter("rn > 2").orderBy(((F.col("c_custkey") - 5 + 100000) % 100000).asc_nulls_last(), key).limit(20).select("c_custkey", F.lit("audit").alias("slot"))
    return r.filter("rn <= 2").select("c_custkey", F.lit("sentinel").alias("slot")).unionByName(audit)


@query(
    "quota_by_kind",
    """WITH r AS (SELECT o_orderkey, o_orderstatus = 'P' AS s, row_number() OVER (PARTITION BY o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders), n AS (SELECT least(10, count(*) FILTER (s)) AS have FROM r)
SELECT o_orderkey, CASE WHEN s THEN 'special' ELSE 'other' END AS kind FROM r, n WHERE CASE WHEN s THEN rn <= have ELSE rn <= 21 - have END""",
)
def quota_by_kind(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "P", "special").otherwise("other").alias("kind"))
    return sel.quota_by_kind(o, "kind", [F.desc("o_totalprice"), F.asc("o_orderkey")], 21, "special").select("o_orderkey", "kind")


@query(
    "lane_once_by_priority",
    """WITH l AS (SELECT o_custkey AS id, 'primary' AS lane, 1 AS p FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT o_custkey, 'recovery', 2 FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_custkey, 'verification', 3 FROM orders WHERE o_orderpriority = '5-LOW')
SELECT id, arg_min(lane, p) AS lane FROM l GROUP BY id""",
)
def lane_once_by_priority(spark, sf_dir):
    o = gates.lanes(_orders(spark, sf_dir), {"primary": F.col("o_totalprice") > 300000, "recovery": F.col("o_orderstatus") == "P", "verification": F.col("o_orderpriority") == "5-LOW"})
    return sel.lanes_once(o.select(F.col("o_custkey").alias("id"), "lane"), "id", "lane", ["primary", "recovery", "verification"])


@query(
    "cross_lane_selection",
    """WITH a AS (SELECT doc_id AS id, source, n_chars FROM documents WHERE lang = 'en'), b AS (SELECT doc_id AS id, source, n_chars FROM documents WHERE n_chars > 500),
ra AS (SELECT id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, id) AS rn, source FROM a), la AS (SELECT id FROM ra ORDER BY rn, source, id LIMIT 15),
rb AS (SELECT id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, id) AS rn, source FROM b), lb AS (SELECT id FROM rb WHERE id NOT IN (SELECT id FROM la) ORDER BY rn, source, id LIMIT 15),
f AS (SELECT DISTINCT id, n_chars FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE id NOT IN (SELECT id FROM la) AND id NOT IN (SELECT id FROM lb) ORDER BY n_chars, id LIMIT 10)
SELECT id, 'lane1' AS lane FROM la UNION ALL SELECT id, 'lane2' FROM lb UNION ALL SELECT id, 'fill' FROM f""",
)
def cross_lane_selection(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "lang", "n_chars")
    return sel.cross_lane([d.filter("lang = 'en'"), d.filter("n_chars > 500")], "id", "source", [F.desc("n_chars"), F.asc("id")], 15, [F.asc("n_chars")], 40)


@query(
    "family_collapse",
    """WITH d AS (SELECT d.doc_id, md5(text) AS family, n_chars, l.doc_id IS NOT NULL AS reviewed FROM documents d LEFT JOIN labels l USING (doc_id)), p AS (SELECT * FROM d WHERE NOT reviewed AND family NOT IN (SELECT family FROM d WHERE reviewed))
SELECT doc_id, reviewed FROM d WHERE reviewed UNION ALL SELECT doc_id, reviewed FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n_chars DESC, doc_id) AS r FROM p) WHERE r = 1""",
)
def family_collapse(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("family"), "n_chars")
    d = d.join(table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("r")), "doc_id", "left").withColumn("reviewed", F.coalesce("r", F.lit(False))).drop("r")
    done = d.filter("reviewed")
    pending = d.filter("not reviewed").join(done.select("family").distinct(), "family", "left_anti")
    best = sel.best_wins(pending.select("family", "doc_id", "n_chars", "reviewed"), ["family"], [F.col("n_chars")], ["doc_id"])
    return done.select("doc_id", "reviewed").unionByName(best.select("doc_id", "reviewed"))


@query("multi_key_sort_top", "SELECT o_orderkey, row_number() OVER (ORDER BY list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority) IS NULL, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority), o_totalprice DESC, o_orderkey) AS position FROM orders ORDER BY position LIMIT 50")
def multi_key_sort_top(spark, sf_dir):
    rank = F.when(F.array_position(F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM"])), F.col("o_orderpriority")) > 0, F.array_position(F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM"])), F.col("o_orderpriority"))).otherwise(F.lit(9))
    order = [rank.asc(), F.desc("o_totalprice"), F.asc("o_orderkey")]
    top = _orders(spark, sf_dir).orderBy(*order).limit(50)
    return top.select("o_orderkey", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)).alias("position"))


@query("fresh_first_then_older", "SELECT o_orderkey, CAST(o_orderdate AS DATE) >= DATE '2001-01-01' AS fresh FROM orders ORDER BY CAST(o_orderdate AS DATE) >= DATE '2001-01-01' DESC, o_orderkey LIMIT 2000")
def fresh_first_then_older(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", (F.col("day") >= F.lit("2001-01-01").cast("date")).alias("fresh"))
    return o.orderBy(F.desc("fresh"), F.asc("o_orderkey")).limit(2000)


@query("heterogeneous_union", "SELECT 'customer' AS family, c_custkey AS id, c_name AS title, c_acctbal AS amount FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT 'part', p_partkey, p_name, NULL FROM part")
def heterogeneous_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("family"), F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("amount"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("family"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), F.col("s_acctbal").alias("amount"))
    p = table(spark, sf_dir, "part").select(F.lit("part").alias("family"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    return c.unionByName(s).unionByName(p, allowMissingColumns=True)


# --- gates and labels


def _reviewed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")


_REV = "r AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query(
    "gate_cascade",
    f"WITH {_REV} SELECT doc_id, CASE WHEN NOT coalesce(lang IN ('en', 'de'), FALSE) THEN 'LANG' WHEN n_chars < 100 THEN 'SHORT' WHEN quality IS NULL THEN 'UNREVIEWED' WHEN quality <> 1 THEN 'LOW' WHEN toxic <> 0 THEN 'TOXIC' ELSE 'PASS' END AS gate FROM r",
)
def gate_cascade(spark, sf_dir):
    checks = [("LANG", F.col("lang").isin("en", "de")), ("SHORT", F.col("n_chars") >= 100), ("UNREVIEWED", F.col("quality").isNotNull()), ("LOW", F.col("quality") == 1), ("TOXIC", F.col("toxic") == 0)]
    return gates.cascade(_reviewed(spark, sf_dir), checks).select("doc_id", "gate")


@query(
    "proposal_blockers",
    f"WITH {_REV} SELECT doc_id, list_filter([CASE WHEN NOT coalesce(quality = 1, FALSE) THEN 'LOW' END, CASE WHEN NOT coalesce(toxic = 0, FALSE) THEN 'TOXIC' END, CASE WHEN n_chars < 100 THEN 'SHORT' END], lambda x: x IS NOT NULL) AS blockers FROM r",
)
def proposal_blockers(spark, sf_dir):
    return gates.blockers(_reviewed(spark, sf_dir), [("LOW", F.col("quality") == 1), ("TOXIC", F.col("toxic") == 0), ("SHORT", F.col("n_chars") >= 100)]).select("doc_id", "blockers")


@query(
    "lane_routing",
    f"WITH {_REV}, l AS (SELECT doc_id, 'review' AS lane FROM r WHERE quality IS NULL UNION ALL SELECT doc_id, 'publish' FROM r WHERE quality = 1 AND toxic = 0 UNION ALL SELECT doc_id, 'long' FROM r WHERE n_chars > 5000) SELECT * FROM l",
)
def lane_routing(spark, sf_dir):
    return gates.lanes(_reviewed(spark, sf_dir), {"review": F.col("quality").isNull(), "publish": (F.col("quality") == 1) & (F.col("toxic") == 0), "long": F.col("n_chars") > 5000}).select("doc_id", "lane")


@query("funnel_counts", f"WITH {_REV} SELECT count(*) AS total, count(quality) AS reviewed, count(*) FILTER (quality = 1) AS useful, count(*) FILTER (quality = 1 AND toxic = 0) AS clean, count(*) FILTER (n_chars > 5000) AS long FROM r")
def funnel_counts(spark, sf_dir):
    return gates.funnel(_reviewed(spark, sf_dir), {"reviewed": F.col("quality").isNotNull(), "useful": F.col("quality") == 1, "clean": (F.col("quality") == 1) & (F.col("toxic") == 0), "long": F.col("n_chars") > 5000})


@query(
    "source_metrics",
    f"WITH {_REV} SELECT source, count(*) AS n, count(quality) AS reviewed, CAST(count(quality) AS DOUBLE) / count(*) AS completion, median(n_chars) AS median_chars, max(n_chars) AS max_chars, count(DISTINCT lang) AS langs FROM r GROUP BY source",
)
def source_metrics(spark, sf_dir):
    n = F.count(F.lit(1))
    return _reviewed(spark, sf_dir).groupBy("source").agg(n.alias("n"), F.count("quality").alias("reviewed"), num.ratio(F.count("quality").cast("double"), n).alias("completion"), F.median("n_chars").alias("median_chars"), F.max("n_chars").alias("max_chars"), F.countDistinct("lang").alias("langs"))


@query(
    "qualification_path_rollup",
    f"WITH {_REV}, p AS (SELECT source, CASE WHEN quality IS NULL THEN 'hold' WHEN quality = 0 THEN 'archived' WHEN toxic = 1 THEN 'stale' ELSE 'fresh' END AS path FROM r) SELECT source, CAST(grouping(source) AS BIGINT) AS is_total, count(*) AS n, count(*) FILTER (path = 'hold') AS hold, count(*) FILTER (path = 'archived') AS archived, count(*) FILTER (path = 'stale') AS stale, count(*) FILTER (path = 'fresh') AS fresh FROM p GROUP BY ROLLUP (source)",
)
def qualification_path_rollup(spark, sf_dir):
    path = F.when(F.col("quality").isNull(), "hold").when(F.col("quality") == 0, "archived").when(F.col("toxic") == 1, "stale").otherwise("fresh")
    return gates.overall_and_by(_reviewed(spark, sf_dir).withColumn("path", path), "source", {"n": F.count(F.lit(1)), **{p: F.count_if(F.col("path") == p) for p in ("hold", "archived", "stale", "fresh")}})


@query(
    "precision_evaluation",
    f"WITH {_REV} SELECT source, CAST(grouping(source) AS BIGINT) AS is_total, count(*) AS generated, count(quality) AS labeled, count(*) FILTER (quality = 1) AS promising, CASE WHEN count(quality) > 0 THEN CAST(count(*) FILTER (quality = 1) AS DOUBLE) / count(quality) END AS precision, CAST(count(quality) AS DOUBLE) / count(*) AS coverage FROM r GROUP BY ROLLUP (source)",
)
def precision_evaluation(spark, sf_dir):
    good, seen, n = F.count_if(F.col("quality") == 1), F.count("quality"), F.count(F.lit(1))
    return gates.overall_and_by(_reviewed(spark, sf_dir), "source", {"generated": n, "labeled": seen, "promising": good, "precision": num.ratio(good.cast("double"), seen), "coverage": num.ratio(seen.cast("double"), n)})


@query(
    "editorial_gate",
    f"""WITH {_REV}, g AS (SELECT source, count(*) AS n, count(quality) AS reviewed, count(*) FILTER (quality IS NOT NULL OR n_chars < 2000) AS done, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad FROM r GROUP BY source),
s AS (SELECT source, n, reviewed, CAST(done AS DOUBLE) / n AS completion, CASE WHEN reviewed > 0 THEN CAST(good AS DOUBLE) / reviewed END AS useful, CASE WHEN reviewed > 0 THEN CAST(bad AS DOUBLE) / reviewed END AS noise FROM g)
SELECT source, completion, useful, noise, CASE WHEN NOT (completion >= 0.8 AND reviewed >= least(10, n)) THEN 'INSUFFICIENT' WHEN useful >= 0.35 AND noise <= 0.5 THEN 'DEEPEN' WHEN useful >= 0.15 THEN 'AUXILIARY' ELSE 'STOP' END AS verdict FROM s""",
)
def editorial_gate(spark, sf_dir):
    n, seen = F.count(F.lit(1)), F.count("quality")
    # Short texts are done without a review.
    done = F.count_if(F.col("quality").isNotNull() | (F.col("n_chars") < 2000)).cast("double")
    g = _reviewed(spark, sf_dir).groupBy("source").agg(n.alias("n"), seen.alias("reviewed"), (done / n).alias("completion"), num.ratio(F.count_if(F.col("quality") == 1).cast("double"), seen).alias("useful"), num.ratio(F.count_if(F.col("toxic") == 1).cast("double"), seen).alias("noise"))
    return g.select("source", "completion", "useful", "noise", gates.editorial_verdict(F.col("completion"), F.col("reviewed"), F.col("n"), F.col("useful"), F.col("noise")).alias("verdict"))


@query(
    "scorecard_rates",
    "SELECT source, count(*) AS n, CAST(count(*) FILTER (length(text) >= 200) AS DOUBLE) / count(*) AS body_rate, CAST(count(DISTINCT sha256(text)) AS DOUBLE) / count(*) AS unique_content_rate, CASE WHEN CAST(count(*) FILTER (length(text) >= 200) AS DOUBLE) / count(*) < 0.6 THEN 'FIX_BODY' WHEN CAST(count(DISTINCT sha256(text)) AS DOUBLE) / count(*) < 0.95 THEN 'FIX_DUPLICATES' ELSE 'READY' END AS technical_gate FROM documents GROUP BY source",
)
def scorecard_rates(spark, sf_dir):
    n = F.count(F.lit(1))
    g = table(spark, sf_dir, "documents").groupBy("source").agg(n.alias("n"), (F.count_if(F.length("text") >= 200).cast("double") / n).alias("body_rate"), (F.countDistinct(F.sha2(F.col("text"), 256)).cast("double") / n).alias("unique_content_rate"))
    return g.withColumn("technical_gate", F.when(F.col("body_rate") < 0.6, "FIX_BODY").when(F.col("unique_content_rate") < 0.95, "FIX_DUPLICATES").otherwise("READY"))


@query(
    "outcome_thresholds",
    f"""WITH {_REV}, g AS (SELECT lang, count(quality) AS docs, CASE WHEN count(quality) > 0 THEN 100.0 * count(*) FILTER (quality = 1) / count(quality) END AS extraction, CASE WHEN count(quality) > 0 THEN 100.0 * count(*) FILTER (toxic = 0) / count(quality) END AS grounding FROM r GROUP BY lang)
SELECT lang, docs, CAST(extraction AS DOUBLE) AS extraction, CAST(grounding AS DOUBLE) AS grounding, CASE WHEN docs < 12 THEN 'COLLECTING' WHEN extraction >= 80 AND grounding >= 90 THEN 'PASS' WHEN extraction >= 80 OR grounding >= 90 THEN 'REVISE' ELSE 'FAIL' END AS outcome FROM g""",
)
def outcome_thresholds(spark, sf_dir):
    seen = F.count("quality")
    pct = lambda c: F.when(seen > 0, F.lit(100.0) * F.count_if(c) / seen)
    g = _reviewed(spark, sf_dir).groupBy("lang").agg(seen.alias("docs"), pct(F.col("quality") == 1).alias("extraction"), pct(F.col("toxic") == 0).alias("grounding"))
    a, b = F.col("extraction") >= 80, F.col("grounding") >= 90
    return g.withColumn("outcome", F.when(F.col("docs") < 12, "COLLECTING").when(a & b, "PASS").when(a | b, "REVISE").otherwise("FAIL"))


@query("error_summary", "SELECT o_orderstatus AS stage, o_orderpriority AS kind, count(*) AS n, count(DISTINCT o_custkey) AS sources FROM orders WHERE o_totalprice > 200000 GROUP BY ALL")
def error_summary(spark, sf_dir):
    return _orders(spark, sf_dir).filter("o_totalprice > 200000").groupBy(F.col("o_orderstatus").alias("stage"), F.col("o_orderpriority").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("sources"))


@query("coverage_with_zero_lanes", "WITH lanes(lane) AS (VALUES ('en'), ('de'), ('xx')), c AS (SELECT lang, count(*) AS n, count(*) FILTER (n_chars > 1000) AS selected FROM documents GROUP BY lang) SELECT lane, coalesce(n, 0) AS expected, coalesce(selected, 0) AS selected FROM lanes LEFT JOIN c ON lang = lane")
def coverage_with_zero_lanes(spark, sf_dir):
    lanes = spark.createDataFrame([("en",), ("de",), ("xx",)], "lane string")
    c = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("lane")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 1000).alias("s"))
    return lanes.join(c, "lane", "left").select("lane", F.coalesce("n", F.lit(0)).cast("long").alias("expected"), F.coalesce("s", F.lit(0)).cast("long").alias("selected"))


@query(
    "cluster_readiness",
    """WITH l AS (SELECT DISTINCT lang AS cluster, doc_id, source, n_chars FROM documents), g AS (SELECT cluster, count(DISTINCT source) AS channels, count(DISTINCT source) FILTER (n_chars > 2000) AS concrete_channels, count(*) FILTER (n_chars > 2000) AS concrete FROM l GROUP BY cluster)
SELECT *, CASE WHEN channels >= 2 AND concrete >= 2 THEN 'READY' ELSE 'WATCH' END AS readiness, channels * 3 + least(concrete, 10) * 2 AS score FROM g""",
)
def cluster_readiness(spark, sf_dir):
    long = F.col("n_chars") > 2000
    g = table(spark, sf_dir, "documents").select(F.col("lang").alias("cluster"), "doc_id", "source", "n_chars").distinct().groupBy("cluster").agg(F.countDistinct("source").alias("channels"), F.countDistinct(F.when(long, F.col("source"))).alias("concrete_channels"), F.count_if(long).alias("concrete"))
    return g.withColumn("readiness", F.when((F.col("channels") >= 2) & (F.col("concrete") >= 2), "READY").otherwise("WATCH")).withColumn("score", F.col("channels") * 3 + F.least(F.col("concrete"), F.lit(10)) * 2)


@query(
    "group_merge_for_review",
    """WITH a AS (SELECT conv_id, coalesce(text, '') AS text, min(turn) AS t, count(*) AS n FROM conversations GROUP BY ALL), r AS (SELECT conv_id, list_sort(list(DISTINCT role)) AS roles FROM conversations GROUP BY conv_id)
SELECT conv_id, list_slice(list(text ORDER BY t, text), 1, 8) AS anchors, CAST(sum(n) AS BIGINT) AS n_turns, CAST(least(count(*), 8) AS BIGINT) AS n_anchors, any_value(roles) AS roles FROM a JOIN r USING (conv_id) GROUP BY conv_id""",
)
def group_merge_for_review(spark, sf_dir):
    """Members of a group merged: the first 8 distinct texts in the order in which they first occur, all members counted, sorted roles."""
    c = table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id", F.coalesce("text", F.lit("")).alias("text")).agg(F.min("turn").alias("t"), F.count(F.lit(1)).alias("n"), F.collect_set("role").alias("r"))
    anchors = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("t", "text"))), lambda x: x["text"]), 1, 8)
    merged = per.groupBy("conv_id").agg(anchors.alias("anchors"), F.sum("n").alias("n_turns"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("r")))).alias("roles"))
    return merged.withColumn("n_anchors", F.size("anchors").cast("long"))


@query(
    "rule_violations",
    """SELECT o_orderkey, rule FROM (SELECT o_orderkey, unnest([CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'STATUS_DOMAIN' END, CASE WHEN o_totalprice < 1000 THEN 'PRICE_FLOOR' END, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'CONDITIONAL' END]) AS rule FROM orders) WHERE rule IS NOT NULL""",
)
def rule_violations(spark, sf_dir):
    s = F.col("o_orderstatus")
    return gates.violations(_orders(spark, sf_dir), "o_orderkey", {"STATUS_DOMAIN": s.isin("F", "O"), "PRICE_FLOOR": F.col("o_totalprice") >= 1000, "CONDITIONAL": (s != "F") | (F.col("o_orderpriority") != "5-LOW")})


@query("unique_key_violations", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_key_violations(spark, sf_dir):
    return gates.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "marginals_integrity",
    """WITH m AS (SELECT CAST(ts AS DATE) AS d, count(*) AS total, count(*) FILTER (hour(ts) BETWEEN 6 AND 23) AS by_hour, count(*) FILTER (event_type IN ('click', 'view', 'purchase')) AS by_kind, count(user_id) AS by_user, count(*) FILTER (value >= 0) AS by_value, count(*) FILTER (regexp_matches(props, '[0-9]+')) AS by_prop, count(ts) AS by_minute FROM events GROUP BY 1),
f AS (SELECT *, list_filter([CASE WHEN by_hour <> total THEN 'by_hour' END, CASE WHEN by_kind <> total THEN 'by_kind' END, CASE WHEN by_user <> total THEN 'by_user' END, CASE WHEN by_value <> total THEN 'by_value' END, CASE WHEN by_prop <> total THEN 'by_prop' END, CASE WHEN by_minute <> total THEN 'by_minute' END], lambda x: x IS NOT NULL) AS differing FROM m)
SELECT *, len(differing) = 0 AS agrees FROM f""",
)
def marginals_integrity(spark, sf_dir):
    """Six marginals of a day's events; those of hours and kinds have no class for nights and errors, so they fall short where there are such."""
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    marginals = {
        "by_hour": F.when(F.hour("ts").between(6, 23), F.hour("ts")), "by_kind": F.when(F.col("event_type").isin("click", "view", "purchase"), F.col("event_type")), "by_user": F.col("user_id"),
        "by_value": F.when(F.col("value") >= 0, F.floor("value")), "by_prop": F.nullif(F.regexp_extract("props", "([0-9]+)", 1), F.lit("")), "by_minute": F.minute("ts"),
    }
    return numbering.marginal_sums(e, ["d"], F.lit(1), marginals)


@query(
    "column_profile",
    """WITH c AS (SELECT 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS v FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders UNION ALL SELECT 'o_totalprice', CAST(o_totalprice AS VARCHAR) FROM orders)
SELECT "column", count(*) FILTER (length(trim(v)) > 0) AS non_empty, count(*) FILTER (TRY_CAST(v AS DOUBLE) IS NOT NULL) AS numeric, count(*) FILTER (TRY_CAST(v AS DOUBLE) IS NOT NULL) >= 0.98 * count(*) AS is_numeric FROM c GROUP BY 1""",
)
def column_profile(spark, sf_dir):
    return gates.profile(_orders(spark, sf_dir), ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("set_cover_proof", "WITH need(k) AS (VALUES ('click'), ('view'), ('purchase'), ('refund')), g AS (SELECT DISTINCT event_type FROM events WHERE day(ts) = 3) SELECT k AS run, event_type IS NOT NULL AS succeeded FROM need LEFT JOIN g ON k = event_type")
def set_cover_proof(spark, sf_dir):
    need = spark.createDataFrame([("click",), ("view",), ("purchase",), ("refund",)], "run string")
    got = table(spark, sf_dir, "events").filter("day(ts) = 3").select(F.col("event_type").alias("run")).distinct().withColumn("ok", F.lit(True))
    return need.join(got, "run", "left").select("run", F.coalesce("ok", F.lit(False)).alias("succeeded"))


@query(
    "decision_recording",
    "WITH d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'KEEP' WHEN o_orderkey % 3 = 1 THEN 'DROP' ELSE 'WHAT' END AS decision FROM orders), q AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O'), p AS (SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '5-LOW') SELECT id, decision FROM d WHERE decision IN ('KEEP', 'DROP') AND id IN (SELECT id FROM q) AND id NOT IN (SELECT id FROM p) ORDER BY id DESC LIMIT 200",
)
def decision_recording(spark, sf_dir):
    o = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority")
    d = o.select("id").withColumn("decision", F.when(F.col("id") % 3 == 0, "KEEP").when(F.col("id") % 3 == 1, "DROP").otherwise("WHAT"))
    good = d.filter(F.col("decision").isin("KEEP", "DROP")).join(o.filter("o_orderstatus = 'O'"), "id", "left_semi").join(o.filter("o_orderpriority = '5-LOW'"), "id", "left_anti")
    return good.orderBy(F.desc("id")).limit(200)


@query(
    "failed_is_not_zero",
    """WITH s AS (SELECT source, count(*) FILTER (quality = 1) > 0 AS ok, count(*) FILTER (toxic = 1) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source)
SELECT source, CASE WHEN NOT ok THEN 'FAILED' WHEN n = 0 THEN 'EMPTY' ELSE 'OK' END AS status, CASE WHEN ok THEN n END AS n FROM s""",
)
def failed_is_not_zero(spark, sf_dir):
    """A source whose collection failed has no count; one that was read and had nothing has a count of zero."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    per = d.groupBy("source").agg((F.count_if(F.col("quality") == 1) > 0).alias("ok"), F.count_if(F.col("toxic") == 1).alias("n"))
    return per.select("source", gates.collection_status(F.col("ok"), F.col("n")).alias("status"), F.when(F.col("ok"), F.col("n")).alias("n"))
