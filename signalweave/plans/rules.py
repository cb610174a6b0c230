"""Queries on rules, contracts, ranks and the remaining small operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as txt
from ..operators import context, gates, rules, similarity
from .base import query, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


_SIG = "CASE WHEN length(text) = 0 THEN 'EMPTY' WHEN contains(lower(text), 'licensed') AND NOT contains(text, 'the ') THEN 'BOILERPLATE' WHEN n_chars < 150 AND NOT regexp_matches(text, '\\d') THEN 'TOO_SHORT' WHEN contains(text, '|') AND NOT contains(text, 'the ') AND NOT regexp_matches(text, '\\d') THEN 'ROUTINE' WHEN contains(text, 'the ') AND regexp_matches(text, '\\d') THEN 'MEASURED_HARM' WHEN contains(text, 'the ') THEN 'DIRECT_HARM' WHEN regexp_matches(text, '\\d') THEN 'MEASURED' WHEN n_chars > 3000 THEN 'STRUCTURE' ELSE 'NONE' END"


@query(
    "content_precheck",
    f"WITH c AS (SELECT doc_id, {_SIG} AS content_class FROM documents) SELECT *, CASE WHEN content_class IN ('EMPTY', 'BOILERPLATE') THEN 'FAIL' WHEN content_class IN ('TOO_SHORT', 'ROUTINE', 'NONE') THEN 'HOLD' ELSE 'PASS' END AS precheck, content_class IN ('MEASURED_HARM', 'DIRECT_HARM', 'MEASURED') AS usable FROM c",
)
def content_precheck(spark, sf_dir):
    t = F.col("text")
    d = rules.content_class(
        table(spark, sf_dir, "documents"),
        {"empty": F.length(t) == 0, "boilerplate": F.contains(F.lower(t), F.lit("licensed")), "short": F.col("n_chars") < 150, "routine": F.contains(t, F.lit("|")), "harm": F.contains(t, F.lit("the ")), "measured": t.rlike(r"\d"), "structure": F.col("n_chars") > 3000},
    )
    return d.select("doc_id", "content_class", "precheck", "usable")


@query(
    "question_contract",
    """WITH q AS (SELECT o_orderkey, o_orderstatus AS rule, CASE o_orderstatus WHEN 'F' THEN 'Why did ' || o_orderpriority || ' cost ' || CAST(o_custkey AS VARCHAR) || '?' WHEN 'O' THEN 'Who pays for ' || o_orderpriority || ' in 1999?' END AS question, 'about ' || o_orderpriority || ' ' || CAST(o_custkey AS VARCHAR) AS src FROM orders)
SELECT o_orderkey, question, CASE WHEN question IS NULL THEN ['no template'] WHEN rule = 'O' AND NOT contains(src, ' 1999') THEN ['number 1999'] WHEN rule = 'O' AND NOT regexp_matches(src, ' 1999$') THEN ['number 1999'] ELSE [] END AS issues, CASE WHEN question IS NULL OR (rule = 'O' AND NOT regexp_matches(src, ' 1999$')) THEN 'HOLD' ELSE 'PASS' END AS grounding FROM q""",
)
def question_contract(spark, sf_dir):
    t = spark.createDataFrame([("F", "Why did {kind} cost {n}?", ["kind", "n"]), ("O", "Who pays for {kind} in 1999?", ["kind"])], "rule string, template string, needs array<string>")
    o = _orders(spark, sf_dir).withColumn("src", F.concat(F.lit("about "), "o_orderpriority", F.lit(" "), F.col("o_custkey").cast("string")))
    return rules.questions(o, "o_orderstatus", t, {"kind": F.col("o_orderpriority"), "n": F.col("o_custkey")}, "src").select("o_orderkey", "question", "issues", "grounding")


@query("bounded_review_window", "SELECT o_orderkey, o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_totalprice > 50000 AND month(o_orderdate) <> 11 AND date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-12-31') BETWEEN 0 AND 89 AND date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-01-15') BETWEEN 0 AND 89 AS open FROM orders")
def bounded_review_window(spark, sf_dir):
    age, source_age = (F.datediff(F.lit(d).cast("date"), F.col("day")) for d in ("2000-12-31", "2001-01-15"))
    return _orders(spark, sf_dir).select("o_orderkey", rules.review_window(F.col("o_orderstatus") == "F", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), F.col("o_totalprice") > 50000, F.month("day") != 11, age, source_age, 90, 89).alias("open"))


@query("review_eligibility", "SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN l.quality = 1 ELSE n_chars > 1000 END AS eligible FROM documents d LEFT JOIN labels l USING (doc_id)")
def review_eligibility(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", F.when(F.col("quality").isNotNull(), F.col("quality") == 1).otherwise(F.col("n_chars") > 1000).alias("eligible"))


@query("fail_closed_gate", "SELECT d.doc_id, CASE WHEN lang = 'en' AND coalesce(quality, 0) <> 1 THEN FALSE ELSE n_chars > 500 END AS qualified, CASE WHEN lang = 'en' AND coalesce(quality, 0) <> 1 THEN 'HOLD' ELSE 'PASS' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)")
def fail_closed_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumns({"qualified": F.col("n_chars") > 500, "status": F.lit("PASS")})
    return rules.fail_closed(d, F.col("lang") == "en", F.col("quality") == 1, ["qualified"], "status").select("doc_id", "qualified", "status")


@query("triage_exception", "SELECT d.doc_id, quality IS NULL AND n_chars >= 800 AND contains(text, 'the ') AS triage FROM documents d LEFT JOIN labels l USING (doc_id)")
def triage_exception(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    missing = F.array_compact(F.array(F.when(F.col("quality").isNull(), "quality"), F.when(F.col("text").isNull(), "text")))
    only = (F.size(missing) > 0) & (F.size(F.array_except(missing, F.array(F.lit("quality")))) == 0)
    return d.select("doc_id", (only & (F.col("n_chars") >= 800) & F.contains("text", F.lit("the "))).alias("triage"))


@query("threshold_by_kind", "SELECT doc_id, CASE WHEN lang = 'en' THEN n_chars >= 400 ELSE n_chars >= 600 END AS qualified, n_chars >= CASE WHEN lang = 'en' THEN 600 ELSE 700 END AS localised FROM documents")
def threshold_by_kind(spark, sf_dir):
    en, n = F.col("lang") == "en", F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", (n >= F.when(en, 400).otherwise(600)).alias("qualified"), (n >= F.when(en, 600).otherwise(700)).alias("localised"))


@query("metric_period_state", r"SELECT doc_id, CASE WHEN NOT regexp_matches(text, '\d') THEN 'N_A' WHEN regexp_matches(text, '(19|20)\d\d') THEN 'EXPLICIT' WHEN contains(lower(text), 'version') THEN 'RELATIVE' ELSE 'UNKNOWN' END AS period FROM documents")
def metric_period_state(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", txt.first_rule([(~t.rlike(r"\d"), "N_A"), (t.rlike(r"(19|20)\d\d"), "EXPLICIT"), (F.contains(F.lower(t), F.lit("version")), "RELATIVE")], "UNKNOWN").alias("period"))


@query("bottleneck_first_match", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'STATUS' WHEN o_totalprice < 5000 THEN 'VALUE' WHEN o_orderpriority = '5-LOW' THEN 'PRIORITY' ELSE 'READY' END AS bottleneck FROM orders")
def bottleneck_first_match(spark, sf_dir):
    checks = [("STATUS", F.col("o_orderstatus") != "P"), ("VALUE", F.col("o_totalprice") >= 5000), ("PRIORITY", F.col("o_orderpriority") != "5-LOW")]
    return gates.cascade(_orders(spark, sf_dir), checks, "READY", "bottleneck").select("o_orderkey", "bottleneck")


@query(
    "briefing_sections",
    """WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 3), v AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT * FROM f) ORDER BY o_totalprice DESC, o_orderkey LIMIT 4),
r AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT * FROM f) AND o_orderkey NOT IN (SELECT * FROM v) ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
SELECT o_orderkey, 'final' AS section FROM f UNION ALL SELECT o_orderkey, 'verify' FROM v UNION ALL SELECT o_orderkey, 'raw' FROM r""",
)
def briefing_sections(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    order, out = [F.desc("o_totalprice"), F.asc("o_orderkey")], None
    for name, cond, n in (("final", "o_orderstatus = 'F'", 3), ("verify", "o_orderpriority = '1-URGENT'", 4), ("raw", "true", 10)):
        rest = o.filter(cond)
        if out is not None:
            # At most 7 rows are chosen so far.
            rest = rest.join(F.broadcast(out.select("o_orderkey")), "o_orderkey", "left_anti")
        top = rest.orderBy(*order).limit(n).select("o_orderkey", F.lit(name).alias("section"))
        out = top if out is None else out.unionByName(top)
    return out


@query("directory_listed_check", r"WITH d AS (SELECT DISTINCT regexp_replace(lower(url), '\?.*$', '') AS u FROM pages WHERE regexp_extract(html, '<title>([^<]*)', 1) <> '') SELECT page_id, CASE WHEN coalesce(html, '') = '' THEN 'SOURCE_UNAVAILABLE' WHEN d.u IS NOT NULL THEN 'LISTED' ELSE 'NOT_LISTED' END AS status FROM pages p LEFT JOIN d ON d.u = regexp_replace(lower(p.url), '\?.*$', '')")
def directory_listed_check(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.lower("url"), r"\?.*$", "").alias("u"), "html")
    d = p.filter(F.regexp_extract("html", "<title>([^<]*)", 1) != "").select("u").distinct().withColumn("listed", F.lit(True))
    return p.join(d, "u", "left").select("page_id", F.when(F.coalesce("html", F.lit("")) == "", "SOURCE_UNAVAILABLE").when(F.col("listed"), "LISTED").otherwise("NOT_LISTED").alias("status"))


@query("prefix_dimension_lookup", "WITH x AS (SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code FROM customer), n AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS p, n_name FROM nation WHERE n_regionkey < 3) SELECT c_custkey, n_name FROM x JOIN n ON left(code, 2) = p")
def prefix_dimension_lookup(spark, sf_dir):
    x = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("code"))
    n = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("p"), "n_name")
    return x.join(F.broadcast(n), F.substring("code", 1, 2) == F.col("p")).select("c_custkey", "n_name")


@query("projection_caps", "SELECT doc_id, left(text, 400) AS body, list_slice(string_split(left(text, 400), ' '), 1, 4) AS first_words FROM documents")
def projection_caps(spark, sf_dir):
    b = F.substring("text", 1, 400)
    return table(spark, sf_dir, "documents").select("doc_id", b.alias("body"), F.slice(F.split(b, " "), 1, 4).alias("first_words"))


@query("editorial_prefilter", "SELECT doc_id FROM documents WHERE length(text) > 0 AND source NOT IN ('src1', 'src2') AND NOT contains(lower(text), 'licensed')")
def editorial_prefilter(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter((F.length("text") > 0) & ~F.col("source").isin("src1", "src2") & ~F.contains(F.lower("text"), F.lit("licensed"))).select("doc_id")


@query("facet_options", "SELECT 'lang' AS facet, lang AS option, count(*) AS n FROM documents WHERE n_chars > 500 GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE n_chars > 500 GROUP BY source")
def facet_options(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("n_chars > 500")
    e = d.select(F.explode(F.array(F.struct(F.lit("lang").alias("facet"), F.col("lang").alias("option")), F.struct(F.lit("source").alias("facet"), F.col("source").alias("option")))).alias("x"))
    return e.groupBy("x.facet", "x.option").agg(F.count(F.lit(1)).alias("n"))


@query(
    "record_rank",
    "SELECT doc_id, row_number() OVER (ORDER BY coalesce(quality = 1, FALSE) DESC, lang <> 'en' OR coalesce(toxic = 0, FALSE) DESC, regexp_matches(text, '[0-9]') DESC, source LIKE '%1' DESC, n_chars > 500 DESC, quality IS NOT NULL DESC, len(string_split(text, chr(10))) DESC, length(text) DESC, doc_id) AS position FROM documents LEFT JOIN labels USING (doc_id) ORDER BY position LIMIT 120",
)
def record_rank(spark, sf_dir):
    """Eight components: qualified, context, values, fresh, precheck, grounded, score, length; all the greater the better, then the smaller id."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    parts = [yes(F.col("quality") == 1), (F.col("lang") != "en") | yes(F.col("toxic") == 0), F.col("text").rlike("[0-9]"), F.col("source").like("%1"), F.col("n_chars") > 500, F.col("quality").isNotNull(), F.size(F.split("text", "\n")), F.length("text")]
    order = [*[F.desc(f"r{i}") for i in range(len(parts))], F.asc("doc_id")]
    top = d.select("doc_id", *[p.alias(f"r{i}") for i, p in enumerate(parts)]).orderBy(*order).limit(120)
    return top.select("doc_id", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)).alias("position"))


@query("operational_rank", "WITH m AS (SELECT o_custkey, count(*) AS matches, max(o_totalprice) AS score FROM orders GROUP BY 1) SELECT o_custkey, row_number() OVER (ORDER BY matches DESC, score DESC, o_custkey) AS position FROM m ORDER BY position LIMIT 25")
def operational_rank(spark, sf_dir):
    order = [F.desc("matches"), F.desc("score"), F.asc("o_custkey")]
    m = _orders(spark, sf_dir).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("matches"), F.max("o_totalprice").alias("score")).orderBy(*order).limit(25)
    return m.select("o_custkey", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)).alias("position"))


@query("stable_descending_sort", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_brand FROM part ORDER BY p_size DESC, p_brand DESC, p_partkey LIMIT 30")
def stable_descending_sort(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("int"), "p_brand").orderBy(F.desc("p_size"), F.desc("p_brand"), F.asc("p_partkey")).limit(30)


@query("keyed_upsert_tail", "WITH n AS (SELECT o_custkey AS id, max(o_orderkey) AS v FROM orders WHERE year(o_orderdate) = 2000 GROUP BY 1), o AS (SELECT o_custkey AS id, max(o_orderkey) AS v FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1) SELECT * FROM (SELECT * FROM n UNION ALL SELECT * FROM o WHERE id NOT IN (SELECT id FROM n)) ORDER BY v DESC, id LIMIT 50")
def keyed_upsert_tail(spark, sf_dir):
    part = lambda y: _orders(spark, sf_dir).filter(f"year(day) = {y}").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").alias("v"))
    return rules.keyed_upsert(part(1999), part(2000), "id", [F.desc("v"), F.asc("id")], 50)


@query("document_identity", "WITH a AS (SELECT doc_id, source, sha256(text) AS h FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), b AS (SELECT doc_id, source, sha256(text) AS h FROM documents) SELECT doc_id FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.doc_id = b.doc_id) AND NOT EXISTS (SELECT 1 FROM a WHERE a.source = b.source AND a.h = b.h)")
def document_identity(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.col("text"), 256).alias("h"))
    a, b = d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"), d
    return b.join(a.select("doc_id"), "doc_id", "left_anti").join(a.select("source", "h"), ["source", "h"], "left_anti").select("doc_id")


@query("external_grouping_checked", "WITH m AS (SELECT c_custkey AS id, c_custkey // 3 AS g FROM customer WHERE c_acctbal > 2000), n AS (SELECT g, count(*) AS c FROM m GROUP BY g HAVING count(*) >= 2), k AS (SELECT id, g FROM m JOIN n USING (g)) SELECT c_custkey AS id, coalesce('g' || CAST(g AS VARCHAR), 'single-' || CAST(c_custkey AS VARCHAR)) AS \"group\" FROM customer LEFT JOIN k ON k.id = c_custkey")
def external_grouping_checked(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    c = customers.select(F.col("c_custkey").alias("id"))
    g = customers.filter("c_acctbal > 2000").select(F.col("c_custkey").alias("id"), F.concat(F.lit("g"), F.floor(F.col("c_custkey") / 3).cast("string")).alias("g")).groupBy("g").agg(F.collect_list("id").alias("members"), F.min("id").alias("rep"))
    return rules.validated_groups(g, c, "g", "id", "rep")


@query("headline_copies_quote", r"WITH t AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(split_part(text, chr(10), 1)), '([0-9A-Za-zÀ-ɏ가-힣]{2,})', 1), lambda t: NOT regexp_matches(t, '^[0-9]+$'))) AS h, list_distinct(list_filter(regexp_extract_all(lower(split_part(text, chr(10), 2)), '([0-9A-Za-zÀ-ɏ가-힣]{2,})', 1), lambda t: NOT regexp_matches(t, '^[0-9]+$'))) AS q FROM documents) SELECT doc_id, CASE WHEN len(h) > 0 THEN CAST(len(list_intersect(h, q)) AS DOUBLE) / len(h) > 0.9 ELSE FALSE END AS copies FROM t")
def headline_copies_quote(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", txt.copies_quote(F.split_part("text", F.lit("\n"), F.lit(1)), F.split_part("text", F.lit("\n"), F.lit(2))).alias("copies"))


@query("archetype_promotion", "WITH c AS (SELECT doc_id, CASE WHEN contains(lower(text), 'licensed') THEN 'official' WHEN contains(text, '|') THEN 'table' ELSE 'other' END AS base, CASE WHEN contains(text, 'the ') THEN 1 ELSE 0 END + CASE WHEN contains(text, 'and ') THEN 1 ELSE 0 END + CASE WHEN contains(text, 'of ') THEN 1 ELSE 0 END AS hits FROM documents) SELECT doc_id, CASE WHEN base = 'other' AND hits >= 2 THEN 'explained' ELSE base END AS archetype FROM c")
def archetype_promotion(spark, sf_dir):
    t = F.col("text")
    base = txt.first_rule([(F.contains(F.lower(t), F.lit("licensed")), "official"), (F.contains(t, F.lit("|")), "table")], "other")
    hits = txt.points(*[(F.contains(t, F.lit(w)), 1) for w in ("the ", "and ", "of ")])
    return table(spark, sf_dir, "documents").select("doc_id", F.when((base == "other") & (hits >= 2), "explained").otherwise(base).alias("archetype"))


@query("claim_classification", "SELECT conv_id, turn, CASE WHEN contains(lower(text), 'that the') THEN 'HEARSAY' WHEN role = 'user' AND contains(lower(text), ' an ') THEN 'SELF_REPORTED' WHEN contains(lower(text), ' to ') THEN 'IDEA' ELSE 'UNRESOLVED' END AS claim FROM conversations")
def claim_classification(spark, sf_dir):
    low = F.lower("text")
    has = lambda w: F.contains(low, F.lit(w))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", txt.first_rule([(has("that the"), "HEARSAY"), ((F.col("role") == "user") & has(" an "), "SELF_REPORTED"), (has(" to "), "IDEA")], "UNRESOLVED").alias("claim"))


@query("recommendation_gate", "WITH g AS (SELECT source, CAST(count(*) FILTER (n_chars > 1000) AS DOUBLE) / count(*) AS rate, count(*) AS n FROM documents GROUP BY source) SELECT source, CASE WHEN n < 10 THEN 'COLLECT_MORE' WHEN rate >= 0.6 THEN 'KEEP' WHEN rate >= 0.4 THEN 'TUNE' ELSE 'PAUSE' END AS recommendation FROM g")
def recommendation_gate(spark, sf_dir):
    n = F.count(F.lit(1))
    rate = F.count_if(F.col("n_chars") > 1000).cast("double") / n
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.when(n < 10, "COLLECT_MORE").when(rate >= 0.6, "KEEP").when(rate >= 0.4, "TUNE").otherwise("PAUSE").alias("recommendation"))


@query("production_shadow_partition", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 50000 THEN 'production' ELSE 'shadow' END AS track FROM orders")
def production_shadow_partition(spark, sf_dir):
    good, rest = gates.partition_by_gate(_orders(spark, sf_dir), (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50000))
    return good.select("o_orderkey", F.lit("production").alias("track")).unionByName(rest.select("o_orderkey", F.lit("shadow").alias("track")))


@query("one_signal_per_query", "SELECT event_type, user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY value DESC, event_id) = 1")
def one_signal_per_query(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.min_by("event_id", F.struct((-F.col("value")).alias("v"), "event_id")).alias("event_id"))


@query(
    "resumable_chunks",
    "WITH w AS (SELECT doc_id, n_chars // 1000 + 1 AS n FROM documents), c AS (SELECT doc_id, 1 - quality AS next_chunk, 3 * toxic AS failures FROM labels), j AS (SELECT w.doc_id, n, coalesce(next_chunk, 0) AS k, coalesce(failures, 0) AS f FROM w LEFT JOIN c USING (doc_id)), x AS (SELECT doc_id, n, CASE WHEN f >= 3 THEN k + 1 ELSE k END AS chunk, f >= 3 AS skipped FROM j) SELECT doc_id, chunk, skipped FROM x WHERE chunk < n ORDER BY chunk, doc_id LIMIT 600",
)
def resumable_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    w = d.select("doc_id", (F.floor(F.col("n_chars") / 1000) + 1).alias("n"))
    c = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("next_chunk"), (3 * F.col("toxic")).alias("failures"))
    return rules.next_chunks(w, c, "doc_id", "n", 600)


@query("resumable_backfill", "WITH s AS (SELECT s_suppkey AS id FROM supplier), t AS (SELECT s_suppkey AS id, s_suppkey % 3 = 0 AS complete, s_suppkey % 4 + 1 AS next_page, s_suppkey % 50 AS done_lookback FROM supplier WHERE s_acctbal > 1000) SELECT s.id, CASE WHEN coalesce(complete, FALSE) THEN 1 ELSE coalesce(next_page, 1) END AS page FROM s LEFT JOIN t USING (id) WHERE NOT coalesce(complete, FALSE) OR coalesce(done_lookback, 0) < 30")
def resumable_backfill(spark, sf_dir):
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("id"))
    t = table(spark, sf_dir, "supplier").filter("s_acctbal > 1000").select(k.alias("id"), (k % 3 == 0).alias("complete"), (k % 4 + 1).alias("next_page"), (k % 50).alias("done_lookback"))
    return rules.backfill_pages(s, t, "id", 30).select("id", F.col("page").cast("long"))


@query("review_sheet_problems", "WITH l AS (SELECT doc_id, source, quality, row_number() OVER (ORDER BY doc_id) + 1 AS line, row_number() OVER (PARTITION BY source, quality ORDER BY doc_id) AS nth FROM documents JOIN labels USING (doc_id)) SELECT line, CASE WHEN quality = 0 THEN 'LABEL' WHEN source = 'src1' THEN 'DATE' ELSE 'REPEATED' END AS problem FROM l WHERE quality = 0 OR source = 'src1' OR nth > 1")
def review_sheet_problems(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source", F.when(F.col("quality") == 0, "WHAT").otherwise("PROMISING").alias("label"), F.when(F.col("source") == "src1", "not a day").otherwise("2024-01-01").alias("day"))
    return rules.numbered_review_problems(d, "doc_id", ["source", "label"], ["PROMISING", "NOISE"], "label", "day")


@query("six_score_contract", "WITH a AS (SELECT o_orderkey, [o_orderkey % 3, o_custkey % 3, o_orderkey % 4, o_custkey % 2, o_orderkey % 2, o_orderkey % 3] AS s, o_orderkey % 3 + o_custkey % 3 + o_orderkey % 4 + o_custkey % 2 + o_orderkey % 2 + o_orderkey % 3 + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS total FROM orders) SELECT o_orderkey, unnest(list_filter([CASE WHEN list_max(s) > 2 THEN 'SCORE_RANGE' END, CASE WHEN list_sum(s) <> total THEN 'TOTAL' END], lambda x: x IS NOT NULL)) AS rule FROM a")
def six_score_contract(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = F.array(k % 3, c % 3, k % 4, c % 2, k % 2, k % 3)
    a = _orders(spark, sf_dir).select("o_orderkey", s.alias("s"), (k % 3 + c % 3 + k % 4 + c % 2 + k % 2 + k % 3 + F.when(k % 10 == 0, 1).otherwise(0)).alias("total"))
    return gates.violations(a, "o_orderkey", {"SCORE_RANGE": F.forall("s", lambda x: x.between(0, 2)), "TOTAL": F.aggregate("s", F.lit(0).cast("long"), lambda t, x: t + x) == F.col("total")})


@query("observation_contract", "WITH n AS (SELECT source, count(*) AS n, count(DISTINCT md5(text)) AS u FROM documents GROUP BY source) SELECT source, unnest(list_filter([CASE WHEN n > 20 THEN 'TOO_MANY' END, CASE WHEN u < n THEN 'REPEATED_BODY' END], lambda x: x IS NOT NULL)) AS rule FROM n")
def observation_contract(spark, sf_dir):
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.md5(F.col("text").cast("binary"))).alias("u"))
    return gates.violations(n, "source", {"TOO_MANY": F.col("n") <= 20, "REPEATED_BODY": F.col("u") == F.col("n")})


@query("speech_type", "WITH w AS (SELECT conv_id, turn, string_agg(text, '') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 120 PRECEDING AND CURRENT ROW) AS near FROM conversations), x AS (SELECT *, replace(lower(near), ' ', '') AS n FROM w) SELECT conv_id, turn, CASE WHEN contains(n, 'thatthe') THEN 'QUESTION' WHEN contains(n, 'andthe') THEN 'REPORT' ELSE 'STATEMENT' END AS speech FROM x")
def speech_type(spark, sf_dir):
    near = context.recent_terms(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("text"), {"asked": "thatthe", "told": "andthe"})
    return near.select("conv_id", "turn", txt.first_rule([(F.col("asked"), "QUESTION"), (F.col("told"), "REPORT")], "STATEMENT").alias("speech"))


@query("latest_subject", "SELECT conv_id, arg_max(text, turn) FILTER (role = 'user' AND length(text) <= 180) AS subject, count(*) AS n FROM conversations GROUP BY conv_id")
def latest_subject(spark, sf_dir):
    ok = (F.col("role") == "user") & (F.length("text") <= 180)
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max_by(F.when(ok, F.col("text")), F.when(ok, F.col("turn"))).alias("subject"), F.count(F.lit(1)).alias("n"))


@query("audit_card_gate", "WITH c AS (SELECT d.doc_id, n_chars > 300 AND quality IS NOT NULL AND toxic IS NOT NULL AND (quality = 1 OR n_chars > 3000) AS ready, split_part(text, chr(10), 1) AS finding FROM documents d LEFT JOIN labels USING (doc_id)) SELECT doc_id, CASE WHEN coalesce(ready, FALSE) THEN 'READY' ELSE 'HOLD' END AS state, CASE WHEN ready THEN finding END AS finding FROM c")
def audit_card_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    ready = F.coalesce((F.col("n_chars") > 300) & F.col("quality").isNotNull() & F.col("toxic").isNotNull() & ((F.col("quality") == 1) | (F.col("n_chars") > 3000)), F.lit(False))
    return d.select("doc_id", F.when(ready, "READY").otherwise("HOLD").alias("state"), F.when(ready, F.substring_index("text", "\n", 1)).alias("finding"))


@query("selected_lead_match", "SELECT d.doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM documents l JOIN labels b ON b.doc_id = l.doc_id AND b.quality = 1 WHERE l.source = d.source AND l.lang = d.lang AND contains(d.text, split_part(l.text, chr(10), 1)))")
def selected_lead_match(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    lead = d.join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi").select("source", "lang", F.substring_index("text", "\n", 1).alias("anchor")).distinct()
    anchors = lead.filter("anchor <> ''").select("anchor", F.col("anchor").alias("text")).distinct()
    hits = similarity.contained_in(anchors, d, "anchor", "doc_id", "text").select(F.col("short").alias("anchor"), F.col("long").alias("doc_id"))
    # An empty anchor is in every text of its source and language.
    empty = d.filter("text is not null").join(lead.filter("anchor = ''"), ["source", "lang"], "left_semi").select("doc_id")
    return hits.join(d.select("doc_id", "source", "lang"), "doc_id").join(lead, ["source", "lang", "anchor"], "left_semi").select("doc_id").union(empty).distinct()


@query("page_break_window", "SELECT p_partkey, pos - 1 AS page, part FROM (SELECT p_partkey, unnest(string_split(p_name || chr(12) || p_brand || chr(12) || p_type, chr(12))) AS part, generate_subscripts(string_split(p_name || chr(12) || p_brand || chr(12) || p_type, chr(12)), 1) AS pos FROM part) WHERE pos <= 2")
def page_break_window(spark, sf_dir):
    t = F.concat_ws("\f", "p_name", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.slice(F.split(t, "\f"), 1, 2)).alias("page", "part"))


@query("search_rank_first_nonempty", "WITH h AS (SELECT o_custkey, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority) AS query_ord, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')), f AS (SELECT *, min(query_ord) OVER (PARTITION BY o_custkey) AS first_ord FROM h) SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM f WHERE query_ord = first_ord QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def search_rank_first_nonempty(spark, sf_dir):
    h = _orders(spark, sf_dir).withColumn("query_ord", F.array_position(F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM"])), F.col("o_orderpriority"))).filter("query_ord > 0")
    first = h.groupBy("o_custkey").agg(F.min("query_ord").alias("first_ord"))
    j = h.join(first, "o_custkey").filter("query_ord = first_ord")
    return j.withColumn("rank", F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")))).filter("rank <= 3").select("o_custkey", "o_orderkey", "rank")


@query("transport_fallback", "WITH p AS (SELECT s_suppkey AS id, s_acctbal AS v FROM supplier WHERE s_nationkey < 17), o AS (SELECT s_suppkey AS id, s_acctbal + 1 AS v FROM supplier WHERE s_nationkey > 5) SELECT id, v, 'preferred' AS route FROM p WHERE v >= 2000 UNION ALL SELECT id, v, 'other' FROM o WHERE id NOT IN (SELECT id FROM p WHERE v >= 2000)")
def transport_fallback(spark, sf_dir):
    from ..sources.files import first_available

    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"), "s_nationkey")
    p = s.filter("s_nationkey < 17").drop("s_nationkey").withColumn("stale", F.col("v") < 2000)
    o = s.filter("s_nationkey > 5").select("id", (F.col("v") + 1).alias("v"))
    return first_available(p, o, "id", "stale").select("id", "v", "route")


@query("sample_metrics", "WITH r AS (SELECT lang, quality, toxic, n_chars FROM documents LEFT JOIN labels USING (doc_id)) SELECT lang, count(*) FILTER (n_chars >= 200) AS readable, count(quality) AS reviewed, CASE WHEN count(quality) > 0 THEN CAST(count(*) FILTER (quality = 1) AS DOUBLE) / count(quality) END AS useful_rate, CASE WHEN count(quality) < 5 THEN 'PENDING' WHEN CAST(count(*) FILTER (quality = 1) AS DOUBLE) / count(quality) >= 0.5 THEN 'USEFUL' ELSE 'WEAK' END AS result FROM r GROUP BY lang")
def sample_metrics(spark, sf_dir):
    seen = F.count("quality")
    rate = F.when(seen > 0, F.count_if(F.col("quality") == 1).cast("double") / seen)
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count_if(F.col("n_chars") >= 200).alias("readable"), seen.alias("reviewed"), rate.alias("useful_rate"), F.when(seen < 5, "PENDING").when(rate >= 0.5, "USEFUL").otherwise("WEAK").alias("result"))


@query("second_review_gate", "SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'AWAITING_REVIEW' WHEN quality = 1 AND toxic = 0 THEN 'CONFIRMED' WHEN quality = 1 THEN 'DISPUTED' ELSE 'REJECTED' END AS review FROM documents d LEFT JOIN labels USING (doc_id)")
def second_review_gate(spark, sf_dir):
    q, t = F.col("quality"), F.col("toxic")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", txt.first_rule([(q.isNull(), "AWAITING_REVIEW"), ((q == 1) & (t == 0), "CONFIRMED"), (q == 1, "DISPUTED")], "REJECTED").alias("review"))


@query(
    "queue_schema_exact",
    """WITH h AS (SELECT column_name AS c FROM (DESCRIBE documents)), w AS (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'title']) AS c)
SELECT 'extra' AS problem, c AS "column" FROM h WHERE c NOT IN (SELECT c FROM w) UNION ALL SELECT 'missing', c FROM w WHERE c NOT IN (SELECT c FROM h)""",
)
def queue_schema_exact(spark, sf_dir):
    have, want = set(table(spark, sf_dir, "documents").columns), {"doc_id", "text", "lang", "source", "title"}
    rows = [("extra", c) for c in sorted(have - want)] + [("missing", c) for c in sorted(want - have)]
    return spark.createDataFrame(rows, "problem string, column string")


@query("seed_rows_in_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50")
def seed_rows_in_json(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k")).filter("k > 50")


@query("html_visible_text")
def html_visible_text(spark, sf_dir):
    from ..sources.html import visible

    v = visible(table(spark, sf_dir, "pages")).filter("kind is not null")
    return v.groupBy("page_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("html_listing_rows")
def html_listing_rows(spark, sf_dir):
    from ..sources.html import visible

    a = visible(table(spark, sf_dir, "pages")).filter("kind = 'anchor' and href is not null")
    return a.groupBy("page_id", "href").agg(F.min_by("text", "pos").alias("text"), F.min("pos").alias("pos"))


@query("html_article_bodies")
def html_article_bodies(spark, sf_dir):
    from ..sources.html import article_bodies

    return article_bodies(table(spark, sf_dir, "pages")).select("page_id", "basis", F.length("body").alias("n_chars"), F.sha2("body", 256).alias("digest"))


@query("isolated_failures", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CASE WHEN n_nationkey % 7 = 3 THEN 'FAILED' ELSE 'OK' END AS status, CASE WHEN n_nationkey % 7 <> 3 THEN length(n_name) END AS n FROM nation")
def isolated_failures(spark, sf_dir):
    def work(r):
        if r["n_nationkey"] % 7 == 3:
            raise ValueError("unreachable")
        return {"n": len(r["n_name"])}

    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long"), "n_name")
    return rules.isolated(n, "n_nationkey", "n long", work).select("n_nationkey", "status", "n")


@query("table_digest")
def table_digest(spark, sf_dir):
    from ..operators.provenance import table_digest as digest

    return digest(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))
