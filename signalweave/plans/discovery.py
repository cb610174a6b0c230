"""Queries on tables inside JSON, run plans, names in texts and personal data."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as txt
from ..operators import gazetteer, provenance
from ..sources import discovery
from .base import query, table


def _nested(spark, sf_dir):
    """Per nation one JSON text: its customers at depth 4, its suppliers at depth 2, and a cut-out and a marked sample of the customers."""
    one = lambda t, p: table(spark, sf_dir, t).select(F.col(f"{p}_nationkey").alias("nation"), F.struct(F.col(f"{p}_{'cust' if p == 'c' else 'supp'}key").alias("key"), F.col(f"{p}_acctbal").alias("balance"), *([F.col("c_mktsegment").alias("segment")] if p == "c" else [])).alias("r"))
    rows = lambda t, p, name: one(t, p).groupBy("nation").agg(F.array_sort(F.collect_list("r")).alias(name))
    j = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name").join(rows("customer", "c", "cs"), "nation", "left").join(rows("supplier", "s", "ss"), "nation", "left")
    none = F.lit(None).cast(j.schema["cs"].dataType)
    sample = F.transform(F.slice("cs", 1, 99), lambda r: F.struct(r["key"].alias("key"), r["balance"].alias("balance"), F.lit(True).alias("sample"), r["segment"].alias("segment")))
    deep = F.struct(F.struct(F.lit("x").alias("note"), F.array(F.struct(F.slice("cs", 1, 2).alias("preview"), none.alias("customers")), F.struct(none.alias("preview"), F.col("cs").alias("customers"))).alias("parts")).alias("data"), F.col("ss").alias("suppliers"), F.concat(F.slice(sample, 1, 99), F.slice(sample, 1, 99), sample).alias("samples"), F.col("n_name").alias("name"))
    return j.select("nation", F.to_json(deep).alias("j"))


@query(
    "table_discovery",
    """WITH c AS (SELECT c_nationkey AS nation, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(12,2))) AS total FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS nation, count(*) AS n, sum(CAST(s_acctbal AS DECIMAL(12,2))) AS total FROM supplier GROUP BY 1)
SELECT nation, 'customers' AS kind, CASE WHEN n <= 2 THEN '$.data.parts[0].preview' ELSE '$.data.parts[1].customers' END AS path, n AS n_rows, total FROM c
UNION ALL SELECT coalesce(s.nation, c.nation), 'any', CASE WHEN coalesce(c.n, 0) >= coalesce(s.n, 0) THEN CASE WHEN c.n <= 2 THEN '$.data.parts[0].preview' ELSE '$.data.parts[1].customers' END ELSE '$.suppliers' END, greatest(coalesce(c.n, 0), coalesce(s.n, 0)), CASE WHEN coalesce(c.n, 0) >= coalesce(s.n, 0) THEN c.total ELSE s.total END FROM s FULL JOIN c USING (nation)""",
)
def table_discovery(spark, sf_dir):
    j = _nested(spark, sf_dir)
    out = None
    for kind, required in (("customers", ["key", "balance", "segment"]), ("any", ["key", "balance"])):
        best = discovery.largest_tables(discovery.find_tables(j, "nation", "j", required, ["sample"]))
        rows = discovery.table_rows(best, {"balance": ("balance", "decimal(12,2)")}).groupBy("id").agg(F.sum("balance").alias("total"))
        d = best.join(rows, "id").select(F.col("id").alias("nation"), F.lit(kind).alias("kind"), "path", "n_rows", "total")
        out = d if out is None else out.unionByName(d)
    return out


@query(
    "run_plan_checks",
    """WITH RECURSIVE t AS (SELECT p_type AS plan, p_partkey AS task, p_partkey - p_size AS x, p_partkey + p_size AS y FROM part UNION ALL SELECT p_type, p_partkey, NULL, NULL FROM part WHERE p_size = 1),
e AS (SELECT DISTINCT plan, task AS a, b FROM (SELECT plan, task, x AS b FROM t UNION ALL SELECT plan, task, y FROM t) WHERE b IS NOT NULL),
k AS (SELECT e.* FROM e WHERE EXISTS (SELECT 1 FROM t WHERE t.plan = e.plan AND t.task = e.b)),
r AS (SELECT plan, a, b FROM k UNION SELECT r.plan, r.a, k.b FROM r JOIN k ON k.plan = r.plan AND k.a = r.b),
c AS (SELECT DISTINCT plan, a FROM r WHERE a = b)
SELECT plan, CAST(task AS VARCHAR) AS task, 'REPEATED' AS problem, CAST(count(*) AS VARCHAR) AS detail FROM t GROUP BY plan, task HAVING count(*) > 1
UNION ALL SELECT plan, CAST(a AS VARCHAR), 'UNKNOWN', CAST(b AS VARCHAR) FROM e WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.plan = e.plan AND t.task = e.b)
UNION ALL SELECT plan, CAST(a AS VARCHAR), 'CYCLE', NULL FROM (SELECT plan, a FROM c UNION SELECT r.plan, r.a FROM r JOIN c ON c.plan = r.plan AND c.a = r.b)""",
)
def run_plan_checks(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_type").alias("plan"), F.col("p_partkey").alias("task"), "p_size", F.array(F.col("p_partkey") - F.col("p_size"), F.col("p_partkey") + F.col("p_size")).alias("needs"))
    again = p.filter("p_size = 1").withColumn("needs", F.lit(None).cast(p.schema["needs"].dataType))
    return provenance.plan_problems(p.unionByName(again), "plan", "task", "needs")


@query(
    "claim_places_supported",
    r"""WITH b AS (SELECT regexp_extract_all(lower(text), '([0-9A-Za-zÀ-ɏ가-힣]+)', 1) AS w FROM benchmark), g AS (SELECT DISTINCT array_to_string(w[1:2], ' ') AS name, 2 AS k FROM b WHERE len(w) >= 2 UNION SELECT DISTINCT array_to_string(w[1:3], ' '), 3 FROM b WHERE len(w) >= 3 UNION SELECT DISTINCT w[-1], 1 FROM b WHERE len(w) >= 1),
d AS (SELECT doc_id, source, regexp_extract_all(lower(text), '([0-9A-Za-zÀ-ɏ가-힣]+)', 1) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d), n AS (SELECT doc_id, i, i + k AS j, array_to_string(w[i:i + k - 1], ' ') AS name FROM p, (VALUES (1), (2), (3)) v(k) WHERE i + k - 1 <= len(w)),
m AS (SELECT DISTINCT n.* FROM n JOIN g USING (name)), x AS (SELECT * FROM m QUALIFY coalesce(j > max(j) OVER (PARTITION BY doc_id ORDER BY i, j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE)),
y AS (SELECT DISTINCT doc_id, name FROM x), q AS (SELECT doc_id, lag(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS quote FROM documents),
z AS (SELECT y.doc_id, y.name, o.name IS NULL AS alone FROM y JOIN q USING (doc_id) LEFT JOIN y o ON o.doc_id = q.quote AND o.name = y.name)
SELECT doc_id, list_sort(list(name)) AS places, coalesce(list_sort(list(name) FILTER (alone)), []) AS unsupported FROM z GROUP BY doc_id""",
)
def claim_places_supported(spark, sf_dir):
    """Names are the first two and three words and the last word of benchmark items; a document's quotes are the document before it of its source."""
    w = table(spark, sf_dir, "benchmark").select(gazetteer.words_of(F.col("text")).alias("w"))
    at_start = [F.when(F.size("w") >= k, F.array_join(F.slice("w", 1, k), " ")) for k in (2, 3)]
    names = w.select(F.explode(F.array_compact(F.array(*at_start, F.try_element_at("w", F.lit(-1))))).alias("name"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Ids alone go through the window; texts are joined by id.
    after = d.select("doc_id", "source").withColumn("next", F.lead("doc_id").over(W.partitionBy("source").orderBy("doc_id")))
    quotes = d.select(F.col("doc_id").alias("quoted"), "text").join(after.filter("next is not null").select(F.col("doc_id").alias("quoted"), F.col("next").alias("doc_id")), "quoted").select("doc_id", "text")
    return gazetteer.unsupported_places(d.select("doc_id", "text"), quotes, names, "doc_id", "text", "name")


_PERSONAL_SQL = "text"
for _pattern, _mask in txt.PERSONAL:
    _sql = _pattern.replace("'", "''")
    _PERSONAL_SQL = f"regexp_replace({_PERSONAL_SQL}, '{_sql}', '{_mask.replace('$1', chr(92) + '1')}', 'g')"


@query("personal_data_redacted", f"WITH d AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - page_id, html FROM pages UNION ALL SELECT -1000000000 - conv_id * 1000 - turn, text FROM conversations) SELECT doc_id, {_PERSONAL_SQL} AS redacted FROM d")
def personal_data_redacted(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    turns = table(spark, sf_dir, "conversations").select((-1000000000 - F.col("conv_id") * 1000 - F.col("turn")).alias("doc_id"), "text")
    d = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(pages).unionByName(turns)
    return d.select("doc_id", txt.redact(F.col("text"), txt.PERSONAL).alias("redacted"))
