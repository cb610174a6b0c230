"""Queries on the content cascade, scopes, scores, lanes, key walks, ledgers and slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoring as ops
from .base import query, table

#: What the signals of the cascade are in the synthetic texts: patterns that need no look-around, so that both engines read them alike.
_PATTERNS = {
    "contact": "@|Ñ",
    "platform": "zzi",
    "instruction": "keit,",
    "dashboard": r"\|",
    "hypothetical": "ieren",
    "mention": "Keit",
    "navigation": "Ü",
    "procedure": "Qu",
    "schema": "ación",
    "forecast": "heit",
    "values": r"\d|Wh|qu",
    "policy": "ment",
    "observed": "Th",
    "concern": "ando",
    "speech": "liche",
    "table_title": "ung",
    "dataset": "ción|schl",
    "linked": r"\d",
    "cost_problem": r"\d{3}",
    "problem": "tion|er ",
    "experience": "That|Des",
    "positive": "Wher",
    "neutral": "There",
    "structural": "est",
    "harm": "keit",
    "attributed": "tionin",
    "cited": "Ther",
    "actual": "and|und",
    "axes": "ing",
    "purpose_only": "These",
}
_ROLES = {"minutes": "source LIKE '%0'", "table_source": "lang = 'es'", "verification": "lang = 'en'", "voice": "lang IN ('en', 'de')", "title_only": "n_chars <= 300"}


def _signals():
    text = F.coalesce(F.col("text"), F.lit(""))
    return {**{k: text.rlike(p) for k, p in _PATTERNS.items()}, **{k: F.expr(e) for k, e in _ROLES.items()}}


_S = "s AS (SELECT doc_id, " + ", ".join([f"coalesce(regexp_matches(text, '{p}'), FALSE) AS {k}" for k, p in _PATTERNS.items()] + [f"coalesce({e}, FALSE) AS {k}" for k, e in _ROLES.items()]) + " FROM documents)"
_C = f"""{_S}, c AS (SELECT *, CASE WHEN contact THEN 'CONTACT_BOILERPLATE' WHEN platform THEN 'PLATFORM_NOTICE' WHEN instruction THEN 'PORTAL_INSTRUCTION' WHEN dashboard THEN 'AGGREGATE_ACTIVITY_DASHBOARD'
 WHEN hypothetical THEN 'HYPOTHETICAL_EXAMPLE' WHEN minutes AND mention AND NOT linked THEN 'ISSUE_MENTION_ONLY' WHEN navigation THEN 'NAVIGATION' WHEN procedure THEN 'PARLIAMENTARY_PROCEDURE'
 WHEN table_source AND schema THEN 'TABLE_SCHEMA_WITHOUT_VALUE' WHEN forecast AND NOT cost_problem THEN 'POLICY_FORECAST' WHEN values AND policy AND NOT observed THEN 'POLICY_ANNOUNCEMENT'
 WHEN NOT values AND concern THEN 'CONCERN_OR_ATTRIBUTED_CLAIM' WHEN NOT values AND speech THEN 'SPEECH_PROMISE' WHEN NOT values AND table_source AND table_title THEN 'TABLE_SCHEMA_WITHOUT_VALUE'
 WHEN NOT values AND verification AND dataset THEN 'DATASET_METADATA' WHEN NOT values AND title_only THEN 'DOCUMENT_TITLE_ONLY' ELSE 'REPORTABLE_TEXT' END AS content_class FROM s),
p AS (SELECT *, CASE WHEN content_class IN ('REPORTABLE_TEXT', 'DATASET_METADATA') THEN 'PASS' WHEN content_class IN ('CONTACT_BOILERPLATE', 'PLATFORM_NOTICE', 'PORTAL_INSTRUCTION', 'NAVIGATION', 'PARLIAMENTARY_PROCEDURE', 'SPEECH_PROMISE') THEN 'FAIL' ELSE 'HOLD' END AS precheck FROM c),
a AS (SELECT *, CASE WHEN precheck <> 'PASS' THEN 'NONE' WHEN voice AND problem AND experience AND NOT purpose_only THEN 'DIRECT_PROBLEM_SIGNAL'
 WHEN values AND problem AND NOT positive AND (linked AND observed OR cost_problem AND NOT purpose_only) THEN 'MEASURED_PROBLEM_SIGNAL' WHEN values AND (structural OR positive OR neutral) THEN 'DECOMPOSABLE_STRUCTURE' ELSE 'NONE' END AS evidence_anchor FROM p),
v AS (SELECT *, CASE WHEN hypothetical THEN 'HYPOTHETICAL' WHEN (attributed OR minutes AND evidence_anchor <> 'NONE') AND NOT cited THEN 'ATTRIBUTED_CLAIM' WHEN evidence_anchor <> 'NONE' THEN 'OBSERVED_OR_PUBLISHED' ELSE 'UNRESOLVED' END AS claim_status,
 CASE WHEN positive THEN 'POSITIVE' WHEN harm THEN 'NEGATIVE' WHEN neutral THEN 'UNCLASSIFIED_CHANGE' ELSE 'AMBIGUOUS' END AS change_direction,
 precheck = 'PASS' AND verification AND values AND actual AND (axes OR structural OR dataset) AS verification_usable,
 CASE WHEN precheck <> 'PASS' OR NOT verification OR values AND actual AND (axes OR structural OR dataset) THEN 'NONE' WHEN content_class = 'DATASET_METADATA' THEN 'METADATA' WHEN axes OR structural OR dataset THEN 'SCHEMA' ELSE 'NONE' END AS verification_lead FROM a)"""
_OUT = ["content_class", "precheck", "evidence_anchor", "claim_status", "change_direction", "verification_usable", "verification_lead"]


@query("content_cascade", f"WITH {_C} SELECT doc_id, {', '.join(_OUT)} FROM v")
def content_cascade(spark, sf_dir):
    return ops.analysed(table(spark, sf_dir, "documents"), _signals()).select("doc_id", *_OUT)


_SCOPE = {"place": "Th|Des|Sch", "wider": "tion|heit", "apart": "These|keit", "measure": "and|est|qu", "row": "[a-z]ó [a-z]"}


@query(
    "scope_classes",
    r"""SELECT doc_id, CASE WHEN lang = 'fr' THEN 'SOURCE_TRUSTED' WHEN regexp_matches(t, '[a-z]ó [a-z]') AND regexp_matches(t, 'tion|heit') THEN 'COMPARISON_WITH_ROW' WHEN regexp_matches(t, '[a-z]ó [a-z]') THEN 'VALUE_BOUND'
WHEN regexp_matches(t, 'tion|heit') AND NOT regexp_matches(t, 'Th|Des|Sch') THEN 'WIDER_ONLY' WHEN regexp_matches(t, 'These|keit') THEN 'UNBOUND'
WHEN len(list_filter(regexp_split_to_array(t, '[.!?。\n]'), lambda s: regexp_matches(s, 'Th|Des|Sch') AND regexp_matches(s, '\d|ch') AND regexp_matches(s, 'and|est|qu'))) > 0 THEN 'VALUE_BOUND' ELSE 'UNBOUND' END AS scope FROM (SELECT *, coalesce(text, '') AS t FROM documents)""",
)
def scope_classes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ops.scope(F.col("text"), F.col("lang") == "fr", number=r"\d|ch", **_SCOPE).alias("scope"))


@query(
    "record_score_full",
    f"""WITH {_C}, r AS (SELECT doc_id, list_filter([CASE WHEN axes THEN ['scope', CASE WHEN structural THEN '2' ELSE '1' END] END, CASE WHEN problem THEN ['problem', '2'] END, CASE WHEN values OR evidence_anchor <> 'NONE' THEN ['evidence', '2'] END,
 CASE WHEN evidence_anchor = 'DECOMPOSABLE_STRUCTURE' AND NOT problem THEN ['structure', '2'] END, CASE WHEN policy THEN ['implementation', '1'] END, CASE WHEN harm THEN ['loss', '1'] END, CASE WHEN voice AND experience THEN ['question', '1'] END,
 CASE WHEN verification THEN ['role', '1'] END, CASE WHEN purpose_only THEN ['promotion', CASE WHEN evidence_anchor <> 'NONE' THEN '-1' ELSE '-3' END] END, CASE WHEN precheck = 'HOLD' THEN ['held', '-2'] END, CASE WHEN precheck = 'FAIL' THEN ['failed', '-6'] END,
 CASE WHEN content_class = 'NAVIGATION' THEN ['boilerplate', '-3'] END], lambda x: x IS NOT NULL) AS parts FROM v)
SELECT doc_id, CAST(coalesce(list_sum(list_transform(parts, lambda x: CAST(x[2] AS BIGINT))), 0) AS BIGINT) AS score, list_transform(parts, lambda x: x[1]) AS reasons FROM r""",
)
def record_score_full(spark, sf_dir):
    s = _signals()
    d = ops.analysed(table(spark, sf_dir, "documents").withColumns({f"is_{k}": s[k] for k in ("axes", "structural", "problem", "values", "policy", "harm", "voice", "experience", "verification", "purpose_only")}), s)
    c = F.col
    anchored = c("evidence_anchor") != "NONE"
    parts = [
        ("scope", c("is_axes"), F.when(c("is_structural"), 2).otherwise(1)),
        ("problem", c("is_problem"), 2),
        ("evidence", c("is_values") | anchored, 2),
        ("structure", (c("evidence_anchor") == "DECOMPOSABLE_STRUCTURE") & ~c("is_problem"), 2),
        ("implementation", c("is_policy"), 1),
        ("loss", c("is_harm"), 1),
        ("question", c("is_voice") & c("is_experience"), 1),
        ("role", c("is_verification"), 1),
        ("promotion", c("is_purpose_only"), F.when(anchored, -1).otherwise(-3)),
        ("held", c("precheck") == "HOLD", -2),
        ("failed", c("precheck") == "FAIL", -6),
        ("boilerplate", c("content_class") == "NAVIGATION", -3),
    ]
    return ops.scored(d, parts).select("doc_id", "score", "reasons")


@query(
    "news_lanes",
    """WITH f AS (SELECT doc_id, lang = 'fr' AS watched, regexp_matches(text, 'heit|zz') AS duty, regexp_matches(text, 'tion') AS transit, regexp_matches(text, 'Wh') AS delay, regexp_matches(text, 'qu') AS works, regexp_matches(text, 'ment|Th') AS impact, regexp_matches(text, 'and') AS routine, regexp_matches(text, 'These|keit') AS strong FROM documents),
r AS (SELECT *, CASE WHEN delay AND transit AND NOT works THEN 'TRANSIT_DELAY' WHEN routine AND (NOT impact OR strong) THEN 'ROUTINE' WHEN duty THEN 'PUBLIC_DUTY' WHEN impact OR works THEN 'IMPACT' ELSE 'NO_SIGNAL' END AS reason FROM f)
SELECT doc_id, reason IN ('PUBLIC_DUTY', 'IMPACT') AS keep, reason, CASE WHEN watched OR duty THEN 'WATCHDOG_DUTY' ELSE 'CITIZEN_ATTENTION' END AS lane FROM r""",
)
def news_lanes(spark, sf_dir):
    lane = ops.news_lane(F.col("text"), F.col("lang") == "fr", ["heit", "zz"], ["tion"], ["Wh"], ["qu"], ["ment", "Th"], ["and"], ["These", "keit"])
    return table(spark, sf_dir, "documents").select("doc_id", lane.alias("l")).select("doc_id", "l.keep", "l.reason", "l.lane")


# The caps of the fourteen lanes.
_CAPS = (3, 3, 2, 5, 5, 8, 5, 5, 4, 4, 4, 2, 5, 5)
_LANES = ("lang = 'en'", "lang = 'de'", "lang = 'es'", "lang = 'fr'", "n_chars > 2000", "n_chars > 1000", "n_chars < 500", "quality = 1", "quality = 0", "toxic = 1", "toxic = 0 AND quality = 1", "quality IS NULL", "source LIKE '%1'", "lang = 'en' AND n_chars > 800")


@query(
    "lane_caps",
    f"""WITH d AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, left(regexp_replace(lower(text), '[^0-9a-z]', '', 'g'), 100) AS k FROM documents d LEFT JOIN labels l USING (doc_id)),
e AS ({' UNION ALL '.join(f"SELECT 'lane{i:02d}' AS lane, {cap} AS cap, doc_id, n_chars, coalesce(k, '') AS k FROM d WHERE {rule}" for i, (rule, cap) in enumerate(zip(_LANES, _CAPS)))}),
o AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lane, k ORDER BY n_chars DESC, doc_id) = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY n_chars DESC, doc_id) AS position FROM o)
SELECT doc_id, lane, position FROM n WHERE position <= cap""",
)
def lane_caps(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("k", F.substring(F.regexp_replace(F.lower("text"), "[^0-9a-z]", ""), 1, 100))
    return ops.capped_lanes(d, {f"lane{i:02d}": (F.expr(rule), cap) for i, (rule, cap) in enumerate(zip(_LANES, _CAPS))}, "doc_id", "n_chars", "k")


@query(
    "forbidden_keys_anywhere",
    """SELECT event_id, list_sort(list_distinct(['kind', 'rows', 'user', event_type] || json_keys(props))) AS keys, list_sort(list_filter(list_distinct(['kind', 'rows', 'user', event_type] || json_keys(props)), lambda k: k IN ('error', 'user', 'purchase'))) AS forbidden FROM events""",
)
def forbidden_keys_anywhere(spark, sf_dir):
    text = F.concat(F.lit('{"kind":"a \\"k\\": b","rows":[{"user":'), F.col("user_id").cast("string"), F.lit(',"'), "event_type", F.lit('" : '), "props", F.lit("}]}"))
    d = table(spark, sf_dir, "events").select("event_id", ops.keys_anywhere(text).alias("keys"))
    return d.select("event_id", "keys", F.array_sort(F.array_intersect("keys", F.array(*map(F.lit, ["error", "user", "purchase"])))).alias("forbidden"))


@query(
    "signal_ledger_merge",
    """WITH old AS (SELECT user_id AS id, list_sort(list(DISTINCT event_type)) AS labels, max(ts) AS published FROM events WHERE ts < TIMESTAMP '2024-01-03' AND event_type = 'error' GROUP BY 1), new AS (SELECT user_id AS id, list_sort(list(DISTINCT event_type)) AS labels, max(ts) AS published FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND value > 50 GROUP BY 1)
SELECT id, list_sort(list_distinct(coalesce(o.labels, []) || coalesce(n.labels, []))) AS labels, coalesce(n.published, o.published) AS published, CASE WHEN o.id IS NULL THEN TIMESTAMP '2024-02-08' ELSE TIMESTAMP '2024-01-12' END AS first, CASE WHEN n.id IS NULL THEN TIMESTAMP '2024-01-12' ELSE TIMESTAMP '2024-02-08' END AS last, o.id IS NULL AS is_new
FROM old o FULL JOIN new n USING (id) WHERE coalesce(n.published, o.published) >= TIMESTAMP '2024-02-08' - INTERVAL 30 DAY""",
)
def signal_ledger_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    at = lambda day: F.lit(f"2024-{day}").cast("timestamp_ntz")
    batch = lambda d: d.groupBy(F.col("user_id").alias("id")).agg(F.collect_set("event_type").alias("labels"), F.max("ts").alias("published"))
    old = batch(e.filter((F.col("ts") < at("01-03")) & (F.col("event_type") == "error"))).withColumns({"first": at("01-12"), "last": at("01-12")})
    return ops.merged_ledger(old, batch(e.filter((F.col("ts") >= at("01-20")) & (F.col("value") > 50))), at("02-08"))


@query(
    "search_slot_plan",
    """WITH q AS (SELECT c_custkey AS key, c_mktsegment AS agenda, CAST(c_nationkey AS VARCHAR) AS cluster, c_mktsegment < 'G' AS core, c_acctbal AS last_run FROM customer),
k AS (SELECT *, row_number() OVER (ORDER BY agenda, cluster) AS n FROM (SELECT DISTINCT agenda, cluster FROM q WHERE core)),
f AS (SELECT q.key, n FROM q JOIN k USING (agenda, cluster) WHERE n BETWEEN 5 AND 7 QUALIFY row_number() OVER (PARTITION BY agenda, cluster ORDER BY last_run NULLS FIRST, key) = 1),
a AS (SELECT agenda, row_number() OVER (ORDER BY agenda) - 1 AS i, count(*) OVER () AS m FROM (SELECT DISTINCT agenda FROM q)),
r AS (SELECT key, agenda, row_number() OVER (PARTITION BY agenda ORDER BY last_run NULLS FIRST, key) AS turn FROM q WHERE key NOT IN (SELECT key FROM f)),
u AS (SELECT key, 'SENTINEL' AS tier, 0 AS turn, n AS seat FROM f UNION ALL SELECT key, 'ROTATION', turn, ((i - 61) % m + m) % m FROM r JOIN a USING (agenda)),
p AS (SELECT key, tier, row_number() OVER (ORDER BY turn, seat) - 1 AS place FROM u)
SELECT key, tier, place, CASE WHEN tier = 'SENTINEL' OR place % 2 = 0 THEN 'date' ELSE 'relevance' END AS search_order FROM p WHERE place < 11""",
)
def search_slot_plan(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    q = c.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("agenda"), F.col("c_nationkey").cast("string").alias("cluster"), (F.col("c_mktsegment") < "G").alias("core"), F.col("c_acctbal").alias("last_run"))
    return ops.slot_plan(q, slot=1, day=20, used=2)


@query("run_slots", "SELECT event_id, CASE WHEN hour(ts) < 10 THEN 0 WHEN hour(ts) < 15 THEN 1 ELSE 2 END::BIGINT AS slot FROM events")
def run_slots(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", ops.slot_of(F.hour("ts")).alias("slot"))


@query(
    "seed_rows_anywhere",
    r"""WITH p AS (SELECT page_id, url, regexp_replace(html, '<[^>]*>', ' ', 'g') AS body FROM pages), s AS (SELECT page_id, replace(url, 'http://', 'https://') AS url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM p)
SELECT page_id, '$.found[0].deep' AS path, '2024-01-05' AS date, url, length(text) AS n FROM s WHERE length(text) >= 80 AND url LIKE 'https://%'
UNION ALL SELECT page_id, '$', '2024-02-01', url, length(text) FROM s WHERE length(text) >= 80 AND length(url) > 45 AND url LIKE 'https://%'""",
)
def seed_rows_anywhere(spark, sf_dir):
    body = F.regexp_replace("html", "<[^>]*>", " ")
    text = F.trim(F.regexp_replace(body, r"\s+", " "))
    url = F.replace("url", F.lit("http://"), F.lit("https://"))
    inner = F.struct(F.lit("2024-01-05").alias("meeting_date"), url.alias("document_url"), text.alias("text"))
    short = F.struct(F.lit("2024-01-05").alias("meeting_date"), url.alias("document_url"), F.lit("too short").alias("text"))
    top = F.struct(F.array(F.struct(inner.alias("deep")), F.struct(short.alias("deep"))).alias("found"), F.when(F.length(url) > 45, "2024-02-01").alias("source_date"), url.alias("url"), text.alias("display_fact"))
    d = table(spark, sf_dir, "pages").select("page_id", F.to_json(top).alias("j"))
    return ops.seed_rows(d, "page_id", "j", ("meeting_date", "source_date"), ("document_url", "url"), ("display_fact", "text")).select("page_id", "path", "date", "url", F.length("text").alias("n"))
