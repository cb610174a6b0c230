"""Queries on contracts of inputs, assessments and reviews, question parts, cluster evidence and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates
from ..operators import reviews as ops
from .base import query, table

# The comma-separated pieces of a text stand for the fields of an answer; verdicts are the labels.
_PIECES = "b AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, coalesce(d.text, '') AS text, string_split(coalesce(d.text, ''), ',') AS p, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
_GENERIC = ("the thth", "der die", "and and")
_DENIED = [(("er",), ("Wh", "Qu"), ("ansh", "eine")), (("tion",), ("haha",), ("thth", "ono"))]
_SCALE = {
    "fit": "CASE WHEN n_chars > 600 THEN 'HIGH' ELSE 'LOW' END",
    "scale": "CASE WHEN toxic = 1 THEN 'ORDINARY_SINGLE_CASE' ELSE 'SYSTEM' END",
    "stage": "CASE lang WHEN 'fr' THEN 'SPECULATIVE' WHEN 'es' THEN 'DOCUMENTED_RISK' ELSE 'ACTUAL' END",
    "lane": "CASE WHEN source LIKE '%1' THEN 'BOTH' WHEN source LIKE '%2' THEN 'WATCHDOG_DUTY' ELSE 'ATTENTION' END",
}


def _s(x):
    return rf"trim(regexp_replace(coalesce({x}, ''), '\s+', ' ', 'g'))"


def _pieces(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("text", F.coalesce("text", F.lit("")))
    return d.withColumn("p", F.split("text", ",")).withColumns({n: F.expr(e) for n, e in _SCALE.items()})


def _piece(i):
    return F.get("p", F.lit(i))


def _scale_sql(public, basis):
    risk = f"({_SCALE['stage']}) = 'DOCUMENTED_RISK'"
    return f"""WHEN ({_SCALE['fit']}) <> 'HIGH' THEN 'NO_LOCAL_FIT' WHEN ({_SCALE['scale']}) = 'ORDINARY_SINGLE_CASE' THEN 'SINGLE_CASE' WHEN ({_SCALE['stage']}) = 'SPECULATIVE' THEN 'SPECULATIVE'
WHEN {risk} AND NOT coalesce(({_SCALE['lane']}) IN ('BOTH', 'WATCHDOG_DUTY'), FALSE) THEN 'LANE_MISMATCH' WHEN {risk} AND length({_s(public)}) < 20 THEN 'NO_PUBLIC_BASIS' WHEN length({_s(basis)}) < 12 THEN 'NO_SCALE_BASIS'"""


def _scale(public, basis):
    return ops.scale_checks(F.col("fit"), F.col("scale"), F.col("stage"), F.col("lane"), public, basis)


@query(
    "input_states",
    rf"""WITH x AS (SELECT page_id, {_s('url')} AS url, {_s("regexp_extract(url, '^https?://([^/]+)', 1)")} AS host, {_s("regexp_extract(url, '^https?://[^/]+/([^/?]*)', 1)")} AS section, {_s("regexp_replace(html, '<[^>]*>', ' ', 'g')")} AS body, {_s("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title, {_s("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS h1 FROM pages)
SELECT page_id, CASE WHEN host = '' OR section = '' THEN 'NO_IDENTITY' WHEN NOT starts_with(url, 'https://') THEN 'NO_HTTPS' WHEN length(body) < 15 THEN 'NO_EVIDENCE' WHEN length(title) < 12 AND length(h1) < 12 THEN 'NO_CONTEXT' ELSE 'VALID' END AS state FROM x""",
)
def input_states(spark, sf_dir):
    found = lambda c, p: F.regexp_extract(c, p, 1)
    state = ops.input_state(
        [F.col("page_id"), found("url", "^https?://([^/]+)"), found("url", "^https?://[^/]+/([^/?]*)")],
        F.col("url"),
        F.regexp_replace("html", "<[^>]*>", " "),
        [found("html", "<title>([^<]*)</title>"), found("html", "<h1>([^<]*)</h1>")],
    )
    return table(spark, sf_dir, "pages").select("page_id", state.alias("state"))


_DENIED_SQL = " OR ".join(
    "(" + " AND ".join([f"contains(text, '{t}')" for t in needs] + ["(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")" for x, terms in (("text", denials), ("coalesce(p[2], '')", claims))]) + ")" for needs, denials, claims in _DENIED
)
_KEY = "regexp_replace(lower(coalesce({}, '')), '[^0-9a-z가-힣]', '', 'g')"


@query(
    "assessment_states",
    f"""WITH {_PIECES}, a AS (SELECT *, {_s('p[1]')} AS quote, {_s('p[2]')} AS title, {_s('p[3]')} || '?' AS q1, {_s('p[4]')} || CASE WHEN lang = 'de' THEN '' ELSE '?' END AS q2 FROM b)
SELECT doc_id, CASE WHEN quality IS NULL THEN 'UNASSESSED' WHEN quality <> 1 THEN 'HOLD' WHEN {_DENIED_SQL} THEN 'CONTEXT_CONFLICT' WHEN NOT (length(quote) BETWEEN 15 AND 100 AND contains({_s('text')}, quote)) THEN 'QUOTE'
WHEN NOT length(title) BETWEEN 10 AND 80 OR {_KEY.format('p[2]')} = {_KEY.format('p[1]')} THEN 'TITLE'
WHEN {' OR '.join(f"contains(q1 || q2, '{g}')" for g in _GENERIC)} OR q1 = q2 OR NOT contains(q2, '?') THEN 'QUESTIONS' {_scale_sql('p[5]', 'p[6]')}
WHEN length({_s('p[7]')}) < 12 OR length({_s('p[8]')}) < 12 THEN 'NO_PATH' ELSE 'PROPOSE' END AS state FROM a""",
)
def assessment_states(spark, sf_dir):
    d, text = _pieces(spark, sf_dir), F.col("text")
    verdict = F.when(F.col("quality") == 1, "PROPOSE").when(F.col("quality").isNotNull(), "HOLD")
    q2 = F.concat(F.rtrim(F.coalesce(_piece(3), F.lit(""))), F.when(F.col("lang") == "de", "").otherwise("?"))
    state = ops.assessment_state(
        verdict, ops.denied_claim(text, _piece(1), _DENIED), _piece(0), text, _piece(1), _piece(0),
        (F.concat(ops.squash(_piece(2)), F.lit("?")), q2), _scale(_piece(4), _piece(5)), [_piece(6), _piece(7)], _GENERIC,
    )
    return d.select("doc_id", state.alias("state"))


@query(
    "review_states",
    f"""WITH {_PIECES} SELECT doc_id, CASE WHEN quality IS NULL THEN 'UNREVIEWED' WHEN quality <> 1 THEN 'HOLD' {_scale_sql('p[3]', 'p[4]')}
WHEN length({_s('p[5]')}) < 12 OR length({_s('p[6]')}) < 12 OR length({_s('p[7]')}) < 12 THEN 'THIN_REASONS' ELSE 'KEEP' END AS state FROM b""",
)
def review_states(spark, sf_dir):
    verdict = F.when(F.col("quality") == 1, "KEEP").when(F.col("quality").isNotNull(), "HOLD")
    return _pieces(spark, sf_dir).select("doc_id", ops.review_state(verdict, _scale(_piece(2), _piece(3)), [_piece(4), _piece(5), _piece(6)]).alias("state"))


@query(
    "answer_states",
    f"""WITH {_PIECES}, a AS (SELECT *, {_s('p[2]')} AS quote, string_split(text, chr(10)) AS parts, CASE WHEN quality = 1 THEN 'REVIEW' WHEN quality = 0 THEN 'HOLD' WHEN lang = 'fr' THEN 'MAYBE' WHEN lang = 'de' THEN 'NO_SIGNAL' ELSE 'REVIEW' END AS verdict FROM b),
t AS (SELECT *, coalesce(list_position(list_transform(parts, lambda x: contains(x, quote)), TRUE), 0) AS pos, length(quote) BETWEEN 15 AND 180 AND contains(text, quote) AS quoted FROM a),
s AS (SELECT *, CASE WHEN n_chars <= 100 THEN 'INVALID_SCHEMA' WHEN verdict = 'MAYBE' THEN 'INVALID_VERDICT' WHEN verdict IN ('NO_SIGNAL', 'HOLD') THEN verdict WHEN NOT quoted THEN 'INVALID_QUOTE'
WHEN length({_s('p[3]')}) < 20 OR {' OR '.join(f"contains({_s('p[3]')}, '{g}')" for g in _GENERIC)} THEN 'GENERIC_QUESTION' WHEN length({_s('p[4]')}) < 15 OR length({_s('p[5]')}) < 15 THEN 'INCOMPLETE_REASONING' WHEN pos = 0 THEN 'QUOTE_TURN_UNRESOLVED' ELSE 'REVIEW' END AS status FROM t)
SELECT doc_id, status, CASE WHEN pos > 0 AND (status = 'REVIEW' OR status = 'HOLD' AND quoted AND length({_s('p[6]')}) >= 12) THEN CAST(pos - 1 AS BIGINT) END AS turn_index FROM s""",
)
def answer_states(spark, sf_dir):
    q, lang = F.col("quality"), F.col("lang")
    verdict = F.when(q == 1, "REVIEW").when(q == 0, "HOLD").when(lang == "fr", "MAYBE").when(lang == "de", "NO_SIGNAL").otherwise("REVIEW")
    state = ops.answer_state(F.col("n_chars") > 100, verdict, _piece(1), F.col("text"), F.split("text", "\n"), _piece(2), [_piece(3), _piece(4)], _piece(5), _GENERIC)
    return _pieces(spark, sf_dir).select("doc_id", state.alias("s")).select("doc_id", "s.status", F.col("s.turn_index").cast("long").alias("turn_index"))


def _five(what, who):
    return (
        f"Who checked {what} of {{subject}} before it was put to use?",
        f"the safety of {who} at {{subject}}",
        f"no office is answerable for {what}",
        f"{what} failed once and was mended since",
        f"compare the records on {what} of {{subject}} before and after",
    )


_RULES = [
    {"domain": "RIGHTS", "all": ("tion", "heit"), "parts": _five("the past of the staff", "children")},
    {"domain": "RIGHTS", "any": ("Wh", "Ther"), "parts": _five("fire safety", "trainees")},
    {"domain": "RIGHTS", "evidence": ("haha", "ono"), "parts": _five("the box for complaints", "residents")},
    {"domain": "RIGHTS", "parts": _five("the protection of rights", "users")},
    {"domain": "CONTRACTS", "parts": _five("the tender", "those who pay for it")},
    {"domain": "SERVICE", "any": ("é", "à"), "parts": _five("the time limits", "applicants")},
]
_DEFAULT = _five("the procedure", "citizens")
_DOMAIN = "CASE lang WHEN 'en' THEN 'RIGHTS' WHEN 'de' THEN 'CONTRACTS' WHEN 'fr' THEN 'SERVICE' ELSE 'OTHER' END"


def _rule_sql():
    line = "split_part(text, chr(10), 1)"
    whens = []
    for i, r in enumerate(_RULES):
        c = [f"domain = '{r['domain']}'", *[f"contains({line}, '{t}')" for t in r.get("all", ())]]
        c += ["(" + " OR ".join(f"contains({x}, '{t}')" for t in r[k]) + ")" for k, x in (("any", line), ("evidence", "text")) if k in r]
        whens.append(f"WHEN {' AND '.join(c)} THEN {i}")
    pick = lambda n: "[" + ", ".join("'" + t + "'" for t in [*[r["parts"][n] for r in _RULES], _DEFAULT[n]]) + "][n + 1]"
    return f"""WITH x AS (SELECT doc_id, source, coalesce(text, '') AS text, {_DOMAIN} AS domain FROM documents), r AS (SELECT *, CASE {' '.join(whens)} ELSE {len(_RULES)} END AS n FROM x)
SELECT doc_id, {', '.join(f"replace({pick(n)}, '{{subject}}', coalesce(source, '')) AS {name}" for n, name in enumerate(ops.PARTS))} FROM r"""


@query("question_parts", _rule_sql())
def question_parts(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = ops.question_parts(F.col("source"), F.expr(_DOMAIN), F.substring_index(text, "\n", 1), text, _RULES, _DEFAULT)
    return table(spark, sf_dir, "documents").select("doc_id", parts.alias("q")).select("doc_id", "q.*")


_THEMES = ("Th", "und", "ción", "qu")


@query(
    "cluster_evidence",
    f"""WITH d AS (SELECT d.*, quality, toxic, list_filter({list(_THEMES)!r}, lambda t: contains(coalesce(text, ''), t)) AS themes FROM documents d LEFT JOIN labels USING (doc_id)),
e AS (SELECT lang, unnest(themes) AS theme, * EXCLUDE (lang, themes) FROM d),
f AS (SELECT lang, theme, doc_id, source, coalesce(quality = 1, FALSE) AS q, q AND coalesce(toxic = 0, FALSE) AS direct, q AND contains(text, 'est') AS scene, q AND regexp_matches(text, '[0-9]') AS concrete, q AND regexp_matches(text, ' (I|ich|je) ') AS fp, coalesce(quality = 0, FALSE) AS advice, q AND n_chars < 500 AS short, direct AND theme = 'Th' AS lead FROM e),
g AS (SELECT lang, theme, count(DISTINCT source) AS channels, count(DISTINCT source) FILTER (q) AS non_media_channels, count(*) FILTER (scene) AS scene, count(*) FILTER (concrete) AS concrete, count(*) FILTER (fp) AS first_person, count(*) FILTER (advice) AS advice, count(*) FILTER (short) AS short, count(*) FILTER (direct) AS n_direct, count(*) FILTER (lead) AS n_lead FROM f GROUP BY lang, theme)
SELECT * EXCLUDE (n_direct, n_lead), CASE WHEN non_media_channels >= 2 AND scene >= 2 AND n_direct > 0 THEN 'CORROBORATED' WHEN scene > 0 OR n_lead > 0 THEN 'LEAD' ELSE 'HOLD' END AS readiness,
3 * least(non_media_channels, 3) + 2 * least(scene, 3) + least(concrete, 2) + 2 * least(first_person, 2) - 3 * advice - short AS score FROM g""",
)
def cluster_evidence(spark, sf_dir):
    d, text = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), F.col("text")
    e = d.withColumn("theme", F.explode(F.filter(F.array(*map(F.lit, _THEMES)), lambda t: F.contains(text, t))))
    return ops.cluster_evidence(
        e, ["lang", "theme"], "doc_id", "source", F.col("quality") == 1, F.col("toxic") == 0, F.contains(text, F.lit("est")), text.rlike("[0-9]"), text.rlike(" (I|ich|je) "), F.col("quality") == 0, F.col("n_chars") < 500, F.col("theme") == "Th"
    )


@query(
    "cluster_selection",
    f"""WITH d AS (SELECT d.*, quality, toxic, list_filter({list(_THEMES)!r}, lambda t: contains(coalesce(text, ''), t)) AS themes FROM documents d LEFT JOIN labels USING (doc_id)),
e AS (SELECT lang, unnest(themes) AS theme, doc_id, source, n_chars, coalesce(toxic = 0, FALSE) AS direct, coalesce(contains(text, 'est'), FALSE) AS scene, coalesce(source LIKE '%1', FALSE) AS near FROM d WHERE quality = 1),
g AS (SELECT lang, theme, list_filter([CASE WHEN count(DISTINCT source) < 2 THEN 'CHANNELS' END, CASE WHEN count(*) FILTER (scene) < 2 THEN 'SCENES' END, CASE WHEN count(*) FILTER (direct) = 0 THEN 'DIRECT' END, CASE WHEN count(*) FILTER (scene AND near) = 0 THEN 'PLACE' END], lambda x: x IS NOT NULL) AS reasons FROM e GROUP BY lang, theme),
r AS (SELECT lang, theme, doc_id, row_number() OVER (PARTITION BY lang, theme ORDER BY NOT near, NOT direct, NOT scene, n_chars, doc_id) AS place FROM e),
s AS (SELECT lang, theme, list(doc_id ORDER BY place) AS sample FROM r WHERE place <= 6 GROUP BY lang, theme)
SELECT g.lang, g.theme, reasons, CASE WHEN len(reasons) = 0 THEN sample END AS sample FROM g JOIN s USING (lang, theme)""",
)
def cluster_selection(spark, sf_dir):
    d, text = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), F.col("text")
    e = d.withColumn("theme", F.explode(F.filter(F.array(*map(F.lit, _THEMES)), lambda t: F.contains(text, t))))
    return ops.cluster_selection(e, ["lang", "theme"], "doc_id", "source", F.col("quality") == 1, F.col("toxic") == 0, F.contains(text, F.lit("est")), F.col("source").like("%1"), F.col("n_chars"))


_COUNTS = {
    "reviews": "o_totalprice > 20000",
    "ready": "o_orderstatus <> 'P'",
    "ready_reviews": "o_orderstatus <> 'P' AND o_totalprice > 20000",
    "attempted": "o_totalprice > 1000",
    "extracted": "o_totalprice > 1500",
    "grounded": "o_orderstatus <> 'P' AND o_totalprice > 25000",
    "startable": "o_orderstatus <> 'P' AND o_totalprice > 60000",
    "angled": "o_totalprice > 60000",
    "right_angle": "o_totalprice > 70000",
    "generic": "o_orderstatus <> 'P' AND o_totalprice > 400000",
    "critical": "o_totalprice > 480000",
    "complete": "o_orderstatus <> 'P'",
}
_PCT = {"reviewed": ("reviews", "documents"), "ready_reviewed": ("ready_reviews", "ready"), "extraction": ("extracted", "attempted"), "grounding": ("grounded", "ready_reviews"), "startable": ("startable", "ready_reviews"), "angle": ("right_angle", "angled"), "generic": ("generic", "ready_reviews"), "structure": ("complete", "ready")}


@query(
    "outcome_metrics",
    f"""WITH m AS (SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, CAST(date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) + 1 AS BIGINT) AS span_days, count(*) AS documents, {', '.join(f'count(*) FILTER ({c}) AS {n}' for n, c in _COUNTS.items())} FROM orders GROUP BY 1),
p AS (SELECT *, {', '.join(f'round(CASE WHEN {b} > 0 THEN CAST(100 AS DOUBLE) * {a} / {b} END, 1) AS {n}_pct' for n, (a, b) in _PCT.items())} FROM m)
SELECT *, CASE WHEN days < 7 OR span_days < 7 OR documents < 12 THEN 'COLLECTING' WHEN NOT coalesce(reviewed_pct >= 80 AND ready_reviewed_pct >= 80, FALSE) THEN 'AWAITING_REVIEW'
WHEN coalesce(extraction_pct >= 80 AND grounding_pct >= 90 AND startable_pct >= 60 AND angle_pct >= 90 AND generic_pct <= 20 AND critical = 0 AND structure_pct = 100, FALSE) THEN 'ELIGIBLE' ELSE 'NOT_MET' END AS outcome FROM p""",
)
def outcome_metrics(spark, sf_dir):
    day = F.to_date("o_orderdate")
    # Days combine before the customer's row is made, so a hot customer keeps no set of dates.
    by_day = table(spark, sf_dir, "orders").groupBy("o_custkey", day.alias("day")).agg(F.count(F.lit(1)).alias("documents"), *[F.count_if(F.expr(c)).alias(n) for n, c in _COUNTS.items()])
    span = (F.datediff(F.max("day"), F.min("day")) + 1).cast("long").alias("span_days")
    m = by_day.groupBy("o_custkey").agg(F.count("day").alias("days"), span, F.sum("documents").alias("documents"), *[F.sum(n).alias(n) for n in _COUNTS])
    return ops.outcome(m)


def _rules_sql(rules):
    """(id, rule) of the rules that a row breaks, from conditions that hold where they are kept."""
    return "unnest(list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({ok}, FALSE) THEN '{n}' END" for n, ok in rules.items()) + "], lambda x: x IS NOT NULL)) AS rule"


_ENUMS = {"agent_role": ["en", "de", "es"], "loss_type": ["LOSS"], "source_family": ["src"], "grounding": ["G0_UNGROUNDED", "G1", "G3_INDEPENDENT_CORROBORATION"], "verdict": ["PASS", "FAIL"], "lane": ["REJECT", "EDITORIAL_PROPOSAL", "VERIFY_TODAY", "HOLD"]}
_SCORES = ("citizen_loss_rights", "competing_hypotheses", "falsification_decision_line", "structure", "locality", "evidence")
_GIVEN = {
    "verdict": "CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END",
    "lane": "CASE WHEN toxic = 1 THEN 'REJECT' WHEN n_chars > 2000 THEN 'EDITORIAL_PROPOSAL' WHEN n_chars > 1000 THEN 'VERIFY_TODAY' ELSE 'HOLD' END",
    "grounding": "CASE lang WHEN 'en' THEN 'G3_INDEPENDENT_CORROBORATION' WHEN 'de' THEN 'G0_UNGROUNDED' ELSE 'G1' END",
    "s1": "CASE WHEN quality = 1 THEN 2 ELSE 0 END",
    "s2": "CASE WHEN toxic = 0 THEN 1 ELSE 0 END",
    "s3": "CASE WHEN n_chars > 1000 THEN 2 ELSE 1 END",
    "s4": "CASE lang WHEN 'es' THEN 3 ELSE 2 END",
}
_LONG = "length(trim(coalesce({}, ''))) BETWEEN 1 AND {}"


@query(
    "assessment_violations",
    f"""WITH {_PIECES}, g AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _GIVEN.items())} FROM b)
SELECT doc_id, """
    + _rules_sql(
        {
            "TEXTS": " AND ".join([_LONG.format("p[1]", 160), _LONG.format("text", 800), _LONG.format("p[3]", 600)]),
            "SNAPSHOT": "quality IS NOT NULL",
            "SCOPE_WARNING": "p[2] IS NOT NULL",
            "ENUMS": "lang IN ('en', 'de', 'es')",
            "EVIDENCE": _LONG.format("p[2]", 1600) + " AND lang <> 'fr'",
            "QUOTE_IDS": "source <> 'src1'",
            "STAKE": _LONG.format("p[4]", 240),
            "FACTS": _LONG.format("p[5]", 100000),
            "CLAIMS": "source <> 'src2'",
            "HYPOTHESES": "p[6] IS NOT NULL AND " + _LONG.format("p[6]", 120),
            "PLAN": _LONG.format("p[7]", 400),
            "KILL_CRITERIA": "length(trim(p[8])) > 0",
            "SCORE_RANGE": "s4 <= 2",
            "SCORE_TOTAL": "n_chars <= 3000",
            "PASS_GATE": "verdict <> 'PASS' OR (s1 + s2 + s3 + s4 + 2 >= 8 AND s1 >= 1 AND s2 >= 1 AND s3 >= 1)",
            "CORROBORATION": "lane <> 'EDITORIAL_PROPOSAL' OR lang = 'en'",
            "UNGROUNDED": "lane <> 'VERIFY_TODAY' OR lang <> 'de'",
            "REJECT": "lane <> 'REJECT' OR verdict = 'FAIL'",
        }
    )
    + " FROM g",
)
def assessment_violations(spark, sf_dir):
    lit, p = F.lit, _piece
    d = _pieces(spark, sf_dir).drop("lane").withColumns({n: F.expr(e) for n, e in _GIVEN.items()})
    ref = lambda i: F.struct(i.alias("quote_id"), lit("r").alias("ref_id"), lit("s").alias("source_id"), F.when(F.col("lang") == "fr", "ftp://x").otherwise("https://x").alias("url"), p(1).alias("exact_text"), lit("UNRESOLVED").alias("claim_status"))
    said = lambda t, i: F.array(F.struct(t.alias("text"), F.array(i).alias("quote_ids")))
    hypothesis = F.struct(p(5).alias("name"), lit("e").alias("explanation"), lit("d").alias("discriminating_evidence"))
    a = d.select(
        "doc_id", "verdict", "lane", "grounding",
        lit("c").alias("candidate_id"), p(0).alias("issue_title"), F.col("text").alias("issue_summary"), lit("m").alias("structural_mechanism"), p(2).alias("editorial_tension"), lit("r").alias("reasoning_summary"),
        F.when(F.col("quality").isNotNull(), F.sha2("text", 256)).otherwise(F.upper(F.sha2("text", 256))).alias("snapshot_id"),
        p(1).alias("scope_warning"),
        F.col("lang").alias("agent_role"),
        F.array(ref(F.col("source")), ref(lit("src1"))).alias("evidence"),
        F.struct(p(3).alias("affected_group"), lit("c").alias("consequence"), lit("LOSS").alias("loss_type")).alias("stake"),
        said(p(4), F.col("source")).alias("confirmed"),
        said(lit("t"), F.when(F.col("source") == "src2", "none").otherwise(F.col("source"))).alias("unverified"),
        F.array(hypothesis, hypothesis).alias("hypotheses"),
        F.array(F.struct(lit("a").alias("action"), p(6).alias("pass_signal"), lit("src").alias("source_family"))).alias("plan"),
        F.array(p(7)).alias("kill_criteria"),
        F.struct(*[x.alias(n) for n, x in zip(_SCORES, [*[F.col(f"s{i}") for i in range(1, 5)], lit(1), lit(1)])]).alias("scores"),
        (F.col("s1") + F.col("s2") + F.col("s3") + F.col("s4") + 2 + F.when(F.col("n_chars") > 3000, 1).otherwise(0)).alias("score_total"),
    )
    return gates.violations(a, "doc_id", ops.assessment_rules(_ENUMS, _SCORES, _SCORES[:3]))


@query(
    "signal_violations",
    f"""WITH {_PIECES} SELECT doc_id, """
    + _rules_sql(
        {
            "NO_ANCHOR": "length(p[1]) > 0 AND quality IS NOT NULL",
            "CONTEXT": "lang <> 'fr'",
            "NO_ARTICLE": "lang <> 'en' OR quality = 1",
            "QUESTION_WITHOUT_BODY": "lang = 'en' OR length(coalesce(p[3], '')) = 0",
            "PROBLEM_ASSUMED": "quality IS NOT NULL",
            "UNREVIEWED_ANGLE": "length(coalesce(p[9], '')) = 0 AND n_chars <= 3000",
        }
    )
    + " FROM b",
)
def signal_violations(spark, sf_dir):
    q, lang = F.col("quality"), F.col("lang")
    kinds = F.when(q == 1, F.array(F.lit("publisher_article"))).when(q.isNotNull(), F.array(F.lit("title"))).otherwise(F.array().cast("array<string>"))
    d = _pieces(spark, sf_dir).select(
        "doc_id", F.col("doc_id").alias("id"), _piece(0).alias("headline"), kinds.alias("evidence_types"), F.when(lang == "en", "BODY_READ").when(lang == "fr", "BODY").otherwise("TITLE_ONLY").alias("context"), _piece(2).alias("question"),
        F.when(q.isNotNull(), "UNASSESSED").alias("problem"), _piece(8).alias("structural_question"), F.when(F.col("n_chars") > 3000, F.array(F.lit("t"))).alias("title_options"),
    )
    return gates.violations(d, "doc_id", ops.signal_rules())


@query(
    "candidate_violations",
    f"""WITH {_PIECES} SELECT doc_id, """
    + _rules_sql(
        {
            "MISSING": "length(p[1]) > 0 AND length(p[2]) > 0 AND length(p[4]) > 0",
            "UNAPPROVED": "quality = 1",
            "TITLE_ONLY": "n_chars >= 300",
            "DISCOVERY_STATUS": "coalesce(toxic, 1) = 0",
            "GENERIC_PHRASE": "NOT (" + " OR ".join(f"contains(coalesce(p[{i}], ''), '{g}')" for i in (1, 2, 4) for g in _GENERIC) + ")",
        }
    )
    + " FROM b",
)
def candidate_violations(spark, sf_dir):
    d = _pieces(spark, sf_dir).select(
        "doc_id", _piece(0).alias("title"), _piece(1).alias("question"), _piece(3).alias("test"), F.when(F.col("quality") == 1, "APPROVED").alias("promotion"), F.when(F.col("n_chars") < 300, "TITLE_ONLY").alias("context"),
        F.when(F.coalesce("toxic", F.lit(1)) == 0, "OPEN").otherwise("DISCOVERY_ONLY").alias("status"),
    )
    return gates.violations(d, "doc_id", ops.candidate_rules(["title", "question", "test"], _GENERIC))


@query(
    "observation_violations",
    """WITH o AS (SELECT conv_id, count(*) AS n, count(DISTINCT role) AS roles, count(DISTINCT length(text)) AS lengths, max(length(text)) AS longest, bool_or(role = 'system') AS probed, min(length(text)) AS shortest FROM conversations GROUP BY conv_id)
SELECT conv_id, """
    + _rules_sql(
        {
            "UNREGISTERED": "n > 1",
            "MATURITY": "n > 1 AND NOT probed",
            "SOURCE_URL": "longest <= 800",
            "ACCESS": "shortest > 20",
            "FORBIDDEN_KEYS": "NOT probed",
            "PROBE_WITH_RECORDS": "n > 1 AND NOT probed",
            "REPEATED_ID": "roles = n",
            "REPEATED_URL": "lengths = n",
            "DATE_STATE": "shortest >= 40",
            "RECORD_STATE": "longest <= 1000",
            "EXCERPT": "longest <= 260",
        }
    )
    + " FROM o",
)
def observation_violations(spark, sf_dir):
    size = F.length("text")
    record = F.struct(
        F.col("role").alias("id"), F.concat(F.lit("https://example.org/"), size.cast("string")).alias("url"), F.when(size < 40, "VERIFIED").otherwise("UNKNOWN").alias("date_state"), F.lit(None).cast("string").alias("published"),
        F.lit("OK").alias("access"), F.when(size > 1000, "GONE").otherwise("READ").alias("body"), F.col("text").alias("excerpt"),
    )
    # An observation is the unit of the contract: its records are the turns of one conversation.
    o = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(record).alias("records"), F.max(size).alias("longest"), F.min(size).alias("shortest"), F.bool_or(F.col("role") == "system").alias("probed"))
    o = o.select(
        "conv_id", "records", F.when(F.size("records") > 1, F.when(F.col("probed"), "L0").otherwise("L1")).alias("registered"), F.lit("L1").alias("maturity"), F.when(F.col("longest") > 800, "http://example.org").alias("source_url"),
        F.when(F.col("shortest") > 20, "OK").otherwise("ODD").alias("access"), F.lit("NOT_EVALUATED").alias("interpretation"), F.array(F.when(F.col("probed"), "score").otherwise("records")).alias("keys"),
    )
    return gates.violations(o, "conv_id", ops.observation_rules(["OK", "FAILED"], ["READ", "TITLE"], ["VERIFIED", "UNKNOWN"], ["score", "verdict"]))
