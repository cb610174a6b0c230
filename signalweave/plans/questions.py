"""Queries that build questions, rank findings and count the funnel of the lanes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as txt
from ..operators import questions as ops
from .base import SQL, query, table
from .texts import lane_selection

#: (terms of which one is asked, least number of values, contract's terms, own axes, whether claims are asked otherwise): thirteen topics; terms are parameters.
_TOPICS = [
    ([["license"], ["copyright"]], 1, [["version"]], True, False), ([["license"]], 0, [["software"]], False, False), ([["password", "token"], ["key"]], 1, [["secret"]], False, False),
    ([["password"]], 0, [["passwd", "word"]], True, True), ([["ción"], ["ñ"]], 2, [["rros"]], False, False), ([["heit"], ["keit"], ["ung"]], 1, [["lich"]], False, True),
    ([["eau"], ["oui"]], 1, [["ment"]], True, False), ([["edly", "ingly"]], 1, [["tion"]], False, False), ([["keit"], ["zz"]], 0, [["ß"]], True, False),
    ([["tionth"], ["thth"]], 2, [["ou"]], False, True), ([["haha"], ["Th"]], 0, [["er"]], True, False), ([["aux"], ["que"]], 3, [["oi"]], False, False), ([["@"]], 0, [["mail"]], True, True),
]
_TEMPLATES = {"none": "not asked", "verify": "Do the values bear it out?", "lead": "Only described so far", "rise": "Where does it rise?", "rise claimed": "Can the rise be reproduced?", "move": "What explains the change?", "move claimed": "Can the change be reproduced?", "claim": "Can the claim be reproduced?", "structure": "Where is it concentrated?", "problem": "How far does it repeat?"}
_TEMPLATES |= {f"topic {i}": f"Who pays for topic {i}?" for i in range(len(_TOPICS))} | {f"topic {i} claimed": f"Is topic {i} as large as said?" for i, t in enumerate(_TOPICS) if t[4]}
_ANCHOR = "CASE WHEN quality IS NULL AND n_chars < 900 THEN 'NONE' WHEN n_chars > 3000 THEN 'DECOMPOSABLE_STRUCTURE' WHEN quality = 1 THEN 'DIRECT_PROBLEM_SIGNAL' WHEN quality = 0 THEN 'OTHER' ELSE 'MEASURED_PROBLEM_SIGNAL' END"
_ANALYSIS = {
    "anchor": _ANCHOR, "usable": "coalesce(toxic = 1, FALSE)", "lead": "source LIKE '%7'", "facts": "coalesce(quality = 1, FALSE)",
    "change": "CASE WHEN text LIKE '%nnen%' THEN 'POSITIVE' WHEN text LIKE '%lyth%' THEN 'UNCLASSIFIED_CHANGE' END", "claim": "CASE WHEN lang IN ('de', 'fr') THEN 'ATTRIBUTED_CLAIM' END",
}


def _topics() -> list[dict]:
    return [
        {"when": [groups, *([n] if n else [])], "contract": [("words", groups), ("part", part), *([("value", "values")] if n else [])], "ask": f"topic {i}", "claimed": f"topic {i} claimed" if claimed else None, "axes": [f"axis {i}", "payer"], "own": own}
        for i, (groups, n, part, own, claimed) in enumerate(_TOPICS)
    ]


def _question_sql() -> str:
    any_of = lambda g: "(" + " OR ".join(f"contains(x, '{t}')" for t in g) + ")"
    every = lambda gs: " AND ".join(any_of(g) for g in gs)
    text = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"
    rows = [("anchor = 'NONE' AND NOT usable", "none", None, [], False, []), ("usable", "verify", None, ["area", "group", "time"], True, [("values of the data", "TRUE")]), ("lead", "lead", None, ["value", "class", "date"], True, [("values of the data", "FALSE")])]
    for i, (gs, n, part, own, claimed) in enumerate(_TOPICS):
        rows.append((every(gs) + (f" AND len(vals) >= {n}" if n else ""), f"topic {i}", f"topic {i} claimed" if claimed else None, [f"axis {i}", "payer"], own, [("words", every(gs)), ("part", every(part)), *([("value", "len(vals) > 0")] if n else [])]))
    p3 = ["area", "group", "period"]
    rows += [
        ("change = 'POSITIVE'", "rise", "rise claimed", p3, True, [("rise", "change = 'POSITIVE'"), ("value", "len(vals) > 0")]),
        ("change = 'UNCLASSIFIED_CHANGE'", "move", "move claimed", p3, True, [("change", "change = 'UNCLASSIFIED_CHANGE'"), ("value", "len(vals) > 0")]),
        ("claim = 'ATTRIBUTED_CLAIM'", "claim", None, ["area", "group", "time", "other reasons"], True, [("claim", "claim = 'ATTRIBUTED_CLAIM'"), ("anchor", "anchor <> 'NONE'")]),
        ("anchor = 'DECOMPOSABLE_STRUCTURE'", "structure", None, ["area", "group", "time"], True, [("structure", "anchor = 'DECOMPOSABLE_STRUCTURE'"), ("value", "len(vals) > 0")]),
        ("TRUE", "problem", None, ["extent", "period", "control"], True, [("problem", "anchor IN ('DIRECT_PROBLEM_SIGNAL', 'MEASURED_PROBLEM_SIGNAL')")]),
    ]
    case = lambda f: "CASE " + " ".join(f"WHEN b = {i} THEN {f(r)}" for i, r in enumerate(rows)) + " END"
    ask = case(lambda r: f"CASE WHEN claim = 'ATTRIBUTED_CLAIM' THEN '{_TEMPLATES[r[2]]}' ELSE '{_TEMPLATES[r[1]]}' END" if r[2] else f"'{_TEMPLATES[r[1]]}'")
    axes = case(lambda r: f"CASE WHEN len(ax) > 0 THEN ax ELSE {text(r[3])} END" if r[4] else text(r[3]))
    unmet = case(lambda r: "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({c}, FALSE) THEN 'unmet: {n}' END" for n, c in r[5]) + "], lambda v: v IS NOT NULL)" if r[5] else text([]))
    fields = ", ".join(f"{v} AS {k}" for k, v in _ANALYSIS.items())
    number = "regexp_extract_all({}, '([0-9]+(?:[.,][0-9]+)*)', 1)"
    return rf"""WITH a AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x, {fields}, list_distinct(regexp_extract_all(text, '[0-9]+')) AS vals, CASE WHEN source LIKE '%3' THEN ['region', 'time'] ELSE []::VARCHAR[] END AS ax FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT *, CASE {' '.join(f'WHEN {r[0]} THEN {i}' for i, r in enumerate(rows))} END AS b FROM a), q AS (SELECT *, {case(lambda r: f"'{r[1]}'")} AS branch, {ask} AS question, {axes} AS axes, {unmet} AS unmet, {case(lambda r: text([n for n, _ in r[5]]))} AS contract FROM c),
n AS (SELECT *, list_sort(list_distinct(list_filter({number.format('question')}, lambda v: NOT list_contains({number.format('x')}, v)))) AS odd FROM q),
i AS (SELECT *, list_filter([CASE WHEN anchor <> 'NONE' AND NOT facts AND NOT usable THEN 'no anchored fact' END] || unmet || [CASE WHEN len(odd) > 0 THEN 'numbers: ' || array_to_string(odd, ', ') END, CASE WHEN anchor = 'NONE' AND NOT usable THEN 'no anchor' END], lambda v: v IS NOT NULL) AS issues FROM n)
SELECT doc_id, branch, question, axes, contract, issues, CASE WHEN len(issues) = 0 THEN 'PASS' ELSE 'HOLD' END AS grounding, anchor <> 'NONE' OR usable AS has_basis FROM i"""


@query("question_builder", _question_sql())
def question_builder(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    a = {k: F.expr(v) for k, v in _ANALYSIS.items()} | {"values": F.array_distinct(F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))), "axes": F.when(F.col("source").like("%3"), F.array(F.lit("region"), F.lit("time")))}
    known = d.select("doc_id", txt.squash(F.col("text")).alias("x"), *[c.alias(k) for k, c in a.items()]).withColumn("numbers", txt.numbers_in(F.col("x")))
    a["numbers"] = F.col("numbers")
    return known.select("doc_id", ops.built_question(F.col("x"), {k: F.col(k) for k in a}, _topics(), _TEMPLATES).alias("q")).select("doc_id", "q.*")


_WEIGHTS = {"license": 9, "password": 7, "thth": 3, "heit": 4, "ción": 2, "eaux": 5, "zz": 1}
_DOMAINS = {"RIGHTS": ["license", "copyright"], "CONTRACT": ["tion", "ment"], "SAFETY": ["heit", "keit"], "SPACE": ["ción", "dad"]}


@query(
    "ranked_findings",
    rf"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents), c AS (SELECT doc_id, p, regexp_replace(regexp_replace(t, '^\s*[0-9]+\s*', ''), '^[ \-·]+|[ \-·]+$', '', 'g') AS t FROM l),
u AS (SELECT doc_id, t, min(p) AS p FROM c WHERE t <> '' GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS pos FROM u),
s AS (SELECT *, {' + '.join(f"CASE WHEN contains(t, '{k}'){' AND (contains(t, chr(109)) OR contains(t, chr(110)))' if k == 'heit' else ''} THEN {w} ELSE 0 END" for k, w in _WEIGHTS.items())} + CASE WHEN contains(t, 'version') OR contains(t, 'software') THEN 8 ELSE 0 END + CASE WHEN contains(t, '?') THEN 1 ELSE 0 END AS score FROM n)
SELECT doc_id, CAST(score AS BIGINT) AS score, pos, t AS line FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 5""",
)
def ranked_findings(spark, sf_dir):
    found = ops.finding_lines(F.col("text"), 5, _WEIGHTS, {"heit": ["m", "n"]}, [(["version", "software"], 8), (["?"], 1)])
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.*")


@query(
    "dominant_domains",
    f"""WITH c AS (SELECT doc_id, text, {', '.join(' + '.join(f"(len(string_split(text, '{t}')) - 1)" for t in ts) + f' AS {d.lower()}' for d, ts in _DOMAINS.items())} FROM documents)
SELECT doc_id, rights, contract, CASE WHEN rights >= 1 AND (contains(text, 'under') OR contains(text, 'version')) THEN 'RIGHTS' WHEN contract >= 40 THEN 'CONTRACT' WHEN greatest(rights, contract, safety, space) = 0 THEN NULL WHEN rights = greatest(rights, contract, safety, space) THEN 'RIGHTS' WHEN safety = greatest(rights, contract, safety, space) THEN 'SAFETY' WHEN contract = greatest(rights, contract, safety, space) THEN 'CONTRACT' ELSE 'SPACE' END AS domain FROM c""",
)
def dominant_domains(spark, sf_dir):
    n = F.col("counts")
    d = table(spark, sf_dir, "documents").select("doc_id", "text", ops.term_counts(F.col("text"), _DOMAINS).alias("counts"))
    domain = ops.dominant_domain(n, F.col("text"), ["RIGHTS", "SAFETY", "CONTRACT", "SPACE"], [("RIGHTS", 1, ["under", "version"]), ("CONTRACT", 40, [])])
    of = lambda k: F.coalesce(F.try_element_at(n, F.lit(k)), F.lit(0).cast("long"))
    return d.select("doc_id", of("RIGHTS").alias("rights"), of("CONTRACT").alias("contract"), domain.alias("domain"))


_STATES = {"extracted": "TRUE", "precheck_pass": "n_chars > 500", "precheck_hold": "n_chars BETWEEN 200 AND 500", "precheck_fail": "n_chars < 200", "grounded": "quality IS NOT NULL", "qualified": "quality = 1", "fresh_qualified": "quality = 1 AND toxic = 0"}
_SIZES = [f"lane{i:02d}" for i in range(2, 14)]


@query(
    "funnel_with_lanes",
    f"""WITH RECURSIVE {SQL['lane_selection'].removeprefix('WITH RECURSIVE ').rpartition('SELECT lane')[0]}, s AS (SELECT lane, count(*) AS n FROM z GROUP BY lane)
SELECT {', '.join(f"(SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE {c}) AS {k}" for k, c in _STATES.items())}, coalesce((SELECT sum(n) FROM s WHERE lane IN ('lane00', 'lane01')), 0)::BIGINT AS selected, {', '.join(f"coalesce((SELECT n FROM s WHERE lane = '{x}'), 0)::BIGINT AS {x}" for x in _SIZES)}""",
)
def funnel_with_lanes(spark, sf_dir):
    """One row: records by state, and how many of them the lanes took; the first two lanes are counted together, empty lanes are 0."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    states = d.agg(*[F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(k) for k, c in _STATES.items()])
    lane = F.col("lane")
    sizes = lane_selection(spark, sf_dir).agg(F.count_if(lane.isin("lane00", "lane01")).alias("selected"), *[F.count_if(lane == x).alias(x) for x in _SIZES])
    both = states.unionByName(sizes, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


