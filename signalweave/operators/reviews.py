"""Contracts of inputs, assessments and independent reviews, question parts from rule tables, cluster evidence and outcomes.

Each contract is one expression over a row's columns: the first check that fails names the row's state. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import key_of, squash
from .gates import first_failure
from .scoring import has

#: The parts of a question, in the order of a rule's templates.
PARTS = ("verification_question", "public_interest", "structural_hypothesis", "alternative_hypothesis", "minimum_test")

# Points and most rows that count for channels, scenes, concrete and first-person rows; penalties of advice and short rows.
CLUSTER_POINTS = {"non_media_channels": (3, 3), "scene": (2, 3), "concrete": (1, 2), "first_person": (2, 2), "advice": (-3, None), "short": (-1, None)}
# Bars in per cent that an outcome must reach.
OUTCOME_BARS = {"extraction": 80, "grounding": 90, "startable": 60, "angle": 90}


def _at_least(x: Column, n: int) -> Column:
    return F.length(squash(x)) >= n


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def input_state(identity: Sequence[Column], url: Column, evidence: Column, contexts: Sequence[Column], evidence_least: int = 15, context_least: int = 12) -> Column:
    """VALID, or why a record can't be assessed: NO_IDENTITY, NO_HTTPS, NO_EVIDENCE, NO_CONTEXT (one long enough context is enough)."""
    return first_failure(
        [
            ("NO_IDENTITY", _all([_at_least(c.cast("string"), 1) for c in identity])),
            ("NO_HTTPS", squash(url).startswith("https://")),
            ("NO_EVIDENCE", _at_least(evidence, evidence_least)),
            ("NO_CONTEXT", _any([_at_least(c, context_least) for c in contexts])),
        ],
        "VALID",
    )


def denied_claim(context: Column, claim: Column, rules: Sequence[tuple[Sequence[str], Sequence[str], Sequence[str]]]) -> Column:
    """Whether a claim asserts what its context denies: rules are (all of these in the context, one of these denials in it, one of these in
    the claim)."""
    return _any([_all([*[has(context, t) for t in needs], has(context, *denials), has(claim, *claims)]) for needs, denials, claims in rules])


def scale_checks(fit: Column, scale: Column, stage: Column, lane: Column, public: Column, basis: Column) -> list[tuple[str, Column]]:
    """The checks that assessments and reviews share: local fit, more than an ordinary single case, documented or actual impact, and for a
    documented risk a watching lane with a public basis of 20 characters; a basis of 12 for the scale."""
    risk = squash(stage) == "DOCUMENTED_RISK"
    return [
        ("NO_LOCAL_FIT", squash(fit) == "HIGH"),
        ("SINGLE_CASE", squash(scale) != "ORDINARY_SINGLE_CASE"),
        ("SPECULATIVE", squash(stage) != "SPECULATIVE"),
        ("LANE_MISMATCH", ~risk | squash(lane).isin("WATCHDOG_DUTY", "BOTH")),
        ("NO_PUBLIC_BASIS", ~risk | _at_least(public, 20)),
        ("NO_SCALE_BASIS", _at_least(basis, 12)),
    ]


def assessment_state(verdict: Column, conflict: Column, quote: Column, evidence: Column, title: Column, headline: Column, questions: tuple[Column, Column], scale: Sequence[tuple[str, Column]], paths: Sequence[Column], generic: Sequence[str]) -> Column:
    """PROPOSE, or the first check that holds an assessment back.

    UNASSESSED: no verdict. HOLD: any verdict but PROPOSE. CONTEXT_CONFLICT: the context denies the claim. QUOTE: not 15 to 100 characters
    of the evidence. TITLE: not 10 to 80 characters, or the headline again. QUESTIONS: generic, equal, or none asked. Then the checks of
    ``scale`` (``scale_checks``), and NO_PATH: a field of ``paths`` under 12 characters.
    """
    q, t, (a, b) = squash(quote), squash(title), map(squash, questions)
    held = first_failure(
        [
            ("CONTEXT_CONFLICT", ~F.coalesce(conflict, F.lit(False))),
            ("QUOTE", F.length(q).between(15, 100) & F.contains(squash(evidence), q)),
            ("TITLE", F.length(t).between(10, 80) & (key_of(title) != key_of(headline))),
            ("QUESTIONS", ~has(F.concat(a, b), *generic) & (a != b) & F.contains(a, F.lit("?")) & F.contains(b, F.lit("?"))),
            *scale,
            ("NO_PATH", _all([_at_least(p, 12) for p in paths])),
        ],
        "PROPOSE",
    )
    return F.when(verdict.isNull(), "UNASSESSED").when(verdict != "PROPOSE", "HOLD").otherwise(held)


def review_state(verdict: Column, scale: Sequence[tuple[str, Column]], reasons: Sequence[Column], least: int = 12) -> Column:
    """KEEP, or why an independent review holds a proposal: UNREVIEWED, HOLD (its verdict), a check of ``scale``, or THIN_REASONS."""
    held = first_failure([*scale, ("THIN_REASONS", _all([_at_least(r, least) for r in reasons]))], "KEEP")
    return F.when(verdict.isNull(), "UNREVIEWED").when(verdict != "KEEP", "HOLD").otherwise(held)


def answer_state(complete: Column, verdict: Column, quote: Column, body: Column, parts: Column, question: Column, fields: Sequence[Column], first_check: Column, generic: Sequence[str]) -> Column:
    """struct(status, turn_index) of an answer about a text with ``parts`` (an array of texts).

    INVALID_SCHEMA, INVALID_VERDICT, NO_SIGNAL; HOLD, with a turn if its quote of 15 to 180 characters is in the body and a part and the
    first check has 12 characters; INVALID_QUOTE, GENERIC_QUESTION (or under 20 characters), INCOMPLETE_REASONING (a field under 15),
    QUOTE_TURN_UNRESOLVED (no part has the quote), REVIEW. ``turn_index`` is the first part that has the quote, counted from 0.
    """
    q = squash(quote)
    found = F.array_position(F.transform(parts, lambda p: F.contains(F.coalesce(p, F.lit("")), q)), True)
    turn = F.when(found > 0, found - 1)
    quoted = F.length(q).between(15, 180) & F.contains(F.coalesce(body, F.lit("")), q)
    status = (
        F.when(~F.coalesce(complete, F.lit(False)), "INVALID_SCHEMA")
        .when(~F.coalesce(verdict.isin("REVIEW", "HOLD", "NO_SIGNAL"), F.lit(False)), "INVALID_VERDICT")
        .when(verdict.isin("NO_SIGNAL", "HOLD"), verdict)
        .when(~quoted, "INVALID_QUOTE")
        .when(~_at_least(question, 20) | has(squash(question), *generic), "GENERIC_QUESTION")
        .when(~_all([_at_least(f, 15) for f in fields]), "INCOMPLETE_REASONING")
        .when(turn.isNull(), "QUOTE_TURN_UNRESOLVED")
        .otherwise("REVIEW")
    )
    placed = (status == "REVIEW") | ((status == "HOLD") & quoted & _at_least(first_check, 12))
    return F.struct(status.alias("status"), F.when(placed, turn).alias("turn_index"))


def question_parts(subject: Column, domain: Column, finding: Column, context: Column, rules: Sequence[Mapping], default: Sequence[str]) -> Column:
    """struct of ``PARTS`` from the first rule that fits: {"domain": name, "all": words in the finding, "any": one of these in it,
    "evidence": one of these in the finding or its context, "parts": five templates}.

    Absent keys ask nothing. ``{subject}`` in a template is replaced; a null subject is empty. No rule fits: the ``default`` templates.
    """
    finding, subject = F.coalesce(finding, F.lit("")), F.coalesce(subject, F.lit(""))
    evidence = F.concat_ws("\n", finding, F.coalesce(context, F.lit("")))

    def fits(r: Mapping) -> Column:
        asked = [domain == r["domain"], *[has(finding, t) for t in r.get("all", ())]]
        asked += [has(finding, *r["any"])] if r.get("any") else []
        asked += [has(evidence, *r["evidence"])] if r.get("evidence") else []
        return _all(asked)

    chosen = F.lit(len(rules))
    for i in range(len(rules) - 1, -1, -1):
        chosen = F.when(fits(rules[i]), F.lit(i)).otherwise(chosen)
    # The rule is found once; the templates are literals picked by its number.
    tables = [F.array(*[F.lit(r["parts"][n]) for r in rules], F.lit(default[n])) for n in range(len(PARTS))]
    return F.transform(F.array(chosen), lambda i: F.struct(*[F.replace(F.get(t, i), F.lit("{subject}"), subject).alias(name) for name, t in zip(PARTS, tables)]))[0]


def cluster_evidence(df: DataFrame, cluster: Sequence[str], id_col: str, channel: str, qualified: Column, direct: Column, scene: Column, concrete: Column, first_person: Column, advice: Column, short: Column, lead_lane: Column) -> DataFrame:
    """A row for each cluster: channels, non-media channels, scene, concrete, first-person, advice and short rows, readiness and score.

    A row may come more than once in a cluster (under several labels); it counts once, and is in a lead lane if one of its labels is.
    All but ``advice`` count qualified rows only. CORROBORATED: two non-media channels, two scenes and a direct row; LEAD: a scene or a
    direct row in a lead lane; else HOLD. Null channels are no channel. Ids and channels combine before the shuffle.
    """
    flag = lambda c: F.coalesce(c, F.lit(False))
    q = flag(qualified)
    flags = {"q": q, "direct": q & flag(direct), "scene": q & flag(scene), "concrete": q & flag(concrete), "first_person": q & flag(first_person), "advice": flag(advice), "short": q & flag(short), "lead": q & flag(direct) & flag(lead_lane)}
    once = df.select(*cluster, F.col(id_col).alias("__id"), F.col(channel).alias("__channel"), *[c.alias(f"__{n}") for n, c in flags.items()])
    once = once.groupBy(*cluster, "__id").agg(F.min("__channel").alias("__channel"), *[F.bool_or(f"__{n}").alias(f"__{n}") for n in flags])
    # One level by channel first, so that the distinct counts of a hot cluster need no set of its channels.
    by = once.groupBy(*cluster, "__channel").agg(F.bool_or("__q").alias("__q"), *[F.count_if(f"__{n}").alias(n) for n in ("scene", "concrete", "first_person", "advice", "short", "direct", "lead")])
    known = F.col("__channel").isNotNull()
    out = by.groupBy(*cluster).agg(
        F.count_if(known).alias("channels"), F.count_if(known & F.col("__q")).alias("non_media_channels"), *[F.sum(n).alias(n) for n in ("scene", "concrete", "first_person", "advice", "short", "direct", "lead")]
    )
    ready = F.when((F.col("non_media_channels") >= 2) & (F.col("scene") >= 2) & (F.col("direct") > 0), "CORROBORATED").when((F.col("scene") > 0) | (F.col("lead") > 0), "LEAD").otherwise("HOLD")
    score = F.lit(0)
    for n, (each, most) in CLUSTER_POINTS.items():
        score = score + each * (F.col(n) if most is None else F.least(F.col(n), F.lit(most)))
    return out.withColumns({"readiness": ready, "score": score}).drop("direct", "lead")


def cluster_selection(df: DataFrame, cluster: Sequence[str], id_col: str, channel: str, qualified: Column, direct: Column, scene: Column, near: Column, published: Column, most: int = 6) -> DataFrame:
    """A row for each cluster with a qualified row: ``reasons`` against its review, and if there are none its ``sample`` of ids.

    Reasons: CHANNELS (under two), SCENES (under two scene rows), DIRECT (no direct row), PLACE (no scene row near). The sample has the
    first ``most`` rows, near ones first, then direct ones, scenes, the earliest published and the smallest id. A row counts once.
    """
    flag = lambda c: F.coalesce(c, F.lit(False))
    flags = {"direct": flag(direct), "scene": flag(scene), "near": flag(near)}
    rows = df.filter(flag(qualified)).select(*cluster, F.col(id_col).alias("__id"), F.col(channel).alias("__channel"), published.alias("__at"), *[c.alias(f"__{n}") for n, c in flags.items()])
    once = rows.groupBy(*cluster, "__id").agg(F.min("__channel").alias("__channel"), F.min("__at").alias("__at"), *[F.bool_or(f"__{n}").alias(f"__{n}") for n in flags])
    by = once.groupBy(*cluster, "__channel").agg(F.count_if("__scene").alias("s"), F.count_if("__direct").alias("d"), F.count_if(F.col("__scene") & F.col("__near")).alias("n"))
    tests = [("CHANNELS", F.count("__channel") >= 2), ("SCENES", F.sum("s") >= 2), ("DIRECT", F.sum("d") > 0), ("PLACE", F.sum("n") > 0)]
    found = by.groupBy(*cluster).agg(F.array_compact(F.array(*[F.when(~ok, F.lit(label)) for label, ok in tests])).alias("reasons"))
    first = W.partitionBy(*cluster).orderBy(F.desc("__near"), F.desc("__direct"), F.desc("__scene"), F.asc("__at"), F.asc("__id"))
    # The rank filter is a group limit: each partition passes on no more than ``most`` rows of a cluster.
    top = once.withColumn("__place", F.row_number().over(first)).filter(F.col("__place") <= most)
    samples = top.groupBy(*cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("__place", "__id"))), lambda x: x["__id"]).alias("sample"))
    joined = found.alias("f").join(samples.alias("s"), [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cluster])
    return joined.select(*[F.col(f"f.{c}").alias(c) for c in cluster], F.col("f.reasons"), F.when(F.size("f.reasons") == 0, F.col("s.sample")).alias("sample"))


def outcome(metrics: DataFrame, least_days: int = 7, least_documents: int = 12) -> DataFrame:
    """``outcome`` and the percentages of rows of counts.

    ``metrics`` has days, span_days, documents, reviews, ready, ready_reviews, attempted, extracted, grounded, startable, angled,
    right_angle, generic, critical, complete. COLLECTING: too few days or documents; AWAITING_REVIEW: under 80 per cent of documents or of
    ready ones reviewed; ELIGIBLE: every bar reached, at most 20 per cent generic, nothing critical, all structures complete; else NOT_MET.
    A percentage of nothing is null, and null reaches no bar.
    """
    per = lambda a, b: F.round(F.when(F.col(b) > 0, 100.0 * F.col(a) / F.col(b)), 1)
    pairs = {"reviewed": ("reviews", "documents"), "ready_reviewed": ("ready_reviews", "ready"), "extraction": ("extracted", "attempted"), "grounding": ("grounded", "ready_reviews"), "startable": ("startable", "ready_reviews"), "angle": ("right_angle", "angled"), "generic": ("generic", "ready_reviews"), "structure": ("complete", "ready")}
    d = metrics.withColumns({f"{n}_pct": per(a, b) for n, (a, b) in pairs.items()})
    p = lambda n: F.col(f"{n}_pct")
    met = _all([*[p(n) >= bar for n, bar in OUTCOME_BARS.items()], p("generic") <= 20, F.col("critical") == 0, p("structure") == 100])
    return d.withColumn(
        "outcome",
        F.when(~_all([F.col("days") >= least_days, F.col("span_days") >= least_days, F.col("documents") >= least_documents]), "COLLECTING")
        .when(~_all([p("reviewed") >= 80, p("ready_reviewed") >= 80]), "AWAITING_REVIEW")
        .when(met, "ELIGIBLE")
        .otherwise("NOT_MET"),
    )


# The longest texts of an assessment, of its evidence, hypotheses and plan.
TEXT_LIMITS = {"candidate_id": 120, "issue_title": 160, "issue_summary": 800, "structural_mechanism": 800, "editorial_tension": 600, "reasoning_summary": 800}
REF_LIMITS = {"quote_id": 80, "ref_id": None, "source_id": None, "url": None, "exact_text": 1600}
STAKE_LIMITS = {"affected_group": 240, "consequence": 600}
HYPOTHESIS_LIMITS = {"name": 120, "explanation": 600, "discriminating_evidence": 500}
STEP_LIMITS = {"action": 500, "pass_signal": 400}
CLAIM_STATES = ("OBSERVED_OR_PUBLISHED", "ATTRIBUTED_CLAIM", "UNRESOLVED")


def _texts(limits: Mapping[str, int | None], get) -> Column:
    """Whether each named text is there and no longer than its limit, its ends trimmed."""
    size = lambda n: F.length(F.trim(F.coalesce(get(n), F.lit(""))))
    return _all([(size(n) > 0) if most is None else size(n).between(1, most) for n, most in limits.items()])


def assessment_rules(enums: Mapping[str, Sequence[str]], scores: Sequence[str], mandatory: Sequence[str], pass_total: int = 8) -> dict[str, Column]:
    """Rules of an assessment's columns for ``gates.violations``; a null breaks the rule that reads it.

    Columns: the texts of ``TEXT_LIMITS``, snapshot_id, scope_warning, ``evidence`` (array of structs, ``REF_LIMITS`` and claim_status),
    ``stake`` (struct, ``STAKE_LIMITS`` and loss_type), ``confirmed`` and ``unverified`` (arrays of struct(text, quote_ids)),
    ``hypotheses``, ``plan`` (arrays of structs), ``kill_criteria`` (array), ``scores`` (struct of ``scores``), score_total, and
    agent_role, grounding, verdict, lane. ``enums`` names the values of agent_role, loss_type, source_family, grounding, verdict, lane.
    """
    c, is_in = F.col, lambda x, n: x.isin(*enums[n])
    each = lambda col, f: F.forall(F.coalesce(F.col(col), F.array()), lambda x: F.coalesce(f(x), F.lit(False)))
    known = F.transform("evidence", lambda r: r["quote_id"])
    cited = lambda col: each(col, lambda x: (F.length(F.trim(x["text"])) > 0) & (F.size(x["quote_ids"]) > 0) & (F.size(F.array_except(x["quote_ids"], known)) == 0))
    points = [c(f"scores.{n}") for n in scores]
    total = sum(points, F.lit(0))
    passed = c("verdict") == "PASS"
    return {
        "TEXTS": _texts(TEXT_LIMITS, F.col),
        "SNAPSHOT": c("snapshot_id").rlike("^[0-9a-f]{64}$"),
        "SCOPE_WARNING": c("scope_warning").isNotNull(),
        "ENUMS": _all([is_in(c(n), n) for n in ("agent_role", "grounding", "verdict", "lane")]),
        "NO_EVIDENCE": F.size("evidence") > 0,
        "EVIDENCE": each("evidence", lambda r: _texts(REF_LIMITS, lambda n: r[n]) & r["url"].rlike("^https?://") & r["claim_status"].isin(*CLAIM_STATES)),
        "QUOTE_IDS": F.size(F.array_distinct(known)) == F.size(known),
        "STAKE": _texts(STAKE_LIMITS, lambda n: F.col(f"stake.{n}")) & is_in(c("stake.loss_type"), "loss_type"),
        "FACTS": c("confirmed").isNotNull() & cited("confirmed"),
        "CLAIMS": c("unverified").isNotNull() & cited("unverified"),
        "HYPOTHESES": (F.size("hypotheses") >= 2) & each("hypotheses", lambda h: _texts(HYPOTHESIS_LIMITS, lambda n: h[n])),
        "PLAN": c("plan").isNotNull() & each("plan", lambda s: _texts(STEP_LIMITS, lambda n: s[n]) & is_in(s["source_family"], "source_family")),
        "KILL_CRITERIA": c("kill_criteria").isNotNull() & each("kill_criteria", lambda k: F.length(F.trim(k)) > 0),
        "SCORE_RANGE": _all([p.between(0, 2) for p in points]),
        "SCORE_TOTAL": total == c("score_total"),
        "PASS_GATE": ~passed | (total >= pass_total) & _all([c(f"scores.{n}") >= 1 for n in mandatory]),
        "PASS_PLAN": ~passed | (F.size("plan") > 0) & (F.size("kill_criteria") > 0),
        "CORROBORATION": (c("lane") != "EDITORIAL_PROPOSAL") | (c("grounding") == "G3_INDEPENDENT_CORROBORATION"),
        "UNGROUNDED": (c("lane") != "VERIFY_TODAY") | (c("grounding") != "G0_UNGROUNDED"),
        "REJECT": (c("lane") != "REJECT") | (c("verdict") == "FAIL"),
    }


def signal_rules(contexts: Sequence[str] = ("TITLE_ONLY", "BODY_UNAVAILABLE", "BODY_READ")) -> dict[str, Column]:
    """Rules of a discovery signal: an anchor, a known context, an article where the body was read, no question without a body, nothing
    assumed and no angle before its review. Columns: id, headline, evidence_types (array), context, question, problem, structural_question, title_options (array)."""
    empty = lambda n: F.length(F.coalesce(F.col(n), F.lit(""))) == 0
    read = F.coalesce(F.col("context") == "BODY_READ", F.lit(False))
    return {
        "NO_ID": F.col("id").isNotNull() & (F.col("id").cast("string") != ""),
        "NO_ANCHOR": ~empty("headline") & (F.size("evidence_types") > 0),
        "CONTEXT": F.col("context").isin(*contexts),
        "NO_ARTICLE": ~read | F.array_contains("evidence_types", "publisher_article"),
        "QUESTION_WITHOUT_BODY": read | empty("question"),
        "PROBLEM_ASSUMED": F.col("problem") == "UNASSESSED",
        "UNREVIEWED_ANGLE": empty("structural_question") & (F.size(F.coalesce("title_options", F.array().cast("array<string>"))) == 0),
    }


def candidate_rules(required: Sequence[str], generic: Sequence[str]) -> dict[str, Column]:
    """Rules of an approved candidate: every required text, approval, more than a title, no discovery status, no generic phrase in any of
    its texts. Columns: ``required``, promotion, context, status."""
    whole = F.concat_ws("\n", *[F.col(n) for n in required])
    return {
        "MISSING": _all([F.length(F.col(n)) > 0 for n in required]),
        "UNAPPROVED": F.col("promotion") == "APPROVED",
        "TITLE_ONLY": ~F.coalesce(F.col("context") == "TITLE_ONLY", F.lit(False)),
        "DISCOVERY_STATUS": ~F.coalesce(F.col("status") == "DISCOVERY_ONLY", F.lit(False)),
        "GENERIC_PHRASE": ~has(whole, *generic),
    }


def observation_rules(access: Sequence[str], bodies: Sequence[str], date_states: Sequence[str], forbidden: Sequence[str], most: int = 20, excerpt: int = 260) -> dict[str, Column]:
    """Rules of a thin observation joined with its source's registered maturity, for ``gates.violations``.

    Columns: registered (its maturity, null if unknown), maturity, source_url, access, interpretation, keys (all keys of the payload), and
    ``records``, an array of struct(id, url, date_state, published, access, body, excerpt). A null breaks the rule that reads it, but for a
    null source_url and null excerpts.
    """
    c = F.col
    safe = lambda u: u.rlike("^https://[A-Za-z0-9.-]+(/|$)")
    each = lambda f: F.forall("records", lambda r: F.coalesce(f(r), F.lit(False)))
    unique = lambda n: F.size(F.array_distinct(F.transform("records", lambda r: r[n]))) == F.size("records")
    none = F.size("records") == 0
    return {
        "UNREGISTERED": c("registered").isNotNull(),
        "MATURITY": c("maturity") == c("registered"),
        "SOURCE_URL": c("source_url").isNull() | (c("source_url") == "") | safe(c("source_url")),
        "ACCESS": c("access").isin(*access),
        "INTERPRETED": c("interpretation") == "NOT_EVALUATED",
        "FORBIDDEN_KEYS": F.size(F.array_intersect("keys", F.array(*map(F.lit, forbidden)))) == 0,
        "TOO_MANY": F.size("records").between(0, most),
        "FAILED_WITH_RECORDS": (c("access") != "FAILED") | none,
        "PROBE_WITH_RECORDS": (c("registered") != "L0") | none,
        "RECORD_ID": each(lambda r: F.trim(r["id"]) != ""),
        "REPEATED_ID": unique("id"),
        "RECORD_URL": each(lambda r: safe(r["url"])),
        "REPEATED_URL": unique("url"),
        "DATE_STATE": each(lambda r: r["date_state"].isin(*date_states) & ((r["date_state"] != "VERIFIED") | (F.length(F.coalesce(r["published"], F.lit(""))) > 0))),
        "RECORD_STATE": each(lambda r: r["access"].isin(*access) & r["body"].isin(*bodies)),
        "EXCERPT": each(lambda r: r["excerpt"].isNull() | (F.length(r["excerpt"]) <= excerpt)),
    }
