"""Questions that a record's evidence supports, impact of findings and their dominant domain. Rules, terms and templates are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as txt
from .scoring import has

#: Fields of an analysed record that the builder reads.
ANALYSIS = ("anchor", "usable", "lead", "values", "facts", "change", "claim", "axes")
NO_ANCHOR = "no anchor"


def _terms(x: Column, groups: Sequence[Sequence[str]]) -> Column:
    """One term of each group is in the text."""
    out = F.lit(True)
    for g in groups:
        one = F.lit(False)
        for t in g:
            one = one | F.contains(x, F.lit(t))
        out = out & one
    return out


def _picked(choice: Column, values: Sequence[Column]) -> Column:
    return F.get(F.array(*values), choice)


def _check(x: Column, a: Mapping[str, Column], need) -> Column:
    """A contract's check: term groups, "values" for a measured value, a number for so many, ("unit", signs) for one with such a unit, or a column."""
    if isinstance(need, Column):
        return F.coalesce(need, F.lit(False))
    if need == "values":
        return F.size(a["values"]) > 0
    if isinstance(need, int):
        return F.size(a["values"]) >= need
    if need and need[0] == "unit":
        return F.exists(a["values"], lambda v: has(v, *need[1]))
    return _terms(x, need)


def branches(x: Column, a: Mapping[str, Column], topics: Sequence[Mapping], templates: Mapping[str, str]) -> list[dict]:
    """The builder's branches in their order: what it never asks about, verification, ``topics``, then what the record's kind allows.

    A topic is {"when": checks that must all hold, "contract": [(label, check)], "ask": template, "claimed": template for attributed claims, "axes": axes, "own":
    whether the record's own axes come first}.
    """
    claimed = F.coalesce(a["claim"] == "ATTRIBUTED_CLAIM", F.lit(False))
    none, usable = F.coalesce(a["anchor"], F.lit("NONE")) == "NONE", F.coalesce(a["usable"], F.lit(False))
    out = [
        {"if": none & ~usable, "ask": "none", "axes": [], "own": False, "contract": []},
        {"if": usable, "ask": "verify", "axes": ["area", "group", "time"], "own": True, "contract": [("values of the data", F.lit(True))]},
        {"if": F.coalesce(a["lead"], F.lit(False)), "ask": "lead", "axes": ["value", "class", "date"], "own": True, "contract": [("values of the data", F.lit(False))]},
    ]
    for i, t in enumerate(topics):
        holds = F.lit(True)
        for need in t["when"]:
            holds = holds & _check(x, a, need)
        out.append({"if": holds, "ask": f"topic {i}", "claimed": f"topic {i} claimed" if t.get("claimed") else None, "axes": t["axes"], "own": t.get("own", False), "contract": t["contract"]})
    rises, moves = (F.coalesce(a["change"] == c, F.lit(False)) for c in ("POSITIVE", "UNCLASSIFIED_CHANGE"))
    structure = a["anchor"] == "DECOMPOSABLE_STRUCTURE"
    out += [
        {"if": rises, "ask": "rise", "claimed": "rise claimed", "axes": ["area", "group", "period"], "own": True, "contract": [("rise", rises), ("value", "values")]},
        {"if": moves, "ask": "move", "claimed": "move claimed", "axes": ["area", "group", "period"], "own": True, "contract": [("change", moves), ("value", "values")]},
        {"if": claimed, "ask": "claim", "axes": ["area", "group", "time", "other reasons"], "own": True, "contract": [("claim", claimed), ("anchor", ~none)]},
        {"if": structure, "ask": "structure", "axes": ["area", "group", "time"], "own": True, "contract": [("structure", structure), ("value", "values")]},
        {"if": F.lit(True), "ask": "problem", "axes": ["extent", "period", "control"], "own": True, "contract": [("problem", a["anchor"].isin("DIRECT_PROBLEM_SIGNAL", "MEASURED_PROBLEM_SIGNAL"))]},
    ]
    missing = {b[k] for b in out for k in ("ask", "claimed") if b.get(k)} - set(templates)
    if missing:
        raise ValueError(f"no template for {sorted(missing)}")
    return out


def built_question(text: Column, analysis: Mapping[str, Column], topics: Sequence[Mapping], templates: Mapping[str, str]) -> Column:
    """struct(branch, question, axes, contract, issues, grounding, has_basis) of a record from the first branch of ``branches`` that holds.

    ``analysis`` has the columns ANALYSIS, and may have ``numbers``, those of the text. Issues, in this order: a basis without an anchored fact, each requirement of the contract that the record does
    not meet, numbers of the question that the text lacks, and no anchor. Grounding is PASS without any. The record has a basis if it has an anchor or
    can be verified. Null texts are empty, null flags false, null anchors NONE, null arrays empty.

    Many branches read the same text and values: give them as columns of a projection before, not as expressions to be computed for each.
    """
    x = F.coalesce(text, F.lit(""))
    a = dict(analysis)
    a["values"], a["axes"] = (F.coalesce(a[k], F.array().cast("array<string>")) for k in ("values", "axes"))
    rows = branches(x, a, topics, templates)
    chosen = F.lit(len(rows) - 1)
    for i in reversed(range(len(rows) - 1)):
        chosen = F.when(rows[i]["if"], F.lit(i)).otherwise(chosen)
    claimed = F.coalesce(a["claim"] == "ATTRIBUTED_CLAIM", F.lit(False))
    none = F.coalesce(a["anchor"], F.lit("NONE")) == "NONE"
    usable = F.coalesce(a["usable"], F.lit(False))
    known = a["numbers"] if "numbers" in a else txt.numbers_in(x)
    strings = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")

    def made(i: Column) -> Column:
        ask = _picked(i, [F.when(claimed, F.lit(templates[b["claimed"]])).otherwise(F.lit(templates[b["ask"]])) if b.get("claimed") else F.lit(templates[b["ask"]]) for b in rows])
        axes = _picked(i, [F.when(F.size(a["axes"]) > 0, a["axes"]).otherwise(strings(b["axes"])) if b["own"] else strings(b["axes"]) for b in rows])
        unmet = _picked(i, [F.array_compact(F.array(*[F.when(~F.coalesce(_check(x, a, need), F.lit(False)), F.lit(f"unmet: {label}")) for label, need in b["contract"]])).cast("array<string>") if b["contract"] else strings([]) for b in rows])
        numbers = F.array_except(txt.numbers_in(ask), known)
        first = F.when((~none | usable) & ~F.coalesce(a["facts"], F.lit(False)) & ~usable, F.lit("no anchored fact"))
        odd = F.when(F.size(numbers) > 0, F.concat(F.lit("numbers: "), F.array_join(F.array_sort(numbers), ", ")))
        issues = F.array_compact(F.concat(F.array(first), unmet, F.array(odd, F.when(none & ~usable, F.lit(NO_ANCHOR)))))
        return F.struct(
            _picked(i, [F.lit(b["ask"]) for b in rows]).alias("branch"), ask.alias("question"), axes.alias("axes"),
            _picked(i, [strings([label for label, _ in b["contract"]]) for b in rows]).alias("contract"), issues.alias("issues"),
            F.when(F.size(issues) == 0, "PASS").otherwise("HOLD").alias("grounding"), (~none | usable).alias("has_basis"),
        )

    return F.transform(F.array(chosen), made)[0]


def impact_score(finding: Column, weights: Mapping[str, int], only_with: Mapping[str, Sequence[str]] | None = None, bonuses: Sequence[tuple[Sequence[str], int]] = ()) -> Column:
    """Sum of the weights of the terms in a finding; a term of ``only_with`` counts only beside one of its companions; each bonus counts once
    if one of its terms is there. Null findings score 0."""
    out = F.lit(0)
    for term, w in weights.items():
        there = has(finding, term)
        beside = (only_with or {}).get(term)
        out = out + F.when(there & has(finding, *beside) if beside else there, w).otherwise(0)
    for terms, w in bonuses:
        out = out + F.when(has(finding, *terms), w).otherwise(0)
    return out.cast("long")


def finding_lines(text: Column, limit: int, weights: Mapping[str, int], only_with: Mapping[str, Sequence[str]] | None = None, bonuses: Sequence[tuple[Sequence[str], int]] = ()) -> Column:
    """The ``limit`` distinct lines of most impact as array<struct<score, pos, line>>; equal ones in their order. A number in front, and blanks, dashes
    and dots at the ends, are no part of a line; the first of equal lines counts."""
    clean = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda t: F.regexp_replace(F.regexp_replace(t, r"^\s*[0-9]+\s*", ""), r"^[ \-·]+|[ \-·]+$", ""))
    lines = F.array_distinct(F.filter(clean, lambda t: t != ""))
    scored = F.transform(lines, lambda t, i: F.struct((-impact_score(t, weights, only_with, bonuses)).alias("less"), i.cast("long").alias("pos"), t.alias("line")))
    return F.transform(F.slice(F.array_sort(scored), 1, limit), lambda s: F.struct((-s["less"]).alias("score"), s["pos"].alias("pos"), s["line"].alias("line")))


def term_counts(text: Column, domains: Mapping[str, Sequence[str]]) -> Column:
    """map<string,long>: of each domain with a term in the text, how often its terms are there. Null texts have none."""
    x = F.coalesce(text, F.lit(""))
    count = lambda t: F.size(F.split(F.replace(x, F.lit(t), F.lit("\x00")), "\x00")) - 1
    made = F.map_from_arrays(F.array(*map(F.lit, domains)), F.array(*[sum((count(t) for t in terms), F.lit(0)).cast("long") for terms in domains.values()]))
    return F.map_filter(made, lambda k, n: n > 0)


def dominant_domain(counts: Column, text: Column, priority: Sequence[str], first: Sequence[tuple[str, int, Sequence[str]]]) -> Column:
    """The domain that a text is about; null if its ``counts`` has none of ``priority``.

    ``first``: (domain, least count, phrases) rules that win in their order: the domain has so many terms, and one of the phrases, if there are any, is in
    the text. Else the domain with most terms, of several the earlier one of ``priority``.
    """
    n = lambda d: F.coalesce(F.try_element_at(counts, F.lit(d)), F.lit(0).cast("long"))
    best = F.array_max(F.array(*[F.struct(n(d).alias("n"), F.lit(-i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(priority)]))
    out = F.when(best["n"] > 0, best["d"])
    for d, least, phrases in reversed(first):
        out = F.when((n(d) >= least) & (has(text, *phrases) if phrases else F.lit(True)), F.lit(d)).otherwise(out)
    return out
