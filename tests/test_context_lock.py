"""The context lock against a loop over chunks."""

import random

from pyspark.sql import functions as F

from signalweave.operators import context

RULES = [("r1", ["aa"], ["bb", "cc"]), ("r2", ["dd"], ["aa"]), ("r3", ["ee", "ff"], ["ee"])]
SCOPE, GROUPS = ["ss", "tt"], ["g1", "g2"]


def lock(chunks, i, back, near, reach, last):
    """``chunks``: (name or None, cut, text); texts of chunks that name a speaker say nothing."""
    said = lambda j: chunks[j][2] if chunks[j][0] is None and chunks[j][2] else None
    speaker = next((chunks[j][0] for j in range(i, max(-1, i - back - 1), -1) if chunks[j][0]), None)
    begins = lambda j: chunks[j][0] is not None or chunks[j][1]
    start = i
    while start > 0 and not begins(start):
        start -= 1
    stop = i
    while stop + 1 < len(chunks) and not begins(stop + 1):
        stop += 1
    low = max(start, i - (back if speaker else near))
    segment = [said(j) for j in range(low, i + 1) if said(j)]
    local = [said(j) for j in range(max(start, i - reach), min(stop, i + reach) + 1) if said(j)]
    inside = lambda terms, texts: any(t in x for t in terms for x in texts)
    rule = next((r for r in RULES if inside(r[1], local) and inside(r[2], segment + local)), None)
    missing, subject = ([] if speaker else ["speaker"]), None
    affected = [g for g in GROUPS if inside([g], segment + local)]
    if rule:
        name, subject = rule[0], rule[0]
    else:
        subject = next((x[:9].rstrip() for x in reversed(segment) if "j" in x), None)
        gaps = [*([] if subject else ["subject"]), *([] if inside(SCOPE, segment + local) else ["scope"]), *([] if affected else ["affected"])]
        missing += gaps
        name = "UNRESOLVED" if gaps else "GENERIC"
    state = "HOLD" if missing else "LOCKED_LOCAL" if rule and inside(rule[2], local) else "LOCKED_SEGMENT"
    shown = [x for x in segment if x != said(i) and (not rule or inside([*rule[1], *rule[2]], [x]))][-last:]
    return speaker, name, state, subject, affected, missing, shown


def test_lock_equals_the_loop(spark):
    rng = random.Random(1)
    rows, want = [], {}
    words = ["aa", "bb", "cc", "dd", "ee", "ff", "ss", "tt", "g1", "g2", "j", "x", "y  z"]
    for k in range(40):
        chunks = []
        for _ in range(rng.randrange(1, 25)):
            name = rng.choice(["N", "M"]) if rng.random() < 0.12 else None
            text = rng.choice([None, ""]) if rng.random() < 0.1 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 3)))
            chunks.append((name, rng.random() < 0.1, None if text is None else " ".join(text.split())))
            rows.append((k if k else None, len(chunks) - 1, name, chunks[-1][1], text))
        for i, c in enumerate(chunks):
            if c[0] is None:
                want[(k if k else None, i)] = lock(chunks, i, 6, 2, 2, 3)
    df = spark.createDataFrame(rows, "k long, p int, name string, cut boolean, t string").repartition(5)
    got = context.context_lock(df, ["k"], "p", "t", F.col("name"), F.col("cut"), F.lit(True), RULES, SCOPE, GROUPS, "j", back=6, near=2, last=3, most=9).collect()
    assert {(r["k"], r["p"]): (r["speaker"], r["rule"], r["state"], r["subject"], r["affected"], r["missing"], r["context"]) for r in got} == want
    assert {v[2] for v in want.values()} == {"LOCKED_LOCAL", "LOCKED_SEGMENT", "HOLD"} and {v[1] for v in want.values()} == {"r1", "r2", "r3", "GENERIC", "UNRESOLVED"}


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0, "N", ""), (1, 1, None, "j ss g1")], "k long, p int, name string, t string")
    run = lambda d: context.context_lock(d, ["k"], "p", "t", F.col("name"), F.lit(False), F.lit(True), [], SCOPE, GROUPS, "j").collect()
    (r,) = run(df)
    assert (r["rule"], r["state"], r["speaker"], r["context"]) == ("GENERIC", "LOCKED_SEGMENT", "N", []) and run(df.limit(0)) == []
