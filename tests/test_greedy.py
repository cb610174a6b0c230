"""Greedy selection and leader clustering against the plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from signalweave.operators import greedy, similarity

FIELDS = ["key", "tokens", "markers", "families", "page", "values", "subject", "day"]
SCHEMA = "id long, lane string, score long, kind string, key string, tokens array<string>, markers array<string>, families array<string>, page string, values array<int>, subject string, day string"


def near(a, b):
    common = lambda k: set(a[k] or ()) & set(b[k] or ())
    same = lambda k: a[k] is not None and a[k] == b[k]
    if a["subject"] and same("subject") and (same("page") or same("day")):
        return True
    if a["key"] and b["key"] and (a["key"] in b["key"] or b["key"] in a["key"]):
        return True
    if len(common("markers")) >= 2 or (common("families") and (same("page") or common("values"))):
        return True
    return bool(a["tokens"] and b["tokens"]) and len(common("tokens")) / min(len(set(a["tokens"])), len(set(b["tokens"]))) >= 0.66


def table(spark, seed, n=260):
    rng = random.Random(seed)
    pick = lambda xs, p: [x for x in xs if rng.random() < p]
    rows = []
    for i in range(n):
        hot = rng.random() < 0.35
        # A third of the rows are copies of one text, with the best scores.
        key = "hotcopy" if hot else rng.choice(["", None, "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))])
        tokens = ["x", "y", "z"] if hot else pick("abcdefghijklm", 0.3)
        rows.append((i, rng.choice("ABCD") if i else None, 90 if hot else rng.randrange(60), rng.choice(["p", "h"]), key, tokens, pick("mno", 0.15), pick("fg", 0.15), rng.choice(["q", "r", "s", None]), pick([1, 2, 3], 0.2), rng.choice(["", None, "s1", "s2"]), rng.choice(["d1", "d2", "d3", "d4", None])))
    return spark.createDataFrame(rows, SCHEMA).repartition(7), [dict(zip([x.split()[0] for x in SCHEMA.split(", ")], r)) for r in rows]


def loop(rows, order, cap):
    out = set()
    for lane in {r["lane"] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r["lane"] == lane), key=order):
            if sum(k["kind"] == r["kind"] for k in kept) < cap(r) and not any(near(r, k) for k in kept):
                kept.append(r)
        out |= {(lane, r["id"], i) for i, r in enumerate(kept, 1)}
    return out


@pytest.mark.parametrize("ahead", [1, 3, 500])
def test_lanes_equal_the_loop(spark, ahead):
    df, rows = table(spark, ahead)
    fields = {k: F.col(k) for k in FIELDS}
    caps = {"p": 3, "h": 5}
    got = greedy.greedy_lanes(df, "lane", "id", [-F.col("score")], F.when(F.col("kind") == "p", 3).otherwise(5), fields, greedy.near_clash(fields), kind=F.col("kind"), ahead=ahead)
    assert {(r["lane"], r["id"], r["position"]) for r in got.collect()} == loop(rows, lambda r: (-r["score"], r["id"]), lambda r: caps[r["kind"]])


def test_many_lanes_are_joined_and_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(greedy, "KEPT_BYTES", 0)
    df, rows = table(spark, 8)
    rows = [r | {"kind": ""} for r in rows]
    fields = {k: F.col(k) for k in FIELDS}
    got = greedy.greedy_top(df, "lane", "id", "score", fields, 6).collect()
    assert {(r["lane"], r["id"], r["position"]) for r in got} == loop(rows, lambda r: (-r["score"], r["id"]), lambda r: 6)


def test_page_quotas_pass_first_and_the_empty_table(spark):
    df, rows = table(spark, 21)
    fields = {k: F.col(k) for k in FIELDS}
    df = df.withColumn("ok", F.when(F.col("kind") == "p", True))
    got = greedy.page_quotas(df, "lane", "id", "ok", "score", fields).collect()
    want = loop(rows, lambda r: (r["kind"] != "p", -r["score"], r["id"]), lambda r: 3 if r["kind"] == "p" else 6)
    assert {(r["lane"], r["id"]) for r in got} == {w[:2] for w in want} and {r["id"]: r["passed"] for r in got} == {r["id"]: rows[r["id"]]["kind"] == "p" for r in got}
    assert greedy.greedy_top(df.limit(0), "lane", "id", "score", fields, 3).count() == 0


def test_a_stretch_is_cut_before_the_shuffle(spark):
    df, _ = table(spark, 2)
    rows = df.withColumns({"__lane": F.col("lane"), "__at": F.struct((-F.col("score")).alias("o0"), "id")})
    plan = rows.withColumn("n", F.row_number().over(greedy.W.partitionBy("__lane").orderBy("__at"))).filter("n <= 32")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def leaders_by_loop(rows, least):
    out, leaders = {}, {}
    for g, i, o, t in sorted(rows, key=lambda r: (r[2], r[1])):
        s = set(t or ())
        found = next((j for j, u in leaders.get(g, []) if s and len(s & u) / len(s | u) >= least), None)
        out[i] = i if found is None else found
        if found is None:
            leaders.setdefault(g, []).append((i, s))
    return out


@pytest.mark.parametrize(("seed", "least", "dense"), [(1, 0.5, 16), (2, 0.5, 0), (3, 0.34, 0), (4, 0.8, 0), (5, 0.34, 16)])
def test_leaders_equal_the_loop(spark, seed, least, dense):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        kind = rng.randrange(5)
        base = [f"c{rng.randrange(8)}-{k}" for k in range(9)] if kind == 0 else list("abcdefgh") if kind == 1 else []
        t = [x for x in base if rng.random() < 0.85] + [f"w{rng.randrange(25)}" for _ in range(rng.randrange(4))]
        rows.append((rng.choice("GH") if i % 9 else None, i, rng.randrange(50), None if i == 7 else t))
    df = spark.createDataFrame(rows, "g string, id long, o long, t array<string>").repartition(6)
    got = {r["id"]: r["leader"] for r in greedy.leader_clusters(df, "g", "id", [F.col("o")], "t", least, dense=dense).collect()}
    assert got == leaders_by_loop(rows, least)


def test_a_large_group_of_near_copies_stays_linear(spark):
    n = 1500
    rows = [("g", i, [f"t{k}" for k in range(30)] + [f"own{i}", f"o{i}"]) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id long, t array<string>").repartition(6)
    seen = []
    made = greedy._verified

    def counted(pairs, nodes, least):
        seen.append(pairs.count())
        return made(pairs, nodes, least)

    greedy._verified = counted
    try:
        got = {r["id"]: r["leader"] for r in greedy.leader_clusters(df, "g", "id", [], "t", 0.5).collect()}
    finally:
        greedy._verified = made
    assert set(got.values()) == {0} and sum(seen) <= 4 * n


def test_predicate_without_some_fields(spark):
    a, b = ({"key": F.lit(x), "subject": F.lit(s), "day": F.lit(d)} for x, s, d in (("abc", "s", "1"), ("zzz", "s", "1")))
    r = spark.range(1).select(similarity.near_duplicate_pair(a, b).alias("x"), similarity.near_duplicate_pair({"key": a["key"]}, {"key": b["key"]}).alias("y")).first()
    assert r["x"] is True and r["y"] is False


def test_best_token_matches_against_all_pairs(spark):
    rng = random.Random(6)
    from signalweave.operators import joins

    common = ["aaaaaaa", "bbbbbb", "cccccccc"]
    word = lambda n: "w" * rng.randrange(2, 8) + str(rng.randrange(n))
    make = lambda n, m: [(i, [w for w in common if rng.random() < 0.6] + [word(40) for _ in range(rng.randrange(m))] if i % 11 else None) for i in range(n)]
    left, right = make(60, 6), make(300, 12)
    df = lambda rows, i: spark.createDataFrame(rows, f"{i} long, t array<string>").repartition(4)
    for k, least_shared, least_score in ((2, 2, 5), (1, 1, 1), (5, 3, 12)):
        want = set()
        for i, t in left:
            scored = []
            for j, u in right:
                both = set(t or ()) & set(u or ())
                s = sum(min(len(w) + 1, 8) for w in both)
                if len(both) >= least_shared and s >= least_score:
                    scored.append((-s, j, len(both)))
            want |= {(i, j, n, -s, r) for r, (s, j, n) in enumerate(sorted(scored)[:k], 1)}
        got = joins.token_matches(df(left, "l"), df(right, "r"), "l", "r", "t", least_shared, least_score, k)
        assert {tuple(r) for r in got.select("l", "r", "shared", "score", "rank").collect()} == want


@pytest.mark.parametrize("least", [0.3, 0.66, 1.0])
def test_token_links_against_all_pairs_and_copies_stay_linear(spark, least):
    rng = random.Random(9)
    rows = [(i, ["p", "q", "r"]) for i in range(400)] + [(i, rng.sample("abcdefghijklmnopqrst", rng.randrange(0, 14)) if i % 7 else None) for i in range(400, 560)]
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(5)
    got = similarity.token_links(df, "id", "t", least).collect()
    sets, first = {}, {}
    for i, t in rows:
        if t:
            sets[i] = frozenset(t)
            first.setdefault(sets[i], i)
    same = {(first[s], i) for i, s in sets.items() if first[s] != i}
    reps = sorted(first.values())
    pairs = {(a, b) for n, a in enumerate(reps) for b in reps[n + 1 :] if len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])) >= least}
    assert {(r["a"], r["b"]) for r in got if r["same"]} == same and {(r["a"], r["b"]) for r in got if not r["same"]} == pairs
