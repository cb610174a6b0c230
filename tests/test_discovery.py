"""Tables in JSON, run plans, names in texts and personal data, against plain loops and single cases."""

import json
import random

from pyspark.sql import functions as F

from signalweave.functions import text as txt
from signalweave.operators import gazetteer, provenance
from signalweave.sources import discovery


def tables_by_loop(value, required, excluded, at="$"):
    if isinstance(value, dict):
        for k, x in value.items():
            yield from tables_by_loop(x, required, excluded, f"{at}.{k}")
    elif isinstance(value, list):
        if value and isinstance(value[0], dict) and set(required) <= value[0].keys() and not set(excluded) & value[0].keys():
            yield at, len(value)
        for i, x in enumerate(value):
            yield from tables_by_loop(x, required, excluded, f"{at}[{i}]")


def test_tables_at_any_depth(spark):
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(4) if depth else 3
        if kind == 0:
            return {k: value(depth - 1) for k in rng.sample("abcdxy", rng.randrange(4))}
        if kind == 1:
            return [{k: value(depth - 1) for k in "xy"[: rng.randrange(1, 3)] + "z"[: rng.randrange(2)]} for _ in range(rng.randrange(4))]
        if kind == 2:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return rng.choice([None, 1, "t", True, 2.5])

    values = [value(5) for _ in range(60)] + [[{"x": None, "y": 1}], [[[[[[{"x": 1, "y": 2}]]]]]]]
    texts = [json.dumps(v) for v in values] + ["{no json", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, j string").repartition(4)
    found = discovery.find_tables(df, "id", "j", ["x", "y"], ["z"])
    want = {(i, at, n) for i, v in enumerate(values) for at, n in tables_by_loop(v, ["x", "y"], ["z"])}
    assert {(r["id"], r["path"], r["n_rows"]) for r in found.select("id", "path", "n_rows").collect()} == want and len(want) > 10
    best = {r["id"]: (r["path"], r["n_rows"]) for r in discovery.largest_tables(found).collect()}
    assert best == {i: min(((at, n) for j, at, n in want if j == i), key=lambda x: (-x[1], x[0])) for i in {w[0] for w in want}}


def test_rows_of_a_found_table_are_typed(spark):
    df = spark.createDataFrame([(1, '{"d": [{"a b": 1, "c": "x"}, {"a b": "no", "c": null}, 5]}')], "id long, j string")
    rows = discovery.table_rows(discovery.find_tables(df, "id", "j", ["a b"]), {"n": ("a b", "long"), "c": ("c", "string")}).orderBy("row").collect()
    assert [(r["row"], r["n"], r["c"]) for r in rows] == [(0, 1, "x"), (1, None, None), (2, None, None)]


def test_run_plans_against_a_loop(spark):
    rng = random.Random(7)
    rows = []
    for p in [*range(12), None]:
        n = rng.randrange(1, 14)
        rows += [(p, f"t{i}", None if rng.random() < 0.2 else [f"t{rng.randrange(max(1, i + rng.randrange(3)))}" for _ in range(rng.randrange(3))]) for i in range(n)]
        rows += [(p, f"t{rng.randrange(n)}", ["zz"])] * rng.randrange(3)
    want = set()
    for p in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == p]
        ids = [r[1] for r in own]
        want |= {(p, i, "REPEATED", str(ids.count(i))) for i in ids if ids.count(i) > 1}
        needs = {}
        for _, i, n in own:
            needs.setdefault(i, set()).update(n or [])
        want |= {(p, i, "UNKNOWN", d) for i, n in needs.items() for d in n if d not in needs}
        left = {i: {d for d in n if d in needs} for i, n in needs.items()}
        while ready := [i for i, d in left.items() if not d]:
            for i in ready:
                del left[i]
            for d in left.values():
                d.difference_update(ready)
        want |= {(p, i, "CYCLE", None) for i in left}
    df = spark.createDataFrame(rows, "plan long, task string, needs array<string>").repartition(4)
    got = provenance.plan_problems(df, "plan", "task", "needs")
    assert {tuple(r) for r in got.collect()} == want and {w[2] for w in want} == {"REPEATED", "UNKNOWN", "CYCLE"}
    assert provenance.plan_problems(df.limit(0), "plan", "task", "needs").count() == 0


def test_longest_names_win_and_long_dictionaries_are_joined(spark, monkeypatch):
    names = ["Nord", "nord SEE", "see", "Nord See Insel Ost", "x y z", "y", "", None, "one two three four five"]
    texts = ["Die Nord-See, nord see insel", "nord see insel ost see", "x y z y", None, "", "one two three four five", "nordsee nord"]
    n = spark.createDataFrame([(x,) for x in names], "name string")
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    want = {(0, "nord see", 1, 3), (0, "nord see", 3, 5), (1, "nord see insel ost", 0, 4), (1, "see", 4, 5), (2, "x y z", 0, 3), (2, "y", 3, 4), (6, "nord", 1, 2)}
    for bound in (gazetteer.BROADCAST_WORDS, 1):
        monkeypatch.setattr(gazetteer, "BROADCAST_WORDS", bound)
        assert {tuple(r) for r in gazetteer.dictionary_matches(d, n, "id", "t", "name").collect()} == want
    quotes = spark.createDataFrame([(0, "see"), (1, "Nord See Insel Ost; see"), (2, None), (6, "NORD city")], "id long, t string")
    got = {r["id"]: (r["places"], r["unsupported"]) for r in gazetteer.unsupported_places(d, quotes, n, "id", "t", "name", {"nord see": "see"}).collect()}
    assert got == {0: (["see"], []), 1: (["nord see insel ost", "see"], []), 2: (["x y z", "y"], ["x y z", "y"]), 6: (["nord"], [])}


def test_seven_kinds_of_personal_data(spark):
    cases = {
        "mail a.b+c@d-e.org now": "mail [EMAIL] now",
        "JSESSIONID = 'aB.9~x_y'": "JSESSIONID=[REDACTED]'",
        "dmcsession:q1 sessionid=zz": "dmcsession=[REDACTED] sessionid=[REDACTED]",
        "900101-1234567, 9001011234567": "[ID], [ID]",
        "12동 345 호에": "[ADDRESS]에",
        "세종대로 110 앞 한강길12-3": "[ADDRESS] 앞 [ADDRESS]",
        "제 이름은 홍길동": "[NAME]",
        "이름: 김철수 / 02-123-4567": "[NAME] / [PHONE]",
        "year 2024, 12 pieces": "year 2024, 12 pieces",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "k string, v string")
    assert {r["k"]: r["got"] for r in df.withColumn("got", txt.redact(F.col("k"), txt.PERSONAL)).collect()} == cases


def test_line_numbers_over_ranges(spark):
    from signalweave.operators import numbering, rules

    rng = random.Random(3)
    keys = list(range(500))
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, "x") for k in keys], "k int, line0 string").repartition(9)
    assert {r["k"]: r["line"] for r in numbering.numbered(df, ["k"], start=2).collect()} == {k: k + 2 for k in keys}
    assert numbering.numbered(df.limit(0), ["k"]).count() == 0
    sheet = [("s", "1", "good", "2024-01-01"), ("s", "1", "bad", "2024-01-01"), ("s", "1", " Good ", "2024-01-01"), ("s", " ", "GOOD", "2024-01-01"), ("s", None, "GOOD", "x"), ("s", "2", None, "2024-01-01"), ("s", "2", "GOOD", "no"), ("s", "2", "GOOD", "2024-01-01"), ("s", "2", "GOOD", "2024-01-02")]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(sheet)], "i int, a string, b string, label string, day string").repartition(4)
    got = {r["line"]: r["problem"] for r in rules.numbered_review_problems(rows, "i", ["a", "b"], ["GOOD"], "label", "day").collect()}
    assert got == {3: "LABEL", 4: "REPEATED", 5: "KEY", 6: "KEY", 7: "LABEL", 8: "DATE", 10: "REPEATED"}


def test_marginals_fall_short_where_a_class_is_missing(spark):
    from signalweave.operators import numbering

    df = spark.createDataFrame([("a", 1, "x", 5), ("a", 2, None, None), ("b", None, "x", 2), (None, 1, "y", 1)], "g string, p int, q string, m long")
    got = {r["g"]: (r["total"], r["p_sum"], r["q_sum"], r["differing"], r["agrees"]) for r in numbering.marginal_sums(df, ["g"], F.col("m"), {"p_sum": F.col("p"), "q_sum": F.col("q")}).collect()}
    assert got == {"a": (5, 5, 5, [], True), "b": (2, 0, 2, ["p_sum"], False), None: (1, 1, 1, [], True)}


def test_many_search_terms_meet_texts_by_grams(spark, monkeypatch):
    from signalweave.operators import joins

    docs = spark.createDataFrame([(1, "The Red Bus"), (2, "a bus stop"), (3, None), (4, "")], "d long, t string")
    terms = spark.createDataFrame([("BUS",), ("red b",), ("bus",), ("",), (None,), ("zzz",)], "term string")
    want = {1: ["bus", "red b"], 2: ["bus"]}
    for most in (joins.MOST_TERMS, 1):
        monkeypatch.setattr(joins, "MOST_TERMS", most)
        assert {r["d"]: r["matched"] for r in joins.term_search(docs, terms, "d", "t", "term").collect()} == want
