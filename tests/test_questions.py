"""Questions, findings and domains: what SQL on the tables does not reach."""

import pytest
from pyspark.sql import functions as F

from signalweave.operators import questions as q
from signalweave.plans.questions import _TEMPLATES, _topics

SCHEMA = "i int, t string, anchor string, usable boolean, lead boolean, v array<string>, facts boolean, change string, claim string, axes array<string>"


def run(spark, rows, topics, templates=_TEMPLATES):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    a = {k: F.col(c) for k, c in zip(q.ANALYSIS, ["anchor", "usable", "lead", "v", "facts", "change", "claim", "axes"])}
    return [r["q"] for r in df.select("i", q.built_question(F.col("t"), a, topics, templates).alias("q")).orderBy("i").collect()]


def test_first_branch_issues_and_nulls(spark):
    topics = [
        {"when": [[["bus"]], ("unit", ["h"])], "contract": [("bus", [["bus"]]), ("hours", ("unit", ["h"])), ("two", 2)], "ask": "topic 0", "axes": ["x"]},
        {"when": [[["bus"]]], "contract": [("fare", [["fare", "price"]])], "ask": "topic 1", "claimed": "topic 1 claimed", "axes": ["y"], "own": True},
    ]
    templates = _TEMPLATES | {"topic 0": "Why 20 hours?", "topic 1": "Who pays?", "topic 1 claimed": "Is it so?"}
    d = "DIRECT_PROBLEM_SIGNAL"
    got = run(
        spark,
        [
            (None, None, None, None, None, None, None, None, None),
            ("bus", d, True, True, ["3 h"], True, "POSITIVE", "ATTRIBUTED_CLAIM", ["own"]),
            ("bus", d, False, True, [], True, None, None, []),
            ("the  bus 20", d, False, False, ["3 h"], False, None, None, ["own"]),
            ("bus fare", d, False, False, ["3"], True, None, "ATTRIBUTED_CLAIM", ["own"]),
            ("x", d, None, None, None, True, "POSITIVE", None, None),
            ("x", "DECOMPOSABLE_STRUCTURE", None, None, ["1"], True, None, None, None),
            ("x", "OTHER", None, None, None, True, None, None, None),
        ],
        topics,
        templates,
    )
    assert [(r["branch"], r["grounding"], r["has_basis"]) for r in got] == [
        ("none", "HOLD", False), ("verify", "PASS", True), ("lead", "HOLD", True), ("topic 0", "HOLD", True), ("topic 1", "PASS", True), ("rise", "HOLD", True), ("structure", "PASS", True), ("problem", "HOLD", True),
    ]
    assert got[0]["issues"] == ["no anchor"] and got[1]["axes"] == ["own"] and got[2]["issues"] == ["unmet: values of the data"]
    assert got[3]["issues"] == ["no anchored fact", "unmet: two"] and got[3]["axes"] == ["x"]
    assert (got[4]["question"], got[4]["axes"], got[4]["contract"]) == ("Is it so?", ["own"], ["fare"]) and got[5]["issues"] == ["unmet: value"]
    # A number of the question that the text does not have.
    assert run(spark, [("bus", d, False, False, ["3 h", "4"], True, None, None, None)], topics, templates)[0]["issues"] == ["numbers: 20"]


def test_twenty_one_branches_each_with_a_template(spark):
    a = {k: F.lit(None).cast("string") for k in q.ANALYSIS} | {"values": F.array().cast("array<string>")}
    assert len(q.branches(F.lit("x"), a, _topics(), _TEMPLATES)) == 21
    with pytest.raises(ValueError, match="topic 3"):
        q.branches(F.lit("x"), a, _topics(), {k: v for k, v in _TEMPLATES.items() if k != "topic 3"})


def test_findings_and_domains(spark):
    text = "1  loss at home\n- minor \nloss at home\nchild out\nout\n\n12\nwarned, unfit"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    found = [[tuple(x) for x in r[0]] for r in df.select(q.finding_lines(F.col("t"), 3, {"loss": 4, "out": 5}, {"out": ["child"]}, [(["warned"], 8), (["unfit", "loss"], 1)])).collect()]
    assert found == [[(9, 4, "warned, unfit"), (5, 0, "loss at home"), (5, 2, "child out")], [], []]
    rows = [("a a b", "CONTRACT"), ("c duty", "RIGHTS"), ("c a a a", "SPACE"), ("b", "CONTRACT"), ("", None), (None, None)]
    d = spark.createDataFrame(rows, "t string, want string")
    n = q.term_counts(F.col("t"), {"RIGHTS": ["c"], "CONTRACT": ["b"], "SPACE": ["a"]})
    out = d.select("want", q.dominant_domain(n, F.col("t"), ["CONTRACT", "SPACE"], [("RIGHTS", 1, ["duty"]), ("CONTRACT", 1, [])]).alias("got"), n.alias("n")).collect()
    assert [r["got"] for r in out] == [r["want"] for r in out] and out[0]["n"] == {"CONTRACT": 1, "SPACE": 2} and out[5]["n"] == {}
