"""Cases of the third round's findings."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from signalweave import plans
from signalweave.operators import greedy, setjoin, similarity


def by_sql(name, folder, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return sorted(con.execute(plans.SQL[name]).fetchall())


def test_sentinel_slots_of_null_balances_and_negative_keys(spark, tmp_path):
    rows = [(k, "AB"[k % 2], None if k % 5 == 0 else float(k % 7)) for k in [*range(1, 31), *range(-250_031, -250_000)]]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = plans.QUERIES["sentinel_slot_selection"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select("c_custkey", "slot").collect())) == by_sql("sentinel_slot_selection", tmp_path, "customer")


def test_sentinel_slots_of_keys_in_one_place_of_the_cycle(spark, tmp_path):
    rows = [(k + 100_000 * i, "A", 0.0 if k == 99_000 else 1.0) for i in range(9) for k in (99_000, 5, 6, 7, 8)]
    for n, order in enumerate((rows, rows[::-1])):
        spark.createDataFrame(order, "c_custkey long, c_mktsegment string, c_acctbal double").repartition(5).write.parquet(f"{tmp_path}/{n}/customer.parquet")
        got = plans.QUERIES["sentinel_slot_selection"](spark, f"{tmp_path}/{n}").filter("slot = 'audit'").collect()
        assert sorted(r["c_custkey"] for r in got) == sorted([k + 100_000 * i for i in range(9) for k in (5, 6)] + [7, 100_007])


def alike(x, y, measure):
    s = len(x & y)
    return s / {"overlap": min(len(x), len(y)), "jaccard": len(x | y), "largest": max(len(x), len(y))}[measure]


@pytest.mark.parametrize(("measure", "least"), [("overlap", 0.66), ("overlap", 1.0), ("jaccard", 0.5), ("largest", 0.8)])
def test_blocks_of_sets_against_all_pairs(spark, measure, least):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        base = [f"c{rng.randrange(4)}-{k}" for k in range(rng.choice((3, 20, 60)))]
        rows.append((i, rng.choice(["x", "y", None]), [t for t in base if rng.random() < 0.9] + [f"w{rng.randrange(30)}" for _ in range(rng.randrange(5))] if i % 17 else None))
    df = spark.createDataFrame(rows, "id long, g string, t array<string>").repartition(5)
    sets = [(i, g, set(t)) for i, g, t in rows if t]
    for block in (None, "g"):
        want = {(a, b, len(x & y)) for a, g, x in sets for b, h, y in sets if a < b and (block is None or g == h) and alike(x, y, measure) >= least}
        got = setjoin.set_pairs(df, "id", "t", least, measure, block).collect()
        assert len(got) == len(want) and {(r["a"], r["b"], r["shared"]) for r in got} == want


def test_token_pairs_shuffle_no_row_for_each_shared_token(spark):
    rows = [(i, [f"t{(i * k) % 97}" for k in range(1, 30)]) for i in range(200)]
    pairs = similarity.token_pairs(spark.createDataFrame(rows, "id long, t array<string>").repartition(4), "id", "t", 0.66)
    assert pairs.count() > 0 and "hashpartitioning" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_same_issues_of_each_branch_against_sql(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        head = rng.sample("aa bb cc dd ee".split(), 4)
        body = [f"k{rng.randrange(3)}x{chr(97 + j)}" for j in range(rng.choice((4, 9)))]
        rows.append((i, " ".join(head) + "\n" + " ".join(body), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None])))
    rows += [(200 + i, *rows[i][1:]) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    got = plans.QUERIES["same_issue_pairs"](spark, str(tmp_path)).select("a", "b", "same")
    assert sorted(map(tuple, got.collect())) == by_sql("same_issue_pairs", tmp_path, "documents")
    # No text and no token array of a pair is fetched but headlines of pairs across sources.
    assert "regexp_extract_all" not in got._jdf.queryExecution().executedPlan().toString()


def test_branches_of_near_duplicates_read_no_text_again(spark):
    got = plans.QUERIES["near_duplicate_predicate"](spark, "/root/testdata/sf0.001")
    assert "regexp" not in got._jdf.queryExecution().executedPlan().toString()


def test_title_pairs_fetch_no_titles(spark):
    got = plans.QUERIES["title_match_pairs"](spark, "/root/testdata/sf0.001")
    assert "array_intersect" not in got._jdf.queryExecution().executedPlan().toString()


def test_leaders_write_no_row_for_a_token(spark, monkeypatch):
    rows = [(i, [f"t{(i * k) % 331}" for k in range(1, 80)]) for i in range(120)]
    written, made = [], greedy.checkpointed
    monkeypatch.setattr(greedy, "checkpointed", lambda df: written.append(made(df)) or written[-1])
    got = greedy.leader_clusters(spark.createDataFrame(rows, "id long, t array<string>").withColumn("g", F.lit("g")), "g", "id", [], "t", 0.5)
    assert got.count() == 120 and max(t.count() for t in written) <= 120


@pytest.mark.parametrize("dense", [0, 16])
def test_leaders_of_many_copies_and_near_copies(spark, dense):
    rng = random.Random(4)
    rows = []
    for i in range(330):
        base = [f"b{k}" for k in range(20)]
        t = base if i % 3 == 0 else [x for x in base if rng.random() < 0.9] + [f"o{i}"] if i % 3 == 1 else rng.sample([f"w{k}" for k in range(9)], 5)
        rows.append((i, None if i % 10 == 0 else "g", rng.randrange(40), t))
    want, leaders = {}, []
    for i, g, o, t in sorted(rows, key=lambda r: (r[2], r[0])):
        found = next((j for j, h, u in leaders if g == h and len(u & set(t)) / len(u | set(t)) >= 0.5), None)
        want[i] = i if found is None else found
        if found is None:
            leaders.append((i, g, set(t)))
    df = spark.createDataFrame(rows, "id long, g string, o long, t array<string>").repartition(5)
    got = greedy.leader_clusters(df, "g", "id", [F.col("o")], "t", 0.5, dense=dense).collect()
    assert len(got) == len(rows) and {r["id"]: r["leader"] for r in got} == want


def test_blocks_of_two_tables_meet(spark):
    rng = random.Random(3)
    sets = {i: (rng.choice(["x", None]), sorted(rng.sample(range(60), rng.choice((4, 12, 40))))) for i in range(150)}
    df = spark.createDataFrame([(i, g, h) for i, (g, h) in sets.items()], "id long, g string, h array<long>").repartition(4)
    often = setjoin.frequencies(df)
    got = setjoin.near_blocks(setjoin.packed(df.filter("id % 5 = 0"), often), 0.34, setjoin.packed(df, often)).collect()
    want = {frozenset((a, b)) for a in sets if a % 5 == 0 for b in sets if a != b and sets[a][0] == sets[b][0] and alike(set(sets[a][1]), set(sets[b][1]), "jaccard") >= 0.34}
    assert {frozenset((r["a"], r["b"])) for r in got} == want
    assert all(r["shared"] == len(set(sets[r["a"]][1]) & set(sets[r["b"]][1])) for r in got)
