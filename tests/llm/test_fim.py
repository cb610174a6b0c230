"""Fill-in-middle against a brute-force version and exact round trips."""

import hashlib
import random

from pyspark.sql import functions as F

from signalweave.llm import fim


def expected(key, text):
    x = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(x)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = x[:lo], x[lo:hi], x[hi:]
    if not x or any(s in x for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, x
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    rng = random.Random(3)
    alphabet = "<>PSM ab\n\r\t é😀́\u0000"
    texts = [None, "", " ", "<P>", "a<S>b", "<", "<P", "P>", "<P>" * 3, "x" * 40_000, "x" * 40_000, "😀" * 999]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def test_forms_and_outputs_equal_the_brute_force_version_and_texts_return(spark):
    texts = odd_texts()
    rows = [(None if i == 7 else i // 2, t, i, "f") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N long, form string").repartition(3)
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "N", "form", "_n", "_form", "output", "prefix_chars", "middle_chars"]
    got = {r["N"]: r for r in out.withColumn("back", fim.restored(F.col("output"), F.col("_form"))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["_n"], r["_form"], r["prefix_chars"], r["middle_chars"], r["output"]) == expected(rows[i][0], t)
        assert r["back"] == (t or "")
    assert {r["_form"] for r in got.values()} == {"plain", "psm", "spm"}


def test_word_units_rates_and_the_empty_table(spark):
    df = spark.createDataFrame([(i, f" one  two{i} three\n") for i in range(200)], "doc_id long, text string")
    out = fim.fill_in_middle(df, unit=fim.WORD, rate=100, suffix_first=100).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert all(r["form"] == "spm" and r["n"] == 3 and r["back"] == r["text"] for r in out)
    for r in out:
        assert r["prefix_chars"] in (0, 6, len(r["text"]) - 6, len(r["text"]))
    assert fim.fill_in_middle(df, rate=0).filter("form <> 'plain' or output <> text").count() == 0
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_only_built_in_functions_and_no_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = fim.op13_fill_in_middle(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
