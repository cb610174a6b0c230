"""Cases of the fourth round's findings."""

import random
import re

import duckdb

from signalweave import plans


def test_token_pairs_of_copies_and_of_other_texts_with_equal_tokens(spark, tmp_path):
    rng = random.Random(6)
    words = [f"{'abcdefgh'[i]}word{'xyzuvwst'[i]}" for i in range(8)]
    texts = [" ".join(rng.sample(words, rng.randrange(1, 6))) for _ in range(60)]
    texts += [*texts[:20], *texts[:5], *[" ".join(t.split()[::-1]).upper() + "!" for t in texts[:15]], "", "a 1", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    sets = [set(re.findall("[a-zà-ɏ]{5,}", (t or "").lower())) for t in texts]
    want = set()
    for b, y in enumerate(sets):
        for a, x in enumerate(sets[:b]):
            n = len(x & y)
            if x and y and n / min(len(x), len(y)) >= 0.66:
                want.add((a, b, n, n / len(x | y), n / min(len(x), len(y))))
    got = plans.QUERIES["jaccard_token_pairs"](spark, str(tmp_path)).select("a", "b", "shared", "jaccard", "overlap").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert set(con.execute(plans.SQL["jaccard_token_pairs"]).fetchall()) == want
