"""Token alignment against a brute-force version that knows neither segments nor union-find."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from signalweave.llm import token_align as ta

SPACES = [" ", "\n", "\t", " ", " ", "\x1c", "\r\n", "　"]


def texts():
    rng = random.Random(11)
    out = [None, "", " ", "   ", "one", " one two", "two  spaces  here ", "a\n b \nc", "▁", "a▁b", "c▁ d", "<|endoftext|> x", "</s><s> <0x41>", "don't 'tis it's", "über 😀😀 ñandú é", "x" * 5000, "\ttab\t tab", "a\u0000b"]
    words = "the of and ation über año 12345 ... don't 日本語 😀 <s> x_y (z) [q], naïve".split()
    for _ in range(250):
        out.append("".join(rng.choice(words) + rng.choice(SPACES) * rng.choice([0, 1, 1, 1, 1, 2, 3]) for _ in range(rng.randrange(1, 30))))
    return out


def brute(rows):
    """By row: counts, groups text, list of linked id pairs."""
    a = Tokenizer.from_file(ta.MODEL_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.MODEL_B)
    raw_a, raw_b = ta.bytes_of_a(open(ta.MODEL_A, "rb").read()), ta.bytes_of_b(open(ta.MODEL_B, "rb").read())
    for text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(raw_a[i] or b"" for i in ids_a) != want or b"".join(raw_b[i] or b"" for i in ids_b) != want:
            yield 0, 0, 0, "", []
            continue
        ends_a, ends_b = np.cumsum([len(raw_a[i]) for i in ids_a]).tolist(), np.cumsum([len(raw_b[i]) for i in ids_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for c in cuts:
            inside = lambda ids, ends: ",".join(str(i) for i, e in zip(ids, ends) if low < e <= c)  # noqa: B023, E731
            groups.append(inside(ids_a, ends_a) + "|" + inside(ids_b, ends_b))
            low = c
        pairs = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f]
        yield len(ids_a), len(ids_b), len(groups), ";".join(groups), pairs


def test_components_are_the_minimal_groups():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randrange(1, 25)
        a, b = (sorted({n, *(rng.randrange(1, n + 1) for _ in range(rng.randrange(9)))}) for _ in range(2))
        a, b = np.array(a), np.array(b)
        ga, gb = ta.groups_of(a, b)
        cuts = np.array(sorted(set(a.tolist()) & set(b.tolist())))
        assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()
        i, j = ta.links_of(a, b, ga, gb)
        assert a[i].tolist() == b[j].tolist() == cuts.tolist()


def test_union_find_against_a_search():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 400):
        u, v = rng.integers(0, n, (2, n // 2))
        label = np.arange(n)
        for _ in range(n):
            for x, y in zip(u, v):
                label[label == max(label[x], label[y])] = min(label[x], label[y])
        assert ta.components(n, u, v).tolist() == label.tolist()


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(i // 2 if i != 9 else None, t, "x", t) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string, pairs string, groups string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in ta.op11_token_alignment(spark, str(tmp_path)).collect())
    known = list(brute([r[1] for r in rows]))
    count = Counter(p for *_, pairs in known for p in pairs)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    want = Counter(
        (r[0], a, b, g, len(pairs), sum(count[p] == top[p[1]] for p in pairs), sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if a else "")
        for r, (a, b, g, text, pairs) in zip(rows, known)
    )
    assert got == want
    zero = {r[1] for r, k in zip(rows, known) if not k[0]}
    assert {None, "", "▁", "a▁b"} <= zero and "<|endoftext|> x" not in zero


def test_segments_align_like_whole_texts_and_pairs_are_bounded():
    raw_a, raw_b = open(ta.MODEL_A, "rb").read(), open(ta.MODEL_B, "rb").read()
    aligner = ta.Aligner(raw_a, raw_b)
    some = [t or "" for t in texts()]
    assert aligner.by_segment
    got, whole = aligner.column(pa.array(some)), aligner.align([t or "\u2581" for t in some])
    for x in ("n_a", "n_b", "n_groups", "pairs", "ends"):
        assert getattr(got, x).tolist() == getattr(whole, x).tolist(), x
    assert got.shown.to_pylist() == whole.shown.to_pylist()
    pairs = ta.possible_pairs(ta.bytes_of_a(raw_a), ta.bytes_of_b(raw_b))
    assert got.pairs.max() < len(pairs) and np.array_equal(pairs, aligner.pairs)
    assert len(pairs) <= sum(len(x or b"") for t in (ta.bytes_of_a(raw_a), ta.bytes_of_b(raw_b)) for x in t)


def test_an_empty_table_and_shown_groups(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    assert ta.rank_links(ta.align_tokens(df.limit(0))).count() == 0
    r = ta.align_tokens(df, keep_groups=True).first()
    assert r["n_groups"] == 2 and hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"]
