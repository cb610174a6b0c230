"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al. 2017).

A linear classifier over words and beginnings of words is trained from confirmed toxic texts and unlabelled ones. With class prior p the
risk of unlabelled text, less p times the risk that positives would have as negatives, estimates the risk of the true
negatives; where that estimate falls under zero the step goes the other way, which keeps the classifier from fitting
the unlabelled positives away. Labels of clean documents are used for the prior only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, read_table, stored, text_key, text_or_empty

#: The classifier is fitted on at most so many positive and unlabelled texts, chosen by a hash of the id, and so many features.
MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS = 4000, 12000, 4096
#: A feature is used if it is in so many positive texts and in this share of them, with a lift of this many standard errors.
LEAST_TEXTS, LEAST_SHARE, LEAST_Z = 3, 0.02, 5.0
PREFIXES = (4, 5, 6, 7)

_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(text: str) -> set[str]:
    """Words, and for each beginning of PREFIXES letters whether it begins 1, 2 or 3 distinct words, and 1 or 3 percent of them.

    Beginnings catch inflected and compounded forms; shares keep long texts from having all of them by chance.
    """
    words = words_of(text)
    out = set(words)
    for prefix, n in Counter(f"^{w[:k]}" for w in words for k in PREFIXES if len(w) > k).items():
        out.update(_levels(prefix, n, len(words)))
    return out


def _levels(prefix: str, n: int, of: int) -> list[str]:
    out = [prefix]
    if n >= 2:
        out.append(f"{prefix} 2")
        if n >= 3:
            out.append(f"{prefix} 3")
        if n >= 0.01 * of:
            out.append(f"{prefix} 1%")
        if n >= 0.03 * of:
            out.append(f"{prefix} 3%")
    return out


class Model:
    """Weights by feature, and the bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.beginnings = {f.partition(" ")[0] for f in weights if f[0] == "^"}
        self.known: dict[str, tuple[float, tuple[str, ...]]] = {}

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def margin(self, text: str) -> float:
        words, known, g = words_of(text), self.known, self.bias
        if len(known) > 100_000:
            known.clear()
        begun: Counter[str] = Counter()
        for w in words:
            hit = known.get(w)
            if hit is None:
                hit = known[w] = (self.weights.get(w, 0.0), tuple(p for k in PREFIXES if len(w) > k and (p := f"^{w[:k]}") in self.beginnings))
            g += hit[0]
            for p in hit[1]:
                begun[p] += 1
        for p, n in begun.items():
            g += sum(self.weights.get(f, 0.0) for f in _levels(p, n, len(words)))
        return g

    def score(self, text: str) -> float:
        """1 / (1 + exp(-margin)), by the features that the text has."""
        return float(_sigmoid(np.float64(round(self.margin(text), 9))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class _Rows:
    """Sparse 0/1 rows: column numbers one after the other, and the row of each."""

    def __init__(self, rows: list[list[int]], width: int):
        self.n, self.width = len(rows), width
        self.col = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def grad(self, d: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=d[self.row], minlength=self.width)


def fit_nnpu(positive: list[list[int]], unlabelled: list[list[int]], width: int, prior: float, steps: int = 600, rate: float = 0.1, decay: float = 1e-6, beta: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the sigmoid loss, by Adam on all rows."""
    p, u = _Rows(positive, width), _Rows(unlabelled, width)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        gp, gu = p.dot(theta[:-1]) + theta[-1], u.dot(theta[:-1]) + theta[-1]
        # Loss of a row called positive: sigmoid(-g); called negative: sigmoid(g).
        sp, su = _sigmoid(gp), _sigmoid(gu)
        slope_p, slope_u = sp * (1 - sp) / max(p.n, 1), su * (1 - su) / max(u.n, 1)
        negative = su.mean() - prior * sp.mean()

        def full(rows: _Rows, d: np.ndarray) -> np.ndarray:
            return np.append(rows.grad(d), d.sum())

        of_negative = full(u, slope_u) - prior * full(p, slope_p)
        if negative >= -beta:
            g = -prior * full(p, slope_p) + of_negative
        else:
            g = -of_negative
        g[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("positive", pa.int32()), ("unlabelled", pa.int32()), ("key", pa.string()), ("words", pa.list_(pa.string()))])
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            words = [sorted(features_of(t)) for t in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(words, pa.list_(pa.string()))], schema=schema)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_words: int = MAX_WORDS) -> Model:
    """Fits the classifier on labels of rows that are not held out.

    Both samples are the rows with the least hashes of their ids, so they are bounded and reruns agree; equal texts count
    once. Only the chosen features and, for the sampled texts, the numbers of those reach the driver. Without positive
    labels the model has a bias alone.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = marks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    prior = min(max(counts["p"] / max(counts["n"], 1), 1e-3), 0.5)
    order = F.xxhash64("doc_id", F.lit(17))
    chosen = marks.filter("toxic = 1").select("doc_id").orderBy(order, "doc_id").limit(max_positive).withColumn("positive", F.lit(1))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    others = ids.orderBy(order, "doc_id").limit(max_unlabelled).distinct().withColumn("unlabelled", F.lit(1))
    sample = chosen.join(others, "doc_id", "full").select("doc_id", F.coalesce("positive", F.lit(0)).alias("positive"), F.coalesce("unlabelled", F.lit(0)).alias("unlabelled"))
    # At most max_positive + max_unlabelled ids: a bounded broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).join(F.broadcast(sample), "doc_id")
    rows = rows.select("positive", "unlabelled", text_key(F.col("text")).alias("key"), "text").mapInArrow(lean(_tokenise), "positive int, unlabelled int, key string, words array<string>")
    texts = stored(rows.groupBy("key").agg(F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"), F.first("words").alias("words")), "sample", rows=max_positive + max_unlabelled, each=1000)
    n = texts.agg(F.coalesce(F.sum("positive"), F.lit(0)).alias("p"), F.coalesce(F.sum("unlabelled"), F.lit(0)).alias("u")).first()
    if not n["p"] or not n["u"]:
        return Model({}, float(np.log(prior / (1 - prior))))
    per = texts.select("positive", "unlabelled", F.explode("words").alias("word")).groupBy("word").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
    share = (F.col("p") + F.col("u")) / float(n["p"] + n["u"])
    z = (F.col("p") / float(n["p"]) - F.col("u") / float(n["u"])) / F.sqrt(share * (1.0 / n["p"] + 1.0 / n["u"]))
    per = per.withColumn("z", z).filter(F.col("p") >= max(LEAST_TEXTS, LEAST_SHARE * n["p"])).filter(F.col("z") >= LEAST_Z)
    vocabulary = [r["word"] for r in per.orderBy(F.desc("z"), "word").limit(max_words).collect()]
    number = {w: i for i, w in enumerate(vocabulary)}

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[number[w] for w in ws if w in number] for ws in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["positive", "unlabelled", "words"])

    got = texts.orderBy("key").select("positive", "unlabelled", "words").mapInArrow(numbered, "positive int, unlabelled int, words array<int>").collect()
    w, b = fit_nnpu([r["words"] for r in got if r["positive"]], [r["words"] for r in got if r["unlabelled"]], len(vocabulary), prior)
    return Model({x: float(v) for x, v in zip(vocabulary, w, strict=True) if abs(v) > 1e-6}, b)


def _scored(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[float] = []
            for lo in range(0, batch.num_rows, 256):
                scores += [model.score(t) for t in batch.column(2).slice(lo, 256).to_pylist()]
            s = np.array(scores, np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema=schema)

    return run


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores under 0.5, with all their columns; fitted on ``labels`` of rows not held out.

    Null texts count as empty; repeated rows and null ids are judged like others. An empty table, or one without positive
    labels, loses nothing.
    """
    model = train(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo in range(0, batch.num_rows, 256):
                clean = [model.score(t or "") < 0.5 for t in texts.slice(lo, 256).to_pylist()]
                yield batch.slice(lo, 256).filter(pa.array(clean))

    return docs.mapInArrow(lean(run), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null texts count as empty; an empty text has the score of the bias. Null ids are scored but never trained on. Equal texts
    have equal scores. Only doc_id and text of ``docs`` are read.
    """
    model = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lean(_scored(model)), "doc_id long, held_out boolean, score double, predicted int")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
