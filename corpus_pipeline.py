"""A corpus pipeline of five stages; each works on the rows that the one before has kept.

Counted as part of the subpackage ``signalweave.llm`` and removed with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm import mixing, ngram_join, secrets, spm, toxicity
from signalweave.llm.common import fresh, read_table, stored, text_or_empty


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not call toxic.

    Null texts count as empty. Each row is judged by itself, so repeated rows stay or go together. Without positive labels,
    and in an empty table, nothing goes. All columns stay, whatever their names.
    """
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five-word shingles, similarity of 0.8 or more.

    The one with the least id stays; of rows that repeat id and text, the least by all columns. Null texts count as empty
    and are copies of each other; null ids give way to others. An empty table stays empty. All columns stay, whatever their names.
    """
    return ngram_join.keep_one(docs, ngram_join.jaccard_links(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; found secrets are replaced in the text, and ``n_chars`` follows where there is such a column.

    Rows without secrets are as they were: null and empty texts, null counts and repeated rows too. All columns stay,
    whatever their names.
    """
    base, found = (fresh(docs.columns, n) for n in ("secret_base", "secret_spans"))
    marked = secrets.scan(docs, names=(base, found))
    hit = F.size(found) > 0
    masked = marked.withColumn("text", F.when(hit, secrets.redacted(text_or_empty("text"), F.col(found))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.drop(base, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null sources are one source, the last. Documents without words, null texts too, stay. An empty table stays empty. Equal
    rows are interchangeable. All columns stay, whatever their names.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left, a row for each row; null texts count as empty."""
    return spm.sp_encode(docs, keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("mixing_sources", mix_sources),
    ("sentencepiece", encode),
]

#: No stage of a trained model, a randomised join and a tokenizer can be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
