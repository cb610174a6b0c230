"""Fill-in-middle transformation with built-in functions only.

A text is an array of units (``regexp_extract_all``). Two cuts from the SHA-256 of seed and id split it into prefix, middle and suffix,
which ``slice`` and ``array_join`` put together again, middle last, each part after its sentinel. Sentinels of an arranged text are
unique, because texts that hold one stay plain, so an arranged text is taken apart at them and restored exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, read_table, text_or_empty

#: A unit is a code point; any pattern that matches every text without gaps serves as well, words with their spaces for example.
CODE_POINT = r"(?s)."
WORD = r"(?s)\s*\S+\s*|\s+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, so many are rearranged; of 100 rearranged ones, so many have the suffix first.
RATE, SUFFIX_FIRST = 90, 20


def draw(seed: int, key: Column, k: int) -> Column:
    """The ``k``-th (from 0) unsigned 32-bit number of the SHA-256 of ``seed:key``. A null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def between(text: Column, after: str, before: str | None = None) -> Column:
    """The part of ``text`` behind ``after`` and up to ``before`` (or the end); both occur once."""
    tail = F.substring_index(text, after, -1)
    return F.substring_index(tail, before, 1) if before else tail


def restored(output: Column, form: Column) -> Column:
    """The text from which ``arranged`` made ``output``, read back from it and its form."""
    psm = F.concat(between(output, PREFIX, SUFFIX), between(output, MIDDLE), between(output, SUFFIX, MIDDLE))
    spm = F.concat(between(output, PREFIX, MIDDLE), between(output, MIDDLE), between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = CODE_POINT, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """All columns of ``docs`` and n, form, output, prefix_chars, middle_chars (clashing names get underscores put before them).

    ``n`` counts units. The prefix ends after the smaller and the middle after the larger of two draws from 0 to n. ``form`` is plain
    for empty texts, for texts that hold a sentinel and for those that the rate leaves out, else psm (prefix, suffix, middle) or spm
    (suffix, prefix, middle). Null texts count as empty, null ids as an empty key. Equal rows have equal results, an empty table
    stays empty, and there is no shuffle: each row is handled where it is read.
    """
    text, key = text_or_empty(text_col), F.col(id_col)
    c = {n: fresh(docs.columns, n) for n in ("n", "form", "output", "prefix_chars", "middle_chars", "fim_units", "fim_low", "fim_high", "fim_pre", "fim_mid", "fim_suf")}
    holds = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | holds | (draw(seed, key, 2) % 100 >= rate), "plain").when(draw(seed, key, 3) % 100 < suffix_first, "spm").otherwise("psm")
    units, n, low, high = (F.col(c[k]) for k in ("fim_units", "n", "fim_low", "fim_high"))
    a, b = draw(seed, key, 0) % (n + 1), draw(seed, key, 1) % (n + 1)
    part = lambda start, length: F.array_join(F.slice(units, start.cast("int"), length.cast("int")), "")
    cut = (
        docs.withColumn(c["form"], form)
        .withColumn(c["fim_units"], F.regexp_extract_all(text, F.lit(unit), F.lit(0)))
        .withColumn(c["n"], F.size(units).cast("long"))
        .withColumns({c["fim_low"]: F.least(a, b), c["fim_high"]: F.greatest(a, b)})
        .withColumns({c["fim_pre"]: part(F.lit(1), low), c["fim_mid"]: part(low + 1, high - low), c["fim_suf"]: part(high + 1, n - high)})
    )
    pre, mid, suf, is_plain = F.col(c["fim_pre"]), F.col(c["fim_mid"]), F.col(c["fim_suf"]), F.col(c["form"]) == "plain"
    psm = F.concat(F.lit(PREFIX), pre, F.lit(SUFFIX), suf, F.lit(MIDDLE), mid)
    spm = F.concat(F.lit(SUFFIX), suf, F.lit(PREFIX), pre, F.lit(MIDDLE), mid)
    out = cut.withColumns(
        {
            c["output"]: F.when(is_plain, text).when(F.col(c["form"]) == "spm", spm).otherwise(psm),
            c["prefix_chars"]: F.when(~is_plain, F.length(pre).cast("long")),
            c["middle_chars"]: F.when(~is_plain, F.length(mid).cast("long")),
        }
    )
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], *[c[k] for k in ("n", "form", "output", "prefix_chars", "middle_chars")])


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the digests of the output and of the text restored from it."""
    made = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda x: F.sha2(x, 256)
    return made.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP13_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
d AS (
  SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substr(x, 1, lo) AS pre, substr(x, lo + 1, hi - lo) AS mid, substr(x, hi + 1, n - hi) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM p"""
