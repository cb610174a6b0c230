"""Gates, lanes, evaluation against labels and violations. Every rejected row keeps a reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failure(checks: Sequence[tuple[str, Column]], passed: str = "PASS") -> Column:
    """The first check that fails (a null counts as failed), or ``passed``."""
    out = F.lit(passed)
    for label, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)).otherwise(out)
    return out


def cascade(df: DataFrame, checks: Sequence[tuple[str, Column]], passed: str = "PASS", name: str = "gate") -> DataFrame:
    """``name``: the first check that fails (a null counts as failed), or ``passed``."""
    return df.withColumn(name, first_failure(checks, passed))


def blockers(df: DataFrame, checks: Sequence[tuple[str, Column]], name: str = "blockers") -> DataFrame:
    """All checks that fail, as an array."""
    return df.withColumn(name, F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)) for label, ok in checks])))


def lanes(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A row for each lane whose rule holds, in one pass."""
    return df.withColumn("lane", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))))


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """One row of counts."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in steps.items()])


def overall_and_by(df: DataFrame, by: str, measures: dict[str, Column]) -> DataFrame:
    """Measures over all rows (``by`` null, ``is_total`` 1) and for each value of ``by``, in one pass."""
    out = df.rollup(by).agg(F.grouping(by).cast("int").alias("is_total"), *[m.alias(n) for n, m in measures.items()])
    return out.filter((F.col("is_total") == 1) | F.col(by).isNotNull())


def violations(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """(id, rule) for each rule that a row breaks; a rule that is null is broken."""
    return lanes(df, {n: ~F.coalesce(ok, F.lit(False)) for n, ok in rules.items()}).select(id_col, F.col("lane").alias("rule"))


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def partition_by_gate(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(ok, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def editorial_verdict(completion: Column, reviewed: Column, n: Column, useful: Column, noise: Column) -> Column:
    enough = (completion >= 0.8) & (reviewed >= F.least(F.lit(10), n))
    return F.when(~enough, "INSUFFICIENT").when((useful >= 0.35) & (noise <= 0.5), "DEEPEN").when(useful >= 0.15, "AUXILIARY").otherwise("STOP")


def profile(df: DataFrame, columns: Sequence[str], numeric_share: float = 0.98) -> DataFrame:
    """Per column: non-empty values, numeric ones, and whether the column counts as numeric. One pass, unpivoted at the end."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("string")
        full = F.coalesce(F.length(F.trim(v)) > 0, F.lit(False))
        aggs += [F.count_if(full).alias(f"{c}__f"), F.count_if(full & F.replace(v, F.lit(","), F.lit("")).try_cast("double").isNotNull()).alias(f"{c}__n")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__f").alias("non_empty"), F.col(f"{c}__n").alias("numeric")) for c in columns]))
    return one.select(rows.alias("r")).select("r.*", ((F.col("r.non_empty") > 0) & (F.col("r.numeric") >= numeric_share * F.col("r.non_empty"))).alias("is_numeric"))


def collection_status(ok: Column, n: Column) -> Column:
    """FAILED where the source could not be read, EMPTY where it was read and had nothing, OK otherwise: a failure is no zero."""
    return F.when(~F.coalesce(ok, F.lit(False)), "FAILED").when(F.coalesce(n, F.lit(0)) == 0, "EMPTY").otherwise("OK")
