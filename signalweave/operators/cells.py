"""Matched cells and what is computed on them: year-on-year change, floors, dominance and weighted totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def last_wins(df: DataFrame, key: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """One row per key: that of the highest ordinal. Combined before the shuffle; ordinals must tell rows of a key apart."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*ordinal)).alias("__r"))
    return picked.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, key: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*ordinal)).alias("__r"))
    return picked.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def matched_cells(df: DataFrame, key: Sequence[str], period: str, now, before, measures: dict[str, Column], present: Sequence[Column] = ()) -> DataFrame:
    """Cells that have rows in both periods, with each measure as ``<name>_now`` and ``<name>_then``, in one aggregation.

    ``measures`` are aggregates over rows of one period. ``present``: conditions that must hold for some row of each period
    (several sources in one long table); without them, any row counts. A cell that is absent on a side is no zero.
    """
    cells = df.filter(F.col(period).isin(now, before)).groupBy(*key, period).agg(*[m.alias(n) for n, m in measures.items()], *[F.max(c.cast("int")).alias(f"__p{i}") for i, c in enumerate(present)])
    for i, _ in enumerate(present):
        cells = cells.filter(F.col(f"__p{i}") == 1)
    sides = [F.max(F.when(F.col(period) == F.lit(p), F.col(n))).alias(f"{n}_{s}") for n in measures for s, p in (("now", now), ("then", before))]
    both = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *sides)
    return both.filter("__n = 2").drop("__n")


def latest_common(left: DataFrame, right: DataFrame, period: Sequence[str]) -> DataFrame:
    """The greatest period that both have, as one row."""
    both = left.select(*period).distinct().intersect(right.select(*period).distinct())
    return both.agg(F.max(F.struct(*period)).alias("p")).select("p.*")


def exclusive_quartile(df: DataFrame, value: str, group: Sequence[str] = (), share: float = 0.25) -> DataFrame:
    """The exclusive quantile of positive values: position (n + 1) * share, interpolated; the neighbours are clamped to the
    ends, so few values can extrapolate. Null for fewer than two values.

    Ranks come from counts of distinct values, not of rows: partial sums keep the shuffle at the number of distinct values. A group's
    distinct values are ordered in one task, so this is for measures of cells; round or group finer values first.
    """
    counts = df.filter(F.col(value) > 0).groupBy(*group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = W.partitionBy(*(group or [F.lit(0)])).orderBy("v")
    ranked = counts.withColumn("upto", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("n", F.sum("c").over(W.partitionBy(*(group or [F.lit(0)]))))
    pos = (F.col("n") + 1) * share
    j = F.greatest(F.lit(1), F.least(F.floor(pos), F.col("n") - 1))
    at = lambda k: F.max(F.when((F.col("upto") >= k) & (F.col("upto") - F.col("c") < k), F.col("v")))
    out = ranked.withColumn("j", j).withColumn("d", pos - j).groupBy(*group).agg(F.max("n").alias("n"), F.max("d").alias("d"), at(F.col("j")).alias("lo"), at(F.col("j") + 1).alias("hi"))
    return out.select(*group, F.when(F.col("n") >= 2, F.col("lo") * (1 - F.col("d")) + F.col("hi") * F.col("d")).alias("floor"))


def direction(changes: Sequence[Column], up: Sequence[float], down: Sequence[float]) -> Column:
    """UP if all changes reach their upper bounds, DOWN if all reach the lower ones, UNCOMPARABLE with a null, else MIXED."""
    none, rising, falling = F.lit(False), F.lit(True), F.lit(True)
    for c, u, d in zip(changes, up, down, strict=True):
        none, rising, falling = none | c.isNull(), rising & (c >= u), falling & (c <= d)
    return F.when(none, "UNCOMPARABLE").when(rising, "UP").when(falling, "DOWN").otherwise("MIXED")


def dominance(df: DataFrame, group: Sequence[str], direction_col: str, least: int = 5, factor: int = 2) -> DataFrame:
    """Per group the counts of rising and falling cells and a verdict.

    SPLIT: both reach ``least``. UP or DOWN: that count reaches ``least`` and ``factor`` times the other. Else NONE.
    """
    up, down = (F.count_if(F.col(direction_col) == d) for d in ("UP", "DOWN"))
    out = df.groupBy(*group).agg(up.alias("n_up"), down.alias("n_down"))
    strong = lambda a, b: (F.col(a) >= least) & (F.col(a) >= F.greatest(factor * F.col(b), F.lit(least)))
    return out.withColumn("verdict", F.when((F.col("n_up") >= least) & (F.col("n_down") >= least), "SPLIT").when(strong("n_up", "n_down"), "UP").when(strong("n_down", "n_up"), "DOWN").otherwise("NONE"))


def top_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; ``order`` must be total."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col(rank) <= k)


def trajectory(values: Sequence[Column], tolerance: float = 0.05) -> Column:
    """Of three points: RISING or FALLING on both legs, PEAK or TROUGH where they turn, else MIXED; null points are UNCOMPARABLE."""
    a, b, c = values
    leg = lambda x, y: F.when(x > 0, (y - x) / x)
    one, two = leg(a, b), leg(b, c)
    up, down = (lambda g: g >= tolerance), (lambda g: g <= -tolerance)
    return F.when(one.isNull() | two.isNull(), "UNCOMPARABLE").when(up(one) & up(two), "RISING").when(down(one) & down(two), "FALLING").when(up(one) & down(two), "PEAK").when(down(one) & up(two), "TROUGH").otherwise("MIXED")


def control_verdict(df: DataFrame, treated: Column, declines: Column) -> DataFrame:
    """One row: STRENGTHENED if all treated cells decline and at most max(1, n/3) controls do; BROAD if two thirds of the controls do; else MIXED."""
    out = df.agg(
        F.count_if(treated).alias("n_treated"),
        F.count_if(treated & declines).alias("treated_declining"),
        F.count_if(~treated).alias("n_controls"),
        F.count_if(~treated & declines).alias("controls_declining"),
    )
    whole = (F.col("n_treated") > 0) & (F.col("treated_declining") == F.col("n_treated"))
    few = F.col("controls_declining") <= F.greatest(F.lit(1.0), F.col("n_controls") / 3)
    broad = F.col("controls_declining") >= F.col("n_controls") * 2 / 3
    return out.withColumn("verdict", F.when(whole & few, "STRENGTHENED").when(broad, "BROAD").otherwise("MIXED"))


def weekday_balanced(df: DataFrame, group: Sequence[str], day: str, value: str) -> DataFrame:
    """Mean over weekdays of the mean daily total, so that no weekday weighs more because a month has five of it."""
    daily = df.groupBy(*group, day).agg(F.sum(value).alias("__t"))
    per = daily.groupBy(*group, F.weekday(day).alias("__w")).agg((F.sum("__t").cast("double") / F.count(F.lit(1))).alias("__m"))
    return per.groupBy(*group).agg((F.sum(F.col("__m").cast("decimal(30,8)")).cast("double") / F.count(F.lit(1))).alias("balanced_mean"), F.count(F.lit(1)).alias("weekdays"))
