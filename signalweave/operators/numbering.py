"""Line numbers of a table in a given order without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import checkpointed


def numbered(df: DataFrame, order: Sequence[str], name: str = "line", start: int = 1) -> DataFrame:
    """``df`` with ``name``: the place of each row by ``order``, from ``start`` on without gaps. Rows of equal order are numbered in no certain order.

    Rows are dealt by ranges of the order and written once, so that a row's range is the same for both readings; ranges are counted, and a row's
    number is its place in its range behind all rows of the ranges before. The counts are as many as there are ranges.
    """
    at = [F.col(c) for c in order]
    ranged = checkpointed(df.repartitionByRange(*at).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition of the shuffle.
    before = counts.select("__range", (F.coalesce(F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("__before"))
    placed = ranged.join(F.broadcast(before), "__range").withColumn("__place", F.row_number().over(W.partitionBy("__range").orderBy(*at)))
    return placed.withColumn(name, (F.col("__before") + F.col("__place") - 1 + start).cast("long")).drop("__range", "__before", "__place")


def marginal_sums(df: DataFrame, key: Sequence[str], measure: Column, marginals: dict[str, Column]) -> DataFrame:
    """(key, total, a column for each of ``marginals``, differing, agrees): the measure in all and over the rows that each marginal puts in a class.

    A marginal is the column of its classes; rows where it is null are in none, so its sum falls short of the total. ``differing`` names the marginals that
    do. Null measures count 0. One aggregate.
    """
    m = F.coalesce(measure, F.lit(0))
    sums = df.groupBy(*key).agg(F.sum(m).alias("total"), *[F.sum(F.when(c.isNotNull(), m).otherwise(0)).alias(n) for n, c in marginals.items()])
    off = F.array_compact(F.array(*[F.when(F.col(n) != F.col("total"), F.lit(n)) for n in marginals]))
    return sums.withColumn("differing", off).withColumn("agrees", F.size("differing") == 0)
