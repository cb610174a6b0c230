"""Selection: dedupe by rank, set contracts, interleaving over groups, quotas and lanes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def best_wins(df: DataFrame, key: Sequence[str], rank: Sequence[Column], ordinal: Sequence[str]) -> DataFrame:
    """The best row of each key: highest ``rank``, then the first by ``ordinal``. ``rank`` columns are numbers, higher better."""
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[(-r).alias(f"r{i}") for i, r in enumerate(rank)], *ordinal)
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("__r")).select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def with_representative(df: DataFrame, key: Column, id_col: str, ordinal: Sequence[str]) -> DataFrame:
    """Rows with ``cluster_key`` and ``representative_id``: the id of the first row of the key. Only ids are combined."""
    keyed = df.withColumn("cluster_key", key)
    first = keyed.groupBy("cluster_key").agg(F.min_by(id_col, F.struct(*ordinal)).alias("representative_id"))
    return keyed.join(first, "cluster_key")


def union_first(*parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Union in which an earlier part's row suppresses those of the same key in later ones; parts may lack columns."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("__part", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    least = out.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)]).agg(F.min("__part").alias("__least"))
    same = F.col("__part") == F.col("__least")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return out.join(least, same).select(*[c for c in out.columns if c != "__part"])


def id_contract(expected: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """(key, problem) for ids that are missing, unknown or given more than once."""
    n = given.groupBy(key).agg(F.count(F.lit(1)).alias("given"))
    e = expected.select(F.col(key)).distinct().withColumn("known", F.lit(True))
    both = e.join(n, key, "full")
    problem = F.when(F.col("known").isNull(), "UNKNOWN").when(F.col("given").isNull(), "MISSING").when(F.col("given") > 1, "DUPLICATE")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def interleave(df: DataFrame, group: str, order: Sequence[Column], group_order: Column, limit: int) -> DataFrame:
    """Round robin: the first row of each group, then the second of each, ... up to ``limit`` rows; ``position`` counts from 1.

    Groups are taken in ``group_order``, an aggregate over the group's rows (its first appearance, say). Only the first
    ``limit`` rows of a group can be drawn, so the final order is over a bounded number of rows for a bounded number of groups.
    """
    ranked = df.withColumn("__rn", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter(F.col("__rn") <= limit)
    groups = df.groupBy(F.col(group).alias("__g")).agg(group_order.alias("__go"))
    drawn = ranked.join(groups, F.col(group).eqNullSafe(F.col("__g"))).orderBy("__rn", "__go", group).limit(limit)
    return drawn.withColumn("position", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("__rn", "__go", group))).drop("__rn", "__go", "__g")


def rotation(df: DataFrame, group: str, order: Sequence[Column], groups: Sequence[str], seed: int, limit: int) -> DataFrame:
    """Round robin over named groups, starting with group number seed mod n."""
    n = len(groups)
    index = F.array_position(F.array(*map(F.lit, groups)), F.col(group)) - 1
    ranked = df.filter(F.col(group).isin(*groups)).withColumn("__rn", F.row_number().over(W.partitionBy(group).orderBy(*order))).withColumn("__turn", F.pmod(index - seed, F.lit(n)))
    drawn = ranked.orderBy("__rn", "__turn").limit(limit)
    return drawn.withColumn("position", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("__rn", "__turn"))).drop("__rn", "__turn")


def lanes_once(df: DataFrame, key: str, lane: str, lanes: Sequence[str]) -> DataFrame:
    """Each key in the first of its lanes by priority."""
    rank = F.array_position(F.array(*map(F.lit, lanes)), F.col(lane))
    return df.filter(F.col(lane).isin(*lanes)).groupBy(key).agg(F.min_by(lane, rank).alias(lane))


def quota_by_kind(df: DataFrame, kind: str, order: Sequence[Column], total: int, special: str) -> DataFrame:
    """``total`` rows of which max(1, total // 2) are of the special kind, if there are so many; the rest are of other kinds."""
    share = max(1, total // 2)
    is_special = F.col(kind) == special
    rows = df.withColumn("__s", is_special).withColumn("__rn", F.row_number().over(W.partitionBy("__s").orderBy(*order))).filter(F.col("__rn") <= total)
    n = rows.agg(F.least(F.lit(share), F.count_if(F.col("__s"))).alias("__have"))
    return rows.join(F.broadcast(n)).filter(F.when(F.col("__s"), F.col("__rn") <= F.col("__have")).otherwise(F.col("__rn") <= F.lit(total) - F.col("__have"))).drop("__s", "__rn", "__have")


def cross_lane(parts: Sequence[DataFrame], key: str, group: str, order: Sequence[Column], per_lane: int, fill: Sequence[Column], total: int) -> DataFrame:
    """Lanes drawn one after the other, each a round robin over groups that skips keys an earlier lane chose, ``per_lane`` rows
    each; then rows of any lane that are not chosen yet, by ``fill``, up to ``total``. Lanes are a few; chosen rows are bounded."""
    chosen = None
    for i, p in enumerate(parts):
        ranked = p.withColumn("__rn", F.row_number().over(W.partitionBy(group).orderBy(*order)))
        first = ranked.groupBy(key).agg(F.min(F.struct("__rn", group)).alias("__at"))
        if chosen is not None:
            first = first.join(F.broadcast(chosen.select(key)), key, "left_anti")
        lane = first.orderBy("__at", key).limit(per_lane).select(key).withColumn("lane", F.lit(f"lane{i + 1}"))
        chosen = lane if chosen is None else chosen.unionByName(lane)
    rest = None
    for p in parts:
        rest = p if rest is None else rest.unionByName(p)
    left = rest.join(F.broadcast(chosen.select(key)), key, "left_anti").dropDuplicates([key]).orderBy(*fill, key).limit(total)
    room = chosen.agg((F.lit(total) - F.count(F.lit(1))).alias("__room"))
    left = left.withColumn("__rn", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*fill, key))).join(F.broadcast(room)).filter("__rn <= __room")
    return chosen.unionByName(left.select(key, F.lit("fill").alias("lane")))
