"""Sharding along a Hilbert curve: metadata dimensions are quantised, rows are ordered by curve index and runs are cut.

Native: expressions and aggregates only. The global order never passes through one task. Rows are counted per
curve cell; a cell with many rows is divided by a hash of its rows, so that no part holds more than a set share of the
table; running offsets are taken over the parts, whose number is bounded by a constant; and each part is ranked by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import read_table, text_or_empty

#: Bits of each dimension; cells of the curve are 2 ** (dimensions * BITS).
BITS = 4
#: Rows of a cell are divided so that a part has about 1 / PARTS of the table; there are at most PARTS + cells parts.
PARTS = 8192


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Index of a grid point on the Hilbert curve of ``len(point)`` dimensions (transpose form of the Gray-code walk)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v >> b & 1)
    return out


def curve_table(dims: int, bits: int = BITS) -> list[int]:
    """Curve index by cell number, where a cell's number holds the dimensions from the highest bits down."""
    mask = (1 << bits) - 1
    return [hilbert_index(tuple(cell >> bits * (dims - 1 - d) & mask for d in range(dims)), bits) for cell in range(1 << dims * bits)]


def quantise_size(size: Column, bits: int = BITS) -> Column:
    """Powers of two from 32 up, cut to the range of ``bits``."""
    return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.greatest(size, F.lit(1)) / 32.0)))).cast("int")


def quantise_name(name: Column, bits: int = BITS) -> Column:
    """A name's cell by checksum; null has the checksum of an empty name."""
    return (F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % (1 << bits)).cast("int")


def curve_cell(dims: list[Column], bits: int = BITS) -> Column:
    """Curve index of quantised dimensions, looked up in one constant array."""
    cell = F.lit(0)
    for d in dims:
        cell = cell * (1 << bits) + d
    return F.element_at(F.lit(curve_table(len(dims), bits)), (cell + 1).cast("int")).cast("int")


def ranked(rows: DataFrame, cell: str, tie: list[str], parts: int = PARTS) -> DataFrame:
    """``rows`` with ``total`` (their count) and ``rank`` (long, from 0, without gaps) in the order of ``cell``, a hash of ``tie``, and ``tie``.

    Rows equal in all of ``tie`` are interchangeable. Offsets are broadcast: at most ``parts`` + cells rows.
    """
    h = F.pmod(F.xxhash64(*tie), F.lit(1 << 20))
    per = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("__n"))
    per = per.withColumn("__k", F.greatest(F.lit(1), F.ceil(F.col("__n") * parts / F.sum("__n").over(W.partitionBy(F.lit(0))))).cast("long")).select(F.col(cell).alias("__cell"), "__k")
    cut = rows.join(F.broadcast(per), F.col(cell) == F.col("__cell")).withColumn("__part", F.floor(h * F.col("__k") / (1 << 20)).cast("long")).drop("__cell", "__k")
    sizes = cut.groupBy(cell, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy(F.lit(0)).orderBy(cell, "__part").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("__n").over(W.partitionBy(F.lit(0)))
    offsets = sizes.select(F.col(cell).alias("__c"), F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"), total.alias("total"))
    local = F.row_number().over(W.partitionBy(cell, "__part").orderBy(*[F.col(t).asc_nulls_first() for t in tie]))
    return (
        cut.withColumn("__local", local)
        .join(F.broadcast(offsets), (F.col(cell) == F.col("__c")) & (F.col("__part") == F.col("__p")))
        .withColumn("rank", F.col("__before") + F.col("__local") - 1)
        .drop("__c", "__p", "__before", "__local", "__part")
    )


def hilbert_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, ...] = ("lang", "source"), parts: int = PARTS) -> DataFrame:
    """Cuts ``docs`` into ``shards`` runs of the curve over size and ``names``; counts differ by one at most (law ``rows``).

    Null texts and names count as empty. Null ids come first among equal cells. Rows that repeat wholly are
    interchangeable. Columns that are not named are not read. An empty table gives no rows. Returns doc_id, size,
    text_crc32, law, curve, shard, slot, grown_shard.
    """
    text = text_or_empty(text_col)
    size = (F.octet_length(text) + 1).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        curve_cell([quantise_size(size), *(quantise_name(F.col(n)) for n in names)]).alias("curve"),
    )
    out = ranked(rows, "curve", ["doc_id", "text_crc32", "size"], parts)
    # Shard s starts at rank ceil(s * total / shards).
    shard = F.expr(f"cast(rank * {shards} div total as int)")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return out.withColumn("shard", shard).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "curve", "shard", (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def pruned_fraction(sharded: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Share of shards whose range of ``column`` misses [low, high]: what a reader with file statistics skips."""
    spans = sharded.groupBy("shard").agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return spans.agg(F.avg(F.when((F.col("hi") < low) | (F.col("lo") > high), 1.0).otherwise(0.0)).alias("pruned"))


def op6_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    return hilbert_shards(read_table(spark, sf_dir, "documents"))
