"""All pairs of similar token sets, exactly: packed blocks of sets meet in tasks, and only pairs that hold leave them.

A join by tokens shuffles a row for each rare token that two sets share, many times what it finds. Here sets are packed into blocks with
their postings, each block meets each other one, and pairs are counted in arrays; nothing but the blocks is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed

#: Tokens are ordered by how often those of their bucket occur; so many buckets are counted.
BUCKETS = 1 << 18
#: A block has so many tokens (or one set) and sets at most; so many matches are counted at once.
TOKENS, SETS, AT_ONCE = 1 << 19, 8192, 1 << 19
#: Of each set, up to so many of its rarest tokens more than must be looked at are looked at, one for 16 tokens; as many more must then be shared.
EXTRA, OF = 8, 16
#: Bytes of a batch that holds sets or pairs of blocks, which tasks hold more than once.
BATCH_BYTES = "8m"

#: What two sets of a and b tokens must share, and their similarity if they share s. What must be shared never falls as sets grow.
NEEDED: dict[str, Callable] = {
    "overlap": lambda least, a, b: least * np.minimum(a, b),
    "jaccard": lambda least, a, b: least / (1 + least) * (a + b),
    "largest": lambda least, a, b: least * np.maximum(a, b),
}
LIKENESS: dict[str, Callable] = {"overlap": lambda s, a, b: s / np.minimum(a, b), "jaccard": lambda s, a, b: s / (a + b - s), "largest": lambda s, a, b: s / np.maximum(a, b)}

_PARTS = {"ids": np.int64, "n": np.int32, "codes": np.int32, "post": np.uint16, "uniq": np.int64, "code_of": np.int32}
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("na", pa.int32()), ("nb", pa.int32())])


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``BATCH_BYTES`` go to Python meanwhile; what runs in here must be written in here."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def hashed(tokens: Column) -> Column:
    """The set of a token array as sorted 64-bit hashes."""
    return F.sort_array(F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t))))


def class_of(h: str) -> Column:
    """128 bits of hash of a set, equal for equal sets."""
    return F.struct(F.xxhash64(h).alias("x"), F.xxhash64(F.lit(1), h).alias("y"))


def _ramp(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``lengths[0]`` places, and so on."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _block(ids: np.ndarray, n: np.ndarray, tokens: np.ndarray, often: np.ndarray) -> dict[str, np.ndarray]:
    """Sets as codes, rarest first, and the sets of each code; ``uniq`` are the tokens in order, ``code_of`` their codes."""
    uniq, found = np.unique(tokens, return_inverse=True)
    code_of = np.empty(len(uniq), np.int32)
    code_of[np.lexsort((uniq, often[uniq & (BUCKETS - 1)]))] = np.arange(len(uniq), dtype=np.int32)
    of = np.repeat(np.arange(len(n)), n)
    key = np.sort(of * len(uniq) + code_of[found])
    codes = key % len(uniq)
    return {"ids": ids, "n": n, "codes": codes, "post": of[np.argsort(codes, kind="stable")], "uniq": uniq, "code_of": code_of}


def _packer(often: np.ndarray) -> Callable:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows (id, g, h, n), ordered by g, a row for each block of one g."""
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def flush(g: str | None) -> pa.RecordBatch:
            nonlocal made, held
            block = _block(*(np.concatenate([x[i] for x in held]) for i in range(3)), often)
            n, made, held = block["n"], made + 1, []
            row = {"id": [(part << 32) + made], "g": [g], "lo": [int(n.min())], "hi": [int(n.max())]} | {k: [block[k].astype(t).tobytes()] for k, t in _PARTS.items()}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("id", pa.int64()), ("g", pa.string()), ("lo", pa.int32()), ("hi", pa.int32()), *((k, pa.binary()) for k in _PARTS)]))

        now, tokens, sets = None, 0, 0
        for batch in batches:
            ids, n = batch.column("id").to_numpy(), batch.column("n").to_numpy().astype(np.int64)
            values, ends, gs = batch.column("h").flatten().to_numpy(), np.cumsum(n), batch.column("g").to_pylist()
            begin = 0
            for i in range(len(ids) + 1):
                full = i < len(ids) and (gs[i] != now or tokens + n[i] > TOKENS or sets == SETS)
                if (full or i == len(ids)) and i > begin:
                    held.append((ids[begin:i], n[begin:i], values[ends[begin] - n[begin] : ends[i - 1]]))
                    begin = i
                if full:
                    if held:
                        yield flush(now)
                    now, tokens, sets = gs[i], 0, 0
                if i < len(ids):
                    tokens, sets = tokens + n[i], sets + 1
        if held:
            yield flush(now)

    return pack


class _Sets:
    """A packed block with what is derived from it."""

    def __init__(self, row: dict):
        for k, t in _PARTS.items():
            setattr(self, k, np.frombuffer(row[k], t))
        self.n = self.n.astype(np.int64)
        self.of = np.repeat(np.arange(len(self.n)), self.n)
        self.start = np.cumsum(self.n) - self.n
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.codes, minlength=len(self.uniq)))])
        self._keys = None

    @property
    def keys(self) -> np.ndarray:
        if self._keys is None:
            self._keys = self.of * len(self.uniq) + self.codes
        return self._keys


def _met(x: _Sets, y: _Sets, measure: str, least: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(set of x, set of y, shared) of all similar pairs whose set of x is the smaller one, or of equal size and with the smaller id."""
    needed = NEEDED[measure]
    to = np.full(len(x.uniq), -1, np.int64)
    place = np.minimum(np.searchsorted(y.uniq, x.uniq), len(y.uniq) - 1)
    hit = y.uniq[place] == x.uniq
    to[x.code_of[hit]] = y.code_of[place[hit]]
    code = to[x.codes]
    must = np.ceil(needed(least, x.n, x.n) - 1e-9).astype(np.int64)
    look = np.minimum(x.n - must + 1 + np.minimum(EXTRA, x.n // OF), x.n)
    must = must - (x.n - look)
    early = np.arange(len(code)) - x.start[x.of] < look[x.of]
    there = code >= 0
    first, rest = early & there, ~early & there
    xs, cs, rest_codes = x.of[first], code[first], code[rest]
    rest_n = np.bincount(x.of[rest], minlength=len(x.n))
    rest_at = np.cumsum(rest_n) - rest_n
    lengths = y.at[cs + 1] - y.at[cs]
    wide = len(y.n)
    # Stretches of x with few matches and few possible pairs each.
    work = np.cumsum(np.bincount(xs, weights=lengths, minlength=len(x.n)))
    a = 0
    while a < len(x.n):
        b = max(a + 1, min(int(np.searchsorted(work, (work[a - 1] if a else 0) + AT_ONCE, "right")), a + max(1, AT_ONCE // wide)))
        e0, e1 = np.searchsorted(xs, [a, b])
        many, codes = lengths[e0:e1], cs[e0:e1]
        total = int(many.sum())
        if total:
            key = np.repeat((xs[e0:e1] - a) * wide, many) + y.post[_ramp(y.at[codes], many)]
            if (b - a) * wide <= 16 * total:
                counted = np.bincount(key, minlength=(b - a) * wide)
                at = np.flatnonzero(counted.reshape(-1, wide) >= must[a:b, None])
                c = counted[at]
            else:
                at, c = np.unique(key, return_counts=True)
            i, j = at // wide + a, at % wide
            nx, ny = x.n[i], y.n[j]
            need = needed(least, nx, ny) - 1e-9
            ok = (c >= must[i]) & ((nx < ny) | ((nx == ny) & (x.ids[i] < y.ids[j]))) & (c + rest_n[i] >= need) & (c + (nx - look[i]) >= need)
            i, j, c = i[ok], j[ok], c[ok]
            ends = np.cumsum(rest_n[i])
            k = 0
            while k < len(i):
                m = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + AT_ONCE, "right")))
                p, q, r = i[k:m], j[k:m], rest_n[i[k:m]]
                look_up = np.repeat(q * len(y.uniq), r) + rest_codes[_ramp(rest_at[p], r)]
                place = np.minimum(np.searchsorted(y.keys, look_up), len(y.keys) - 1)
                s = c[k:m] + np.bincount(np.repeat(np.arange(m - k), r), weights=y.keys[place] == look_up, minlength=m - k).astype(np.int64)
                held = LIKENESS[measure](s, x.n[p], y.n[q]) >= least
                yield p[held], q[held], s[held]
                k = m
        a = b


def _meeting(measure: str, least: float) -> Callable:
    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, tuple[int, _Sets]] = {}

        def side(row: dict, k: str) -> _Sets:
            if last.get(k, (None,))[0] != row[f"{k}_id"]:
                last[k] = row[f"{k}_id"], _Sets({p: bytes(row[f"{k}_{p}"]) for p in _PARTS})
            return last[k][1]

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() if c.endswith("_id") else batch.column(c)[r].as_buffer() for c in batch.schema.names}
                x, y = side(row, "x"), side(row, "y")
                for one, other in ((x, y), (y, x))[: 1 + (row["x_id"] != row["y_id"])]:
                    lo = max(other.n.min(), one.n.min())
                    # No pair of these sizes can hold: the smaller set is in ``one``.
                    if one.n.min() > other.n.max() or NEEDED[measure](least, one.n.max(), lo) - 1e-9 > one.n.max():
                        continue
                    for i, j, s in _met(one, other, measure, least):
                        if len(i):
                            flip = one.ids[i] > other.ids[j]
                            ids, n = (one.ids[i], other.ids[j]), (one.n[i], other.n[j])
                            pick = lambda v: (np.where(flip, v[1], v[0]), np.where(flip, v[0], v[1]))
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((*pick(ids), s, *pick(n)), _PAIR.types)], schema=_PAIR)

    return meet


def frequencies(sets: DataFrame) -> np.ndarray:
    """How often tokens of each bucket occur in the sets ``h``; blocks that meet must be packed by the same ones."""
    bucket = F.col("t").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("k")
    counted = sets.select(F.explode("h").alias("t")).groupBy(bucket).agg(F.count(F.lit(1)).alias("c")).toArrow()
    often = np.zeros(BUCKETS, np.int64)
    often[counted.column("k").to_numpy()] = counted.column("c").to_numpy()
    return often


def packed(sets: DataFrame, often: np.ndarray | None = None) -> DataFrame:
    """Blocks of the sets (id long, g string, h array of long): rows of one ``g`` and of similar size lie together. ``sets`` is read twice, or once if its ``frequencies`` are given."""
    sets = sets.select("id", "g", "h", F.size("h").alias("n")).filter("n > 0 and id is not null")
    often = frequencies(sets) if often is None else often
    schema = "id long, g string, lo int, hi int, " + ", ".join(f"{k} binary" for k in _PARTS)
    with _small_batches(sets.sparkSession):
        return checkpointed(sets.sortWithinPartitions("g", "n").mapInArrow(_packer(often), schema))


def block_pairs(blocks: DataFrame, least: float, measure: str = "overlap") -> DataFrame:
    """(a, b, shared, na, nb): all pairs a < b of sets of one ``g`` (null is one too) whose similarity is ``least`` or more.

    ``measure``: ``overlap`` (shared over the smaller set), ``jaccard``, ``largest`` (over the larger set). Exact by a prefix filter that
    counts: of two sets the smaller one shares so many of its rarest tokens as it must share in all, less those that are not looked at.
    Equal tokens are those of equal 64-bit hashes.
    """
    side = lambda k: blocks.select(*[F.col(c).alias(f"{k}_{c}") for c in blocks.columns])
    tasks = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    g = lambda k: F.coalesce(F.concat(F.lit("="), f"{k}_g"), F.lit(""))
    # Not an equality, for blocks of one frequent g would meet in one task.
    both = side("x").repartition(tasks).join(side("y"), (F.col("x_id") <= F.col("y_id")) & (g("x") <= g("y")) & (g("x") >= g("y")))
    return both.select(*[f"{k}_{c}" for k in "xy" for c in ("id", *_PARTS)]).mapInArrow(_meeting(measure, least), "a long, b long, shared int, na int, nb int")


def near_blocks(blocks: DataFrame, least: float, others: DataFrame | None = None) -> DataFrame:
    """(a, b, shared): ``block_pairs`` by Jaccard, a and b in any order, for blocks dealt by size: those whose sizes lie too far apart don't meet, and none is shuffled. The pairs are written.

    With ``others``, blocks packed apart by the same frequencies, the pairs of a set of ``blocks`` and one of ``others``, which may be in both.
    """
    side = lambda d, k: d.select(*[F.col(c).alias(f"{k}_{c}") for c in blocks.columns])
    g = lambda k: F.coalesce(F.concat(F.lit("="), f"{k}_g"), F.lit(""))
    # Blocks of others get other ids.
    once, ys = (F.col("x_id") <= F.col("y_id"), blocks) if others is None else (F.lit(True), others.withColumn("id", -F.col("id") - 1))
    near = (F.col("x_hi") >= least * F.col("y_lo") - 1e-9) & (F.col("y_hi") >= least * F.col("x_lo") - 1e-9)
    tasks = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    both = side(blocks, "x").coalesce(tasks).join(side(ys, "y"), once & near & (g("x") <= g("y")) & (g("x") >= g("y")))
    met = both.select(*[f"{k}_{c}" for k in "xy" for c in ("id", *_PARTS)]).mapInArrow(_meeting("jaccard", least), "a long, b long, shared int, na int, nb int")
    with _small_batches(blocks.sparkSession):
        return checkpointed(met.select("a", "b", "shared"))


def set_pairs(df: DataFrame, id_col: str, tokens: str, least: float, measure: str = "overlap", block: str | None = None) -> DataFrame:
    """``block_pairs`` of the rows' token arrays; rows without tokens match nothing."""
    g = F.lit(None).cast("string") if block is None else F.col(block).cast("string")
    return block_pairs(packed(checkpointed(df.select(F.col(id_col).cast("long").alias("id"), g.alias("g"), hashed(F.col(tokens)).alias("h")))), least, measure)
