"""N-gram Jaccard self-join by the chosen-path method.

Every distinct text is a set of hashed five-word shingles with a MinHash signature. A run sends each set down a tree:
at a node one signature position is sampled (the same for all sets there) and sets go to the child named by the token
they hold at it, so that two sets of similarity s part with probability 1 - s at each step. A bucket that is small, or
that further splits do not shrink, is brute-forced on sketches. Runs repeat, for the sets that need it, until the chance
that a pair at the threshold never met falls under 1 - recall. Sketch pairs only form candidate classes; inside these the
exact similarity of every pair is computed on bit sets, in pairs of bounded blocks spread over tasks. Tasks give link
counts per text and a spanning forest, never the pairs themselves, so a group of copies costs rows in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, fresh, join_uneven, lean, read_table, stored, text_key, text_or_empty

#: Words in a shingle and the least similarity of a link.
WORDS, THRESHOLD = 5, 0.8
#: Bytes of a sketch; the first POSITIONS signature positions can be sampled by the tree.
SKETCH, POSITIONS = 128, 64
#: Sets in a bucket that is brute-forced; sets and, in the exact step, shingles in a block. Pairs of blocks are dealt to tasks.
SMALL, BLOCK, BLOCK_SHINGLES = 1000, 300, 200_000
#: Rows with signatures in a file of a written table.
TEXTS_A_FILE = 20_000
#: A child with this share of its parent's sets stops the splitting.
DENSE = 0.75
#: Chance that a pair at the threshold meets in some bucket.
RECALL = 0.9999
#: Least sketch agreement of a candidate pair: 4.5 standard deviations under the threshold.
AGREE = 0.64

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIERS = (np.random.default_rng(20240607).integers(0, 1 << 63, SKETCH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` lower-case words, parted by white space.

    A text of fewer words is one shingle; one without words has none.
    """
    norm = " ".join(text.lower().split()).encode("utf-8", "replace")
    if not norm:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(norm, np.uint8)
    size = len(raw)
    power, inverse = _upto(size + 1)
    total = np.empty(size + 1, np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:size], out=total[1:])
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [size]))
    if len(starts) > words:
        starts, ends = starts[: len(starts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of SKETCH multiplicative permutations."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (_MULTIPLIERS[:, None] * shingles[None, at : at + 1024]).min(axis=1), out=low)
    return low


_FEATURES = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int32()), ("sketch", pa.binary()), ("tokens", pa.list_(pa.int32()))])


def _featurise(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, sketches, tokens = [], [], []
                for text in part.column(2).to_pylist():
                    s = shingle_set(text, words)
                    low = signature(s)
                    n.append(len(s))
                    sketches.append((low >> np.uint64(24)).astype(np.uint8).tobytes())
                    tokens.append((low[:POSITIONS] >> np.uint64(16)).astype(np.uint32).view(np.int32))
                flat = pa.array(np.concatenate(tokens)) if tokens else pa.array([], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(tokens) * POSITIONS + 1, POSITIONS, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.binary()), pa.array(n, pa.int32()), pa.array(sketches, pa.binary()), lists], schema=_FEATURES)

    return run


def _runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows that are equal in the first ``keys`` columns, from sorted batches; a group may go on over batches."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        cut = np.zeros(batch.num_rows, bool)
        cut[0] = True
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        at = [*np.flatnonzero(cut).tolist(), batch.num_rows]
        for lo, hi in zip(at, at[1:]):
            k = tuple(c[lo] for c in cols)
            if key is not None and k != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = k
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield key, pa.Table.from_batches(held)


def _forest(n: int, pairs: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """Root of each of n nodes, given for node i the array of nodes it is joined to."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, others in pairs:
        r = find(i)
        for j in others.tolist():
            s = find(j)
            if s != r:
                r, s = (r, s) if r < s else (s, r)
                up[s] = r
    return np.array([find(i) for i in range(n)])


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _brute(threshold: float, agree: float):
    """Of each bucket (or pair of its blocks), a spanning forest of the pairs whose sketches agree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[bytes] = []
        b: list[bytes] = []
        for _, table in _runs(batches, 3):
            keys = table.column("key").to_pylist()
            m = len(keys)
            if m < 2:
                continue
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(m, SKETCH)
            n = table.column("n").to_numpy().astype(np.float64)
            least = int(math.ceil(agree * SKETCH))

            def near(sketch=sketch, n=n, m=m, least=least):
                for i in range(m - 1):
                    same = np.count_nonzero(sketch[i + 1 :] == sketch[i], axis=1)
                    ok = (same >= least) & (np.minimum(n[i + 1 :], n[i]) >= threshold * np.maximum(n[i + 1 :], n[i]))
                    yield i, np.flatnonzero(ok) + i + 1

            root = _forest(m, near())
            for i in np.flatnonzero(root != np.arange(m)).tolist():
                a.append(keys[i])
                b.append(keys[root[i]])
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=_EDGES)
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=_EDGES)

    return run


def exact_links(sets: list[np.ndarray], sizes: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each i, the j > i with Jaccard similarity of at least ``threshold``, by bit sets over the shingles that two sets share."""
    m = len(sets)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, index, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[index]
    rows, cols = owner[keep], number[index[keep]]
    width = (int(shared.sum()) + 63) // 64
    bits = np.zeros((m, max(width, 1)), np.uint64)
    np.bitwise_or.at(bits, (rows, cols >> 6), np.uint64(1) << (cols & 63).astype(np.uint64))
    for i in range(m - 1):
        fit = np.flatnonzero(np.minimum(sizes[i + 1 :], sizes[i]) >= threshold * np.maximum(sizes[i + 1 :], sizes[i]) - 1e-9) + i + 1
        linked = []
        for at in range(0, len(fit), 256):
            some = fit[at : at + 256]
            both = np.bitwise_count(bits[some] & bits[i]).sum(axis=1, dtype=np.int64)
            linked.append(some[both >= threshold * (sizes[some] + sizes[i] - both) - 1e-9])
        if linked:
            yield i, np.concatenate(linked)


_LINKS = pa.schema([("key", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def _verify(threshold: float):
    """Of each pair of blocks, the number of linked rows of each text and its root in the forest of links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, first, second), table in _runs(batches, 3):
            keys, block = table.column("key").to_pylist(), table.column("block").to_numpy()
            m = len(keys)
            copies = table.column("copies").to_numpy().astype(np.int64)
            sets = [np.asarray(s.values).view(np.uint64) for s in table.column("shingles").combine_chunks()] if m else []
            sizes = np.array([len(s) for s in sets], np.int64)
            links = np.zeros(m, np.int64)

            def linked(sets=sets, sizes=sizes, block=block, copies=copies, links=links, across=first != second):
                for i, js in exact_links(sets, sizes, threshold):
                    if across:
                        js = js[block[js] != block[i]]
                    links[i] += copies[js].sum()
                    links[js] += copies[i]
                    yield i, js

            root = _forest(m, linked())
            rows = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in rows], pa.binary()), pa.array([keys[root[i]] for i in rows], pa.binary()), pa.array(links[rows])], schema=_LINKS)

    return run


def _block_pairs(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in; ``block`` is its block of ``blocks``."""
    df = df.withColumn("block", F.pmod(F.xxhash64("key"), F.col(blocks)))
    return _with_others(df.withColumn("others", F.sequence(F.lit(0).cast("long"), (F.col(blocks) - 1).cast("long"))))


def _with_others(df: DataFrame) -> DataFrame:
    df = df.withColumn("other", F.explode("others")).drop("others")
    return df.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))


def _in_blocks(cand: DataFrame, threshold: float, small: int) -> DataFrame:
    """``cand`` (root, key, n, ...) with ``block``, and ``others``: the blocks of its class that may hold sets similar to its own.

    Sets of similarity t have sizes within a factor of t, so with sizes in bands of that factor only the same and the next
    bands are compared. A band is divided by hash into blocks of bounded counts and bounded shingles.
    """
    # A little wider than the factor, so that rounding never puts a pair two bands apart.
    band = F.floor(F.log(F.col("n").cast("double")) / (-math.log(threshold) * 1.000001)).cast("long")
    cand = cand.withColumn("band", band)
    load = cand.groupBy("root", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / small), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("k"))
    near = load.select("root", F.explode(F.array(*[F.struct((F.col("band") + d).alias("band"), F.col("band").alias("of"), "k") for d in (-1, 0, 1)])).alias("x")).select("root", "x.*")
    codes = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda h: F.col("of") * (1 << 32) + h)
    around = near.groupBy("root", "band").agg(F.flatten(F.collect_list(codes)).alias("others"), F.max(F.when(F.col("of") == F.col("band"), F.col("k"))).alias("k")).filter("k is not null")
    joined = cand.join(around, ["root", "band"])
    return joined.withColumn("block", F.col("band") * (1 << 32) + F.pmod(F.xxhash64("key"), F.col("k"))).drop("band", "k")


def _paths(reps: DataFrame, n: int, first: int, last: int, threshold: float, small: int, tmp: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Leaves (bucket, size, key) of runs first .. last-1 over ``reps`` (``n`` at most), and (key, deficit): what their depth beyond 1 costs in log misses."""
    # The first step is hashed before rows are multiplied, so that signatures stay behind; only sets of large buckets fetch theirs.
    roots = F.expr(f"transform(sequence({first}, {last - 1}), r -> xxhash64(r, element_at(tokens, r + 1)))")
    paths = reps.filter("n > 0").select("key", F.explode(roots).alias("path"), F.lit(None).cast("long").alias("parent"))
    leaves, deficits = [], []
    depth = 1
    while True:
        met = paths.groupBy("path").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        at = tmp.stored(paths.join(met, "path", "left") if depth > 1 else paths.join(met, "path"), "paths", rows=n * (last - first))
        if depth > 1:
            lost = math.log(1 - threshold**depth) - math.log(1 - threshold)
            stop = F.col("c").isNull() | (F.col("c") <= small) | (F.col("c") >= DENSE * F.col("parent"))
        else:
            lost, stop = 0.0, F.col("c") <= small
        leaves.append(at.filter("c > 1").filter(stop).select("path", "c", "key"))
        if lost:
            deficits.append(at.filter(stop).select("key", F.lit(lost).alias("deficit")))
        rest = at.filter(~stop)
        if rest.isEmpty():
            break
        if depth == 1:
            rest = rest.join(reps.select("key", "tokens"), "key")
        token = F.expr(f"element_at(tokens, cast(pmod(xxhash64(path, {depth}), {POSITIONS}) + 1 as int))")
        paths = rest.select("key", "tokens", F.xxhash64("path", token).alias("path"), F.col("c").alias("parent"))
        depth += 1
    union = leaves[0]
    for x in leaves[1:]:
        union = union.unionByName(x)
    cost = None
    for x in deficits:
        cost = x if cost is None else cost.unionByName(x)
    return union, cost


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, positions: int = POSITIONS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, copies, text_key.

    Two rows are linked if their texts are equal or their shingle sets have a Jaccard similarity of at least
    ``threshold``; ``n_links`` counts the other rows linked to this one, ``copies`` the rows of equal text (itself
    included), ``class_id`` is the least doc_id among rows connected by links. Null texts count as empty. Texts without
    words are linked to equal texts only. Null ids are never a class_id unless a class has no other. Other columns are
    not read. An empty table gives no rows. Each link between different texts is found with chance ``recall`` at least:
    sets whose paths are so deep that all sampled runs fall short of it are compared within their buckets of depth 1.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", F.unhex(text_key(F.col("text"))).alias("key"), "text")
    tmp = Scratch(docs.sparkSession)
    feats = stored(rows.mapInArrow(lean(_featurise(words)), "doc_id long, key binary, n int, sketch binary, tokens array<int>"), "features")
    n_rows = feats.count()
    per = feats.groupBy("key").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("tokens").alias("tokens"))
    reps = stored(per, "texts", rows=n_rows, each=TEXTS_A_FILE)

    edges, cost, active, ran = None, None, reps, 0
    need = math.log(1 - recall)
    step = math.ceil(need / math.log(1 - threshold))
    block = min(small, BLOCK)

    def met(leaves: DataFrame) -> DataFrame:
        sized = leaves.withColumn("blocks", F.ceil(F.col("c") / block).cast("int"))
        wide = _block_pairs(sized.join(reps.select("key", "n", "sketch"), "key"), "blocks").select("path", "lo", "hi", "key", "n", "sketch")
        # Each pair of blocks is a group of about 2 * block rows at most, wherever it lands.
        return wide.repartition("path", "lo", "hi").sortWithinPartitions("path", "lo", "hi").mapInArrow(lean(_brute(threshold, AGREE)), "a binary, b binary")

    while True:
        until = min(ran + step, positions)
        leaves, deficits = _paths(active, n_rows, ran, until, threshold, small, tmp)
        found = met(leaves)
        edges = found if edges is None else edges.unionByName(found)
        ran = until
        if deficits is None:
            break
        cost = deficits if cost is None else cost.unionByName(deficits)
        short = cost.groupBy("key").agg(F.sum("deficit").alias("d")).filter(F.col("d") + ran * math.log(1 - threshold) > need)
        active = tmp.stored(reps.join(short.select("key"), "key", "left_semi"), "active", rows=n_rows, each=TEXTS_A_FILE)
        if active.isEmpty():
            break
        if ran == positions:
            # No position is left to sample: buckets of depth 1 are compared whole, and ``step`` of them reach the recall.
            whole, _ = _paths(active, n_rows, 0, step, threshold, 1 << 62, tmp)
            edges = edges.unionByName(met(whole))
            break

    cand = components(edges)
    tmp.clear()
    cand = tmp.stored(cand.join(reps.select("key", "low", "copies", "n"), cand["node"] == F.col("key")).select("key", "root", "low", "copies", "n"), "candidates", rows=n_rows)
    blocks = _in_blocks(cand, threshold, block).withColumn("low", F.coalesce("low", F.lit(-(1 << 63))))
    texts = rows.withColumn("low", F.coalesce("doc_id", F.lit(-(1 << 63)))).select("key", "low", "text")
    # Sorted merge at every size: neither side has a bound that would allow a broadcast.
    one = texts.join(blocks.hint("merge"), ["key", "low"]).dropDuplicates(["key"]).select("root", "block", "others", "key", "copies", "text")
    sets = one.mapInArrow(lean(_shingled(words)), "root binary, block long, others array<long>, key binary, copies long, shingles array<long>")
    spread = _with_others(sets).select("root", "lo", "hi", "block", "key", "copies", "shingles")
    links = stored(spread.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi").mapInArrow(lean(_verify(threshold)), "key binary, root binary, links long"), "links")
    tmp.clear()

    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    in_group = groups.join(reps.select(F.col("key").alias("node"), "low"), "node")
    least = in_group.groupBy("root").agg(F.min("low").alias("class_id"))
    classes = join_uneven(in_group, least, "root").select(F.col("node").alias("key"), "class_id").join(counts, "key", "left")
    info = reps.select("key", "low", "copies").join(classes, "key", "left")
    info = info.select("key", "copies", F.when(F.col("class_id").isNull(), F.col("low")).otherwise(F.col("class_id")).alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return join_uneven(feats.select("doc_id", "key"), info, "key").select("doc_id", "class_id", "n_links", "copies", F.col("key").alias("text_key"))


def _shingled(words: int):
    schema = pa.schema([("root", pa.binary()), ("block", pa.int64()), ("others", pa.list_(pa.int64())), ("key", pa.binary()), ("copies", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [shingle_set(t, words) for t in part.column(5).to_pylist()]
                ends = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.binary()), part.column(1), part.column(2).cast(schema.types[2]), part.column(3).cast(pa.binary()), part.column(4), lists], schema=schema)

    return run


def keep_one(docs: DataFrame, links: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of ``jaccard_links``: the one whose id is the class_id.

    Rows are told apart by id and text, so an id that two texts share is no reason to drop either. Rows that repeat both are
    one row afterwards: the least by all columns; only where there are such rows is the table grouped. Null ids and texts
    are values like others. All columns stay, whatever their names.
    """
    k, i, t, r = (fresh(docs.columns, x) for x in ("key", "id", "text_key", "row"))
    key = F.unhex(text_key(text_or_empty(text_col)))
    gone = links.filter(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(i), F.col("text_key").alias(t)).distinct()
    marked = docs.withColumn(k, key)
    same = (F.col(k) == F.col(t)) & F.col(id_col).cast("long").eqNullSafe(F.col(i))
    kept = marked.join(gone, same, "left_anti")
    repeated = links.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("copies") > 1)).groupBy("doc_id", "text_key").count().filter("count > 1")
    if not repeated.isEmpty():
        again = repeated.select(F.col("doc_id").alias(i), F.col("text_key").alias(t))
        once = kept.join(again, same, "left_semi").groupBy(k, F.col(id_col).alias(i)).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias(r)).select(f"{r}.*", k).select(*(F.col(f"`{c}`") for c in marked.columns))
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.drop(k)


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_links(read_table(spark, sf_dir, "documents")).drop("text_key")
