"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). The flow runs over patterns, not
documents: source -> pattern by one edge for each repetition (capacity: the pattern's words; cost: 0, 1, 4, ... so that
repetition gets dearer), pattern -> each of its sources, source -> sink with the source's quota. Each pattern's flow is
then dealt to its documents: all take the whole repetitions, and seeded documents take one more until the rest is filled.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import read_table, small_table, stored, text_or_empty

#: The weights that sources get in turn, and the most a document is repeated.
WEIGHTS, REPEATS = (5, 2, 1), 3
#: Hash bins in which a pattern's seeded order is counted; only the bin at the cut is ranked by document.
BINS = 4096
#: Patterns are kept on the driver for the flow; more than this many are refused.
MAX_PATTERNS = 100_000


def targets(sizes: Sequence[int], weights: Sequence[float], cap: float = REPEATS) -> list[float]:
    """Shares of ``sum(sizes)`` by weight; one that would pass ``cap`` times its size stops there and the excess is shared anew."""
    total = float(sum(sizes))
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while open_ and left > 0:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w >= cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = cap * float(sizes[i])
        left = total - sum(out)
        open_ = [i for i in open_ if i not in set(full)]
    return out


class Flow:
    """Min-cost flow by successive shortest paths with potentials (Dijkstra)."""

    def __init__(self, nodes: int):
        self.to: list[int] = []
        self.cap: list[float] = []
        self.cost: list[float] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, cap: float, cost: float) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.cap += [cap, 0]
        self.cost += [cost, -cost]
        return len(self.to) - 2

    def run(self, s: int, t: int) -> float:
        n, sent = len(self.out), 0.0
        potential = [0.0] * n
        while True:
            dist, via = [float("inf")] * n, [-1] * n
            dist[s] = 0.0
            heap = [(0.0, s)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > dist[a]:
                    continue
                for e in self.out[a]:
                    if self.cap[e] > 0 and (x := d + self.cost[e] + potential[a] - potential[self.to[e]]) < dist[self.to[e]] - 1e-12:
                        dist[self.to[e]], via[self.to[e]] = x, e
                        heapq.heappush(heap, (x, self.to[e]))
            if via[t] < 0:
                return sent
            for i in range(n):
                if dist[i] < float("inf"):
                    potential[i] += dist[i]
            path, a = [], t
            while a != s:
                path.append(via[a])
                a = self.to[via[a] ^ 1]
            most = min(self.cap[e] for e in path)
            for e in path:
                self.cap[e] -= most
                self.cap[e ^ 1] += most
            sent += most


def route(patterns: Sequence[tuple[tuple[int, ...], int]], quotas: Sequence[int], repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words each pattern (its sources, its words) sends to each source, at least repetition cost; quotas may stay unfilled."""
    p, q = len(patterns), len(quotas)
    flow = Flow(p + q + 2)
    s, t = p + q, p + q + 1
    sends: list[dict[int, int]] = []
    for i, (members, words) in enumerate(patterns):
        for k in range(repeats):
            flow.edge(s, i, words, k * k)
        sends.append({j: flow.edge(i, p + j, repeats * words, 0) for j in members})
    for j, x in enumerate(quotas):
        flow.edge(p + j, t, x, 0)
    flow.run(s, t)
    return [{j: int(flow.cap[e ^ 1]) for j, e in x.items()} for x in sends]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix(rows: DataFrame, sources: list[str] | Column, size: str = "size", ids: Sequence[str] = ("doc_id",), weights: dict | None = None, repeats: int = REPEATS, seed: int = 0, wide: bool = False) -> tuple[DataFrame, list[dict]]:
    """``rows`` with ``pattern`` (the sorted distinct sources of the row) and ``taken`` (long), and the report of each source.

    ``sources`` is an array column of names; null is a source of its own, put last. ``weights`` by name; without it
    sources in code-point order weigh 5, 2, 1 in turn. A row's ``taken`` is at most ``repeats`` times its size; rows of size
    0 take 0. The last seeded row of a pattern gives just the words that are missing. Only per-pattern sums (at most
    MAX_PATTERNS rows) reach the driver. Which rows take one more repetition is decided by a hash of ``ids`` and the seed:
    reruns agree, and rows equal in all ``ids`` and size are interchangeable. With ``wide`` only ids and sizes go through the
    order of the bin at the cut, and the rows of that bin fetch their share by a join.
    """
    names = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.when(s.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), s)))))
    rows = rows.withColumn("__key", names)
    sums = rows.groupBy("__key").agg(F.sum(size).alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError("too many membership patterns")
    sums = sorted(((tuple(r["__key"]), int(r["words"] or 0)) for r in sums), key=lambda x: tuple(n.encode("utf-8", "surrogatepass") for n in x[0]))
    order = sorted({n for k, _ in sums for n in k}, key=lambda n: n.encode("utf-8", "surrogatepass"))
    at = {n: i for i, n in enumerate(order)}
    # A document of several sources counts in equal parts for the size of each.
    sizes = [0.0] * len(order)
    for k, words in sums:
        for n in k:
            sizes[at[n]] += words / len(k)
    sizes = [int(s) if s == int(s) else s for s in sizes]
    w = [(weights[n[1:] if n[0] == "0" else None] if weights else WEIGHTS[i % len(WEIGHTS)]) for i, n in enumerate(order)]
    goal = targets(sizes, w, repeats)
    sent = route([(tuple(at[n] for n in k), words) for k, words in sums], [int(round(g)) for g in goal], repeats)
    got = [0] * len(order)
    for x in sent:
        for j, v in x.items():
            got[j] += v
    report = [{"source": n[1:] if n[0] == "0" else None, "size": sizes[i], "target": goal[i], "flow": got[i]} for i, n in enumerate(order)]
    plan = [(list(k), words, min(sum(x.values()) // words, repeats) if words else 0, sum(x.values())) for (k, words), x in zip(sums, sent, strict=True)]
    spark = rows.sparkSession
    plan_df = small_table(spark, [(k, int(b), int(f - b * words)) for k, words, b, f in plan], "__key array<string>, __base long, __rest long")

    joined = rows.join(F.broadcast(plan_df), "__key")
    joined = joined.withColumn("__h", F.xxhash64(F.lit(seed), *[F.col(i) for i in ids], F.col(size)))
    joined = joined.withColumn("__bin", F.pmod("__h", F.lit(BINS)))
    bins = joined.groupBy("__key", "__bin", "__rest").agg(F.sum(size).alias("__n"))
    # Patterns times BINS sums, ranked per pattern: bounded, whatever the number of documents.
    run = F.sum("__n").over(W.partitionBy("__key").orderBy("__bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = bins.withColumn("__run", run).filter((F.col("__run") >= F.col("__rest")) & (F.col("__run") - F.col("__n") < F.col("__rest"))).groupBy("__key").agg(F.min("__bin").alias("__cut"), F.min_by(F.col("__run") - F.col("__n"), "__bin").alias("__before"))
    joined = joined.join(F.broadcast(cut), "__key", "left")
    # Only rows of the bin at the cut need an exact order; all others are decided by their bin.
    at_cut = (F.col("__rest") > 0) & F.col("__bin").eqNullSafe(F.col("__cut"))
    order_by = [F.col("__h"), *[F.col(i) for i in ids], F.col(size)]
    before = F.coalesce(F.sum(size).over(W.partitionBy("__key").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    more = F.greatest(F.lit(0), F.least(F.col(size), F.col("__rest") - F.col("__before") - before))
    edge = joined.filter(at_cut)
    if wide:
        # Equal rows are numbered, so that each finds a share of its own.
        edge = edge.withColumn("__nth", F.row_number().over(W.partitionBy("__key", "__h", *ids, size).orderBy(F.lit(0))))
        same = ["__key", "__h", *ids, size, "__nth"]
        share = edge.select(*same, more.alias("__more")).select(*(F.col(c).alias(f"__at_{i}") for i, c in enumerate(same)), "__more")
        found = F.lit(True)
        for i, c in enumerate(same):
            found = found & F.col(c).eqNullSafe(F.col(f"__at_{i}"))
        edge = edge.join(share, found).drop("__nth", *(f"__at_{i}" for i in range(len(same))))
    else:
        edge = edge.withColumn("__more", more)
    whole = (F.col("__rest") > 0) & (F.col("__cut").isNull() | (F.col("__bin") < F.col("__cut")))
    plain = joined.filter(~at_cut).withColumn("__more", F.when(whole, F.col(size)).otherwise(0))
    both = edge.unionByName(plain)
    out = both.withColumn("taken", (F.col(size) * F.col("__base") + F.when(F.col("__base") < repeats, F.col("__more")).otherwise(0)).cast("long"))
    pattern = F.transform("__key", lambda n: F.when(n == "1", F.lit(None).cast("string")).otherwise(F.substring(n, 2, 1 << 30)))
    return out.withColumn("pattern", pattern).drop("__key", "__base", "__rest", "__h", "__bin", "__cut", "__before", "__more"), report


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """Mixes documents of one source each: doc_id, source, size, source_size, target, taken.

    Size is the number of words; null texts have none. Null sources are one source, the last. Null ids and repeated rows
    are rows like others. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_or_empty(text_col)).alias("size"))
    # Words are counted once; what follows reads three narrow columns.
    taken, report = mix(stored(rows, "sizes"), F.array("source"), repeats=repeats, seed=seed)
    spark = docs.sparkSession
    per = small_table(spark, [(r["source"], int(r["size"]), float(r["target"])) for r in report], "__s string, source_size long, target double")
    return taken.join(F.broadcast(per), F.col("source").eqNullSafe(F.col("__s")), "left").select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """``docs`` as the mix takes them: rows that it leaves out are gone, rows that it repeats are there as often.

    A row that is to give a part of its words is there as a whole. Rows without words are kept: they cost nothing. Null texts
    have no words, null sources are one source, an empty table gives no rows, and all columns stay, whatever their names. The
    order within a source is by a hash of all columns. Texts are not shuffled, but for those in the hash bin at the cut, which
    are dealt by that hash.
    """
    rows = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(source_col).cast("string").alias("__source"), word_count(text_or_empty(text_col)).alias("__size"), F.xxhash64(*docs.columns).alias("__row"))
    taken, _ = mix(rows, F.array("__source"), size="__size", ids=("__row",), repeats=repeats, seed=seed, wide=True)
    times = F.when(F.col("__size") == 0, 1).otherwise(F.ceil(F.col("taken") / F.greatest(F.col("__size"), F.lit(1)))).cast("int")
    return taken.select("__doc", F.explode(F.array_repeat(F.lit(0), times))).select("__doc.*")


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents")).drop("source")
