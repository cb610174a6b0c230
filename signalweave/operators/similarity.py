"""Similarity of texts: pairs come from shared tokens, shared grams of keys, or classes. Greedy selection and clusters: ``greedy``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from . import setjoin


def _with_measures(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"), (F.col("shared") / F.least("na", "nb")).alias("overlap"))


def token_pairs(df: DataFrame, id_col: str, tokens: str, least_overlap: float) -> DataFrame:
    """(a, b, shared, jaccard, overlap) of all pairs with a < b whose overlap coefficient is ``least_overlap`` or more."""
    return _with_measures(setjoin.set_pairs(df, id_col, tokens, least_overlap))


def token_links(df: DataFrame, id_col: str, tokens: str, least_overlap: float) -> DataFrame:
    """(a, b, same, shared, jaccard, overlap): ``token_pairs`` without expanding copies. Rows with equal token sets are a class: each is
    linked (``same``) to its first, the smallest id, and the first stands for all of them in the pairs of different sets."""
    # Stored before anything else is derived, so that texts are searched once.
    d = checkpointed(df.select(F.col(id_col).cast("long").alias("id"), F.lit(None).cast("string").alias("g"), setjoin.hashed(F.col(tokens)).alias("h"))).filter(F.size("h") > 0)
    keyed = d.withColumn("c", setjoin.class_of("h"))
    first = keyed.groupBy("c").agg(F.min("id").alias("first"))
    copies = checkpointed(keyed.select("c", "id", F.size("h").alias("n")).join(first, "c").filter("id <> first").select("first", "id", "n"))
    same = copies.select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(True).alias("same"), F.col("n").alias("shared"), F.lit(1.0).alias("jaccard"), F.lit(1.0).alias("overlap"))
    others = _with_measures(setjoin.block_pairs(setjoin.packed(keyed.join(copies.select("id"), "id", "left_anti")), least_overlap))
    return same.unionByName(others.withColumn("same", F.lit(False)).select(same.columns))


def same_issue(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two findings are one issue, by Jaccard similarity of their token sets.

    Keys: doc, kind, headline, structure, affected. Within a document: headline >= .45, or structure >= .50, or the same kind
    with affected >= .50 and structure >= .34. Across documents: the same kind, affected >= .55, and headline or structure >= .68.
    """
    from ..functions.text import jaccard

    h, s, g = (jaccard(a[k], b[k]) for k in ("headline", "structure", "affected"))
    kind = a["kind"] == b["kind"]
    within = (h >= 0.45) | (s >= 0.50) | (kind & (g >= 0.50) & (s >= 0.34))
    across = kind & (g >= 0.55) & ((h >= 0.68) | (s >= 0.68))
    return F.when(a["doc"] == b["doc"], within).otherwise(across)


def near_duplicate_pair(a: dict[str, Column], b: dict[str, Column], least: float = 0.66) -> Column:
    """The full near-duplicate predicate as a column. Keys: key, tokens, markers, families, page, values, subject, day.

    Both have the same locked subject and a common page or day; or one key contains the other; or two topic markers are shared; or a
    family is shared on the same page or with a shared value; or the overlap coefficient reaches ``least``. A branch whose keys are not
    given does not apply; null is no match. Rows with an empty key match nothing by the other branches' terms either where they have none.
    """
    from ..functions.text import overlap

    common = lambda k: F.size(F.array_intersect(a[k], b[k]))
    no = F.lit(False)
    sure = lambda c: F.coalesce(c, no)
    page = sure(a["page"] == b["page"]) if "page" in a else no
    day = sure(a["day"] == b["day"]) if "day" in a else no
    locked = sure((a["subject"] == b["subject"]) & (F.length(a["subject"]) > 0)) & (page | day) if "subject" in a else no
    contained = sure((F.length(a["key"]) > 0) & (F.length(b["key"]) > 0) & (F.contains(a["key"], b["key"]) | F.contains(b["key"], a["key"]))) if "key" in a else no
    marked = sure(common("markers") >= 2) if "markers" in a else no
    related = sure(common("families") > 0) & (page | (sure(common("values") > 0) if "values" in a else no)) if "families" in a else no
    alike = sure(overlap(a["tokens"], b["tokens"]) >= least) if "tokens" in a else no
    return locked | contained | marked | related | alike


#: Lengths in bytes of the grams by which contained keys are found, and the most places of the bitmap of those looked for, as a power of two.
_GRAMS, _MOST_BITS = (1, 2, 4, 8, 16), 30


def _grams(key: bytes) -> dict[int, np.ndarray]:
    """By length, a 64-bit hash of the gram at each position."""
    h, p, out = np.frombuffer(key, np.uint8).astype(np.uint64), 0x9E3779B97F4A7C15, {}
    for q in _GRAMS:
        if len(key) < q:
            break
        if q > 1:
            h, p = h[: len(h) - q // 2] + h[q // 2 :] * np.uint64(p), p * p % 2**64
        x = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(q * 0xA0761D6478BD642F % 2**64)
        out[q] = x ^ (x >> np.uint64(29))
    return out


def contained_in(needles: DataFrame, texts: DataFrame, needle_id: str, text_id: str, key: str) -> DataFrame:
    """(short, long): the ids of all needles and texts where the ``key`` of the text contains that of the needle.

    Ids are of any type; needles should be distinct, empty and null ones match nothing. Exact: each needle looks for one gram of its
    own, the one in the fewest texts of four spread over it, among the grams of all texts (bytes of UTF-8, where substrings are the
    same); what is found is compared. A bitmap with 128 places for each gram looked for, up to 2^30 (128 MB), keeps other grams from being
    written, and grams of a length that no needle looks for are not made; a gram with the same hash as another only adds a comparison.
    """
    small = needles.select(F.col(needle_id).alias("short"), F.col(key).alias("ks")).filter(F.length("ks") > 0)
    large = texts.select(F.col(text_id).alias("long"), F.col(key).alias("kl")).filter(F.length("kl") > 0)

    def wanted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at, grams, sizes = [], [], []
            for n, k in enumerate(frame["ks"]):
                last = list(_grams(k.encode()).values())[-1]
                own = np.unique(last[[0, (len(last) - 1) // 3, 2 * (len(last) - 1) // 3, len(last) - 1]])
                at.append(np.full(len(own), n, np.int64))
                grams.append(own)
                sizes.append(np.full(len(own), max(q for q in _GRAMS if q <= len(k.encode())), np.int32))
            if at:
                yield pd.DataFrame({"short": frame["short"].to_numpy()[np.concatenate(at)], "gram": np.concatenate(grams).view(np.int64), "size": np.concatenate(sizes)})

    looked = checkpointed(small.mapInPandas(wanted, f"short {small.schema['short'].dataType.simpleString()}, gram long, size int"))
    known = looked.agg(F.count(F.lit(1)).alias("n"), F.collect_set("size").alias("sizes")).first()
    width, lengths = min(max((128 * known["n"]).bit_length(), 16), _MOST_BITS), frozenset(known["sizes"])
    looked = looked.drop("size")
    place = F.shiftrightunsigned("gram", 64 - width) + 1
    maps = looked.groupBy(F.bitmap_bucket_number(place).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")).collect()
    bits = np.zeros(max(2 ** (width - 3), 4096), np.uint8)
    for r in maps:
        bits[(r["n"] - 1) * 4096 : r["n"] * 4096] = np.frombuffer(r["m"], np.uint8)

    def there(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at, grams = [], []
            for n, k in enumerate(frame["kl"]):
                for size, x in _grams(k.encode()).items():
                    if size not in lengths:
                        continue
                    b = x >> np.uint64(64 - width)
                    own = np.unique(x[(bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1])
                    at.append(np.full(len(own), n, np.int64))
                    grams.append(own)
            if at:
                yield pd.DataFrame({"long": frame["long"].to_numpy()[np.concatenate(at)], "gram": np.concatenate(grams).view(np.int64)})

    found = checkpointed(large.mapInPandas(there, f"long {large.schema['long'].dataType.simpleString()}, gram long"))
    rare = looked.join(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram").groupBy("short").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    met = rare.join(found, "gram").select("short", "long")
    return met.join(small, "short").join(large, "long").filter(F.contains("kl", "ks")).select("short", "long")


def contained_pairs(df: DataFrame, id_col: str, key: str) -> DataFrame:
    """(short, long): ids of all pairs of rows whose keys differ and where one key contains the other. Keys are not empty and distinct."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(key).alias("key"))
    return contained_in(rows, rows, "id", "id", "key").filter(F.col("short") != F.col("long"))


def near_duplicate_links(df: DataFrame, id_col: str, least: float = 0.66) -> DataFrame:
    """(branch, class, a, b): all pairs for which ``near_duplicate_pair`` holds, without expanding classes into pairs.

    ``df`` has key, tokens, markers, families, page and values. Rows with a class state that ``a`` is a member of it, and any two members of
    one branch and class are near duplicates: ``key`` and ``tokens`` (equal ones; the class is the smallest id), ``markers`` (two of them),
    ``page`` (with a family) and ``value`` (with a family). Rows without a class are pairs a < b: ``contained`` of classes ``key`` and
    ``overlap`` of classes ``tokens``, each class standing for its members by its smallest id, a single row by itself.
    """
    own = {"key": F.when(F.length("key") > 0, F.sha2("key", 256)), "h": setjoin.hashed(F.col("tokens")), "m": F.array_sort(F.array_distinct("markers")), "f": F.array_distinct("families"), "v": F.array_distinct("values")}
    # Stored, so that texts are read once for all branches; keys themselves are only read to be searched.
    d = checkpointed(df.select(F.col(id_col).cast("long").alias("id"), F.col("page").cast("string").alias("page"), *[c.alias(n) for n, c in own.items()]))

    def members(rows: DataFrame, branch: str, label: str | None = None) -> DataFrame:
        """Of (id, c), the classes with two members or more."""
        n = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("string").alias("first")).filter("n > 1")
        return rows.join(n, "c").select(F.lit(branch).alias("branch"), F.col(label or "first").alias("class"), F.col("id").alias("a"), F.lit(None).cast("long").alias("b"))

    def firsts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("c").agg(F.min("id").alias("id")).select("id")

    pair = lambda x, y: F.concat_ws(" + ", x, y)
    pair = lambda x, y: F.concat_ws(" + ", x, y)
    m = F.col("m")
    keys = d.filter("key is not null").select("id", F.col("key").alias("c"))
    sets = d.filter(F.size("h") > 0).select("id", setjoin.class_of("h").alias("c"))
    twos = d.select("id", F.explode(F.flatten(F.transform(m, lambda x, i: F.transform(F.slice(m, i + 2, F.size(m)), lambda y: pair(x, y))))).alias("c"))
    families = d.select("id", "page", "v", F.explode("f").alias("f"))
    pages = families.filter("page is not null").select("id", pair(F.col("f"), F.col("page")).alias("c"))
    values = families.select("id", "f", F.explode("v").alias("v")).filter("v is not null").select("id", pair(F.col("f"), F.col("v").cast("string")).alias("c"))
    out = members(keys, "key").unionByName(members(sets, "tokens"))
    for rows, branch in ((twos, "markers"), (pages, "page"), (values, "value")):
        out = out.unionByName(members(rows, branch, "c"))
    link = lambda pairs, branch, x, y: pairs.select(F.lit(branch).alias("branch"), F.lit(None).cast("string").alias("class"), F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    texts = checkpointed(df.select(F.col(id_col).cast("long").alias("id"), "key").join(firsts(keys), "id", "left_semi"))
    contained = contained_pairs(texts, "id", "key")
    blocks = setjoin.packed(d.join(firsts(sets), "id", "left_semi").select("id", F.lit(None).cast("string").alias("g"), "h"))
    overlapping = setjoin.block_pairs(blocks, least)
    return out.unionByName(link(contained, "contained", "short", "long")).unionByName(link(overlapping, "overlap", "a", "b"))


def suppress_neighbours(df: DataFrame, group: str, at: str, score: str, k: int) -> DataFrame:
    """Greedy choice per group of the ``k`` best positions, none next to a chosen one; ties go to the earlier position."""
    rows = df.select(F.col(group).cast("long").alias("g"), F.col(at).cast("long").alias("p"), F.col(score).cast("double").alias("s"))
    rows = rows.repartition("g").sortWithinPartitions("g", F.desc("s"), "p")

    def pick(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, used, n = None, set(), 0
        for frame in frames:
            out = []
            for g, p, _ in frame.itertuples(index=False, name=None):
                if g != now:
                    now, used, n = g, set(), 0
                if n < k and p not in used:
                    used |= {p - 1, p, p + 1}
                    n += 1
                    out.append((g, p, n))
            yield pd.DataFrame(out, columns=["g", "p", "pick"])

    return rows.mapInPandas(pick, "g long, p long, pick long").withColumnRenamed("g", group).withColumnRenamed("p", at)


def unique_with_reasons(df: DataFrame, order: Sequence[str], family: str, issue: str, id_col: str, cap: int) -> DataFrame:
    """(id, outcome): KEPT for rows that, in order, repeat no kept family or issue, up to ``cap``; the others have the reason
    DUPLICATE_FAMILY, DUPLICATE_ISSUE or OVER_CAP, a duplicate's before the cap's.

    Each kept row is found by one distributed minimum over the rows that do not clash with those before it, so there are ``cap``
    short passes and no ordered one; a row's reason then depends on the kept rows before it alone. ``order`` must be total.
    """
    at = F.struct(*order)
    kept = []
    for _ in range(cap):
        rest = df
        for k in kept:
            rest = rest.filter(~F.col(family).eqNullSafe(F.lit(k[family])) & ~F.col(issue).eqNullSafe(F.lit(k[issue])))
        one = rest.select(*dict.fromkeys([*order, family, issue, id_col])).orderBy(*order).limit(1).collect()
        if not one:
            break
        kept.append(one[0])
    same_family, same_issue_, is_kept = F.lit(False), F.lit(False), F.lit(False)
    for k in kept:
        after = at > F.struct(*[F.lit(k[o]).alias(o) for o in order])
        same_family = same_family | (after & F.col(family).eqNullSafe(F.lit(k[family])))
        same_issue_ = same_issue_ | (after & F.col(issue).eqNullSafe(F.lit(k[issue])))
        is_kept = is_kept | (at == F.struct(*[F.lit(k[o]).alias(o) for o in order]))
    return df.select(id_col, F.when(is_kept, "KEPT").when(same_family, "DUPLICATE_FAMILY").when(same_issue_, "DUPLICATE_ISSUE").otherwise("OVER_CAP").alias("outcome"))
