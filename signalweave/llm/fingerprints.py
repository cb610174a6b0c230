"""Document fingerprints as invertible Bloom lookup tables over paragraphs.

A paragraph is a line, or a sentence of a line of several. Its 64-bit digest goes into one cell of each of three subtables; a
cell holds a count, the XOR of digests and the XOR of their checksums. Subtracting the cells of two versions leaves the
digests that differ; cells that hold one of them are peeled until none is left. Fingerprints have a fixed small size, which
suffices for small edits. Where peeling stops short it is retried with four times the cells: the digests are dealt by two of
their bits to four tables, each of which is subtracted and peeled by itself, and so on for those tables that fail again.
The counts of a failed table tell about how many digests differ; retries that this says would fail are passed over.

Native: higher-order functions build, subtract and peel all tables in the row, in time proportional to the paragraphs for
each retry; the only exchange is that which brings a document to its neighbour.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import read_table, small_table, text_key, text_or_empty

#: Cells of each of the three subtables (a power of two), and rounds of peeling.
CELLS, ROUNDS = 8, 10
#: Retries; each has four times the cells of the one before. Tables with more differences than this by estimate are not tried.
RETRIES, FULL = 9, 12
#: Rows in a bucket of the id order, and the most buckets (their first rows are kept on the driver).
BUCKET, MAX_BUCKETS = 1000, 65536

_PARAGRAPH = r"\n+|(?<=[.!?])\s+"
_KEY = "struct<k:bigint,c:int,s0:int,s1:int,s2:int>"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs of a text."""
    return F.array_distinct(F.transform(F.filter(F.split(text, _PARAGRAPH), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _slot(k: Column, j: int, cells: int) -> Column:
    """The cell of digest k in subtable j, by 21 bits of the digest for each; subtables are numbered through."""
    return F.shiftright(k, 21 * j).bitwiseAND(F.lit(cells - 1)).cast("int") + j * cells


def placed(keys: Column, cells: int = CELLS) -> Column:
    """Digests with their checksums and their three cells."""
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.hash(k).alias("c"), *(_slot(k, j, cells).alias(f"s{j}") for j in range(3))))


def sketch(keys: Column, cells: int = CELLS) -> Column:
    """The table of a set of ``placed`` digests: subtable 0, then 1 and 2, ``cells`` each."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("c"))
    add = lambda s, x: F.struct((s["n"] + 1).alias("n"), s["k"].bitwiseXOR(x["k"]).alias("k"), s["c"].bitwiseXOR(x["c"]).alias("c"))

    def table(j: int) -> Column:
        return F.transform(F.sequence(F.lit(j * cells), F.lit((j + 1) * cells - 1)), lambda i: F.aggregate(F.filter(keys, lambda x: x[f"s{j}"] == i), zero, add))

    return F.concat(*(table(j) for j in range(3)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")))


def difference(cells: Column, sizes: Column, size: int = CELLS) -> Column:
    """Estimated number of digests in a difference of tables, by the squares of its counts; ``sizes`` is the sets' difference in size."""
    squares = F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + c["n"].cast("long") * c["n"])
    return (size * squares / 3 - sizes * sizes) / (size - 1)


def peel(cells: Column, size: int = CELLS, rounds: int = ROUNDS) -> Column:
    """(plus, minus) digests recovered from a difference, as a struct of two arrays; null if cells remain.

    A cell is pure if its count is 1 or -1 and the checksum is that of its digest. Each round takes the digests of all pure
    cells out of their three cells.
    """
    clear = lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0)
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["c"] == F.hash(c["k"]))

    def state(cells: Column, plus: Column, minus: Column) -> Column:
        side = lambda found, sign: F.array_distinct(F.transform(F.filter(found, lambda c: c["n"] == sign), lambda c: c["k"]))
        both = _bound(F.filter(cells, pure), lambda found: F.struct(side(found, 1).alias("p"), side(found, -1).alias("m")))
        return F.struct(cells.alias("cells"), plus.alias("plus"), minus.alias("minus"), both.alias("found"))

    def without(c: Column, i: Column, found: Column) -> Column:
        take = lambda s, x: F.struct((s["n"] - x["n"]).alias("n"), s["k"].bitwiseXOR(x["k"]).alias("k"), s["c"].bitwiseXOR(x["c"]).alias("c"))
        return F.aggregate(F.filter(found, lambda x: F.call_function("shiftright", x["m"], i).bitwiseAND(F.lit(1)) == 1), c, take)

    def signed(keys: Column, sign: int) -> Column:
        def one(k: Column) -> Column:
            m = F.lit(0).cast("long")
            for j in range(3):
                m = m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), _slot(k, j, size)))
            return F.struct(k.alias("k"), m.alias("m"), F.hash(k).alias("c"), F.lit(sign).alias("n"))

        return F.transform(keys, one)

    def step(s: Column, _: Column) -> Column:
        found = s["found"]
        left = _bound(F.concat(signed(found["p"], 1), signed(found["m"], -1)), lambda f: F.transform(s["cells"], lambda c, i: without(c, i, f)))
        again = _bound(left, lambda cells: state(cells, F.concat(s["plus"], found["p"]), F.concat(s["minus"], found["m"])))
        return F.when((F.size(found["p"]) == 0) & (F.size(found["m"]) == 0), s).otherwise(again)

    none = F.array().cast("array<bigint>")
    end = _bound(cells, lambda c: F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state(c, none, none), step))
    return _bound(end, lambda s: F.when(F.forall(s["cells"], clear), F.struct(s["plus"].alias("plus"), s["minus"].alias("minus"))))


def _branch(k: Column, level: Column) -> Column:
    """Two bits of a digest for each retry; none of them chooses a cell."""
    return F.call_function("shiftright", k, F.lit(3) + level * 2).bitwiseAND(F.lit(3))


def retried(a: Column, b: Column, estimate: Column | None = None, cells: int = CELLS, retries: int = RETRIES) -> Column:
    """How many digests of each of two sets are not in the other, as struct (plus, minus, left); the sets are ``placed`` for ``cells``.

    Each retry deals the digests of every table that is left to four. Where ``estimate`` (of the differences in all) says that
    tables would have more than FULL, they are dealt on at once. ``left`` counts the tables that could not be peeled after
    all retries; plus and minus miss their digests then.
    """
    pair = f"struct<a:array<{_KEY}>,b:array<{_KEY}>>"
    begin = F.lit(0) if estimate is None else F.ceil(F.log2(F.greatest(estimate, F.lit(1.0)) / FULL) / 2).cast("int") - 1

    def split(groups: Column, level: Column) -> Column:
        part = lambda g, q: F.struct(F.filter(g["a"], lambda x: _branch(x["k"], level) == q).alias("a"), F.filter(g["b"], lambda x: _branch(x["k"], level) == q).alias("b"))
        return F.flatten(F.transform(groups, lambda g: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: part(g, q))))

    def tried(g: Column, level: Column, begin: Column) -> Column:
        worth = (level >= begin) & (F.abs(F.size(g["a"]) - F.size(g["b"])) <= 3 * cells)
        got = F.when(worth, peel(subtract(sketch(g["a"], cells), sketch(g["b"], cells)), cells))
        return F.struct(g["a"].alias("a"), g["b"].alias("b"), got.alias("d"))

    def step(s: Column, level: Column) -> Column:
        def count(done: Column, side: str) -> Column:
            return s[side] + F.aggregate(done, F.lit(0), lambda n, t: n + F.coalesce(F.size(t["d"][side]), F.lit(0)))

        def after(t: Column) -> Column:
            failed = F.transform(F.filter(t, lambda x: x["d"].isNull()), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
            done = F.filter(t, lambda x: x["d"].isNotNull())
            return F.struct(failed.alias("groups"), s["begin"].alias("begin"), count(done, "plus").alias("plus"), count(done, "minus").alias("minus"))

        made = F.transform(split(s["groups"], level), lambda g: tried(g, level, s["begin"]))
        return F.when(F.size(s["groups"]) == 0, s).otherwise(_bound(made, after))

    start = F.struct(F.array(F.struct(a.alias("a"), b.alias("b"))).cast(f"array<{pair}>").alias("groups"), begin.alias("begin"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(retries - 1)), start, step)
    return _bound(end, lambda s: F.struct(s["plus"].alias("plus"), s["minus"].alias("minus"), F.size(s["groups"]).alias("left")))


def likeness(a: Column, b: Column, only_a: Column, only_b: Column) -> Column:
    """Jaccard similarity from the sizes of two sets and of their differences; 1 for two empty sets."""
    both = a - only_a
    union = both + only_a + only_b
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _written(cells: Column) -> Column:
    """A table as text: count, digest and checksum of each cell."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["n"].cast("string"), F.lower(F.hex(c["k"])), F.lower(F.hex(c["c"])))), " ")


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are greater than ``value``: by a chunk of them, then inside it."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    greater = lambda values: F.size(F.filter(values, lambda b: value < b))
    later = greater(F.lit([c[0] for c in chunks]).cast("array<bigint>"))
    # The chunk that begins at or before the value; all chunks after it are greater.
    at = F.lit(len(chunks)) - later
    inside = greater(F.element_at(F.lit(chunks).cast("array<array<bigint>>"), at.cast("int")))
    return F.when(at == 0, F.lit(len(bounds))).otherwise(F.greatest(F.lit(0), F.lit(len(bounds)) - at * step) + inside)


def with_next(docs: DataFrame, rows_per_bucket: int = BUCKET) -> DataFrame:
    """doc_id, text, keys and the next document's text and keys, by descending doc_id; the first follows the last.

    Ids are cut into buckets at approximate quantiles; each bucket also gets a copy of the first row of the next one,
    so that the order never passes through one task. Equal ids are in the order of their texts' digests; null ids come last
    and are cut into buckets by those digests.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    n = rows.agg(F.count("doc_id").alias("ids"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    buckets, last = (max(1, min(n[k] // rows_per_bucket, MAX_BUCKETS)) for k in ("ids", "nulls"))
    bounds = sorted({int(b) for b in rows.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)}) if buckets > 1 else []
    rows = rows.withColumn("tie", text_key(F.col("text")))
    by_tie = F.floor(F.conv(F.substring("tie", 1, 8), 16, 10).cast("long") * last / (1 << 32))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1) + by_tie).otherwise(_bucket(F.col("doc_id"), bounds)).cast("int"))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("d"), F.col("tie").alias("t"))).alias("f")).collect()
    firsts = sorted((r["bucket"], r["f"]["d"], r["f"]["t"]) for r in firsts)
    guests = [(p, None if d is None else -d, t, firsts[i - 1][0]) for i, (p, d, t) in enumerate(firsts)]
    g = small_table(docs.sparkSession, guests, "gb int, gd long, gt string, guest_of int")
    marked = rows.join(F.broadcast(g), (F.col("bucket") == F.col("gb")) & F.col("doc_id").eqNullSafe(F.col("gd")) & (F.col("tie") == F.col("gt")), "left")
    place = F.when(F.col("guest_of").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")))).otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")), F.struct(F.col("guest_of").alias("b"), F.lit(True).alias("g"))))
    placed_rows = marked.select("doc_id", "text", "tie", digests(F.col("text")).alias("keys"), F.explode(place).alias("at")).select("doc_id", "text", "tie", "keys", F.col("at.b").alias("bucket"), F.col("at.g").alias("guest"))
    order = W.partitionBy("bucket").orderBy(F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("tie"))
    led = placed_rows.withColumn("next", F.lead(F.struct("text", "keys")).over(order))
    return led.filter(~F.col("guest")).select("doc_id", "text", "keys", F.col("next.text").alias("next_text"), F.col("next.keys").alias("next_keys"))


def fingerprints(docs: DataFrame, cells: int = CELLS, retries: int = RETRIES, rows_per_bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    retried, compared.

    The edited text has the last floor(n/3) code points replaced by the first as many of the next document's text. Likeness is
    the Jaccard similarity of paragraph sets, as recovered from tables; ``retried`` counts the comparisons (0 to 2) that needed
    larger ones, ``compared`` those that no retry could peel, where the digest sets themselves are compared. Null texts count
    as empty; texts without paragraphs are alike only to each other. Equal texts have equal fingerprints. Only doc_id and text
    are read. An empty table gives no rows.
    """
    led = with_next(docs, rows_per_bucket)
    n = F.length("text")
    led = led.withColumn("cut", F.floor(n / 3).cast("int")).withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cut)"), F.expr("substring(next_text, 1, cut)")))
    led = led.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), "keys", "next_keys", digests(F.col("edited")).alias("edited_keys"))
    led = led.withColumns({k: placed(F.col(k), cells) for k in ("keys", "edited_keys", "next_keys")})
    led = led.withColumns({"own": sketch(F.col("keys"), cells), "other": sketch(F.col("edited_keys"), cells), "after": sketch(F.col("next_keys"), cells)})
    led = led.withColumns({"cut_e": subtract(F.col("own"), F.col("other")), "cut_x": subtract(F.col("own"), F.col("after"))})

    def first(table: str) -> Column:
        return _bound(peel(F.col(table), cells), lambda d: F.when(d.isNotNull(), F.struct(F.size(d["plus"]).alias("plus"), F.size(d["minus"]).alias("minus"), F.lit(0).alias("left"))))

    def again(table: str, keys: str) -> Column:
        return retried(F.col("keys"), F.col(keys), difference(F.col(table), F.size("keys") - F.size(keys), cells), cells, retries)

    led = led.withColumns({"e": first("cut_e"), "x": first("cut_x")})
    led = led.withColumn("retried", F.col("e").isNull().cast("int") + F.col("x").isNull().cast("int"))
    led = led.withColumns({"e": F.coalesce("e", again("cut_e", "edited_keys")), "x": F.coalesce("x", again("cut_x", "next_keys"))})
    sound = lambda c, keys: (F.col(f"{c}.left") == 0) & (F.size("keys") - F.col(f"{c}.plus") == F.size(keys) - F.col(f"{c}.minus"))
    led = led.withColumns({"sound_e": sound("e", "edited_keys"), "sound_x": sound("x", "next_keys")})

    def near(c: str, keys: str) -> Column:
        a, b = F.size("keys"), F.size(keys)
        only = lambda one, two: F.size(F.array_except(F.col(one)["k"], F.col(two)["k"]))
        return F.when(F.col(f"sound_{c}"), likeness(a, b, F.col(f"{c}.plus"), F.col(f"{c}.minus"))).otherwise(likeness(a, b, only("keys", keys), only(keys, "keys")))

    return led.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _written(F.col("own")).alias("fingerprint"),
        _written(F.col("other")).alias("edited_fingerprint"),
        near("e", "edited_keys").alias("near_edited"),
        near("x", "next_keys").alias("near_next"),
        "retried",
        ((~F.col("sound_e")).cast("int") + (~F.col("sound_x")).cast("int")).alias("compared"),
    )


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
