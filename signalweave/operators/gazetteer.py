"""Names of a dictionary in texts: matched by words with a join, longest names first; places of claims that no quote has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Distinct first words of names up to which the dictionary is broadcast to the texts; beyond, both sides shuffle by word.
BROADCAST_WORDS = 200_000
WORD = r"[0-9A-Za-zÀ-ɏ가-힣]+"


def words_of(x: Column) -> Column:
    """Lower-case words in order, repeated ones too."""
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def dictionary_matches(texts: DataFrame, names: DataFrame, id_col: str, text: str, name: str, most_words: int = 4) -> DataFrame:
    """(id, name, start, stop): the names in each text as runs of words, ``start`` from 0 and ``stop`` behind the last; names are lower-case words with a blank between.

    Of names that lie within a longer match only the longer counts; matches that merely overlap both count, and a name counts at each
    of its places. Each word is joined once with the names that begin with it, and what follows is compared; so there is one row for each
    word of a text that begins a name, however many names there are. Names of over ``most_words`` words, or of none, match nothing.
    """
    cut = names.select(words_of(F.col(name)).alias("w")).filter(F.size("w").between(1, most_words)).distinct()
    by_first = cut.groupBy(F.col("w")[0].alias("first")).agg(F.collect_set("w").alias("names"))
    small = by_first.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS
    at = texts.select(F.col(id_col).alias("id"), words_of(F.col(text)).alias("all"))
    ahead = F.transform("all", lambda w, i: F.struct(i.alias("start"), F.slice("all", i + 1, most_words).alias("next")))
    each = at.select("id", F.explode(ahead).alias("a")).select("id", "a.start", "a.next").withColumn("first", F.col("next")[0])
    met = each.join(F.broadcast(by_first) if small else by_first, "first").select("id", "start", F.explode(F.filter("names", lambda n: F.slice("next", 1, F.size(n)) == n)).alias("n"))
    found = met.select("id", F.array_join("n", " ").alias("name"), F.col("start").cast("long").alias("start"), (F.col("start") + F.size("n")).cast("long").alias("stop"))
    before = F.max("stop").over(W.partitionBy("id").orderBy("start", F.desc("stop")).rowsBetween(W.unboundedPreceding, -1))
    return found.withColumn("before", before).filter(F.col("before").isNull() | (F.col("stop") > F.col("before"))).drop("before")


def unsupported_places(claims: DataFrame, quotes: DataFrame, names: DataFrame, id_col: str, text: str, name: str, same: dict[str, str] | None = None, most_words: int = 4) -> DataFrame:
    """(id, places, unsupported): the places that each claim names, and those of them that the quotes of its id do not name; both sorted.

    ``same`` maps other names of a place to the one that counts for both sides. Claims without a place do not appear.
    """
    one = F.col("name")
    for other, chosen in (same or {}).items():
        one = F.when(F.col("name") == other, chosen).otherwise(one)
    of = lambda d: dictionary_matches(d, names, id_col, text, name, most_words).select("id", one.alias("name")).distinct()
    both = of(claims).withColumn("claimed", F.lit(True)).unionByName(of(quotes).withColumn("claimed", F.lit(False)))
    each = both.groupBy("id", "name").agg(F.bool_or("claimed").alias("claimed"), F.bool_and("claimed").alias("alone")).filter("claimed")
    out = each.groupBy("id").agg(F.array_sort(F.collect_list("name")).alias("places"), F.array_sort(F.collect_list(F.when(F.col("alone"), F.col("name")))).alias("unsupported"))
    return out.withColumnRenamed("id", id_col)
