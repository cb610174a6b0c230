"""Joins with a meaning of their own: coverage, precedence, siblings, token overlap, lead exclusion and registry caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as txt
from ..session import checkpointed
from .similarity import contained_in


def with_precedence(base: DataFrame, over: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join in which non-empty values of ``over`` win and those of ``base`` stand in."""
    o = over.select(*key, *[F.col(c).alias(f"__o_{c}") for c in columns])
    j = base.join(o, list(key), "left")
    kept = [c for c in base.columns if c not in columns]
    return j.select(*kept, *[F.coalesce(F.nullif(F.col(f"__o_{c}"), F.lit("")), F.col(c)).alias(c) for c in columns])


def sibling_counts(df: DataFrame, entity: str, kinds: dict[str, Column]) -> DataFrame:
    """Per entity how many of its events are of each kind: what a self join would count, without pairs."""
    return df.groupBy(entity).agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])


#: Distinct tokens of the left side, or rows of it, up to which they are broadcast; beyond, the same joins shuffle.
BROADCAST_ROWS = 1_000_000


def token_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str, least_shared: int = 2, least_score: int = 5, k: int = 2, most: int = 8) -> DataFrame:
    """Best ``k`` right rows of each left row by shared tokens, then by id: score is the sum of min(length + 1, ``most``). Ids are distinct.

    Exact, by bounds: of a left row's tokens, the rarest on the right are probed first, as many as it takes to meet some right rows. The
    ``k``-th best of those gives a score that has to be reached; tokens that are too common are then probed for no new row, if all of
    them together score less. Scores of the rows that are met come from their whole token sets. Tokens that no left row has
    are dropped where the right side is read, before anything is shuffled.
    """
    weight = lambda t: F.least(F.length(t) + 1, F.lit(most))
    a = checkpointed(left.select(F.col(left_id).alias("l"), F.array_distinct(tokens).alias("t")))
    words = a.select("l", F.explode("t").alias("tok"))
    vocabulary = checkpointed(words.select("tok").distinct())
    sized = lambda df, n: F.broadcast(df) if n <= BROADCAST_ROWS else df
    n_tokens, n_words = vocabulary.count(), words.count()
    b = right.select(F.col(right_id).alias("r"), F.explode(F.array_distinct(tokens)).alias("tok")).join(sized(vocabulary, n_tokens), "tok")
    b = checkpointed(b)
    often = b.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    ranked = words.join(sized(often, n_tokens), "tok").groupBy("l").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("by_df"))
    # Of each token of a left row: its score, and how much it and all more common ones score together.
    tails = F.reverse(F.aggregate(F.reverse("by_df"), F.expr("cast(array() as array<struct<df:bigint,tok:string,w:int,tail:int>>)"), lambda acc, e: F.concat(acc, F.array(F.struct(e["df"].alias("df"), e["tok"].alias("tok"), weight(e["tok"]).alias("w"), (F.coalesce(F.try_element_at(acc, F.lit(-1))["tail"], F.lit(0)) + weight(e["tok"])).alias("tail"))))))
    ranked = ranked.select("l", F.size("by_df").alias("n"), F.posexplode(tails).alias("p", "e"))
    # Of the tokens that are shared, all but the last few by rarity are probed: a row that shares enough is met by another one.
    ranked = checkpointed(ranked.filter(F.col("p") <= F.col("n") - least_shared).select("l", "p", "e.df", "e.tok", "e.w", "e.tail"))
    before = F.coalesce(F.sum("df").over(W.partitionBy("l").orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    probes = ranked.withColumn("before", before).filter(F.col("before") < 16 * k)
    found = sized(probes.select("l", "tok", "w"), n_words).join(b, "tok").groupBy("l", "r").agg(F.sum("w").alias("low"), F.count(F.lit(1)).alias("c"))
    # Only rows that share enough tokens count towards the k-th best, which rows yet to be met have to reach.
    kth = found.filter((F.col("c") >= least_shared) & (F.col("low") >= least_score)).withColumn("n", F.row_number().over(W.partitionBy("l").orderBy(F.desc("low"), "r"))).filter(F.col("n") == k).select("l", "low")
    bound = ranked.join(kth, "l", "left").filter(F.col("tail") >= F.greatest(F.coalesce("low", F.lit(least_score)), F.lit(least_score)))
    met = checkpointed(sized(bound.select("l", "tok"), n_words).join(b, "tok").select("l", "r").distinct())
    n_met = met.count()
    sets = b.join(sized(met.select("r").distinct(), n_met), "r", "left_semi").groupBy("r").agg(F.collect_list("tok").alias("tr"))
    full = sized(met.join(sized(a.select("l", F.col("t").alias("tl")), n_words), "l"), n_met).join(sets, "r").withColumn("both", F.array_intersect("tl", "tr"))
    score = F.aggregate("both", F.lit(0).cast("long"), lambda acc, t: acc + weight(t))
    good = full.select("l", "r", F.size("both").cast("long").alias("shared"), score.alias("score")).filter((F.col("shared") >= least_shared) & (F.col("score") >= least_score))
    top = good.withColumn("rank", F.row_number().over(W.partitionBy("l").orderBy(F.desc("score"), F.asc("r")))).filter(F.col("rank") <= k)
    return top.select(F.col("l").alias(left_id), F.col("r").alias(right_id) if right_id != left_id else F.col("r").alias(f"match_{right_id}"), "shared", "score", "rank")


def exclude_leads(candidates: DataFrame, leads: DataFrame, url: str, anchor: str, title: str, least: int = 4) -> DataFrame:
    """Candidates that no known lead of the same URL covers: by its anchor, or by a title of ``least`` letters or more, contained in the candidate's."""
    c = candidates.withColumns({"__a": txt.key_of(F.col(anchor)), "__t": txt.key_of(F.col(title))})
    k = leads.select(F.col(url).alias("__u"), txt.key_of(F.col(anchor)).alias("__la"), txt.key_of(F.col(title)).alias("__lt"))
    covered = (F.col(url) == F.col("__u")) & (((F.length("__la") > 0) & F.contains("__a", "__la")) | ((F.length("__lt") >= least) & F.contains("__t", "__lt")))
    return c.join(k, covered, "left_anti").drop("__a", "__t")


#: Search terms up to which a text is looked through for all of them at once; beyond, terms meet texts by their grams.
MOST_TERMS = 10_000


def term_search(docs: DataFrame, terms: DataFrame, doc_id: str, text: str, term: str) -> DataFrame:
    """(id, matched, n_matched): documents with the sorted set of terms they contain, whatever the case. Null and empty terms match nothing.

    Up to MOST_TERMS terms become one array beside each text; more of them are joined with the texts by rare grams (``similarity.contained_in``).
    """
    low = terms.select(F.lower(term).alias("t")).filter(F.length("t") > 0).distinct()
    if low.limit(MOST_TERMS + 1).count() <= MOST_TERMS:
        listed = low.agg(F.array_sort(F.collect_list("t")).alias("__terms"))
        hits = docs.join(F.broadcast(listed)).select(doc_id, F.filter("__terms", lambda t: F.contains(F.lower(F.col(text)), t)).alias("matched"))
    else:
        found = contained_in(low.select("t", F.col("t").alias("k")), docs.select(F.col(doc_id).alias("d"), F.lower(text).alias("k")), "t", "d", "k")
        hits = found.groupBy(F.col("long").alias(doc_id)).agg(F.array_sort(F.collect_set("short")).alias("matched"))
    return hits.filter(F.size("matched") > 0).withColumn("n_matched", F.size("matched"))


def source_search(docs: DataFrame, terms: DataFrame, sources: DataFrame, doc_id: str, text: str, source: str, day: str, since: str, until: str, term: str = "term") -> DataFrame:
    """(id, source, day, matched, n_matched): what a search for every term at every one of ``sources`` finds, one row for each document.

    Days from ``since`` to ``until`` count, both included; a document without a day is not found. The order of results is most terms first, then by day
    and id; it is left to the reader. Pairs of terms and sources are never made: documents are first cut down to sources and days.
    """
    inside = docs.filter(F.col(day).between(F.lit(since).cast("date"), F.lit(until).cast("date"))).join(sources.select(F.col(source)).distinct(), source, "left_semi")
    return inside.select(doc_id, source, day).join(term_search(inside, terms, doc_id, text, term), doc_id)


def freshness_sides(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str) -> DataFrame:
    """Full join of two latest dates: BOTH_CURRENT, LEFT_STALE, RIGHT_STALE, ONLY_LEFT or ONLY_RIGHT."""
    j = left.select(key, F.col(left_day).alias("__l")).join(right.select(key, F.col(right_day).alias("__r")), key, "full")
    status = F.when(F.col("__r").isNull(), "ONLY_LEFT").when(F.col("__l").isNull(), "ONLY_RIGHT").when(F.col("__l") < F.col("__r"), "LEFT_STALE").when(F.col("__l") > F.col("__r"), "RIGHT_STALE").otherwise("BOTH_CURRENT")
    return j.select(key, F.col("__l").alias(left_day), F.col("__r").alias(right_day), status.alias("status"))


def cap_violations(rows: DataFrame, caps: DataFrame, level: str, value: str, order: Sequence[str]) -> DataFrame:
    """Rows whose ordered enum ``value`` is above the cap of their level, or not in the order at all."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, order)), c)
    j = rows.join(caps.select(level, F.col("cap").alias("__cap")), level, "left")
    problem = F.when(F.col("__cap").isNull(), "UNKNOWN_LEVEL").when(rank(F.col(value)) == 0, "UNKNOWN_VALUE").when(rank(F.col(value)) > rank(F.col("__cap")), "ABOVE_CAP")
    return j.withColumn("problem", problem).drop("__cap").filter("problem is not null")
