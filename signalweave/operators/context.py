"""Context of turns and chunks: speakers, topics, local evidence, islands of lines and quoted turns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import squash
from .scoring import has


def with_sessions(df: DataFrame, key: Sequence[str], at: str, starts: Column, name: str = "session") -> DataFrame:
    """Number of the session a row is in: it grows at rows where ``starts`` holds; 0 before the first."""
    return df.withColumn(name, F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(W.partitionBy(*key).orderBy(at)))


def topic_start(df: DataFrame, key: Sequence[str], at: str, boundary: Column) -> DataFrame:
    """``topic_at``: position of the last boundary at or before the row, else the first position of the key."""
    w = W.partitionBy(*key).orderBy(at)
    last = F.last(F.when(boundary, F.col(at)), ignorenulls=True).over(w)
    return df.withColumn("topic_at", F.coalesce(last, F.first(at).over(w)))


def local_evidence(df: DataFrame, key: Sequence[str], at: str, text: str, session: str, reach: int = 2, sep: str = " ") -> DataFrame:
    """Texts from ``reach`` rows before to ``reach`` after, inside the row's session."""
    w = W.partitionBy(*key, session).orderBy(at).rowsBetween(-reach, reach)
    return df.withColumn("evidence", F.array_join(F.collect_list(text).over(w), sep))


def joined_islands(df: DataFrame, key: Sequence[str], at: str, text: str, starts: Column, sep: str = " ") -> DataFrame:
    """Wrapped rows put together: each row where ``starts`` holds and the lines after it. Lines before the first are dropped."""
    s = with_sessions(df, key, at, starts, "island").filter("island > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(at, text))), lambda x: x[text])
    return s.groupBy(*key, "island").agg(F.array_join(lines, sep).alias("line"), F.count(F.lit(1)).alias("n_lines"))


def quoted_turn(turns: DataFrame, quotes: DataFrame, key: str, at: str, text: str, quote: str, before: int = 450, after: int = 450) -> DataFrame:
    """The first turn that contains the quote, with the end of the turn before and the beginning of the one after."""
    w = W.partitionBy(key).orderBy(at)
    around = turns.withColumns({"__prev": F.lag(text).over(w), "__next": F.lead(text).over(w)})
    hit = around.join(quotes.select(key, quote), key).filter(F.contains(F.col(text), F.col(quote)))
    first = hit.groupBy(key, quote).agg(F.min_by(F.struct(at, text, "__prev", "__next"), at).alias("r"))
    tail = F.expr(f"right(r.__prev, {before})")
    return first.select(key, quote, F.col(f"r.{at}").alias(at), F.instr(F.col(f"r.{text}"), F.col(quote)).alias("found_at"), tail.alias("before"), F.substring(F.col("r.__next"), 1, after).alias("after"))


#: Rules that are tried on each row.
MOST_RULES = 10_000


def first_rule_match(df: DataFrame, rules: DataFrame, text: str, order: str, subject: str, evidence: str, out: str) -> DataFrame:
    """Each row with the label of the first rule (by ``order``) whose subject and evidence terms are both in its text; null if none.

    Rules become one array beside each row, so rows are not multiplied; more than MOST_RULES are refused.
    """
    if rules.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    listed = rules.agg(F.array_sort(F.collect_list(F.struct(order, subject, evidence, out))).alias("__rules"))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = F.filter("__rules", lambda r: F.contains(low, F.lower(r[subject])) & F.contains(low, F.lower(r[evidence])))
    return df.join(F.broadcast(listed)).withColumn(out, F.get(hits, F.lit(0))[out]).drop("__rules")


def speakers(df: DataFrame, key: Sequence[str], at: str, text: str, mark: str = r"[○●◯*]", name: str = r"[\w.-]+(?: [\w.-]+)?", parts: int = 4) -> DataFrame:
    """``speaker``: the name after a mark and before a colon, put together from up to ``parts`` consecutive rows; the shortest
    join that matches is taken; null where none does."""
    w = W.partitionBy(*key).orderBy(at)
    out = None
    for n in range(1, parts + 1):
        joined = F.concat_ws(" ", *[F.col(text) if i == 0 else F.lead(text, i).over(w) for i in range(n)])
        got = F.regexp_extract(joined, rf"^\s*{mark}\s*({name})\s*:", 1)
        got = F.when(got != "", got)
        out = got if out is None else F.coalesce(out, got)
    return df.withColumn("speaker", out)


def transcript_parts(df: DataFrame, id_col: str, text: str, mark: str = r"\n", name: str = r"^([A-Za-zÀ-ɏ]+)[ .,]", letters: str = r"\p{L}", least_parts: int = 2, least_letters: int = 200) -> DataFrame:
    """Parts of transcripts split at a mark: (id, pos, speaker, part); transcripts with too few parts or letters are left out."""
    t = df.select(F.col(id_col), F.filter(F.split(F.col(text), mark), lambda p: F.trim(p) != "").alias("parts"), F.regexp_count(F.col(text), F.lit(letters)).alias("__n"))
    ok = t.filter((F.size("parts") >= least_parts) & (F.col("__n") >= least_letters))
    p = ok.select(id_col, F.posexplode("parts").alias("pos", "part"))
    got = F.regexp_extract("part", name, 1)
    return p.select(id_col, "pos", F.when(got != "", got).alias("speaker"), "part")


def missing_fields(df: DataFrame, required: dict[str, Column], name: str = "missing") -> DataFrame:
    """``missing``: labels of required fields that are null or empty; ``context``: PASS without any, else HOLD."""
    gaps = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) == "", F.lit(n)) for n, c in required.items()]))
    return df.withColumn(name, gaps).withColumn("context", F.when(F.size(name) == 0, "PASS").otherwise("HOLD"))


#: The longest bracketed remark, the lines of a text's head, and the greatest count that is believed.
REMARK_CHARS, HEAD_LINES, MOST_COUNTED = 180, 25, 500


def remarks(line: Column) -> Column:
    """The bracketed remarks of a line: what stands before each closing bracket and behind the first opening one that is near enough."""
    before_ends = F.slice(F.split(line, r"[\]】]"), 1, F.size(F.split(line, r"[\]】]")) - 1)

    def inner(part: Column) -> Column:
        opened = F.split(part, r"[\[【]")
        tails = F.transform(F.sequence(F.lit(2), F.size(opened)), lambda k: F.array_join(F.slice(opened, k, F.size(opened)), "["))
        near = F.filter(tails, lambda t: F.length(t).between(1, REMARK_CHARS))
        return F.when(F.size(opened) > 1, F.get(near, F.lit(0)))

    return F.array_compact(F.transform(before_ends, inner))


def count_behind(fragment: Column, term: str) -> Column:
    """The number of up to three digits that stands behind the first mention of a term that has one, in a bracket or not."""
    behind = F.slice(F.split(fragment, re.escape(term)), 2, 2_000_000_000)
    digits = F.transform(behind, lambda t: F.regexp_extract(F.ltrim(F.regexp_replace(F.ltrim(t), r"^\(", "")), r"^\d{1,3}", 0))
    return F.get(F.filter(digits, lambda d: d != ""), F.lit(0)).cast("int")


def disposition_counts(x: Column, terms: Sequence[str], most: int = MOST_COUNTED, lines: int = HEAD_LINES) -> Column:
    """Map of each term to the count that stands behind it. The text's head counts before its bracketed remarks: of the first ``lines`` lines the last
    with a count of at most ``most``, else of all remarks the last. A null text, and terms without a count, have no entry."""
    rows = F.split(F.coalesce(x, F.lit("")), r"\r\n|\r|\n")
    ranked = F.concat(F.reverse(F.slice(rows, 1, lines)), F.reverse(F.flatten(F.transform(rows, remarks))))
    best = lambda t: F.get(F.filter(F.transform(ranked, lambda f: count_behind(f, t)), lambda n: n <= most), F.lit(0))
    made = F.map_from_arrays(F.array(*map(F.lit, terms)), F.array(*map(best, terms)))
    return F.map_filter(made, lambda k, v: v.isNotNull())


def subject_context(df: DataFrame, key: Sequence[str], at: str, text: str, speaker: Column, subject: str, scope: Sequence[str], groups: Sequence[str], most: int = 180) -> DataFrame:
    """A row for each segment: its ``subject`` (the latest text that no speaker's name opens and that matches the pattern ``subject``, at
    most ``most`` characters), ``scoped`` (a scope term anywhere in it), ``affected`` (its group terms, in their order), ``missing`` and ``context`` (PASS if nothing is missing).

    One aggregate that combines before the shuffle; no texts are gathered. Ties of ``at`` take the greatest text; null texts say nothing.
    """
    x = squash(F.col(text))
    fits = (x != "") & ~F.coalesce(speaker, F.lit(False)) & x.rlike(subject)
    d = df.select(*key, F.when(fits, F.struct(F.col(at).alias("at"), F.rtrim(F.substring(x, 1, most)).alias("subject"))).alias("__last"), has(x, *scope).alias("__scoped"), *[has(x, t).alias(f"__g{i}") for i, t in enumerate(groups)])
    g = d.groupBy(*key).agg(F.max("__last")["subject"].alias("subject"), F.bool_or("__scoped").alias("scoped"), F.array_compact(F.array(*[F.when(F.bool_or(f"__g{i}"), F.lit(t)) for i, t in enumerate(groups)])).alias("affected"))
    return missing_fields(g, {"subject": F.col("subject"), "scope": F.when(F.col("scoped"), "yes"), "affected": F.array_join("affected", "")})


def recent_terms(df: DataFrame, part: Sequence[str], order: Sequence[str], text: Column, terms: dict[str, str], back: int = 120) -> DataFrame:
    """A boolean column for each of ``terms``: whether the texts of this row and the ``back`` rows before it, joined, have the term in
    lower case and without blanks, across their ends too. Null texts are empty.

    A window carries each text's verdict and its two ends, as long as a term less one, never the text itself: a match is inside a text,
    or crosses ends.
    """
    x = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit(" "), F.lit(""))
    keep = max(len(t) for t in terms.values()) - 1
    d = df.withColumn("__x", x)
    ends = F.when(F.length("__x") <= 2 * keep, F.col("__x")).otherwise(F.concat(F.left("__x", F.lit(keep)), F.lit("\n\n"), F.right("__x", F.lit(keep))))
    d = d.withColumns({"__ends": ends, **{f"__has_{n}": F.contains("__x", F.lit(t)) for n, t in terms.items()}}).drop("__x")
    w = W.partitionBy(*part).orderBy(*order).rowsBetween(-back, 0)
    d = d.withColumns({"__near": F.array_join(F.collect_list("__ends").over(w), ""), **{f"__has_{n}": F.max(f"__has_{n}").over(w) for n in terms}})
    return d.withColumns({n: F.col(f"__has_{n}") | F.contains("__near", F.lit(t)) for n, t in terms.items()}).drop("__ends", "__near", *[f"__has_{n}" for n in terms])


def context_lock(
    df: DataFrame, key: Sequence[str], at: str, text: str, speaker: Column, boundary: Column, locked: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]], scope: Sequence[str],
    groups: Sequence[str], subject: str, back: int = 120, near: int = 12, reach: int = 2, last: int = 5, most: int = 180,
) -> DataFrame:
    """A row for each chunk where ``locked`` holds: (key, at, speaker, rule, state, subject, affected, missing, context).

    Two scopes are read. Local: the chunk and ``reach`` on both sides. Segment: the chunks from the start of its topic. Both end at
    chunks that name a ``speaker`` (a name or null) and before those where ``boundary`` holds; the speaker's chunk says nothing itself. A
    speaker counts for the ``back`` chunks after its own; without one the segment is the ``near`` chunks before.

    ``rule`` is the first of ``rules`` (name, evidence terms, subject terms) with an evidence term in the local scope and a subject term in either; its
    subject is its name, and the state is LOCKED_LOCAL if a subject term is local, else LOCKED_SEGMENT. Without one it is GENERIC, if the segment has a
    chunk that fits the pattern ``subject`` (the latest, at most ``most`` characters), and either scope a term of ``scope`` and one of ``groups``
    (LOCKED_SEGMENT), else UNRESOLVED. What is ``missing`` (a speaker too) makes the state HOLD. ``context`` are the last ``last`` chunks of the
    segment, other than the chunk's own text, that have a term of the rule, or any without one.

    Terms of all rules are bits of one number, so windows carry numbers and no texts; only the chunks of ``context`` are fetched again.
    Null and empty texts say nothing; (key, at) is distinct. Chunks that name a speaker are not locked.
    """
    x = squash(F.coalesce(F.col(text), F.lit("")))
    bits = [*[(f"e{i}", e) for i, (_, e, _) in enumerate(rules)], *[(f"s{i}", t) for i, (_, _, t) in enumerate(rules)], ("scope", scope), *[(f"g{i}", [g]) for i, g in enumerate(groups)]]
    if len(bits) > 62:
        raise ValueError("at most 62 term lists")
    place = {n: 1 << i for i, (n, _) in enumerate(bits)}
    says = F.lit(0).cast("long")
    for n, terms in bits:
        says = says + F.when(has(F.col("__x"), *terms), F.lit(place[n]).cast("long")).otherwise(F.lit(0).cast("long"))
    d = df.select(*key, at, x.alias("__x"), speaker.alias("__name"), F.coalesce(boundary, F.lit(False)).alias("__cut"), F.coalesce(locked, F.lit(False)).alias("__locked"))
    d = d.withColumn("__says", F.when(F.col("__name").isNull(), says).otherwise(F.lit(0).cast("long")))
    d = with_sessions(d, key, at, F.col("__name").isNotNull() | F.col("__cut"), "__part")
    order = lambda *k: W.partitionBy(*key, *k).orderBy(at)
    said = F.col("__name").isNull() & (F.col("__x") != "")
    one = F.when(said, F.struct(F.col(at).alias("at"), F.col("__says").alias("says"), F.xxhash64("__x").alias("h")))
    fits = F.when(said & F.col("__x").rlike(subject), F.rtrim(F.substring("__x", 1, most)))
    known = F.last("__name", ignorenulls=True).over(order().rowsBetween(-back, 0))
    frames = {"far": order("__part").rowsBetween(-back, 0), "close": order("__part").rowsBetween(-near, 0)}
    d = d.withColumns({"speaker": known, "__local": F.bit_or("__says").over(order("__part").rowsBetween(-reach, reach)), "__one": one, "__fits": fits})
    d = d.withColumns({f"__{n}_{k}": f for n, w in frames.items() for k, f in (("says", F.bit_or("__says").over(w)), ("subject", F.last("__fits", ignorenulls=True).over(w)), ("chunks", F.collect_list("__one").over(w)))})
    d = d.filter(F.col("__locked") & F.col("__name").isNull())
    pick = lambda k: F.when(F.col("speaker").isNotNull(), F.col(f"__far_{k}")).otherwise(F.col(f"__close_{k}"))
    both = F.col("__local").bitwiseOR(pick("says"))
    on = lambda mask, n: mask.bitwiseAND(F.lit(place[n]).cast("long")) != 0
    found = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        found = F.when(on(F.col("__local"), f"e{i}") & on(F.col("__both"), f"s{i}"), F.lit(i)).otherwise(found)
    d = d.withColumns({"__both": both, "__subject": pick("subject"), "__chunks": pick("chunks")}).withColumn("__rule", found)
    nth = lambda values: F.get(F.array(*values), F.col("__rule")) if rules else F.lit(None)
    affected = F.array_compact(F.array(*[F.when(on(F.col("__both"), f"g{i}"), F.lit(g)) for i, g in enumerate(groups)])).cast("array<string>")
    d = d.withColumns({"__name_of": nth([F.lit(r[0]) for r in rules]).cast("string"), "__here": nth([on(F.col("__local"), f"s{i}") for i in range(len(rules))]).cast("boolean"), "__affected": affected})
    by_rule = F.col("__rule").isNotNull()
    gaps = [F.when(F.col("speaker").isNull(), "speaker"), F.when(~by_rule & F.col("__subject").isNull(), "subject"), F.when(~by_rule & ~on(F.col("__both"), "scope"), "scope"), F.when(~by_rule & (F.size("__affected") == 0), "affected")]
    d = d.withColumn("missing", F.array_compact(F.array(*gaps)))
    unresolved = F.array_size(F.filter("missing", lambda m: m != "speaker")) > 0
    terms = nth([F.lit(place[f"e{i}"] + place[f"s{i}"]).cast("long") for i in range(len(rules))])
    shown = F.filter("__chunks", lambda c: (c["h"] != F.xxhash64("__x")) & (~by_rule | (c["says"].bitwiseAND(F.coalesce(terms.cast("long"), F.lit(0).cast("long"))) != 0)))
    d = d.withColumn("__shown", F.transform(F.reverse(F.slice(F.reverse(shown), 1, last)), lambda c: c["at"]))
    out = d.select(
        *key, at, "speaker",
        F.when(by_rule, F.col("__name_of")).when(unresolved, "UNRESOLVED").otherwise("GENERIC").alias("rule"),
        F.when(F.size("missing") > 0, "HOLD").when(F.col("__here"), "LOCKED_LOCAL").otherwise("LOCKED_SEGMENT").alias("state"),
        F.when(by_rule, F.col("__name_of")).otherwise(F.col("__subject")).alias("subject"), F.col("__affected").alias("affected"), "missing", "__shown",
    )
    texts = df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(at).alias("__at"), x.alias("__x"))
    same = F.col("__at") == F.col("__p")
    for i, k in enumerate(key):
        same = same & F.col(f"__k{i}").eqNullSafe(F.col(k))
    names = {k: f"__g{i}" for i, k in enumerate((*key, at))}
    asked = out.select(*key, at, F.explode("__shown").alias("__p")).join(texts, same)
    got = asked.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__x"))), lambda c: c["__x"]).alias("context"))
    link = F.lit(True)
    for k, n in names.items():
        link = link & F.col(k).eqNullSafe(F.col(n))
    return out.join(got, link, "left").select(*[c for c in out.columns if c != "__shown"], F.coalesce("context", F.array().cast("array<string>")).alias("context"))
