"""Content cascade, geographic scope, record score, news lanes and capped lanes. Terms are parameters; every verdict is a column."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import hide_escapes, show_escapes

# Classes in the order of the checks, their status, the signals that must hold and those that must not.
CASCADE: tuple[tuple[str, str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("CONTACT_BOILERPLATE", "FAIL", ("contact",), ()),
    ("PLATFORM_NOTICE", "FAIL", ("platform",), ()),
    ("PORTAL_INSTRUCTION", "FAIL", ("instruction",), ()),
    ("AGGREGATE_ACTIVITY_DASHBOARD", "HOLD", ("dashboard",), ()),
    ("HYPOTHETICAL_EXAMPLE", "HOLD", ("hypothetical",), ()),
    ("ISSUE_MENTION_ONLY", "HOLD", ("minutes", "mention"), ("linked",)),
    ("NAVIGATION", "FAIL", ("navigation",), ()),
    ("PARLIAMENTARY_PROCEDURE", "FAIL", ("procedure",), ()),
    ("TABLE_SCHEMA_WITHOUT_VALUE", "HOLD", ("table_source", "schema"), ()),
    ("POLICY_FORECAST", "HOLD", ("forecast",), ("cost_problem",)),
    ("POLICY_ANNOUNCEMENT", "HOLD", ("values", "policy"), ("observed",)),
    ("CONCERN_OR_ATTRIBUTED_CLAIM", "HOLD", ("concern",), ("values",)),
    ("SPEECH_PROMISE", "FAIL", ("speech",), ("values",)),
    ("TABLE_SCHEMA_WITHOUT_VALUE", "HOLD", ("table_source", "table_title"), ("values",)),
    ("DATASET_METADATA", "PASS", ("verification", "dataset"), ("values",)),
    ("DOCUMENT_TITLE_ONLY", "HOLD", ("title_only",), ("values",)),
)
# What a row is anchored in, in order.
ANCHORS: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("DIRECT_PROBLEM_SIGNAL", ("voice", "problem", "experience"), ("purpose_only",)),
    ("MEASURED_PROBLEM_SIGNAL", ("values", "problem", "linked", "observed"), ("positive",)),
    ("MEASURED_PROBLEM_SIGNAL", ("values", "problem", "cost_problem"), ("positive", "purpose_only")),
    ("DECOMPOSABLE_STRUCTURE", ("values", "structural"), ()),
    ("DECOMPOSABLE_STRUCTURE", ("values", "positive"), ()),
    ("DECOMPOSABLE_STRUCTURE", ("values", "neutral"), ()),
)


def has(x: Column, *terms: str) -> Column:
    """Whether a text has one of the terms, in one scan; false for null and for no terms."""
    return F.coalesce(x.rlike("|".join(map(re.escape, terms))), F.lit(False)) if terms else F.lit(False)


def sentences(x: Column) -> Column:
    return F.split(F.coalesce(x, F.lit("")), r"[.!?。\n]")


def together(x: Column, *patterns: str) -> Column:
    """Whether one sentence matches all patterns."""
    def all_of(s: Column) -> Column:
        out = F.lit(True)
        for p in patterns:
            out = out & s.rlike(p)
        return out

    return F.exists(sentences(x), all_of)


def _holds(named: dict[str, Column], need: Sequence[str], never: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in need:
        out = out & named.get(n, F.lit(False))
    for n in never:
        out = out & ~named.get(n, F.lit(False))
    return out


def analysed(df: DataFrame, signals: dict[str, Column], cascade=CASCADE, anchors=ANCHORS) -> DataFrame:
    """``content_class``, ``precheck``, ``evidence_anchor``, ``claim_status``, ``change_direction``, ``verification_usable`` and
    ``verification_lead`` of each row.

    A signal that is null or not given does not hold. No class fits: REPORTABLE_TEXT, which passes. Rows that do not pass have no
    anchor. All columns of the frame are kept; its own columns of these names are replaced.
    """
    at = {k: f"__signal_{i}" for i, k in enumerate(signals)}
    d = df.withColumns({at[k]: F.coalesce(c, F.lit(False)) for k, c in signals.items()})
    s = {k: F.col(v) for k, v in at.items()}
    off = F.lit(False)
    rule = F.lit(len(cascade))
    for i in range(len(cascade) - 1, -1, -1):
        rule = F.when(_holds(s, cascade[i][2], cascade[i][3]), F.lit(i)).otherwise(rule)
    d = d.withColumn("__rule", rule)
    label = F.array(*[F.lit(c[0]) for c in cascade], F.lit("REPORTABLE_TEXT"))
    status = F.array(*[F.lit(c[1]) for c in cascade], F.lit("PASS"))
    d = d.withColumns({"content_class": F.get(label, F.col("__rule")), "precheck": F.get(status, F.col("__rule"))})
    anchor = F.lit("NONE")
    for name, need, never in reversed(anchors):
        anchor = F.when(_holds(s, need, never), F.lit(name)).otherwise(anchor)
    passed, verification = F.col("precheck") == "PASS", s.get("verification", off)
    d = d.withColumn("evidence_anchor", F.when(passed, anchor).otherwise("NONE"))
    anchored, cited = F.col("evidence_anchor") != "NONE", s.get("cited", off)
    claim = F.when(s.get("hypothetical", off), "HYPOTHETICAL").when((s.get("attributed", off) | (s.get("minutes", off) & anchored)) & ~cited, "ATTRIBUTED_CLAIM").when(anchored, "OBSERVED_OR_PUBLISHED").otherwise("UNRESOLVED")
    direction = F.when(s.get("positive", off), "POSITIVE").when(s.get("harm", off), "NEGATIVE").when(s.get("neutral", off), "UNCLASSIFIED_CHANGE").otherwise("AMBIGUOUS")
    axes = s.get("axes", off) | s.get("structural", off) | s.get("dataset", off)
    usable = passed & verification & s.get("values", off) & s.get("actual", off) & axes
    lead = F.when(~passed | ~verification | usable, "NONE").when(F.col("content_class") == "DATASET_METADATA", "METADATA").when(axes, "SCHEMA").otherwise("NONE")
    d = d.withColumns({"claim_status": claim, "change_direction": direction, "verification_usable": usable, "verification_lead": lead})
    return d.drop("__rule", *at.values())


def scope(x: Column, trusted: Column, place: str, wider: str, apart: str, measure: str, row: str, number: str = r"\d") -> Column:
    """Where a record's values hold: the source's own area, a structured row of the place, one sentence that has place, number and
    measure, only a wider area, or unbound. ``place``, ``wider``, ``apart`` (the place named for an event or in a list of places),
    ``measure`` and ``row`` are patterns. Null texts are unbound unless the source is trusted."""
    x = F.coalesce(x, F.lit(""))
    return (
        F.when(F.coalesce(trusted, F.lit(False)), "SOURCE_TRUSTED")
        .when(x.rlike(row), F.when(x.rlike(wider), "COMPARISON_WITH_ROW").otherwise("VALUE_BOUND"))
        .when(x.rlike(wider) & ~x.rlike(place), "WIDER_ONLY")
        .when(x.rlike(apart), "UNBOUND")
        .when(together(x, place, number, measure), "VALUE_BOUND")
        .otherwise("UNBOUND")
    )


def scored(df: DataFrame, parts: Sequence[tuple[str, Column, Column | int]]) -> DataFrame:
    """``score`` (the points of all parts that hold) and ``reasons`` (their names in order); a null condition does not hold."""
    held = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("n"), (F.lit(p) if isinstance(p, int) else p).cast("long").alias("p"))) for n, c, p in parts]))
    d = df.withColumn("__held", held)
    total = F.aggregate("__held", F.lit(0).cast("long"), lambda a, h: a + h["p"])
    return d.withColumns({"score": total, "reasons": F.transform("__held", lambda h: h["n"])}).drop("__held")


def news_lane(x: Column, watched: Column, duty: Sequence[str], transit: Sequence[str], delay: Sequence[str], works: Sequence[str], impact: Sequence[str], routine: Sequence[str], strong: Sequence[str]) -> Column:
    """struct(keep, reason, lane): transit delays and routine notices go, public duty stays and is watched, impact or works stay."""
    is_duty, works_, impact_ = has(x, *duty), has(x, *works), has(x, *impact)
    reason = (
        F.when(has(x, *delay) & has(x, *transit) & ~works_, "TRANSIT_DELAY")
        .when(has(x, *routine) & (~impact_ | has(x, *strong)), "ROUTINE")
        .when(is_duty, "PUBLIC_DUTY")
        .when(impact_ | works_, "IMPACT")
        .otherwise("NO_SIGNAL")
    )
    lane = F.when(F.coalesce(watched, F.lit(False)) | is_duty, "WATCHDOG_DUTY").otherwise("CITIZEN_ATTENTION")
    return F.struct(reason.isin("PUBLIC_DUTY", "IMPACT").alias("keep"), reason.alias("reason"), lane.alias("lane"))


def capped_lanes(df: DataFrame, rules: dict[str, tuple[Column, int]], id_col: str, score: str, key: str) -> DataFrame:
    """(id, lane, position): for each lane its best rows by score, then id, one of each key (null keys are one), as many as its cap.

    Lanes are assigned in one pass; rows of a key combine before the shuffle, and each partition keeps no more than the largest cap of
    a lane before lanes meet, so a lane that holds most rows is no hot key. Near duplicates: ``similarity.greedy_top`` per lane.
    """
    made = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("lane"), F.lit(cap).alias("cap"))) for n, (c, cap) in rules.items()]))
    each = df.select(F.explode(made).alias("__l"), F.col(id_col).alias("__id"), F.col(score).alias("__score"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"))
    best = each.groupBy("__l", "__key").agg(F.max_by(F.struct("__id", "__score"), F.struct("__score", -F.col("__id"))).alias("b"))
    top = W.partitionBy("lane").orderBy(F.desc("__score"), "__id")
    rows = best.select("__l.lane", "__l.cap", F.col("b.__id").alias("__id"), F.col("b.__score").alias("__score")).withColumn("position", F.row_number().over(top))
    most = max(cap for _, cap in rules.values())
    return rows.filter(F.col("position") <= most).filter("position <= cap").select(F.col("__id").alias(id_col), "lane", "position")


def keys_anywhere(x: Column) -> Column:
    """Distinct keys at any depth of a JSON text: string tokens, read from the left, that a colon follows; sorted. Invalid JSON gives
    the keys that can be read; null gives none. Escapes in keys are decoded."""
    tokens = F.transform(F.regexp_extract_all(hide_escapes(F.coalesce(x, F.lit(""))), F.lit(r'("[^"]*"(?:\s*:)?)'), F.lit(1)), show_escapes)
    raw = F.transform(F.filter(tokens, lambda t: F.endswith(t, F.lit(":"))), lambda t: F.regexp_replace(t, r"\s*:$", ""))
    return F.array_sort(F.array_distinct(F.transform(raw, lambda k: F.get(F.from_json(F.concat(F.lit("["), k, F.lit("]")), "array<string>"), F.lit(0)))))


def seed_rows(df: DataFrame, id_col: str, text_json: str, dates: Sequence[str], urls: Sequence[str], texts: Sequence[str], least: int = 80) -> DataFrame:
    """(id, path, date, url, text): each object at any depth of a JSON text that has a date, an https address and a text.

    Of ``dates`` and ``urls`` the first key with a fitting value counts; the values of ``texts`` are squashed and joined, once each, and
    must have ``least`` characters. Text that is no JSON, and null, has no rows. The walk keeps its own stack, so depth is no limit but
    that of the parser; Arrow batches go through it, one text at a time.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def found(raw: str) -> Iterator[tuple[str, str, str, str]]:
        try:
            stack = [("$", json.loads(raw))]
        except (ValueError, RecursionError, TypeError):
            return
        while stack:
            path, v = stack.pop()
            if isinstance(v, list):
                stack.extend((f"{path}[{i}]", x) for i, x in enumerate(v))
            elif isinstance(v, dict):
                stack.extend((f"{path}.{k}", x) for k, x in v.items())
                said = {k: " ".join(x.split()) for k, x in v.items() if isinstance(x, str)}
                day = next((said[k] for k in dates if re.fullmatch(r"\d{4}-\d{2}-\d{2}", said.get(k, ""))), None)
                url = next((said[k] for k in urls if said.get(k, "").startswith("https://")), None)
                text = " | ".join(dict.fromkeys(said[k] for k in texts if said.get(k)))
                if day and url and len(text) >= least:
                    yield path, day, url, text

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *r) for i, raw in zip(b.column(0), b.column(1)) for r in found(raw.as_py())]
            if rows:
                ids = pa.array([r[0].as_py() for r in rows], b.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([r[n] for r in rows], pa.string()) for n in range(1, 5)]], [id_col, "path", "date", "url", "text"])

    return df.select(id_col, text_json).mapInArrow(walk, f"`{id_col}` {kind}, path string, date string, url string, text string")


def merged_ledger(ledger: DataFrame, batch: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """A ledger (id, labels, published, first, last) after a batch (id, labels, published) is seen at ``now``.

    Labels of both sides are united and sorted; the batch's newest publishing date wins; ``first`` is kept, ``last`` is now for rows of
    the batch. Rows published over ``days`` days before now, or at no known time, leave. ``is_new``: the ledger had no such id.
    """
    old = ledger.select("id", "labels", "published", "first", "last", F.lit(False).alias("fresh"))
    new = batch.select("id", "labels", "published", now.alias("first"), now.alias("last"), F.lit(True).alias("fresh"))
    each = old.unionByName(new).withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))
    # Labels are exploded so that a hot id combines before the shuffle instead of gathering its arrays.
    flat = each.withColumn("label", F.explode_outer("labels")).groupBy("id", "label").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max(F.when(F.col("fresh"), F.col("published"))).alias("p"), F.max(F.when(~F.col("fresh"), F.col("published"))).alias("q"), F.bool_and("fresh").alias("is_new")
    )
    out = flat.groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("labels"), F.coalesce(F.max("p"), F.max("q")).alias("published"), F.min("first").alias("first"), F.max("last").alias("last"), F.bool_and("is_new").alias("is_new"))
    return out.filter(F.col("published") >= now - F.expr(f"interval {int(days)} days"))


def slot_of(hour: Column, ends: Sequence[int] = (10, 15)) -> Column:
    """Which slot of a day an hour is in: below the first end 0, below the second 1, and so on."""
    out = F.lit(len(ends))
    for i in range(len(ends) - 1, -1, -1):
        out = F.when(hour < ends[i], F.lit(i)).otherwise(out)
    return out


def slot_plan(queries: DataFrame, slot: int, day: int, sentinels: Sequence[int] = (4, 3, 3), calls: Sequence[int] = (14, 13, 13), used: int = 0) -> DataFrame:
    """(key, tier, place, search_order) of the queries that a slot runs: ``queries`` has (key, agenda, cluster, core, last_run).

    Core clusters, by name, are shared out to the slots; the least recently run query of each of this slot's is a SENTINEL. The calls that
    are left go to ROTATION: the least recently run of every agenda in turn, the agenda that begins moving with the day and slot. Sentinels
    and every second place search by date, the others by relevance. A query that never ran comes first.
    """
    room = max(0, calls[slot] - used)
    low, high = sum(sentinels[:slot]), sum(sentinels[: slot + 1])
    oldest = [F.asc_nulls_first("last_run"), F.asc("key")]
    ranked = queries.select("key", "agenda", "cluster", "core", "last_run")
    core = ranked.filter("core").select("agenda", "cluster").distinct().orderBy("agenda", "cluster").limit(high).withColumn("n", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("agenda", "cluster"))).filter(F.col("n") > low)
    first = ranked.join(F.broadcast(core), ["agenda", "cluster"]).withColumn("r", F.row_number().over(W.partitionBy("agenda", "cluster").orderBy(*oldest))).filter("r = 1")
    sentinel = first.orderBy("n").limit(room).select("key", F.lit("SENTINEL").alias("tier"), F.lit(0).alias("turn"), F.col("n").alias("seat"))
    rest = ranked.join(F.broadcast(sentinel.select("key")), "key", "left_anti")
    turn = rest.withColumn("turn", F.row_number().over(W.partitionBy("agenda").orderBy(*oldest))).filter(F.col("turn") <= room)
    names = ranked.select("agenda").distinct()
    seats = names.withColumns({"i": F.row_number().over(W.partitionBy(F.lit(0)).orderBy("agenda")) - 1, "m": F.count(F.lit(1)).over(W.partitionBy(F.lit(0)))})
    seats = seats.select("agenda", F.pmod(F.col("i") - F.lit(day * 3 + slot), F.col("m")).alias("seat"))
    rotation = turn.join(seats, "agenda").select("key", F.lit("ROTATION").alias("tier"), "turn", "seat")
    both = sentinel.unionByName(rotation).orderBy("turn", "seat").limit(room)
    both = both.withColumn("place", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("turn", "seat")) - 1)
    return both.select("key", "tier", "place", F.when((F.col("tier") == "SENTINEL") | (F.col("place") % 2 == 0), "date").otherwise("relevance").alias("search_order"))
