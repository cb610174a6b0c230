"""Rule-shaped operators: content classes, question templates, review windows, contracts and resumable work."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as txt
from .numbering import numbered

#: Content checks in order: (class, status, which of the precomputed signals must hold, which must not).
CONTENT_RULES: tuple[tuple[str, str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("EMPTY", "FAIL", ("empty",), ()),
    ("BOILERPLATE", "FAIL", ("boilerplate",), ("harm",)),
    ("TOO_SHORT", "HOLD", ("short",), ("measured",)),
    ("ROUTINE", "HOLD", ("routine",), ("harm", "measured")),
    ("MEASURED_HARM", "PASS", ("harm", "measured"), ()),
    ("DIRECT_HARM", "PASS", ("harm",), ()),
    ("MEASURED", "PASS", ("measured",), ()),
    ("STRUCTURE", "PASS", ("structure",), ()),
)


def content_class(df: DataFrame, signals: dict[str, Column], rules: Sequence[tuple[str, str, tuple[str, ...], tuple[str, ...]]] = CONTENT_RULES) -> DataFrame:
    """``content_class`` and ``precheck`` of the first rule that fits; NONE and HOLD without one. ``usable``: PASS and measured or direct."""
    named = df.withColumns({f"__s_{k}": F.coalesce(c, F.lit(False)) for k, c in signals.items()})
    kind, status = None, None
    for label, verdict, need, never in rules:
        ok = F.lit(True)
        for n in need:
            ok = ok & F.col(f"__s_{n}")
        for n in never:
            ok = ok & ~F.col(f"__s_{n}")
        kind = F.when(ok, label) if kind is None else kind.when(ok, label)
        status = F.when(ok, verdict) if status is None else status.when(ok, verdict)
    out = named.withColumns({"content_class": kind.otherwise("NONE"), "precheck": status.otherwise("HOLD")})
    return out.withColumn("usable", (F.col("precheck") == "PASS") & F.col("content_class").isin("MEASURED_HARM", "DIRECT_HARM", "MEASURED")).drop(*[f"__s_{k}" for k in signals])


def questions(df: DataFrame, rule: str, templates: DataFrame, values: dict[str, Column], source_text: str) -> DataFrame:
    """A question per row from the template of its rule, with its contract.

    ``templates``: (rule, template, needs array<string>), a small table. ``issues`` lists required evidence that is missing and
    numbers in the question that the source text does not have; grounding is PASS without any.
    """
    j = df.join(templates.select(F.col("rule").alias("__rule"), "template", "needs"), F.col(rule) == F.col("__rule"), "left")
    q = F.col("template")
    for name, c in values.items():
        q = F.replace(q, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    present = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) != "", F.lit(n)) for n, c in values.items()]))
    j = j.withColumn("question", q)
    missing = F.transform(F.array_except("needs", present), lambda n: F.concat(F.lit("missing "), n))
    ungrounded = F.transform(txt.unsupported(F.col("question"), F.col(source_text)), lambda n: F.concat(F.lit("number "), n))
    j = j.withColumn("issues", F.when(F.col("template").isNull(), F.array(F.lit("no template"))).otherwise(F.concat(missing, ungrounded)))
    return j.withColumn("grounding", F.when(F.size("issues") == 0, "PASS").otherwise("HOLD")).drop("__rule", "template", "needs")


def review_window(judged: Column, lane_ok: Column, grounded: Column, fresh: Column, age: Column, source_age: Column, days: int = 7, source_days: int = 14) -> Column:
    """Whether a row is still open for review."""
    return F.coalesce(~judged & lane_ok & grounded & fresh & (age >= 0) & (age < days) & (source_age >= 0) & (source_age <= source_days), F.lit(False))


def fail_closed(df: DataFrame, guarded: Column, ok: Column, flags: Sequence[str], status: str) -> DataFrame:
    """Guarded rows whose check is not passed (null counts) are set to HOLD and lose the given flags."""
    bad = guarded & ~F.coalesce(ok, F.lit(False))
    return df.withColumns({**{f: F.when(bad, F.lit(False)).otherwise(F.col(f)) for f in flags}, status: F.when(bad, "HOLD").otherwise(F.col(status))})


def validated_groups(groups: DataFrame, members: DataFrame, group: str, member: str, representative: str) -> DataFrame:
    """(member, group, problem): an external grouping made whole.

    A group needs two members or more, each known and in no other group, and its representative among them; members of a
    bad group, and members that no group mentions, are groups of their own.
    """
    g = groups.select(group, representative, F.explode(F.array_distinct("members")).alias(member))
    times = g.groupBy(member).agg(F.count(F.lit(1)).alias("__times"))
    known = members.select(F.col(member)).distinct().withColumn("__known", F.lit(True))
    each = g.join(times, member).join(known, member, "left")
    facts = each.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max("__times").alias("t"), F.count_if(F.col("__known").isNull()).alias("u"), F.count_if(F.col(representative) == F.col(member)).alias("r"))
    problem = F.when(F.col("n") < 2, "TOO_SMALL").when(F.col("u") > 0, "UNKNOWN_MEMBER").when(F.col("t") > 1, "OVERLAP").when(F.col("r") == 0, "BAD_REPRESENTATIVE")
    facts = facts.select(group, problem.alias("problem"))
    good = g.join(facts.filter("problem is null"), group).select(member, F.col(group).cast("string").alias("group"))
    rest = known.select(member).join(good.select(member), member, "left_anti").select(member, F.concat(F.lit("single-"), F.col(member).cast("string")).alias("group"))
    return good.unionByName(rest)


def keyed_upsert(old: DataFrame, new: DataFrame, key: str, order: Sequence[Column], keep: int) -> DataFrame:
    """New rows replace old ones of their key; the ``keep`` newest stay."""
    merged = new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"))
    return merged.orderBy(*order).limit(keep)


def next_chunks(work: DataFrame, cursor: DataFrame, key: str, n_chunks: str, budget: int, retries: int = 3) -> DataFrame:
    """What a resumed run does next: per key the next chunk of those not finished, a chunk that failed ``retries`` times skipped;
    at most ``budget`` of them, least advanced first."""
    j = work.join(cursor, key, "left").select(key, n_chunks, F.coalesce("next_chunk", F.lit(0)).alias("next_chunk"), F.coalesce("failures", F.lit(0)).alias("failures"))
    skip = F.col("failures") >= retries
    j = j.withColumns({"chunk": F.when(skip, F.col("next_chunk") + 1).otherwise(F.col("next_chunk")), "skipped": skip})
    return j.filter(F.col("chunk") < F.col(n_chunks)).orderBy("chunk", key).limit(budget).select(key, "chunk", "skipped")


def backfill_pages(sources: DataFrame, state: DataFrame, key: str, lookback: int) -> DataFrame:
    """Sources to read and from which page: those not complete, and complete ones whose lookback has been widened (from page 1)."""
    j = sources.join(state, key, "left")
    wider = F.coalesce(F.col("done_lookback"), F.lit(0)) < lookback
    done = F.coalesce(F.col("complete"), F.lit(False))
    return j.filter(~done | wider).select(key, F.when(done & wider, 1).otherwise(F.coalesce("next_page", F.lit(1))).alias("page"))


def bounded_round_robin(sources: Sequence[str], fetch: Callable[[str, int], Sequence], most: int, failures: int = 5) -> tuple[list, list[str]]:
    """Driver-side ingestion: one page of each source in turn until ``most`` documents; a source that raises is out, and ``failures``
    of them end the run."""
    out, failed, pages, live = [], [], dict.fromkeys(sources, 1), list(sources)
    while live and len(out) < most and len(failed) < failures:
        for s in list(live):
            if len(out) >= most or len(failed) >= failures:
                break
            try:
                got = fetch(s, pages[s])
            except Exception:  # noqa: BLE001  any failure of a source only ends that source
                failed.append(s)
                live.remove(s)
                continue
            pages[s] += 1
            if not got:
                live.remove(s)
            out += list(got)[: most - len(out)]
    return out, failed


def isolated(df: DataFrame, key: str, schema: str, work: Callable[[dict], dict]) -> DataFrame:
    """``work`` on each row; one that raises, or gives fields outside the schema, becomes a row with status FAILED and the reason."""
    import pandas as pd

    names = [p.strip().split()[0] for p in schema.split(",")]

    def run(frames: Iterable[pd.DataFrame]):
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                try:
                    got = work(r)
                    if set(got) - set(names):
                        raise ValueError("unknown fields")
                    rows.append({key: r[key], "status": "OK", "reason": None, **{n: got.get(n) for n in names}})
                except Exception as e:  # noqa: BLE001  the batch goes on
                    rows.append({key: r[key], "status": "FAILED", "reason": str(e)[:180], **dict.fromkeys(names)})
            yield pd.DataFrame(rows, columns=[key, "status", "reason", *names])

    kind = dict(df.dtypes)[key]
    return df.mapInPandas(run, f"{key} {kind}, status string, reason string, {schema}")


def numbered_review_problems(df: DataFrame, ordinal: str, key: Sequence[str], labels: Sequence[str], label: str, day: str) -> DataFrame:
    """(line, problem) of a review sheet, the first problem of each line: KEY for an empty part of the key, LABEL for an unknown one, DATE for what is no
    day, REPEATED for the key of an earlier line without these. The header is line 1.

    A sheet with a ``line`` column keeps its numbers; another is numbered by ``ordinal`` over ranges. A repeated key is found by its first line, a
    minimum that combines before the shuffle.
    """
    lines = df if "line" in df.columns else numbered(df, [ordinal], start=2)
    empty = F.lit(False)
    for k in key:
        empty = empty | (F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) == "")
    known = F.coalesce(F.upper(F.trim(label)).isin(*labels), F.lit(False))
    own = F.when(empty, "KEY").when(~known, "LABEL").when(F.col(day).try_cast("date").isNull(), "DATE")
    lines = lines.withColumn("__own", own)
    first = lines.filter("__own is null").groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.min("line").alias("__first"))
    same = F.lit(True)
    for k in key:
        same = same & (F.col(k) == F.col(f"__{k}"))
    problem = F.coalesce("__own", F.when(F.col("line") > F.col("__first"), "REPEATED"))
    return lines.join(first, same, "left").withColumn("problem", problem).filter("problem is not null").select("line", "problem")
