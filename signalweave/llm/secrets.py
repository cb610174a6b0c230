"""Secret scans with multipart credential linking.

Native: regular expressions mark matches inside the text, splitting at the marks gives their offsets in code points, and
candidate parts (access identifiers, weak secrets, endpoints) are interval-joined within a scope: a weak secret counts
only where an identifier or an endpoint lies within ``SCOPE`` code points. Everything happens in the row, so there is no
shuffle and no group of documents ever meets in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_or_empty

#: Code points between parts of one credential.
SCOPE = 200
#: Base kinds in the order that ties in spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Parts that are no finding by themselves.
IDENTIFIER = r"""(?i:client_?id|user(?:name)?|login|account|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"(?i:https?|postgres(?:ql)?|mysql|redis|amqp|mongodb)://[A-Za-z0-9._~:@/?#&=%+-]+"
#: What stands before the last @ of an endpoint's authority; a password may hold a slash.
USERINFO = r"^[A-Za-z]+://(?:[^/?#@]*:[^?#]*|[^/?#]*)@"
#: A maximal run of 20 characters or more with base64 padding; ``_weak`` tests the character classes on all of it.
WEAK = r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=:)//)|(?<=://))[A-Za-z0-9+/_-]{20,}+={0,2}"

#: Two control characters that mark a match. In the text they are first replaced by a third, which no pattern matches.
_OPEN, _SHUT, _OTHER = "\u0001", "\u0002", "\u0003"
_SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def spans(text: Column, pattern: str, kind: str, rank: int, keep=None, guard: str | None = None) -> Column:
    """Array of (start, rank, stop, kind), by code points, of the leftmost non-overlapping matches that satisfy ``keep``.

    ``text`` must be free of the marks (see ``unmarked``). ``guard`` is a cheap pattern that each match contains.
    """
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_SHUT}"), f"[{_OPEN}{_SHUT}]", -1)
    state = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.lit(None).cast(_SPAN).alias("out")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p)).cast("int").alias("at"),
            (~s["hit"]).alias("hit"),
            F.when(
                s["hit"] & (keep(p) if keep else F.lit(True)),
                F.concat(F.coalesce(s["out"], F.array().cast(_SPAN)), F.array(F.struct(s["at"].alias("start"), F.lit(rank).alias("rank"), (s["at"] + F.length(p)).cast("int").alias("stop"), F.lit(kind).alias("kind")))),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )
    found = F.coalesce(state["out"], F.array().cast(_SPAN))
    return F.when(text.rlike(guard or pattern), found).otherwise(F.array().cast(_SPAN))


def unmarked(text: Column) -> Column:
    return F.translate(text, _OPEN + _SHUT, _OTHER + _OTHER)


def base_spans(text: Column) -> dict[str, Column]:
    """The base kinds: assignments with a value of 6 characters or more, access keys of 20 or more, hex runs of 24 or more."""
    return {
        "assign": spans(text, ASSIGN, "assign", 0, lambda p: F.length(F.regexp_extract(p, ASSIGN, 2)) >= 6, ASSIGN),
        "access": spans(text, ACCESS, "access", 1, lambda p: F.length(p) >= 20, r"AKIA[A-Z0-9]{16}"),
        # A run of fewer than 24 can be passed over: it is a match by itself and would be dropped.
        "hex": spans(text, r"[0-9a-f]{24,}", "hex", 2),
    }


def _weak(p: Column) -> Column:
    """Whether a run has a digit, a capital and a small letter."""
    return p.rlike("[0-9]") & p.rlike("[A-Z]") & p.rlike("[a-z]")


def _near(a: Column, b: Column, scope: int) -> Column:
    return (a["start"] <= b["stop"] + scope) & (b["start"] <= a["stop"] + scope)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def secret_places(text: Column, ends: Column) -> Column:
    """Spans of each endpoint's userinfo and of its query and fragment; they may be empty."""

    def place(e: Column, start: Column, stop: Column) -> Column:
        return F.struct((e["start"] + start).cast("int").alias("start"), (e["start"] + stop).cast("int").alias("stop"))

    def both(e: Column) -> Column:
        url = F.substring(text, e["start"] + 1, e["stop"] - e["start"])
        tail = F.regexp_extract(url, r"[?#].*$", 0)
        return F.array(place(e, F.lit(0), F.length(F.regexp_extract(url, USERINFO, 0))), place(e, F.length(url) - F.length(tail), F.length(url)))

    return F.flatten(F.transform(ends, both))


def linked_parts(weak: Column, ids: Column, ends: Column, taken: Column, places: Column, scope: int) -> Column:
    """Weak secrets outside ``taken`` with an identifier or endpoint in scope, and those identifiers and endpoints.

    Of those inside an endpoint only the ones in ``places`` count; they are linked to it.
    """
    free = F.filter(weak, lambda w: ~F.exists(taken, lambda t: _overlap(t, w)) & (~F.exists(ends, lambda e: _overlap(e, w)) | F.exists(places, lambda s: _overlap(s, w))))
    hits = F.filter(free, lambda w: F.exists(F.concat(ids, ends), lambda p: _near(p, w, scope)))
    partners = F.filter(F.concat(ids, ends), lambda p: ~F.exists(taken, lambda t: _overlap(t, p)) & F.exists(hits, lambda w: _near(p, w, scope)))
    return F.concat(hits, partners)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, text_col: str = "text", scope: int = SCOPE, names: tuple[str, str] = ("secret_base", "secret_spans")) -> DataFrame:
    """Every row of ``docs`` with two columns of ``names``: sorted arrays of (start, rank, stop, kind).

    Base spans are in both; spans of parts that only count together are in the second. Null texts count as empty and
    have none. All other columns stay, whatever their names; those of ``docs`` that are named like the two new ones are replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    # Spans are computed in projections of their own, so that each is evaluated once.
    df = docs.select(F.struct(F.lit(0).alias("__none"), *kept).alias("doc"), unmarked(text_or_empty(text_col)).alias("text"))
    df = df.withColumns(base_spans(F.col("text")))
    df = df.withColumns(
        {
            "ids": spans(F.col("text"), IDENTIFIER, "part_id", 3),
            "ends": spans(F.col("text"), ENDPOINT, "part_endpoint", 4),
            "weak": spans(F.col("text"), WEAK, "part_secret", 5, _weak),
        }
    )
    df = df.withColumn("places", F.when(F.size("weak") > 0, secret_places(F.col("text"), F.col("ends"))))
    df = df.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    with_access = F.concat("ids", "access")
    more = F.when(F.size("weak") > 0, linked_parts(F.col("weak"), with_access, F.col("ends"), F.col("base"), F.col("places"), scope)).otherwise(F.array().cast(_SPAN))
    df = df.withColumn("all", F.array_sort(F.concat(F.col("base"), more)))
    fields = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    return df.select(*fields, F.col("base").alias(names[0]), F.col("all").alias(names[1]))


def redacted(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each span (sorted; overlapping ones as one) replaced by ``mask``."""
    state = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["stop"]).cast("int").alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mask))).otherwise(s["out"]).alias("out"),
        ),
    )
    return F.when(F.size(found) == 0, text).otherwise(F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))


def op7_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kind = lambda k: F.size(F.filter("secret_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        kind("assign"),
        kind("access"),
        kind("hex"),
        F.sha2(_joined(F.col("secret_base")), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )
