"""Pandas functions for what built-in expressions cannot say: chunks, nearest spans, excerpts and protected measurements."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squash


#: What ends a line: the usual breaks, vertical tab, form feed, the separators of files, groups and records, and Unicode's own.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def chunks(x: Column, size: int = 12_000, overlap: int = 600, least: int = 120) -> Column:
    """Overlapping chunks of a text as an array, by offsets into its squashed lines.

    Lines, their white space collapsed and empty ones left out, are joined by line breaks; a line of over ``size`` characters stands as cuts of
    ``size`` that repeat ``overlap`` of the one before. A chunk begins with the first line that the one before has no room for, and takes lines while it
    is no longer than ``size`` (the first chunk of a text one less); it has one line at least. In front of it stands what comes ``overlap`` characters before it,
    which counts towards its length, so a chunk of one line can be longer than ``size``. Chunks of under ``least`` characters are
    dropped; null and empty texts have none.
    """
    step = max(1, size - overlap)
    lines = F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), LINE_ENDS), squash), lambda t: t != "")
    cut = lambda t: F.transform(F.sequence(F.lit(1), F.length(t), F.lit(step)), lambda i: t.substr(i, F.lit(size)))
    pieces = F.flatten(F.transform(lines, lambda t: F.when(F.length(t) > size, cut(t)).otherwise(F.array(t))))
    front = lambda start: F.greatest(start - overlap - 1, F.lit(0)) if overlap else start
    # Of the chunk at hand where it begins in the whole; of each chunk where its first line starts. A line ends at the state's ``end``.
    zero = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("front"), F.array(F.lit(0)).alias("starts"))

    def add(state: Column, piece: Column) -> Column:
        start, end = state["end"] + 1, state["end"] + 1 + F.length(piece)
        longer = end - state["front"] + F.when(F.size(state["starts"]) == 1, 1).otherwise(0)
        full = (longer > size) & (start > F.element_at(state["starts"], -1))
        return F.struct(end.alias("end"), F.when(full, front(start)).otherwise(state["front"]).alias("front"), F.when(full, F.concat(state["starts"], F.array(start))).otherwise(state["starts"]).alias("starts"))

    def cut_out(whole: Column, starts: Column) -> Column:
        stop = lambda i: F.coalesce(F.get(starts, i + 1) - 1, F.length(whole))
        return F.transform(starts, lambda s, i: whole.substr(front(s) + 1, stop(i) - front(s)))

    # The whole and the starts are each computed once: a transform over one struct binds both.
    bound = F.array(F.struct(F.array_join(pieces, "\n").alias("whole"), F.aggregate(pieces, zero, add)["starts"].alias("starts")))
    all_of = F.flatten(F.transform(bound, lambda b: cut_out(b["whole"], b["starts"])))
    return F.filter(all_of, lambda c: F.length(squash(c)) >= F.lit(max(least, 1)))


def nearest_span_of(text: str, left: Sequence[str], right: Sequence[str], most: int = 180) -> tuple[int, int] | None:
    """Shortest span with a term of both lists, ``most`` characters or fewer; the earlier of equal ones."""
    low = text.lower()
    find = lambda terms: sorted((m.start(), m.end()) for t in terms for m in re.finditer(re.escape(t.lower()), low))
    a, b = find(left), find(right)
    best, j = None, 0
    for s, e in a:
        # Only the nearest right terms before and after can make a shortest span with this one.
        while j < len(b) and b[j][0] < s:
            j += 1
        for k in (j - 1, j, j + 1):
            if 0 <= k < len(b):
                lo, hi = min(s, b[k][0]), max(e, b[k][1])
                if hi - lo <= most and (best is None or (hi - lo, lo) < (best[1] - best[0], best[0])):
                    best = (lo, hi)
    return best


def excerpt_of(text: str, span: tuple[int, int], around: int = 15, most: int = 240) -> str:
    """The span with ``around`` characters on both sides, never cut inside a [TOKEN], ``most`` characters at the most."""
    lo, hi = max(0, span[0] - around), min(len(text), span[1] + around)
    for m in re.finditer(r"\[[A-Z_]+\]", text):
        if m.start() < lo < m.end():
            lo = m.start()
        if m.start() < hi < m.end():
            hi = m.end()
    out = text[lo:hi]
    if len(out) > most:
        out = out[:most]
        at = out.rfind("[")
        if at > out.rfind("]"):
            out = out[:at]
    return out.strip()


def nearest_span(x: Column, left: Sequence[str], right: Sequence[str], most: int = 180, around: int = 15) -> Column:
    """Struct of start, stop (end exclusive) and excerpt; null where no span is short enough."""
    left, right = list(left), list(right)

    @F.pandas_udf("start int, stop int, excerpt string")
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for t in s:
            span = nearest_span_of(t or "", left, right, most)
            rows.append((None, None, None) if span is None else (span[0], span[1], excerpt_of(t, span, around)))
        out = pd.DataFrame(rows, columns=["start", "stop", "excerpt"], dtype=object)
        return out

    got = run(x)
    return F.when(got["start"].isNotNull(), got)


#: Numbers that are references, ordinals or dates are no measurements.
PROTECTED = (r"\b(?:art|article|section|no)\.?\s*\d+", r"\b\d+(?:st|nd|rd|th)\b", r"\b\d{4}-\d{2}-\d{2}\b")
MEASURES = (r"(?:[$€£]\s?)\d[\d.,]*", r"\d[\d.,]*\s?(?:%|percent|km|kg|hours?|minutes?|days?|people|units?)\b")


def measurements_of(text: str, protected: Sequence[str] = PROTECTED, measures: Sequence[str] = MEASURES) -> list[str]:
    for p in protected:
        text = re.sub(p, " ", text, flags=re.IGNORECASE)
    found = sorted((m.start(), " ".join(m[0].split())) for p in measures for m in re.finditer(p, text, flags=re.IGNORECASE))
    return list(dict.fromkeys(v for _, v in found))


def measurements(x: Column) -> Column:
    """Ordered distinct amounts and measures, without numbers of the protected kinds."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: measurements_of(t or ""))

    return run(x)
