"""Text functions. Term lists and patterns are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of personal data in the order of replacement, and what replaces them.
REDACTIONS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    (r"\b\d{6}-\d{7}\b", "[ID]"),
    (r"\+?\d[\d .-]{7,}\d", "[PHONE]"),
)
#: Words that come before a name, endings of street names, and names of session parameters.
NAME_LEADS, ROAD_ENDS, SESSION_NAMES = ("제 이름은", "이름:", "이름"), ("로", "길"), ("jsessionid", "dmcsession", "sessionid")
#: The same with sessions, identity numbers of either form, flats, streets and names: mail, session, identity number, flat, street, name, phone.
PERSONAL = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    (rf"(?i)({'|'.join(SESSION_NAMES)})[ ]*[=:][ ]*[\"']?[A-Za-z0-9._~-]+", "$1=[REDACTED]"),
    (r"\b[0-9]{6}[- ]?[1-4][0-9]{6}\b", "[ID]"),
    (r"[0-9]+ *동 *[0-9]+ *호", "[ADDRESS]"),
    (rf"[가-힣A-Za-z0-9]{{1,24}}(?:{'|'.join(ROAD_ENDS)}) *[0-9]+(?:-[0-9]+)?", "[ADDRESS]"),
    (rf"(?:{'|'.join(NAME_LEADS)}) *[가-힣]{{2,4}}", "[NAME]"),
    (r"\+?[0-9][0-9 .-]{7,}[0-9]", "[PHONE]"),
)
#: Secrets in error texts: addresses first, then key=value pairs.
ERROR_REDACTIONS = ((r"https?://\S+", "[URL]"), (r"(?i)\b(key|token|secret|password)=[^&\s]+", "$1=[REDACTED]"))


def squash(x: Column) -> Column:
    """White space of any kind to single blanks, none at the ends; null to an empty text."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def key_of(x: Column, keep: str = "0-9a-z가-힣", limit: int | None = None) -> Column:
    """Lower-case letters and digits only; at most ``limit`` of them."""
    out = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), f"[^{keep}]", "")
    return out if limit is None else F.substring(out, 1, limit)


def concise(x: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last one an ellipsis where something was cut."""
    x = squash(x)
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(F.rtrim(F.substring(x, 1, limit - 1)), F.lit("…")))


def redact(x: Column, rules: Sequence[tuple[str, str]] = REDACTIONS) -> Column:
    for pattern, mask in rules:
        x = F.regexp_replace(x, pattern, mask)
    return x


def safe_error(x: Column, limit: int = 180) -> Column:
    """Error text without addresses and secrets, cut to ``limit``."""
    return F.substring(redact(squash(x), ERROR_REDACTIONS), 1, limit)


def digest_id(*parts: Column, length: int = 16, sep: str = "|") -> Column:
    """The first characters of SHA-256 over the parts, nulls as empty texts."""
    return F.substring(F.sha2(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, length)


def digest_id_short(*parts: Column, length: int = 12, sep: str = "|") -> Column:
    """The same over SHA-1."""
    return F.substring(F.sha1(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary")), 1, length)


def tokens(x: Column, stop: Sequence[str] = (), pattern: str = r"[0-9A-Za-zÀ-ɏ가-힣]{2,}") -> Column:
    """Distinct lower-case tokens in order of appearance, without stop words and plain numbers."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(f"({pattern})"), F.lit(1)))
    if stop:
        found = F.array_except(found, F.array(*map(F.lit, stop)))
    return F.filter(found, lambda t: ~t.rlike(r"^[0-9]+$"))


def matched_terms(x: Column, terms: Sequence[str], limit: int | None = None) -> Column:
    """Terms contained in the text, whatever their case, in the order of ``terms``."""
    low = F.lower(F.coalesce(x, F.lit("")))
    out = F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(low, F.lower(t)))
    return out if limit is None else F.slice(out, 1, limit)


def before_markers(x: Column, markers: Sequence[str]) -> Column:
    """The text before the first occurrence of any marker."""
    low = F.lower(x)
    at = F.array_min(F.filter(F.array(*[F.locate(m.lower(), low) for m in markers]), lambda p: p > 0))
    return F.when(at.isNull(), x).otherwise(F.rtrim(x.substr(F.lit(1), at - 1)))


def head_part(x: Column) -> Column:
    """The headline before a dash or pipe between blanks."""
    return F.element_at(F.split(x, r" [-|] ", 2), 1)


def relevant_reason(x: Column, areas: Sequence[str], names_only: Sequence[str] = ()) -> Column:
    """The first area in the headline's first part; null if there is none or a name-only term is there too."""
    head = head_part(x)
    hit = F.get(matched_terms(head, areas), F.lit(0))
    if names_only:
        hit = F.when(F.size(matched_terms(head, names_only)) == 0, hit)
    return hit


def grounded(quote: Column, body: Column, least: int = 12, most: int = 100) -> Column:
    """Whether the quote, without white space, has from ``least`` to ``most`` characters and is in the body."""
    q, b = (F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", "") for x in (quote, body))
    return F.length(q).between(least, most) & F.contains(b, q)


def numbers_in(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"([0-9]+(?:[.,][0-9]+)*)"), F.lit(1)))


def unsupported(claim: Column, quotes: Column) -> Column:
    """Numbers of the claim that the quotes do not have; a sound claim has none."""
    return F.array_except(numbers_in(claim), numbers_in(quotes))


def copies_quote(headline: Column, quote: Column, share: float = 0.9) -> Column:
    """Whether more than ``share`` of the headline's tokens are in the quote."""
    h = tokens(headline)
    return F.when(F.size(h) > 0, F.size(F.array_intersect(h, tokens(quote))) / F.size(h) > share).otherwise(F.lit(False))


def first_rule(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that holds."""
    out = None
    for condition, label in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default) if out is not None else F.lit(default)


def points(*parts: tuple[Column, int]) -> Column:
    """Sum of points of the conditions that hold; penalties are negative."""
    total = F.lit(0)
    for condition, n in parts:
        total = total + F.when(condition, n).otherwise(0)
    return total


def field_after(x: Column, pattern: str, kind: str = "string") -> Column:
    """First group of a pattern, as ``kind``; null if absent or malformed."""
    got = F.regexp_extract(F.coalesce(x, F.lit("")), pattern, 1)
    return F.when(got != "", got).try_cast(kind) if kind != "string" else F.when(got != "", got)


def canonical_url(x: Column) -> Column:
    """Scheme and host in lower case, no fragment, no trailing slash."""
    bare = F.regexp_replace(F.trim(x), r"#.*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1))
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    return F.regexp_replace(F.concat(head, rest), r"/+$", "")


def query_value(x: Column, name: str) -> Column:
    return field_after(x, rf"[?&]{name}=([^&#]*)")


def host_allowed(x: Column, hosts: Sequence[str]) -> Column:
    """Whether the host is one of ``hosts`` or under it."""
    host = F.lower(F.regexp_extract(x, r"^https?://([^/:?#]+)", 1))
    out = F.lit(False)
    for h in hosts:
        out = out | (host == h) | host.endswith("." + h)
    return out


def header_values(x: Column, allowed: Sequence[str], sep: str = "·") -> Column:
    """Map of ``header: number`` parts with an allowed header."""
    parts = F.filter(F.transform(F.split(x, sep), lambda p: F.trim(p)), lambda p: p.rlike(r"^[^:]+:\s*[0-9][0-9,.]*$"))
    entries = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("key"), F.trim(F.substring_index(p, ":", -1)).alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isin(*allowed)))


def label_map_hits(x: Column, labels: dict[str, Sequence[str]]) -> Column:
    """Labels whose tokens occur in the text, in the order of ``labels``."""
    low = F.lower(F.coalesce(x, F.lit("")))
    hits = []
    for label, terms in labels.items():
        any_of = F.lit(False)
        for t in terms:
            any_of = any_of | F.contains(low, F.lit(t.lower()))
        hits.append(F.when(any_of, F.lit(label)))
    return F.array_compact(F.array(*hits))


def bound_in_sentence(x: Column, left: Sequence[str], right: Sequence[str]) -> Column:
    """Whether one sentence has a term of both lists."""

    def has(s: Column, terms: Sequence[str]) -> Column:
        out = F.lit(False)
        for t in terms:
            out = out | F.contains(s, F.lit(t.lower()))
        return out

    return F.exists(F.split(F.lower(F.coalesce(x, F.lit(""))), r"[.!?\n]"), lambda s: has(s, left) & has(s, right))


def term_hits(x: Column, pattern: str) -> Column:
    """Number of matches of a pattern."""
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(pattern)).cast("long")


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0 if one is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def overlap(a: Column, b: Column) -> Column:
    """Common tokens over the smaller set; 0 if one is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b)))


def titles_match(a: Column, b: Column, least: int = 12, length_ratio: float = 0.65, shared: float = 0.8) -> Column:
    """Containment with similar lengths, or most words in common; keys under ``least`` characters never match."""
    ka, kb = key_of(a), key_of(b)
    la, lb = F.length(ka), F.length(kb)
    contained = (F.contains(ka, kb) | F.contains(kb, ka)) & (F.least(la, lb) / F.greatest(la, lb) >= length_ratio)
    ta, tb = tokens(a), tokens(b)
    common = F.when(F.greatest(F.size(ta), F.size(tb)) > 0, F.size(F.array_intersect(ta, tb)) / F.greatest(F.size(ta), F.size(tb)) >= shared).otherwise(F.lit(False))
    return (F.least(la, lb) >= least) & (contained | common)


def stem(t: Column, suffixes: Sequence[str], least: int = 3) -> Column:
    """Token without the longest of the suffixes, if ``least`` characters remain."""
    ordered = "|".join(sorted(suffixes, key=lambda s: (-len(s), s)))
    return F.regexp_replace(t, rf"^(.{{{least},}}?)(?:{ordered})$", "$1")


def shared_weight(a: Column, b: Column, most: int = 8) -> Column:
    """Sum over shared tokens of min(length + 1, ``most``)."""
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, t: s + F.least(F.length(t) + 1, F.lit(most)))


def pipe_set(x: Column) -> Column:
    """Sorted distinct non-empty parts of a pipe-separated set."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda p: F.trim(p)), lambda p: p != "")))


def pipe_join(x: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(x)), "|")


def hide_escapes(x: Column) -> Column:
    """JSON text in which escaped backslashes and quotes are control characters, so that a quote always ends a string and a pattern of plain runs reads it."""
    return F.replace(F.replace(x, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))


def show_escapes(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
