"""Dates, cadences and periods. ``as_of`` is always a parameter."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days in which a source of a cadence is fresh, and in which it may be carried.
CADENCE = {"daily": (3, 7), "continuous": (7, 14), "event": (14, 28), "weekly": (14, 28), "monthly": (45, 90), "quarterly": (120, 180)}


def day(x: Column) -> Column:
    """Date of an ISO or yyyymmdd text; null if it is none."""
    return F.coalesce(x.try_cast("date"), F.try_to_timestamp(x, F.lit("yyyyMMdd")).cast("date"))


def freshness(cadence: Column, age: Column) -> Column:
    """FUTURE, FRESH, CARRY, STALE, or UNKNOWN without a date; an unknown cadence counts as continuous."""
    out = F.when(age.isNull(), "UNKNOWN").when(age < 0, "FUTURE")
    for name, (fresh, carry) in CADENCE.items():
        out = out.when((cadence == name) & (age <= fresh), "FRESH").when((cadence == name) & (age <= carry), "CARRY").when(cadence == name, "STALE")
    fresh, carry = CADENCE["continuous"]
    return out.when(age <= fresh, "FRESH").when(age <= carry, "CARRY").otherwise("STALE")


def due_status(due: Column, as_of: date) -> Column:
    at = F.lit(as_of)
    return F.when(due.isNull(), "UNSCHEDULED").when(due < at, "OVERDUE").when(due == at, "DUE_TODAY").otherwise("UPCOMING")


def overdue_days(due: Column, as_of: date) -> Column:
    return F.greatest(F.datediff(F.lit(as_of), due), F.lit(0))


def priority(stage: Column, status: Column, evidence: Column) -> Column:
    """P1 for stage S1 that is due or has evidence E3, P2 for other S1, else P3."""
    due = status.isin("OVERDUE", "DUE_TODAY")
    return F.when((stage == "S1") & (due | (evidence == "E3")), "P1").when(stage == "S1", "P2").otherwise("P3")


def month_day(month: Column, dom: Column, as_of: date) -> Column:
    """Full date of a month and day: this year's if it is before ``as_of``, else last year's; null if there is no such day."""
    made = lambda y: F.try_to_timestamp(F.format_string("%04d-%02d-%02d", F.lit(y), month, dom), F.lit("yyyy-MM-dd")).cast("date")
    this = made(as_of.year)
    return F.when(this < F.lit(as_of), this).otherwise(made(as_of.year - 1))


def per_hour(count: Column, since: Column, now: Column) -> Column:
    """Count per hour since a time; the age is one hour at least."""
    hours = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(since.cast("timestamp"))).cast("double") / 3_600_000_000
    return count / F.greatest(hours, F.lit(1.0))


def lifecycle(gap_days: Column, resolved: Column, partial: Column, long_gap: int = 270) -> Column:
    return F.when(gap_days.isNull(), "NO_MATCH").when(resolved, "RESOLVED").when(partial, "PARTIAL").when(gap_days >= long_gap, "REPEATED_LONG").otherwise("REPEATED_SHORT")


def expired(at: Column, made: Column, hours: int = 26) -> Column:
    return at > made + F.expr(f"interval {hours} hours")


def quota_day(utc: Column, zone: str = "America/Los_Angeles") -> Column:
    """Calendar day of a UTC time in the zone of the quota."""
    return F.from_utc_timestamp(utc.cast("timestamp"), zone).cast("date")


def iso_seconds(x: Column) -> Column:
    """Seconds of an ISO-8601 duration of hours, minutes and seconds."""
    part = lambda u: F.coalesce(F.regexp_extract(x, rf"(\d+){u}", 1).try_cast("int"), F.lit(0))
    return F.when(x.startswith("PT"), part("H") * 3600 + part("M") * 60 + part("S"))


def latest_date(x: Column, as_of: date, ahead: int = 3) -> Column:
    """Latest ISO date in a text that is not more than ``ahead`` days after ``as_of``; a year and month count as the month's
    end, this month's as ``as_of``."""
    full = F.transform(F.regexp_extract_all(x, F.lit(r"(\d{4}-\d{2}-\d{2})"), F.lit(1)), lambda d: d.try_cast("date"))
    month = F.transform(F.regexp_extract_all(x, F.lit(r"(\d{4}-\d{2})(?!-?\d)"), F.lit(1)), lambda m: F.last_day(F.concat(m, F.lit("-01")).try_cast("date")))
    month = F.transform(month, lambda d: F.when(F.date_trunc("month", d) == F.date_trunc("month", F.lit(as_of)), F.lit(as_of)).otherwise(d))
    return F.array_max(F.filter(F.concat(full, month), lambda d: d <= F.date_add(F.lit(as_of), ahead)))


def latest_period(x: Column, as_of: date, ahead: int = 3) -> Column:
    """struct(effective, label) of the latest date or period in a text that is not more than ``ahead`` days after ``as_of``.

    Full dates, years with a month, two-digit years with a month after an apostrophe (of this century) and years alone, separated by
    ``-``, ``.`` or ``/``. What a longer form has taken is not read again as a shorter one. A period counts as its last day, the one
    that ``as_of`` lies in as ``as_of``. Of equal days the longer label wins. No such day: not read. Null without any.
    """
    at, sep, rest = F.lit(as_of), "[-./]", F.coalesce(x, F.lit(""))
    full, month, short, year = rf"(?<!\d)(\d{{4}}{sep}\d{{1,2}}{sep}\d{{1,2}})(?!\d)", rf"(?<!\d)(\d{{4}}{sep}\d{{1,2}})(?!\d)", rf"['’](\d{{2}}{sep}\d{{1,2}})(?!\d)", r"(?<!\d)((?:19|20)\d{2})(?!\d)"

    def take(pattern: str, mask: str, before: str, day: Callable[[Column], Column]) -> Column:
        def one(found: Column) -> Column:
            parts = F.split(found, sep)
            filled = F.concat_ws("-", F.concat(F.lit(before), parts[0]), *[F.lpad(F.get(parts, F.lit(i)), 2, "0") for i in range(1, mask.count("-") + 1)])
            last = day(filled)
            own = (F.date_format(last, mask) == F.date_format(at, mask)) if mask != "yyyy-MM-dd" else F.lit(False)
            return F.struct(F.when(own, at).otherwise(last).alias("effective"), filled.alias("label"))

        return F.transform(F.regexp_extract_all(rest, F.lit(pattern), F.lit(1)), one)

    found = [take(full, "yyyy-MM-dd", "", lambda d: d.try_cast("date"))]
    rest = F.regexp_replace(rest, full, " ")
    end = lambda m: F.last_day(F.concat(m, F.lit("-01")).try_cast("date"))
    found += [take(month, "yyyy-MM", "", end), take(short, "yyyy-MM", "20", end)]
    rest = F.regexp_replace(F.regexp_replace(rest, month, " "), short, " ")
    found.append(take(year, "yyyy", "", lambda y: F.concat(y, F.lit("-12-31")).try_cast("date")))
    return F.array_max(F.filter(F.concat(*found), lambda f: f["effective"] <= F.date_add(at, ahead)))


def band(hour: Column, bands: dict[str, tuple[int, int]]) -> Column:
    """Names of the hour bands (both ends in) that have the hour: none, one or more."""
    return F.array_compact(F.array(*[F.when(hour.between(lo, hi), F.lit(name)) for name, (lo, hi) in bands.items()]))
