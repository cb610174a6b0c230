"""Numbers out of raw strings, change measures and ratios. Nothing is rounded here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_number(x: Column) -> Column:
    """Number of a string with thousands commas; 0.0 if it is none."""
    return F.coalesce(F.replace(x, F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0))


def strict_number(x: Column) -> Column:
    """Number of a string with thousands commas; null if it is none (rows are dropped by the caller)."""
    return F.replace(x, F.lit(","), F.lit("")).try_cast("double")


def code(x: Column) -> Column:
    """Integer-like codes in one spelling: trimmed, without a trailing ``.0``."""
    return F.regexp_replace(F.trim(x.cast("string")), r"\.0$", "")


def change_fraction(now: Column, before: Column) -> Column:
    """(now - before) / before; null unless before > 0."""
    return F.when(before > 0, (now - before) / before)


def change_signed(now: Column, before: Column) -> Column:
    """(now - before) / before; null if before is 0."""
    return F.when(before != 0, (now - before) / before)


def change_percent(now: Column, before: Column) -> Column:
    """(now / before - 1) * 100; null if before is 0 or missing."""
    return F.when(before != 0, (now / before - 1) * 100)


def share_points(part_now: Column, all_now: Column, part_before: Column, all_before: Column) -> Column:
    """Difference of two shares in percentage points; null if a total is 0."""
    return F.when((all_now != 0) & (all_before != 0), (part_now / all_now - part_before / all_before) * 100)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; null if whole is 0."""
    return F.when(whole != 0, part / whole)


def share_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def exact(x: Column, scale: int = 4) -> Column:
    """As a decimal, so that sums do not depend on the order of rows."""
    return x.cast(f"decimal(20,{scale})")
