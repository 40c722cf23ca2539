"""Text normalisation as single-pass ``translate`` expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rootloom.rules.model import Profile

BLANKS = " \t\n\r\f\u000b"


def strip_ws(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def normalize(col: Column, profile: Profile) -> Column:
    out = F.lower(col) if profile.lower else col
    if profile.fold_from or profile.delete:
        out = F.translate(out, profile.fold_from + profile.delete, profile.fold_to)
    if profile.strip_prefix:
        out = F.regexp_replace(out, profile.strip_prefix, "")
    if profile.collapse:
        out = F.trim(F.regexp_replace(out, r"\s+", " "))
    return out


def normalize_root(col: Column, profile: Profile) -> Column:
    return normalize(F.replace(col, F.lit(" "), F.lit("")), profile)
