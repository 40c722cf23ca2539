"""First-match rule lists compiled to one CASE expression (it short-circuits)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def first_label(text: Column, rules: Iterable[tuple[str, str]], default: str | None) -> Column:
    out = None
    for pattern, label in rules:
        hit = text.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def first_text(text: Column, patterns: Iterable[str], group: int = 1) -> Column:
    """Group text of the first pattern that gives a non-empty one, else NULL."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p in patterns))


def label_map(col: Column, mapping: Mapping[str, str], default: str | Column | None = None) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.element_at(F.create_map(*pairs), col), fallback)
