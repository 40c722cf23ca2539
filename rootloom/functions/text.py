"""Small text expressions used inside the jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rootloom.functions.normalize import strip_ws


def none_if_blank(col: Column) -> Column:
    return F.when(strip_ws(col) != "", strip_ws(col))


def cut(col: Column, length: int) -> Column:
    return F.substring(col, 1, length)


def body_excerpt(body: Column, length: int = 300) -> Column:
    return F.when(F.length(body) > length, F.concat(cut(body, length), F.lit("…"))).otherwise(body)


def excerpt(text: Column, keyword: Column, before: int = 60, window: int = 150) -> Column:
    """Context of the first hit, with ellipses at cut ends; no hit gives the head."""
    at = F.instr(text, keyword) - 1
    start = F.greatest(F.lit(0), at - before)
    stop = F.least(F.length(text), at + window)
    around = F.concat(F.when(start > 0, "…").otherwise(""),
                      text.substr(start + 1, stop - start),
                      F.when(stop < F.length(text), "…").otherwise(""))
    return F.when(at >= 0, around).otherwise(cut(text, window))


def fix_ocr(col: Column, fix: tuple[str, str]) -> Column:
    return F.regexp_replace(col, *fix)


def best_text(human: Column, corrected: Column, raw: Column) -> Column:
    return F.coalesce(none_if_blank(human), none_if_blank(corrected), none_if_blank(raw), F.lit(""))


def text_confidence(human: Column, corrected: Column, raw: Column, confidence: Column) -> Column:
    """1.0 human, 0.7 corrected, scaled recogniser confidence for raw, else 0."""
    return (F.when(F.length(human) > 0, F.lit(1.0))
            .when(F.length(corrected) > 0, F.lit(0.7))
            .when(F.length(raw) > 0, F.round(F.coalesce(confidence, F.lit(0.5)) * 0.6, 3))
            .otherwise(F.lit(0.0)))


def checksum(col: Column, length: int | None = None) -> Column:
    full = F.sha2(col, 256)
    return cut(full, length) if length else full


def entity_id(namespace: str, kind: str, *parts: Column | str) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws(":", F.lit(f"{namespace}:{kind}"), *(c.cast("string") for c in cols))


def exact_avg(col: Column) -> Column:
    """Mean summed in decimals: the same in any row order, so thresholds do not flicker."""
    return F.avg(col.cast("decimal(20,9)")).cast("double")


def volume_number(filename: Column) -> Column:
    """`02.pdf` gives 2; a name without digits gives 0."""
    digits = F.nullif(F.regexp_extract(filename, r"^\D*(\d+)\.pdf$", 1), F.lit(""))
    return F.coalesce(digits.cast("long"), F.lit(0).cast("long"))


def source_id(filename: Column, namespace: str = "lex") -> Column:
    known = F.regexp_extract(filename, r"^\D*(\d+)\.pdf$", 1) != ""
    label = F.when(known, volume_number(filename).cast("string")).otherwise("_unknown")
    return F.concat(F.lit(f"{namespace}:source:vol"), label)


def classify_evidence_id(col: Column, namespace: str = "lex") -> Column:
    """The namespaced prefix wins over a generic catalogue id."""
    return (F.when(col.startswith(f"{namespace}:root:"), "LEXICON_ROOT")
            .when(col.startswith(f"{namespace}:"), "LEXICON_ENTITY")
            .when(F.lower(col).contains("root") & F.lower(col).contains("catalog"), "ROOT_CATALOG")
            .otherwise("OTHER"))


def root_profile(root: Column, script_class: str) -> Column:
    letters = F.regexp_replace(root, f"[^{script_class}]", "")
    return F.struct(
        F.filter(F.split(letters, ""), lambda c: c != "").alias("letters"),
        F.nullif(F.length(letters), F.lit(0)).alias("letter_count"),
        (F.length(F.replace(root, F.lit(" "), F.lit(""))) == 2).alias("geminate"),
    )
