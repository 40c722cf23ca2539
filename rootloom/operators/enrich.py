"""Entries to enriched entries: origin type, axes, authorities, text quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import normalize, once, strip_ws
from rootloom.rules.model import OriginPack, OriginRule
from rootloom.rules.vocab import ATTRIBUTION_DIRECT


def strip_letter_chain(body: Column, pack: OriginPack) -> Column:
    """What follows the opening letter-name chain, normalised for the cascade."""
    text = body
    if pack.noise:
        text = strip_ws(F.regexp_replace(F.regexp_replace(text, pack.noise, " "), r"\s+", " "))
    if pack.pre_strip:
        text = normalize(text, pack.pre_strip)
    tails = [F.nullif(F.regexp_extract(text, chain, 1), F.lit("")) for chain in pack.chains]
    after = strip_ws(F.coalesce(*tails, text))
    if pack.raw_prefix:
        after = F.regexp_replace(after, pack.raw_prefix, "")
    after = normalize(after, pack.profile)
    for prefix in pack.context_prefixes:
        after = strip_ws(F.regexp_replace(after, prefix, ""))
    return after


def _seen(after: Column, window: int | None) -> Column:
    return F.substring(after, 1, window) if window else after


def origin_rule(after: Column, pack: OriginPack) -> Column:
    """Name of the first rule that holds, NULL when none does."""
    out = None
    for rule in pack.rules:
        hit = _seen(after, rule.window).rlike(rule.pattern)
        out = F.when(hit, rule.name) if out is None else out.when(hit, rule.name)
    return out


def _axis_texts(after: Column, rule: OriginRule) -> Column:
    source = _seen(after, rule.extract_window if rule.extract else rule.window)
    texts = [strip_ws(F.regexp_replace(F.regexp_extract(source, rule.extract or rule.pattern, g),
                                       r"\s+", " ")) for g in rule.groups]
    found = F.filter(F.array(*texts), lambda t: t != "")
    return F.slice(found, 1, 1) if rule.first_only else found


def _by_rule(rule: Column, pack: OriginPack, value, default: Column) -> Column:
    out = None
    for r in pack.rules:
        v = value(r)
        if v is not None:
            out = F.when(rule == r.name, v) if out is None else out.when(rule == r.name, v)
    return out.otherwise(default)


def classify_origin(entries: DataFrame, pack: OriginPack, body: str = "body_text") -> DataFrame:
    """Adds ``after``, ``origin_rule``, ``entry_type``, ``axes_count``."""
    rule = F.col("origin_rule")
    df = once(entries.withColumn("after", strip_letter_chain(F.coalesce(F.col(body), F.lit("")), pack)), "after")
    df = once(df.withColumn("origin_rule", origin_rule(F.col("after"), pack)), "origin_rule")
    return (df
            .withColumn("entry_type", _by_rule(rule, pack, lambda r: F.lit(r.entry_type), F.lit("UNKNOWN")))
            .withColumn("axes_count", _by_rule(rule, pack, lambda r: F.lit(r.axes_count), F.lit(None))))


def extract_axes(entries: DataFrame, pack: OriginPack) -> DataFrame:
    """Adds ``semantic_axes`` from the groups of the winning rule only."""
    none = F.array().cast("array<string>")
    texts = _by_rule(F.col("origin_rule"), pack,
                     lambda r: _axis_texts(F.col("after"), r) if r.groups else None, none)
    return once(entries.withColumn("semantic_axes", F.transform(texts, lambda t: F.struct(
        t.alias("text"), F.lit(ATTRIBUTION_DIRECT).alias("attribution")))), "semantic_axes")


def quoted_authorities(body: Column, pack: OriginPack) -> Column:
    return F.array_sort(F.array_distinct(
        F.regexp_extract_all(body, F.lit(f"({pack.authorities})"), F.lit(1))))


def ocr_confidence(body: Column, pack: OriginPack) -> Column:
    total = F.length(body)
    suspect = total - F.length(F.regexp_replace(body, pack.ocr_suspect, ""))
    return F.greatest(F.lit(0.0), F.round(1.0 - suspect / F.greatest(total, F.lit(1)) * 10, 2))


def enrich(entries: DataFrame, pack: OriginPack, body: str = "body_text") -> DataFrame:
    """All enrichment columns in one pass without a shuffle."""
    text = F.coalesce(F.col(body), F.lit(""))
    return (extract_axes(classify_origin(entries, pack, body), pack)
            .withColumn("quoted_authorities", quoted_authorities(text, pack))
            .withColumn("ocr_confidence", ocr_confidence(text, pack))
            .withColumn("review_state", F.lit("PENDING"))
            .withColumn("claim_status", F.lit("UNVERIFIED"))
            .drop("after", "origin_rule"))


def enrichment_report(enriched: DataFrame) -> DataFrame:
    """Per type: entries, entries with axes, multi-origin, low quality, first sample."""
    first_axis = F.coalesce(F.get("semantic_axes", F.lit(0))["text"], F.lit("—"))
    return enriched.groupBy("entry_type").agg(
        F.count("*").alias("entries"),
        F.count_if(F.size("semantic_axes") > 0).alias("with_axes"),
        F.count_if(F.coalesce("axes_count", F.lit(0)) >= 2).alias("multi_origin"),
        F.count_if(F.col("ocr_confidence") < 0.8).alias("low_ocr"),
        F.count_if(F.col("entry_type") == "UNKNOWN").alias("unknown"),
        F.min_by("root_display", "entry_num").alias("sample_root"),
        F.min_by(F.substring(first_axis, 1, 50), F.col("entry_num")).alias("sample_axis"))
