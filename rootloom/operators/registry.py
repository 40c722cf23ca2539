"""OCR entries to one row per root, typed batch lookup, catalogue evidence ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import label_map, strip_ws
from rootloom.operators.predicates import drop_blank_root, exclude_uncovered_initials, uncovered
from rootloom.session import broadcast_if_small

FOUND = ("FOUND_AUTO_AGREED", "FOUND_REVIEW_REQUIRED")


def real_type(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).isin("NONE", "UNKNOWN", "") == F.lit(False)


def merge_roots(entries: DataFrame, chapter_names: Mapping[str, str], missing: Sequence[str] = (),
                initial_profile=None) -> DataFrame:
    """One row per root.

    "First" always means lowest ``line_no``.  Rows are reduced per (root, file)
    before the second shuffle, so a very common root arrives already condensed.
    """
    kept = drop_blank_root(entries).withColumn("root_letters", strip_ws(F.col("root_letters")))
    if missing:
        kept = exclude_uncovered_initials(kept, missing, initial_profile)
    agreed = F.coalesce("review_status", F.lit("")) == "AUTO_AGREED"
    real = real_type(F.col("semantic_origin_type"))
    typed = F.struct("line_no", F.col("semantic_origin_type").alias("type"),
                     F.col("origin_count").alias("count"))
    corrected = F.struct(
        "line_no", F.col("corrected_bab_letter").alias("chapter"),
        strip_ws(F.coalesce("original_bab_letter", "bab_letter", F.lit(""))).alias("original"),
        F.coalesce("correction_version", F.lit("v1")).alias("version"))

    def first(name: str, cond: Column, value: Column) -> Column:
        return F.min(F.when(cond, value)).alias(name)

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) != ""

    per_file = kept.groupBy("root_letters", F.coalesce("source_pdf", F.lit("")).alias("pdf")).agg(
        F.max(agreed).alias("agreed"), F.count("*").alias("n"), F.min("line_no").alias("seen"),
        first("agreed_type", agreed & real, typed), first("any_type", real, typed),
        first("corrected", filled("corrected_bab_letter"), corrected),
        first("stored", filled("bab_letter"), F.struct("line_no", "bab_letter")),
        first("heading", filled("root_heading_text"), F.struct("line_no", "root_heading_text")))
    per_root = per_file.groupBy("root_letters").agg(
        F.max("agreed").alias("agreed"), F.sum("n").alias("entry_count"),
        *(F.min(c).alias(c) for c in ("agreed_type", "any_type", "corrected", "stored", "heading")),
        F.array_sort(F.collect_list(F.when(F.col("pdf") != "", F.struct("seen", "pdf")))).alias("pdfs"))
    winner = F.when(F.col("agreed"), F.col("agreed_type")).otherwise(F.col("any_type"))
    has = F.col("corrected").isNotNull()
    return per_root.select(
        "root_letters",
        F.coalesce(winner["type"], F.lit("NONE")).alias("semantic_origin_type"),
        winner["count"].alias("origin_count"),
        F.when(F.col("agreed"), "AUTO_AGREED").otherwise("REVIEW_REQUIRED").alias("review_status"),
        "entry_count",
        F.transform("pdfs", lambda x: x["pdf"]).alias("source_pdfs"),
        F.coalesce("heading.root_heading_text", F.lit("")).alias("heading_sample"),
        F.when(has, F.col("corrected.chapter")).otherwise(
            label_map(F.substring("root_letters", 1, 1), chapter_names, "")).alias("bab_letter"),
        F.when(has, F.col("corrected.original")).otherwise(
            F.coalesce("stored.bab_letter", F.lit(""))).alias("original_bab_letter"),
        F.when(has, F.col("corrected.version")).otherwise("v1-derived").alias("correction_version"))


def typed_lookup(requests: DataFrame, registry: DataFrame, missing: Sequence[str],
                 initial_profile=None, load_failed: bool = False) -> DataFrame:
    """Adds ``kind`` (six outcomes) and the registry columns to each request."""
    root = strip_ws(F.coalesce("root", F.lit("")))
    asked = requests.withColumn("lookup_root", root)
    joined = _lookup_join(asked, registry)
    kind = (F.when(F.col("lookup_root") == "", "INVALID_ROOT_INPUT")
            .when(F.lit(load_failed), "REGISTRY_LOAD_FAILURE")
            .when(uncovered(F.col("lookup_root"), missing, initial_profile), "MISSING_VOLUME_COVERAGE_GAP")
            .when(F.col("review_status").isNull(), "NOT_FOUND_IN_COVERED_VOLUME")
            .when(F.col("review_status") == "AUTO_AGREED", FOUND[0]).otherwise(FOUND[1]))
    return joined.withColumn("kind", kind)


def _lookup_join(asked: DataFrame, registry: DataFrame) -> DataFrame:
    """Only registry rows that are asked for travel to the requests."""
    wanted = broadcast_if_small(asked.select("lookup_root").distinct())
    hits = registry.withColumnRenamed("root_letters", "lookup_root").join(
        wanted, "lookup_root", "left_semi")
    return asked.join(hits, "lookup_root", "left")


def lookup_flags(lookups: DataFrame) -> DataFrame:
    kind = F.col("kind")
    return lookups.withColumns({
        "found": kind.isin(*FOUND), "auto_agreed": kind == FOUND[0],
        "review_required": kind == FOUND[1],
        "coverage_gap": kind == "MISSING_VOLUME_COVERAGE_GAP"})


def catalog_evidence_ids(lookups: DataFrame, namespace: str = "lex") -> DataFrame:
    """Adds ``evidence_ids``: origin id only for agreed roots, chapter id for any found."""
    root, kind = F.col("lookup_root"), F.col("kind")
    origin = F.when(
        (kind == FOUND[0]) & real_type(F.col("semantic_origin_type")),
        F.concat(F.lit(f"{namespace}:root:"), root, F.lit(":origin:"), F.col("semantic_origin_type"),
                 F.lit(":count:"), F.coalesce(F.col("origin_count").cast("string"), F.lit("none"))))
    chapter = F.when(kind.isin(*FOUND) & (F.coalesce("bab_letter", F.lit("")) != ""),
                     F.concat(F.lit(f"{namespace}:root:"), root, F.lit(":bab:"), F.col("bab_letter")))
    return lookups.withColumn("evidence_ids", F.array_compact(F.array(origin, chapter)))


def lookup_explain(lookups: DataFrame, namespace: str = "lex") -> DataFrame:
    return catalog_evidence_ids(lookups, namespace).select(
        "request_id", F.col("lookup_root").alias("root"), "kind", "review_status",
        "semantic_origin_type", "origin_count", "bab_letter", "original_bab_letter",
        "correction_version", F.coalesce(F.size("source_pdfs"), F.lit(0)).alias("source_pdf_count"),
        F.size("evidence_ids").alias("evidence_id_count"))


def registry_health(registry: DataFrame, load_error: str | None = None) -> DataFrame:
    n = F.count("*")
    return registry.agg(n.alias("total_roots"), F.lit(load_error).cast("string").alias("load_error"),
                        (F.lit(load_error is None) & (n > 0)).alias("is_healthy"))
