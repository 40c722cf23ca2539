"""Imports to source claims, origin candidates and cross-entry conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import entity_id, label_map
from rootloom.operators.identity import usable
from rootloom.operators.quarantine import claim_kind, origin_type_normalize, residuals_frame, trace_frame
from rootloom.rules import vocab as V

CLAIM_ACTOR = "claim_pipeline_v1"


def root_claims_build(imports: DataFrame, claim_text: str = "origin_text") -> DataFrame:
    """One claim per usable import.  ``claim_text``: ``origin_text`` or ``heading``."""
    source = {"origin_text": F.col("origin_text"), "heading": F.col("heading_text")}[claim_text]
    return usable(imports).select(
        "line_no", "claim_id", "passage_id", F.col("candidate_id").alias("identity_id"), "root_letters",
        "discriminator", claim_kind(F.col("origin_label")).alias("claim_kind"),
        origin_type_normalize(F.col("origin_label")).alias("origin_type"),
        F.coalesce(source, F.lit("")).alias("raw_claim_text"), "origin_text", "heading_text",
        F.lit("TEXT_CANDIDATE").alias("review_state"), "evidence_status",
        F.lit("MACHINE_OCR").alias("extraction_method"))


def candidate_count(policy: str = "strict") -> Column:
    """Origin candidates a claim yields (0 or 1).

    ``strict``: a single-origin claim with its own text.  ``heading_fallback``: the
    heading may stand in, and MULTIPLE with text also yields one.
    """
    kind, has_text = F.col("origin_type"), F.coalesce("origin_text", F.lit("")) != ""
    single = kind.isin("SINGULAR", "SOUND_ROOTS")
    if policy == "strict":
        return F.when(single & has_text, 1).otherwise(0)
    return F.when(single, 1).when((kind == "MULTIPLE") & has_text, 1).otherwise(0)


def origin_candidates(claims: DataFrame, policy: str = "strict", id_policy: str = "with_discriminator",
                      namespace: str = "lex") -> DataFrame:
    key = [F.col("root_letters")] + ([F.col("discriminator")] if id_policy == "with_discriminator" else [])
    fallback = F.when(F.coalesce("origin_text", F.lit("")) != "", F.col("origin_text")).otherwise(
        F.col("heading_text"))
    return claims.where(candidate_count(policy) == 1).select(
        "line_no", entity_id(namespace, "lexical-origin-candidate", *key, F.lit(0)).alias("origin_id"),
        "claim_id", "identity_id", "root_letters", F.lit(0).alias("origin_index"), "origin_type",
        label_map(F.col("origin_type"), V.ORIGIN_DESCRIPTIONS, F.col("origin_type")).alias("origin_description"),
        (F.col("origin_text") if policy == "strict" else fallback).alias("raw_origin_text"),
        F.lit("ORIGIN_CANDIDATE").alias("review_state"), "evidence_status")


def segmentation_deferral_residuals(claims: DataFrame, policy: str = "strict",
                                    namespace: str = "lex") -> DataFrame:
    kind, none_yet = F.col("origin_type"), candidate_count(policy) == 0
    residual = (F.when(kind.isin(*V.MULTI_TYPES) & none_yet, "SEGMENTATION_REQUIRED")
                .when(kind.isin(*V.NO_ORIGIN_TYPES), "ORIGIN_NOT_EXTRACTED")
                .when(none_yet, "ORIGIN_NOT_EXTRACTED"))
    typed = claims.withColumn("residual", residual).where(F.col("residual").isNotNull())
    tag = F.when(F.col("residual") == "SEGMENTATION_REQUIRED", F.concat(
        F.lit("SEGMENTATION_REQUIRED:"), kind, F.lit("_NO_DISTINCT_SPANS"))).otherwise(F.col("residual"))
    return residuals_frame(
        typed, entity_id(namespace, "residual", tag, F.col("root_letters"), F.col("discriminator")),
        "claim_id", "SourceRootClaim", F.col("residual"),
        F.concat(F.lit("Root "), F.col("root_letters"), F.lit(" origin_type="), kind),
        F.when(F.col("residual") == "SEGMENTATION_REQUIRED", "ORIGIN_SEGMENTED").otherwise("ORIGIN_CANDIDATE"))


def missing_claim_text_residuals(claims: DataFrame, namespace: str = "lex") -> DataFrame:
    return residuals_frame(
        claims.where(F.coalesce("origin_text", F.lit("")) == ""),
        entity_id(namespace, "residual:MISSING_SOURCE_CLAIM_TEXT", F.col("root_letters"), F.col("discriminator")),
        "claim_id", "SourceRootClaim", "MISSING_SOURCE_PASSAGE",
        F.concat(F.lit("No origin text for root "), F.col("root_letters")), "TEXT_CANDIDATE")


def origin_trace_events(claims: DataFrame, policy: str = "strict", namespace: str = "lex") -> DataFrame:
    n = candidate_count(policy)
    kind = (F.when(n > 1, "ORIGIN_SEGMENTED").when(n == 1, "ORIGIN_EXTRACTED")
            .otherwise("ORIGIN_EXTRACTION_DEFERRED"))
    return trace_frame(
        claims, entity_id(namespace, "trace", F.lower(kind), F.col("root_letters"), F.col("discriminator")),
        kind, "claim_id", "SourceRootClaim", CLAIM_ACTOR,
        F.concat_ws(" ", F.lower(kind), F.col("root_letters"), F.col("origin_type")),
        origin_type=F.col("origin_type"), n_origins=n)


def detect_conflicts(imports: DataFrame) -> DataFrame:
    """Roots whose usable rows disagree on the origin label.

    Rows are first reduced to one per (root, label), so a very common root sends
    only its few labels to the final grouping.
    """
    per_label = usable(imports).groupBy("root_letters", "origin_label").agg(
        F.count("*").alias("n"), F.min(F.struct("line_no", "claim_id")).alias("first"))
    labels = F.array_join(F.array_sort(F.collect_list("origin_label")), ",")
    return (per_label.groupBy("root_letters").agg(
        F.sum("n").alias("entry_count"), F.count("*").alias("n_types"), labels.alias("origin_types"),
        F.min("first").alias("first"))
        .where((F.col("n_types") > 1) & (F.col("entry_count") > 1))
        .select("root_letters", "entry_count", "origin_types", F.col("first.claim_id").alias("claim_id"),
                F.concat(F.lit("Root '"), F.col("root_letters"), F.lit("' has "), F.col("entry_count"),
                         F.lit(" entries with conflicting origin types: "),
                         F.replace(F.col("origin_types"), F.lit(","), F.lit(", "))).alias("description")))


def conflict_residuals(conflicts: DataFrame, namespace: str = "lex") -> DataFrame:
    return residuals_frame(
        conflicts, entity_id(namespace, "residual:ORIGIN_CLAIM_CONFLICT", F.col("root_letters")), "claim_id",
        "SourceRootClaim", "ORIGIN_CLAIM_CONFLICT", F.col("description"), "ORIGIN_SEGMENTED")


def conflict_trace_events(conflicts: DataFrame, namespace: str = "lex") -> DataFrame:
    return trace_frame(
        conflicts, entity_id(namespace, "trace:origin_conflict", F.col("root_letters")), "ORIGIN_CONFLICT",
        "claim_id", "SourceRootClaim", CLAIM_ACTOR, F.col("description"),
        conflict_origin_types=F.col("origin_types"), entry_count=F.col("entry_count"))


def claim_summary(imports: DataFrame, policy: str = "strict") -> DataFrame:
    """One row, from the imports reduced to (root, label)."""
    typed = imports.withColumn("origin_type", origin_type_normalize(F.col("origin_label")))
    one = candidate_count(policy)
    used = ~F.col("is_noise")
    groups = typed.groupBy("root_letters", "origin_label", "is_noise").agg(
        F.count("*").alias("n"), F.sum(F.when(used, one).otherwise(0)).alias("candidates"))
    roots = groups.groupBy("root_letters").agg(
        F.sum(F.when(used, F.col("n")).otherwise(0)).alias("claims"), F.sum("candidates").alias("candidates"),
        F.sum(F.when(~used, F.col("n")).otherwise(0)).alias("noise"), F.count_if(used).alias("labels"))
    conflict = (F.col("labels") > 1)
    return roots.agg(
        F.sum("claims").alias("claims_produced"), F.sum("candidates").alias("origin_candidates"),
        F.sum("candidates").alias("singular_claims"), F.lit(0).cast("long").alias("multi_origin_segmented"),
        F.count_if(conflict).alias("conflict_roots"), F.sum("noise").alias("skipped_noise"),
        F.lit(0).cast("long").alias("failed"))
