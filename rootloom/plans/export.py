"""Joined layers as one nested JSON document per entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rootloom.rules.vocab import CANDIDATE_NOTICE


def _nested(df: DataFrame, name: str, order: str, *cols: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct(order, *cols)))
    return df.groupBy("entry_id").agg(items.alias(name))


def bundle_export(entries: DataFrame, bundles: DataFrame, claims: DataFrame, origins: DataFrame,
                  branches: DataFrame, concepts: DataFrame, gate: DataFrame) -> DataFrame:
    """(entry_id, bundle): NULL and absent parts are left out of the JSON.

    Every nested list stems from one entry's own text, and all joins share its key.
    """
    parts = (
        _nested(claims, "claim_nodes", "pos", "claim_type", "raw_text", "term", "definition", "authority",
                "origin_index"),
        _nested(origins, "origins", "origin_index", "origin_type", "raw_origin_text", "semantic_nucleus",
                "gloss_method", "semantic_kind"),
        _nested(branches, "branches", "pos", "origin_index", "branch_index", "relation", "explicitness", "distance"),
        _nested(concepts, "concepts", "origin_index", "concept_id", "preferred_label", "upper_kind", "genus",
                "opposition"),
        gate.select("entry_id", "status", "reason"))
    out = bundles.join(entries.select("entry_id", F.size("body_line_ids").alias("body_lines"),
                                      F.size("poetry_line_ids").alias("poetry_lines")), "entry_id")
    for part in parts:
        out = out.join(part, "entry_id", "left")
    stored, fixed = F.coalesce("bab_letter", F.lit("")), F.coalesce("corrected_bab_letter", F.lit(""))
    entry = F.struct(
        "entry_id", "root_letters", "entry_kind",
        F.when(fixed != "", fixed).otherwise(stored).alias("bab_letter"),
        F.when((fixed != "") & (stored != "") & (fixed != stored), stored).alias("bab_letter_corrected_from"),
        "body_lines", "poetry_lines")
    doc = F.struct(
        F.lit(CANDIDATE_NOTICE).alias("notice"), entry.alias("entry"),
        F.struct("heading_type", "root_identity_match", "match_confidence", "ocr_confidence", "coverage_state",
                 "residuals").alias("layer_1"),
        F.struct("claim_nodes").alias("layer_2"), F.struct("origins", "branches").alias("layer_3"),
        F.struct("status", "reason", "concepts").alias("layer_4"))
    return out.select("entry_id", "root_letters", F.to_json(doc, {"ignoreNullFields": "true"}).alias("bundle"))
