"""Chapter-letter correction from the first radical, with its report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from rootloom.functions import label_map
from rootloom.operators.predicates import trimmed
from rootloom.rules.vocab import CORRECTION_REASON, CORRECTION_VERSION


def correct_chapter(entries: DataFrame, chapter_names: Mapping[str, str]) -> DataFrame:
    """Stored chapter is kept untouched, blanks and nulls too; the derived one is added with provenance."""
    root = trimmed("root_letters")
    derived = F.when(root == "", F.lit("")).otherwise(
        label_map(F.substring(root, 1, 1), chapter_names, ""))
    return entries.withColumns({
        "original_bab_letter": F.col("bab_letter"),
        "corrected_bab_letter": derived,
        "correction_reason": F.lit(CORRECTION_REASON),
        "correction_version": F.lit(CORRECTION_VERSION)})


def correction_outcome():
    return (F.when(trimmed("root_letters") == "", "no_root")
            .when(F.col("corrected_bab_letter") == "", "unmapped")
            .when(trimmed("original_bab_letter") != F.col("corrected_bab_letter"), "changed")
            .otherwise("unchanged"))


def correction_report(corrected: DataFrame) -> DataFrame:
    outcome = correction_outcome()
    return corrected.agg(
        F.count("*").alias("total_entries"),
        F.count_if(outcome == "changed").alias("bab_changed"),
        F.count_if(outcome == "unchanged").alias("bab_already_correct"),
        F.count_if(outcome == "no_root").alias("no_root_letters"),
        F.count_if(outcome == "unmapped").alias("first_radical_not_in_map"))


def remaining_mismatch(entries: DataFrame, chapter_names: Mapping[str, str]) -> DataFrame:
    """Computed counters: unknown chapter names, wrong initials, missing provenance."""
    root = trimmed("root_letters")
    chapter = F.coalesce(F.col("corrected_bab_letter"), F.lit(""))
    known = chapter.isin(*sorted(set(chapter_names.values())))
    derived = label_map(F.substring(root, 1, 1), chapter_names, "")
    missing = (F.coalesce(F.col("correction_reason"), F.lit("")) == "") | (
        F.coalesce(F.col("correction_version"), F.lit("")) == "")
    return entries.agg(
        F.count_if((chapter != "") & ~known).alias("wrong_chapter_remaining"),
        F.count_if((root != "") & (chapter != "") & (derived != "") & (chapter != derived))
        .alias("chapter_initial_mismatch"),
        F.count_if((chapter != "") & missing).alias("provenance_missing"))
