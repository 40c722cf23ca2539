"""Legacy entries to quarantined imports, with residuals, trace and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import entity_id, label_map, strip_ws
from rootloom.operators.predicates import trimmed
from rootloom.rules import vocab as V

IMPORT_ACTOR = "legacy_importer_v1"


def text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def origin_type_normalize(col: Column) -> Column:
    """Legacy label to a closed origin type; blank is NOT_EXTRACTED, other UNKNOWN."""
    label = F.upper(strip_ws(col))
    return F.when(F.coalesce(col, F.lit("")) == "", "NOT_EXTRACTED").otherwise(
        label_map(label, V.LEGACY_ORIGIN_TYPE, "UNKNOWN"))


def claim_kind(col: Column) -> Column:
    return label_map(F.upper(strip_ws(F.coalesce(col, F.lit("")))), V.LEGACY_CLAIM_KIND, "INCOMPLETE_CLAIM")


def residuals_frame(df: DataFrame, rid: Column, target: str, target_type: str, kind: str | Column,
                    description: Column, blocking: str | Column) -> DataFrame:
    def col(x):
        return x if isinstance(x, Column) else F.lit(x)
    return df.select(
        rid.alias("residual_id"), F.col("root_letters"), F.col(target).alias("target_id"),
        F.lit(target_type).alias("target_type"), col(kind).alias("residual_type"),
        description.alias("description"), col(blocking).alias("blocking_until"),
        F.lit(None).cast("timestamp").alias("resolved_at"))


def trace_frame(df: DataFrame, tid: Column, kind: str | Column, target: str, target_type: str,
                actor: str, summary: Column, **metadata: Column) -> DataFrame:
    pairs = [x for k, v in metadata.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        tid.alias("trace_id"), F.col("root_letters"),
        (kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"),
        F.col(target).alias("target_id"), F.lit(target_type).alias("target_type"),
        F.lit("MACHINE_ONLY").alias("actor_type"), F.lit(actor).alias("actor_id"),
        summary.alias("summary"), F.create_map(*pairs).alias("metadata"))


def import_entries(entries: DataFrame, namespace: str = "lex") -> DataFrame:
    """Every non-blank root becomes a machine-only candidate import."""
    root, status, kind = trimmed("root_letters"), trimmed("review_status"), trimmed("semantic_origin_type")
    named = (F.when(trimmed("corrected_bab_letter") != "", trimmed("corrected_bab_letter"))
             .otherwise(trimmed("bab_letter")))
    original = F.when(text("original_bab_letter") != "", trimmed("original_bab_letter")).otherwise(
        trimmed("bab_letter"))
    pdf = trimmed("source_pdf")
    out = entries.where(root != "").select(
        "line_no", root.alias("root_letters"), status.alias("review_status"), kind.alias("origin_label"),
        "origin_count", named.alias("bab_letter"), trimmed("corrected_bab_letter").alias("corrected_bab_letter"),
        original.alias("original_bab_letter"),
        F.when(text("correction_version") == "", "none").otherwise(F.col("correction_version"))
        .alias("correction_version"),
        F.when(status == "AUTO_AGREED", "MACHINE_CANDIDATE").otherwise("UNVERIFIED_REVIEW_REQUIRED")
        .alias("review_state"),
        F.lit(V.EVIDENCE_STATUSES[0]).alias("evidence_status"),
        kind.isin(*V.MULTI_TYPES).alias("requires_segmentation"),
        kind.isin(*V.NOISE_TYPES).alias("is_noise"),
        trimmed("root_heading_text").alias("heading_text"),
        F.col("semantic_origin_text").alias("origin_text"), trimmed("entry_id").alias("entry_id"),
        pdf.alias("source_pdf"), F.coalesce("pdf_page", F.lit(0)).alias("pdf_page"),
        F.coalesce("line_ids", F.array().cast("array<string>")).alias("line_ids"))
    key = (F.col("root_letters"), F.col("line_no"))
    out = out.withColumns({
        "candidate_id": entity_id(namespace, "root-identity-candidate", *key),
        "passage_id": entity_id(namespace, "passage", *key),
        "claim_id": entity_id(namespace, "source-root-claim", *key),
        "import_trace_id": entity_id(namespace, "trace:import", *key)})
    return out.withColumn("discriminator", F.when(F.col("entry_id") != "", F.col("entry_id")).otherwise(
        F.col("passage_id")))


def segmentation_residuals(imports: DataFrame, namespace: str = "lex") -> DataFrame:
    return residuals_frame(
        imports.where("requires_segmentation"),
        entity_id(namespace, "residual:SEGMENTATION_REQUIRED", F.col("root_letters"), F.col("line_no")),
        "claim_id", "SourceRootClaim", "SEGMENTATION_REQUIRED",
        F.concat(F.lit("Origin type "), F.col("origin_label"),
                 F.lit(" requires segmentation into separate origin candidates")), "ORIGIN_SEGMENTED")


def review_residuals(imports: DataFrame, namespace: str = "lex") -> DataFrame:
    return residuals_frame(
        imports.where(F.col("review_state") == "UNVERIFIED_REVIEW_REQUIRED"),
        entity_id(namespace, "residual:REVIEW_REQUIRED_UNRESOLVED", F.col("root_letters"), F.col("line_no")),
        "candidate_id", "RootIdentityCandidate", "REVIEW_REQUIRED_UNRESOLVED",
        F.concat(F.lit("Human review required for root "), F.col("root_letters")), "IDENTITY_VERIFIED")


def import_trace_events(imports: DataFrame) -> DataFrame:
    return trace_frame(
        imports, F.col("import_trace_id"), "IMPORT", "candidate_id", "LegacyCandidateImport", IMPORT_ACTOR,
        F.concat(F.lit("Legacy import: "), F.col("root_letters"), F.lit(" ("), F.col("review_status"),
                 F.lit(" → "), F.col("review_state"), F.lit(")")),
        schema_version=F.lit(V.IMPORT_SCHEMA_VERSION), legacy_review_status=F.col("review_status"),
        initial_review_state=F.col("review_state"), noise_entry=F.col("is_noise"),
        requires_segmentation=F.col("requires_segmentation"))


def reconciliation(entries: DataFrame) -> DataFrame:
    """One row of counts, from one pass over the scanned lines (blank lines included).

    Imports, residuals and trace events follow from the same row, so they are
    counted here without building those tables.
    """
    n = F.count_if
    malformed = F.coalesce("is_malformed", F.lit(False))
    blank = F.coalesce("is_blank", F.lit(False)) if "is_blank" in entries.columns else F.lit(False)
    valid = ~malformed & ~blank
    root, status, kind = trimmed("root_letters"), trimmed("review_status"), trimmed("semantic_origin_type")
    ok = valid & (root != "")
    corrected, original = trimmed("corrected_bab_letter"), trimmed("original_bab_letter")
    chapter = F.when(corrected != "", corrected).otherwise(trimmed("bab_letter"))
    unverified, multi, noise = status != "AUTO_AGREED", kind.isin(*V.MULTI_TYPES), kind.isin(*V.NOISE_TYPES)
    state = F.when(status == "AUTO_AGREED", "MACHINE_CANDIDATE").otherwise("UNVERIFIED_REVIEW_REQUIRED")
    row = entries.agg(
        F.count("*").alias("raw_jsonl_lines"), n(malformed).alias("malformed_json_lines"),
        n(valid).alias("valid_raw_entries"), n(valid & (root == "")).alias("no_root_letters"),
        n(valid & (status == "AUTO_AGREED")).alias("auto_agreed_raw"),
        n(valid & (status == "REVIEW_REQUIRED")).alias("review_required_raw"),
        n(valid & ~status.isin("AUTO_AGREED", "REVIEW_REQUIRED")).alias("unknown_status_raw"),
        n(ok & ~unverified).alias("mapped_machine_candidate"),
        n(ok & unverified).alias("mapped_unverified_review"),
        n(ok).alias("import_success"), n(valid & (root == "")).alias("import_failed"),
        n(valid & noise).alias("noise_entries"),
        *(n(valid & (kind == t)).alias(t.lower()) for t in V.NOISE_TYPES),
        n(valid & multi).alias("requires_segmentation"),
        *(n(valid & (kind == t)).alias(t.lower()) for t in V.MULTI_TYPES),
        n(valid & (chapter == "")).alias("bab_empty"),
        n(valid & (corrected != "") & (original != "") & (corrected != original)).alias("bab_corrected"),
        n(ok & (status == "AUTO_AGREED") & state.isin(*V.HUMAN_STATES)).alias("agreed_mapped_to_verified"),
        n(ok & (kind == "NONE") & (claim_kind(F.col("semantic_origin_type")) == "NEGATIVE_CLAIM"))
        .alias("none_as_negative_claim"),
        n(ok & (status == "REVIEW_REQUIRED") & (state == "MACHINE_CANDIDATE")).alias("review_as_positive"),
        n(ok & (trimmed("root_heading_text") != "")).alias("heading_text_present"),
        n(ok & F.col("semantic_origin_text").isNotNull()).alias("origin_text_present"),
        n(ok & (trimmed("root_heading_text") == root)).alias("passage_is_root_text"),
        (n(ok & multi) + n(ok & unverified)).alias("residuals_emitted"),
        n(ok).alias("trace_events_emitted"))
    return row.withColumn("pipeline_entries", F.col("import_success") - F.col("noise_entries")) \
        .withColumn("import_schema_version", F.lit(V.IMPORT_SCHEMA_VERSION)) \
        .withColumn("import_actor", F.lit(IMPORT_ACTOR))


def verify_import(report: DataFrame) -> DataFrame:
    """(check, expected, actual, ok) rows."""
    def check(name: str, expected: Column, actual: Column, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), expected.cast("string").alias("expected"),
                        actual.cast("string").alias("actual"), ok.alias("ok"))
    zero = [check(c, F.lit(0), F.col(c), F.col(c) == 0)
            for c in ("agreed_mapped_to_verified", "none_as_negative_claim", "review_as_positive")]
    failed = check("import_failed", F.col("no_root_letters"), F.col("import_failed"),
                   F.col("import_failed") == F.col("no_root_letters"))
    some = check("import_success", F.lit(">0"), F.col("import_success"), F.col("import_success") > 0)
    return report.select(F.inline(F.array(*zero, failed, some)))
