"""Imports to passages, OCR gates and identity candidates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import checksum, entity_id, normalize, source_id
from rootloom.operators.quarantine import residuals_frame, trace_frame
from rootloom.rules import vocab as V
from rootloom.rules.model import Profile

IDENTITY_ACTOR = "identity_pipeline_v1"
Gate = tuple[str, str, str, str]


def usable(imports: DataFrame) -> DataFrame:
    return imports.where(~F.col("is_noise"))


def passages(imports: DataFrame, namespace: str = "lex") -> DataFrame:
    pdf, heading = F.col("source_pdf"), F.col("heading_text")
    return usable(imports).select(
        "passage_id", "root_letters", source_id(pdf, namespace).alias("source_id"),
        F.col("pdf_page").alias("page_number"), heading.alias("raw_passage"),
        F.when(F.col("review_state") == "MACHINE_CANDIDATE", 1.0).otherwise(0.7).alias("ocr_confidence"),
        "review_state", "evidence_status", "entry_id", "source_pdf", "line_ids",
        F.when(pdf != "", F.concat(pdf, F.lit(":p"), F.col("pdf_page"))).alias("image_ref"),
        F.when(heading != "", checksum(heading)).otherwise("").alias("passage_checksum"))


def missing_passage_residuals(imports: DataFrame, namespace: str = "lex") -> DataFrame:
    return residuals_frame(
        usable(imports).where(F.col("heading_text") == ""),
        entity_id(namespace, "residual:MISSING_SOURCE_PASSAGE", F.col("root_letters"), F.col("discriminator")),
        "passage_id", "SourcePassage", "MISSING_SOURCE_PASSAGE",
        F.concat(F.lit("No heading text for root "), F.col("root_letters")), "TEXT_VERIFIED")


def gate_flag(root: Column, kind: str, arg: str) -> Column:
    present = [root.contains(ch) for ch in arg]
    if kind == "all":
        return reduce(lambda a, b: a & b, present)
    if kind == "distinct_2":
        return reduce(lambda a, b: a + b, [p.cast("int") for p in present]) >= 2
    if kind.startswith("at_least_"):
        return F.length(root) - F.length(F.translate(root, arg, "")) >= int(kind[-1])
    if kind == "longer":
        return F.length(root) >= int(arg)
    if kind == "shorter":
        return F.length(root) <= int(arg)
    return F.lit(False)


def ocr_gates(root: Column, gates: Sequence[Gate] = V.OCR_GATES, strict_compat: bool = False) -> Column:
    """array<struct<gate, flag>> in gate order; ``strict_compat`` keeps G01 silent."""
    return F.array(*(F.struct(
        F.lit(g).alias("gate"),
        (F.lit(False) if strict_compat and g == "G01" else gate_flag(root, kind, arg)).alias("flag"))
        for g, kind, arg, _ in gates))


def identity_candidates(imports: DataFrame, hamza: Profile, gates: Sequence[Gate] = V.OCR_GATES,
                        strict_compat: bool = False) -> DataFrame:
    root = F.col("root_letters")
    return usable(imports).select(
        "line_no", "candidate_id", "passage_id", "claim_id", "root_letters", "discriminator",
        normalize(root, hamza).alias("normalized_letters"),
        F.when(F.col("corrected_bab_letter") != "", F.col("corrected_bab_letter"))
        .otherwise(F.col("bab_letter")).alias("bab_letter"),
        "original_bab_letter", "correction_version",
        ocr_gates(root, gates, strict_compat).alias("gates"),
        F.lit("IDENTITY_CANDIDATE").alias("review_state"), "evidence_status") \
        .withColumn("flagged", F.transform(F.filter("gates", lambda g: g["flag"]), lambda g: g["gate"]))


def ocr_ambiguity_residuals(candidates: DataFrame, gates: Sequence[Gate] = V.OCR_GATES,
                            namespace: str = "lex") -> DataFrame:
    names = F.create_map(*(F.lit(x) for g in gates for x in (g[0], g[3])))
    raised = candidates.withColumn("gate", F.explode("flagged"))
    return residuals_frame(
        raised, entity_id(namespace, "residual:OCR_AMBIGUITY", F.col("gate"), F.col("root_letters"),
                          F.col("discriminator")),
        "candidate_id", "RootIdentityCandidate", "OCR_AMBIGUITY",
        F.concat(F.lit("OCR gate "), F.col("gate"), F.lit(" raised: "), F.element_at(names, F.col("gate"))),
        "IDENTITY_VERIFIED")


def identity_trace_events(candidates: DataFrame, namespace: str = "lex") -> DataFrame:
    return trace_frame(
        candidates, entity_id(namespace, "trace:identity_extracted", F.col("root_letters"),
                              F.col("discriminator")),
        "IDENTITY_EXTRACTED", "candidate_id", "RootIdentityCandidate", IDENTITY_ACTOR,
        F.concat(F.lit("Identity extracted for root "), F.col("root_letters"), F.lit(": "),
                 F.size("flagged"), F.lit(" gate(s) flagged")),
        flagged_gates=F.array_join("flagged", ","), bab_letter=F.col("bab_letter"),
        bab_corrected=F.col("bab_letter") != F.col("original_bab_letter"))


def gate_summary(imports: DataFrame, gates: Sequence[Gate] = V.OCR_GATES,
                 strict_compat: bool = False) -> DataFrame:
    """(metric, value): inputs, noise, flagged entries, residuals, count per gate."""
    used = ~F.col("is_noise")
    flags = {g: used & (F.lit(False) if strict_compat and g == "G01" else gate_flag(F.col("root_letters"), k, a))
             for g, k, a, _ in gates}
    any_flag = reduce(lambda a, b: a | b, flags.values())
    row = imports.agg(
        F.count_if(used).alias("pipeline_input"), F.count_if(~used).alias("skipped_noise"),
        F.count_if(used).alias("candidates"), F.count_if(any_flag).alias("entries_with_any_flag"),
        *(F.count_if(f).alias(g) for g, f in flags.items()))
    total = reduce(lambda a, b: a + b, [F.col(g) for g in flags])
    row = row.withColumn("ocr_ambiguity_residuals", total)
    return row.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                                         for c in row.columns))))
