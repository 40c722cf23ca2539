"""One runnable query per operator over the given tables.

Nested results are rendered as text so that they compare as plain values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rootloom.functions import (
    best_text, body_excerpt, checksum, classify_evidence_id, entity_id, excerpt, fix_ocr, normalize,
    normalize_root, root_profile, source_id, text_confidence, volume_number,
)
from rootloom.operators import (
    audit, body, chapters, claimgraph, claims, concepts, enrich, entities, evidence, governed, identity,
    origins, predicates, quarantine, registry, segment, star, volumes,
)
from rootloom.plans import export, requests as rq
from rootloom.plans.bindings import Tables
from rootloom.plans.layers import Layers
from rootloom.rules import latin
from rootloom.session import scratch
from rootloom.sources import jsonl, pages as page_source
from rootloom.sources.schemas import ROOT_ENTRY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOOKUP, INITIAL = latin.PROFILES["lookup"], latin.PROFILES["initial"]
PACK, DISC = latin.LINES, latin.DISCOURSE
MISSING, NAMES = latin.MISSING_INITIALS, latin.CHAPTER_NAMES


def query(name: str, staged: bool = False):
    """Registers a query; ``staged`` ones read derived tables several times."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder, staged))
        return fn
    return register


def joined(col: str | Column, sep: str = "|") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


def big(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("long")


# ------------------------------------------------------------------- A: scans
@query("A1_parse_json_lines")
def _(t: Tables):
    lines = t.read("events").select(F.col("event_id").alias("line_no"), F.col("props").alias("raw"))
    return jsonl.parse_json_lines(lines, StructType([StructField("k", LongType())])).select(
        "line_no", "k", "is_malformed")


def _stored_entries(t: Tables, entries: DataFrame) -> str:
    """Entries as JSON lines in the shared folder, every seventh one cut off in the middle."""
    folder = scratch(t.spark, "jsonl")
    whole = F.to_json(F.struct(*(c for c in ("entry_id", "source_pdf", "root_letters", "semantic_origin_text", "line_ids"))))
    line = F.when(F.col("line_no") % 7 == 0, F.substring(whole, 1, 9)).otherwise(whole)
    entries.select(line.alias("value")).write.text(folder)
    return folder


def _loaded(rows: DataFrame) -> DataFrame:
    return rows.select("entry_id", "source_pdf", "root_letters", "semantic_origin_text", big(F.size("line_ids")).alias("lines"), "is_malformed",
                       "load_status")


@query("A2_resolve_corpus")
def _(t: Tables):
    """The corrected corpus is absent, so the original one is loaded, malformed lines counted."""
    rows, _ = jsonl.resolve_corpus(t.spark, scratch(t.spark, "none"), _stored_entries(t, t.root_entries()), ROOT_ENTRY)
    return _loaded(rows)


@query("A2_load_health")
def _(t: Tables):
    rows, _ = jsonl.resolve_corpus(t.spark, _stored_entries(t, t.corrected_entries()), scratch(t.spark, "none"), ROOT_ENTRY)
    return governed.load_health(rows).select(big("malformed_line_count").alias("malformed_line_count"), "partial_load")


@query("A4_write_jsonl")
def _(t: Tables):
    """Enriched entries written as JSON lines, a folder per type, and read back."""
    folder = scratch(t.spark, "written")
    jsonl.write_jsonl(t.enriched().select("entry_num", "entry_type", "root_letters", "semantic_axes", "quoted_authorities"), folder, "entry_type")
    back = t.spark.read.schema("entry_num long, root_letters string, semantic_axes array<struct<text:string,attribution:string>>, "
                               "quoted_authorities array<string>, entry_type string").json(folder)
    return back.select("entry_num", "entry_type", "root_letters", F.array_join(F.transform("semantic_axes", lambda a: a["text"]), "|").alias("axes"),
                       joined("quoted_authorities").alias("authorities"))


@query("A3_star_entries")
def _(t: Tables):
    e = star.star_entries(t.enriched())
    return e.select("entry_id", "source", "root_letters", "root_display", "chapter_header", "is_lexical_entry",
                    big(F.length("body_text")).alias("body_length"), big(F.size("page_refs")).alias("page_ref_count"),
                    "entry_type", big("axes_count").alias("axes_count"), joined("quoted_authorities").alias("authorities"),
                    "ocr_confidence", "review_state", "claim_status")


@query("A3a_semantic_axes")
def _(t: Tables):
    return star.star_axes(t.enriched()).withColumn("axis_num", big("axis_num"))


@query("A3b_poetry_evidence")
def _(t: Tables):
    return star.star_poetry(t.enriched()).withColumn("line_num", big("line_num"))


@query("A3c_source_passages")
def _(t: Tables):
    return star.star_passages(t.enriched()).withColumn("passage_num", big("passage_num"))


@query("A3d_trace_events")
def _(t: Tables):
    return star.star_trace(t.enriched())


@query("A5_extract_pages")
def _(t: Tables):
    out = page_source.extract_pages(t.read("pages").select("page_id", "html"), script_class=r"\p{L}")
    return out.select("page_id", big(F.length("text")).alias("text_length"), F.md5("text").alias("text_md5"),
                      big(F.size("footnotes")).alias("footnotes"))


@query("A6_volume_page")
def _(t: Tables):
    text = F.concat(F.lit("ج "), F.col("conv_id"), F.lit(" - ص "), F.col("turn"), F.lit(" "), F.col("text"))
    vol, label = page_source.volume_page(text)
    return t.read("conversations").select("conv_id", "turn", vol.alias("vol"), label.alias("page_label"))


@query("A7_segment_entries")
def _(t: Tables):
    e = segment.segment_entries(t.book_pages(), PACK, pages_per_block=2)
    return e.select("book", big("entry_num").alias("entry_num"), "root_letters",
                    "root_display", "chapter_header", "body_text", joined("poetry_lines", "\n").alias("poetry"),
                    joined("footnote_lines", "\n").alias("footnotes"), joined("page_refs").alias("page_refs"),
                    joined("raw_page_nums").alias("raw_page_nums"))


@query("A7_entry_heads")
def _(t: Tables):
    e = segment.entry_heads(segment.entry_lines(t.book_pages(), PACK, pages_per_block=2))
    return e.drop("is_lexical_entry").withColumn("entry_num", big("entry_num"))


@query("A7_numbered_lines")
def _(t: Tables):
    e = segment.numbered_entry_lines(segment.entry_lines(t.book_pages(), PACK, pages_per_block=2))
    return e.select("book", big("entry_num").alias("entry_num"), big("line_num").alias("line_num"), "page_num", big("pos").alias("pos"), "role", "filled")


@query("A7_entry_lines")
def _(t: Tables):
    e = segment.entry_lines(t.book_pages(), PACK, pages_per_block=3)
    return e.select("book", "page_num", big("pos").alias("pos"), big("entry_num").alias("entry_num"), "role", "opener",
                    "chapter")


@query("A8_classify_lines")
def _(t: Tables):
    e = segment.classify_lines(segment.page_lines(t.book_pages()), PACK)
    return e.select("book", "page_num", big("pos").alias("pos"), "line_class",
                    joined(segment.page_refs(F.col("line"), PACK)).alias("page_refs"))


@query("A9_letter_names_to_root")
def _(t: Tables):
    lines = segment.page_lines(t.book_pages())
    prefix = F.regexp_extract("line", PACK.confirm, 0)
    return lines.select("book", "page_num", big("pos").alias("pos"),
                        segment.letter_names_to_root(prefix, PACK).alias("root"))


@query("A10_segmentation_report")
def _(t: Tables):
    lines = segment.entry_lines(t.book_pages(), PACK)
    return segment.segmentation_report(t.book_pages(), lines)


@query("A11_page_counts")
def _(t: Tables):
    return volumes.page_counts(t.read("documents"), "source")


@query("A12_volume_content_hash")
def _(t: Tables):
    lines = t.read("documents").select("source", F.col("doc_id").alias("line_no"), F.col("text").alias("raw"))
    return volumes.volume_content_hash(lines, "source")


@query("A12_volume_tree_hash")
def _(t: Tables):
    lines = t.read("documents").select("source", F.col("doc_id").alias("line_no"), F.col("text").alias("raw"))
    return volumes.volume_tree_hash(lines, "source")


@query("A13_source_records")
def _(t: Tables):
    docs = t.read("documents").withColumn("source_pdf", F.concat("source", F.lit(".pdf")))
    hashes = volumes.volume_tree_hash(docs.select("source_pdf", F.col("doc_id").alias("line_no"), F.col("text").alias("raw")))
    out = volumes.source_records(t.volumes(), volumes.page_counts(docs), hashes)
    return out.withColumn("ocr_pass_count", big("ocr_pass_count")).withColumn("initial_letters", joined("initial_letters", ""))


# -------------------------------------------------------------------- B: text
for _name in ("lookup", "classify", "classify_v1", "graph_origin", "entity", "initial"):
    def _norm(t: Tables, _name=_name):
        return t.read("documents").select("doc_id", F.md5(normalize(F.col("text"), latin.PROFILES[_name])).alias("norm"))
    query(f"B_normalize_{_name}")(_norm)


@query("B2_normalize_root")
def _(t: Tables):
    return t.read("part").select("p_partkey", normalize_root(F.col("p_name"), LOOKUP).alias("root_norm"))


@query("B9_fix_ocr")
def _(t: Tables):
    return t.read("documents").select("doc_id", F.md5(fix_ocr(F.col("text"), (r" de ", " di "))).alias("fixed"))


@query("B10_excerpt")
def _(t: Tables):
    return t.read("documents").select("doc_id", excerpt(F.col("text"), F.lit(" that ")).alias("excerpt"))


@query("B11_body_excerpt")
def _(t: Tables):
    return t.read("documents").select("doc_id", body_excerpt(F.col("text")).alias("excerpt"))


@query("B12_best_text")
def _(t: Tables):
    return t.lines().select("line_id", best_text(F.col("human_text"), F.col("corrected_ocr"), F.col("raw_ocr"))
                            .alias("best"))


@query("B13_text_confidence")
def _(t: Tables):
    lines = t.lines()
    fixed = F.when(F.col("corrected_ocr") != F.col("raw_ocr"), F.col("corrected_ocr"))
    return lines.select("line_id", F.round(text_confidence(
        F.col("human_text"), fixed, F.col("raw_ocr"), F.col("raw_candidates")[0]["confidence"]), 6).alias("confidence"))


@query("B14_checksum")
def _(t: Tables):
    return t.read("documents").select("doc_id", checksum(F.col("text")).alias("full"),
                                      checksum(F.col("text"), 16).alias("short"))


@query("B15_entity_ids")
def _(t: Tables):
    e = t.root_entries()
    return e.select("line_no", entity_id("lex", "passage", F.col("root_letters"), F.col("line_no")).alias("by_line"),
                    entity_id("lex", "claim", F.col("root_letters"), F.col("entry_id")).alias("by_entry"))


@query("B16_source_id")
def _(t: Tables):
    e = t.root_entries()
    return e.select("line_no", source_id(F.col("source_pdf")).alias("source_id"),
                    volume_number(F.col("source_pdf")).alias("volume_number"))


@query("B17_classify_evidence_id")
def _(t: Tables):
    e = t.read("documents")
    eid = (F.when(F.col("lang") == "en", F.concat(F.lit("lex:root:"), "source"))
           .when(F.col("lang") == "fr", F.concat(F.lit("lex:claim:"), "source"))
           .when(F.col("lang") == "es", F.concat(F.lit("ROOT_CATALOG:"), "source")).otherwise(F.col("source")))
    return e.select("doc_id", classify_evidence_id(eid).alias("kind"))


@query("B18_root_profile")
def _(t: Tables):
    p = root_profile(F.col("root_letters"), DISC.script_class)
    return t.root_entries().select("line_no", joined(p["letters"]).alias("letters"),
                                   big(p["letter_count"]).alias("letter_count"), p["geminate"].alias("geminate"))


# ------------------------------------------------------------------ C: filters
@query("C1_drop_noise")
def _(t: Tables):
    return predicates.drop_noise(t.root_entries()).select("line_no", "semantic_origin_type")


@query("C2_drop_blank_root")
def _(t: Tables):
    return predicates.drop_blank_root(t.root_entries()).select("line_no", "root_letters")


@query("C3_exclude_uncovered_initials")
def _(t: Tables):
    kept = predicates.exclude_uncovered_initials(t.root_entries(), MISSING, INITIAL)
    return kept.select("line_no", "root_letters")


@query("C4_lexical_only")
def _(t: Tables):
    return segment.lexical_only(t.parsed_entries()).select("entry_num", "root_letters")


@query("C5_by_author_position")
def _(t: Tables):
    axes = star.star_axes(t.enriched())
    quoted = F.when(F.length("axis_text") % 3 == 0, "QUOTED_AUTHORITY").otherwise(F.col("attribution"))
    position = F.when(F.col("entry_id") % 2 == 0, "ADOPTED_BY_IBN_FARIS")
    return axes.withColumn("attribution", quoted).where(predicates.author_position_kept(
        F.col("attribution"), position)).select("entry_id", big("axis_num").alias("axis_num"), "attribution")


@query("C6_licence_refusal")
def _(t: Tables):
    return t.requests().select("request_id", predicates.licence_refusal(F.col("directive"), F.col("root")).alias("reason"))


@query("C7_open_residuals")
def _(t: Tables):
    imports = quarantine.import_entries(t.corrected_entries())
    certs = t.certificates().join(imports.select("line_no", F.col("candidate_id").alias("target_id")), "line_no")
    res = audit.residuals_apply(quarantine.review_residuals(imports), certs)
    return predicates.open_residuals(res).select("residual_id", "target_id")


# --------------------------------------------------------------- D: enrichment
@query("D1_strip_letter_chain")
def _(t: Tables):
    return t.parsed_entries().select("entry_num", enrich.strip_letter_chain(F.col("body_text"), latin.ORIGINS)
                                     .alias("after"))


@query("D2_classify_origin")
def _(t: Tables):
    return enrich.classify_origin(t.parsed_entries(), latin.ORIGINS).select(
        "entry_num", "origin_rule", "entry_type", big("axes_count").alias("axes_count"))


@query("D3_extract_axes")
def _(t: Tables):
    e = enrich.extract_axes(enrich.classify_origin(t.parsed_entries(), latin.ORIGINS), latin.ORIGINS)
    return e.select("entry_num", F.array_join(F.transform("semantic_axes", lambda a: a["text"]), "|").alias("axes"))


@query("D5_quoted_authorities")
def _(t: Tables):
    return t.parsed_entries().select("entry_num", joined(enrich.quoted_authorities(F.col("body_text"), latin.ORIGINS))
                                     .alias("authorities"))


@query("D6_ocr_confidence")
def _(t: Tables):
    return t.parsed_entries().select("entry_num", enrich.ocr_confidence(F.col("body_text"), latin.ORIGINS)
                                     .alias("ocr_confidence"))


@query("D7_enrich")
def _(t: Tables):
    return t.enriched().select(
        "entry_num", "root_letters", "entry_type", big("axes_count").alias("axes_count"),
        F.array_join(F.transform("semantic_axes", lambda a: a["text"]), "|").alias("axes"),
        joined("quoted_authorities").alias("authorities"), "ocr_confidence", "review_state", "claim_status")


@query("D4_enrich_v1")
def _(t: Tables):
    return enrich.enrich(t.parsed_entries(), latin.ORIGINS_V1).select(
        "entry_num", "entry_type", big("axes_count").alias("axes_count"),
        F.array_join(F.transform("semantic_axes", lambda a: a["text"]), "|").alias("axes"), "ocr_confidence")


@query("D8_enrichment_report")
def _(t: Tables):
    return enrich.enrichment_report(t.enriched())


# ----------------------------------------------------------------- E: chapters
@query("E1_correct_chapter")
def _(t: Tables):
    return t.corrected_entries().select("line_no", "bab_letter", "original_bab_letter", "corrected_bab_letter",
                                        "correction_reason", "correction_version")


@query("E2_correction_report")
def _(t: Tables):
    return chapters.correction_report(t.corrected_entries())


@query("E3_remaining_mismatch")
def _(t: Tables):
    stored = t.corrected_entries().withColumn("corrected_bab_letter", F.col("original_bab_letter"))
    return chapters.remaining_mismatch(stored, NAMES)


# ----------------------------------------------------------------- F: registry
def _registry(t: Tables) -> DataFrame:
    return registry.merge_roots(t.corrected_entries(), NAMES, MISSING, INITIAL)


def _lookups(t: Tables) -> DataFrame:
    return registry.typed_lookup(t.requests(), _registry(t), MISSING, INITIAL)


@query("F1_merge_roots")
def _(t: Tables):
    return _registry(t).withColumn("source_pdfs", joined("source_pdfs"))


@query("F2_typed_lookup")
def _(t: Tables):
    return _lookups(t).select("request_id", "lookup_root", "kind", "semantic_origin_type", "review_status", "bab_letter")


@query("F3_lookup_flags")
def _(t: Tables):
    return registry.lookup_flags(_lookups(t)).select("request_id", "found", "auto_agreed", "review_required",
                                                     "coverage_gap")


@query("F4_catalog_evidence_ids")
def _(t: Tables):
    return registry.catalog_evidence_ids(_lookups(t)).select("request_id", joined("evidence_ids").alias("evidence_ids"))


@query("F5_registry_health")
def _(t: Tables):
    return registry.registry_health(_registry(t)).select("total_roots", "is_healthy")


# --------------------------------------------------------------- G: quarantine
def _imports(t: Tables) -> DataFrame:
    """Written once where a query reads them for several derived tables (``staged``)."""
    if t.staged:
        return t.keep("imports", lambda: quarantine.import_entries(t.corrected_entries()))
    return quarantine.import_entries(t.corrected_entries())


def _residual_view(df: DataFrame) -> DataFrame:
    return df.select("residual_id", "target_id", "target_type", "residual_type", "description", "blocking_until")


def _trace_view(df: DataFrame, *keys: str) -> DataFrame:
    return df.select("trace_id", "kind", "target_id", "actor_id", "summary",
                     F.array_join(F.array(*(F.col("metadata")[k] for k in keys)), "|").alias("metadata"))


@query("G1_import_entries")
def _(t: Tables):
    return _imports(t).drop("line_ids", "origin_text", "heading_text", "origin_count")


@query("G2_reconciliation")
def _(t: Tables):
    return quarantine.reconciliation(t.corrected_entries().withColumn("is_malformed", F.lit(False)))


@query("G3_segmentation_residuals")
def _(t: Tables):
    return _residual_view(quarantine.segmentation_residuals(_imports(t)))


@query("G4_review_residuals")
def _(t: Tables):
    return _residual_view(quarantine.review_residuals(_imports(t)))


@query("G5_import_trace_events")
def _(t: Tables):
    return _trace_view(quarantine.import_trace_events(_imports(t)), "legacy_review_status", "initial_review_state",
                       "noise_entry", "requires_segmentation")


@query("G6_verify_import")
def _(t: Tables):
    return quarantine.verify_import(quarantine.reconciliation(
        t.corrected_entries().withColumn("is_malformed", F.lit(False))))


@query("G7_origin_type_normalize")
def _(t: Tables):
    return t.root_entries().select("line_no", quarantine.origin_type_normalize(F.col("semantic_origin_type"))
                                   .alias("origin_type"))


# ----------------------------------------------------------------- H: identity
def _candidates(t: Tables) -> DataFrame:
    return identity.identity_candidates(_imports(t), INITIAL, latin.GATES)


@query("H1_passages")
def _(t: Tables):
    return identity.passages(_imports(t)).drop("line_ids", "root_letters")


@query("H2_missing_passage_residuals")
def _(t: Tables):
    return _residual_view(identity.missing_passage_residuals(_imports(t)))


@query("H2_blank_headings")
def _(t: Tables):
    """Every heading that doesn't begin with a capital counts as missing."""
    blank = F.when(F.col("root_heading_text").rlike(r"^\p{Lu}"), F.col("root_heading_text")).otherwise("")
    imports = quarantine.import_entries(t.corrected_entries().withColumn("root_heading_text", blank))
    return _residual_view(identity.missing_passage_residuals(imports))


@query("H3_ocr_gates")
def _(t: Tables):
    g = identity.ocr_gates(F.col("root_letters"), latin.GATES)
    return t.root_entries().select("line_no", F.array_join(F.transform(g, lambda x: x["flag"].cast("int").cast("string")),
                                                           "").alias("gates"))


@query("H4_identity_candidates")
def _(t: Tables):
    return _candidates(t).select("candidate_id", "passage_id", "root_letters", "normalized_letters", "bab_letter",
                                 "original_bab_letter", joined("flagged").alias("flagged"), "review_state")


@query("H5_ocr_ambiguity_residuals")
def _(t: Tables):
    return _residual_view(identity.ocr_ambiguity_residuals(_candidates(t), latin.GATES))


@query("H6_identity_trace_events")
def _(t: Tables):
    return _trace_view(identity.identity_trace_events(_candidates(t)), "flagged_gates", "bab_letter", "bab_corrected")


@query("H7_gate_summary")
def _(t: Tables):
    return identity.gate_summary(_imports(t), latin.GATES)


# ------------------------------------------------------------------- I: claims
def _claims(t: Tables) -> DataFrame:
    return claims.root_claims_build(_imports(t))


@query("I1_root_claims_build")
def _(t: Tables):
    return _claims(t).select("claim_id", "passage_id", "identity_id", "claim_kind", "origin_type", "raw_claim_text",
                             "review_state")


@query("I2_origin_candidates")
def _(t: Tables):
    return claims.origin_candidates(_claims(t)).select("origin_id", "claim_id", "origin_type", "origin_description",
                                                       "raw_origin_text")


@query("I2_origin_candidates_heading_fallback")
def _(t: Tables):
    return claims.origin_candidates(_claims(t), "heading_fallback").select("origin_id", "claim_id", "raw_origin_text")


@query("I3_segmentation_deferral_residuals")
def _(t: Tables):
    return _residual_view(claims.segmentation_deferral_residuals(_claims(t)))


@query("I4_missing_claim_text_residuals")
def _(t: Tables):
    return _residual_view(claims.missing_claim_text_residuals(_claims(t)))


@query("I5_origin_trace_events")
def _(t: Tables):
    return _trace_view(claims.origin_trace_events(_claims(t)), "origin_type", "n_origins")


@query("I6_detect_conflicts")
def _(t: Tables):
    return claims.detect_conflicts(_imports(t))


@query("I7_claim_summary")
def _(t: Tables):
    return claims.claim_summary(_imports(t))


# ----------------------------------------------------------------- J: governed
def _governed(t: Tables) -> DataFrame:
    return governed.governed_lookup(t.requests(), _imports(t), MISSING, INITIAL)


def _origin_rows(t: Tables) -> DataFrame:
    return claims.origin_candidates(_claims(t))


def _all_residuals(t: Tables) -> DataFrame:
    imports, cl = _imports(t), _claims(t)
    parts = [quarantine.segmentation_residuals(imports), quarantine.review_residuals(imports),
             identity.missing_passage_residuals(imports),
             identity.ocr_ambiguity_residuals(_candidates(t), latin.GATES),
             claims.segmentation_deferral_residuals(cl), claims.missing_claim_text_residuals(cl),
             claims.conflict_residuals(claims.detect_conflicts(imports))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _all_traces(t: Tables) -> DataFrame:
    return (identity.identity_trace_events(_candidates(t)).unionByName(claims.origin_trace_events(_claims(t)))
            .unionByName(claims.conflict_trace_events(claims.detect_conflicts(_imports(t)))))


def _evidence_ids(t: Tables) -> DataFrame:
    return governed.root_evidence_ids(_governed(t), _claims(t), _origin_rows(t))


def _verified(t: Tables) -> DataFrame:
    c = _candidates(t)
    return t.keep("verified", lambda: governed.governed_lookup(
        t.requests(), _imports(t), MISSING, INITIAL, certificates=_certs_for(t, c, "candidate_id")))


@query("J1_entity_index", staged=True)
def _(t: Tables):
    index = governed.entity_index(
        claim=(_claims(t), "claim_id"), origin=(_origin_rows(t), "origin_id"), candidate=(_candidates(t), "candidate_id"),
        residual=(_all_residuals(t), "residual_id"), trace=(_all_traces(t), "trace_id"),
        **{"import": (_imports(t), "candidate_id")})
    return governed.entity_counts(index)


@query("J2_governed_lookup")
def _(t: Tables):
    return _governed(t).select("request_id", "root_letters", "kind", "found", "has_conflict", "coverage_gap",
                               "is_machine_only", "review_state", "coverage_note", "noise_only",
                               F.col("candidate.candidate_id").alias("candidate_id"))


@query("J3_load_health")
def _(t: Tables):
    lines = t.read("events").select(F.col("event_id").alias("line_no"), F.col("props").alias("raw"))
    parsed = jsonl.parse_json_lines(lines, StructType([StructField("k", LongType())]))
    return governed.with_health(_governed(t).select("request_id", "kind"), governed.load_health(parsed))


@query("J2_verified_lookup", staged=True)
def _(t: Tables):
    return _verified(t).select("request_id", "root_letters", "kind", "found", "review_state", "carrier_id")


@query("J4_governed_evidence_ids", staged=True)
def _(t: Tables):
    ids = governed.governed_evidence_ids(_governed(t), _claims(t), _origin_rows(t))
    return ids.select("request_id", big("step").alias("step"), "position", "evidence_id")


@query("J4_root_evidence_ids", staged=True)
def _(t: Tables):
    return _evidence_ids(t).withColumn("step", big("step"))


@query("J4_verified_evidence_ids", staged=True)
def _(t: Tables):
    return governed.root_evidence_ids(_verified(t), _claims(t), _origin_rows(t)).withColumn("step", big("step"))


@query("J5_evidence_metadata", staged=True)
def _(t: Tables):
    rows = governed.evidence_metadata(_governed(t), _evidence_ids(t))
    return governed.for_each_request(rows, _governed(t), "evidence_id").select(
        "request_id", "evidence_id", "root_letters", "kind", "evidence_status", "review_state")


@query("J6_licensed_augmentation")
def _(t: Tables):
    return governed.licensed_augmentation(t.requests(), _imports(t), MISSING, INITIAL)


@query("J6_augmentation_ids", staged=True)
def _(t: Tables):
    return governed.augmentation_ids(t.requests(), _claims(t), _all_residuals(t), _all_traces(t))


@query("J6_root_augmentation_ids", staged=True)
def _(t: Tables):
    return governed.root_augmentation_ids(t.requests(), _claims(t), _all_residuals(t), _all_traces(t))


@query("J7_lookup_explain", staged=True)
def _(t: Tables):
    return governed.lookup_explain(_governed(t), _evidence_ids(t), _all_residuals(t), _origin_rows(t), _candidates(t))


@query("J7_catalog_explain")
def _(t: Tables):
    out = registry.lookup_explain(_lookups(t))
    return out.select("request_id", "root", "kind", "review_status", "bab_letter", "correction_version",
                      big("source_pdf_count").alias("source_pdf_count"),
                      big("evidence_id_count").alias("evidence_id_count"))


# ------------------------------------------------------------------- K: audits
def _certs_for(t: Tables, df: DataFrame, key: str) -> DataFrame:
    return t.certificates().join(df.select("line_no", F.col(key).alias("target_id")), "line_no").drop("line_no")


@query("K1_audit_source_to_identity")
def _(t: Tables):
    return audit.audit_source_to_identity(identity.passages(_imports(t)))


@query("K2_audit_identity_licence", staged=True)
def _(t: Tables):
    c = _candidates(t)
    conflicts = claims.detect_conflicts(_imports(t)).select("root_letters")
    open_ones = c.join(conflicts, "root_letters").select(
        F.col("candidate_id").alias("target_id"), F.lit("ROOT_IDENTITY_CONFLICT").alias("residual_type"),
        F.lit(None).cast("timestamp").alias("resolved_at"))
    return audit.audit_identity_licence(c, _certs_for(t, c, "candidate_id"), open_ones)


@query("K3_audit_identity_to_claim")
def _(t: Tables):
    return audit.audit_identity_to_claim(_imports(t))


@query("K4_audit_claim_to_origins")
def _(t: Tables):
    return audit.audit_claim_to_origins(_claims(t))


@query("K5_audit_origin_review", staged=True)
def _(t: Tables):
    o = _origin_rows(t)
    return audit.audit_origin_review(o, _certs_for(t, o, "origin_id"),
                                     claims.conflict_residuals(claims.detect_conflicts(_imports(t))))


@query("K6_audit_machine_ceiling")
def _(t: Tables):
    certs = t.certificates()
    return audit.audit_machine_ceiling(certs.select(
        F.col("certificate_id").alias("record_id"),
        F.when(F.col("line_no") % 3 == 0, "RootIdentityCarrier").otherwise("ReviewCertificate").alias("record_type"),
        F.col("reviewer_type").alias("actor_type"), F.col("granted_state").alias("review_state"),
        F.when(F.col("granted_state") == "LEXICALLY_REVIEWED", "LEXICALLY_REVIEWED_EVIDENCE")
        .otherwise("SOURCE_LOCATED_EVIDENCE").alias("evidence_status")))


@query("K7_audit_id_uniqueness", staged=True)
def _(t: Tables):
    ids = audit.all_ids(Claim=(_claims(t), "claim_id"), Origin=(_origin_rows(t), "origin_id"),
                        Import=(_imports(t), "candidate_id"), Candidate=(_candidates(t), "candidate_id"))
    return audit.audit_id_uniqueness(ids)


@query("K8_audit_domains")
def _(t: Tables):
    volume = volume_number(F.col("source_pdf"))
    imports = _imports(t).withColumn("volume", volume)
    return audit.audit_domains(imports, "candidate_id", {
        "volume": range(1, 7), "review_status": ("AUTO_AGREED", "REVIEW_REQUIRED"),
        "review_state": audit.V.REVIEW_STATES})


@query("K9_audit_orphans", staged=True)
def _(t: Tables):
    kept = _claims(t).where(F.col("raw_claim_text").contains(" "))
    return audit.audit_orphans(_origin_rows(t), kept)


@query("K10_audit_chapter_initial")
def _(t: Tables):
    stored = _imports(t).withColumn("bab_letter", F.col("original_bab_letter"))
    return audit.audit_chapter_initial(stored, NAMES, INITIAL)


@query("K11_audit_counters", staged=True)
def _(t: Tables):
    imports, cl, orig, cand = _imports(t), _claims(t), _origin_rows(t), _candidates(t)
    return audit.audit_counters(
        passages_in_wrong_state=audit.audit_source_to_identity(identity.passages(imports)),
        identity_below_candidate=audit.audit_identity_to_claim(cand),
        segmentation_not_due=audit.audit_claim_to_origins(cl),
        import_mapping=audit.audit_import_mapping(imports),
        orphan_origins=audit.audit_orphans(orig, cl),
        chapter_initial=audit.audit_chapter_initial(imports, NAMES, INITIAL),
        none_as_negative=cl.where((F.col("origin_type") == "NONE") & (F.col("claim_kind") == "NEGATIVE_CLAIM")),
        origin_from_unextracted=orig.where(F.col("origin_type").isin(*audit.V.NO_ORIGIN_TYPES)),
        claim_text_is_root=cl.where((F.col("raw_claim_text") != "") & (F.col("raw_claim_text") == F.col("root_letters"))),
        multiple_forced=orig.where(F.col("origin_type") == "MULTIPLE"),
        duplicate_ids=audit.audit_id_uniqueness(audit.all_ids(
            Claim=(cl, "claim_id"), Origin=(orig, "origin_id"), Candidate=(cand, "candidate_id"))))


@query("K12_review_apply", staged=True)
def _(t: Tables):
    c = _candidates(t)
    return audit.review_apply(c, "candidate_id", _certs_for(t, c, "candidate_id")).select(
        "candidate_id", "review_state", "effective_state", "certificate_id", "reviewer_type")


@query("K12_residuals_apply", staged=True)
def _(t: Tables):
    imports = _imports(t)
    res = audit.residuals_apply(quarantine.review_residuals(imports), _certs_for(t, imports, "candidate_id"))
    return res.groupBy("residual_type", F.col("resolved_at").isNotNull().alias("resolved")).agg(F.count("*").alias("n"))


# --------------------------------------------------------------- L: discourse
def _bodies(t: Tables) -> DataFrame:
    return body.resolve_body(t.root_entries(), t.lines(), DISC)


def _segments(t: Tables) -> DataFrame:
    return body.segment_body(_bodies(t), DISC)


def _claim_rows(t: Tables) -> DataFrame:
    return claimgraph.extract_claims(_segments(t), DISC)


def _claim_nodes(t: Tables) -> DataFrame:
    return claimgraph.claim_nodes(_claim_rows(t), DISC)


@query("L1_resolve_body")
def _(t: Tables):
    return _bodies(t)


@query("L1_resolve_body_with_footnotes")
def _(t: Tables):
    return body.resolve_body(t.root_entries(), t.lines(), DISC, include_footnotes=True)


@query("L2_entry_text")
def _(t: Tables):
    both = t.root_entries().select("entry_id", "root_heading_text").join(_bodies(t), "entry_id")
    return both.select("entry_id", body.entry_text(F.col("root_heading_text"), F.col("body")).alias("entry_text"))


@query("L3_poetry_texts")
def _(t: Tables):
    return body.poetry_texts(t.root_entries(), t.lines()).withColumn("pos", big("pos"))


@query("L4_segment_body")
def _(t: Tables):
    return _segments(t).select("entry_id", big("pos").alias("pos"), "segment_type", "marker", "text",
                               big("origin_index").alias("origin_index"))


@query("L5_marker_types")
def _(t: Tables):
    return _segments(t).groupBy("segment_type", "marker").agg(F.count("*").alias("n"))


@query("L6_extract_claims")
def _(t: Tables):
    return _claim_rows(t).select("entry_id", big("pos").alias("pos"), "claim_type", "term", "definition", "authority",
                                 big("origin_index").alias("origin_index"))


@query("L7_origin_index")
def _(t: Tables):
    return _segments(t).groupBy("entry_id").agg(
        F.count_if(F.col("origin_index") == 0).alias("first_origin"),
        F.count_if(F.col("origin_index") == 1).alias("second_origin"))


@query("L8_claims_summary")
def _(t: Tables):
    s = claimgraph.claims_summary(_claim_rows(t))
    by_type = F.array_join(F.transform(F.array_sort(F.map_entries("by_type")), lambda e: F.concat(
        e["key"], F.lit("="), e["value"])), ",")
    return s.select("entry_id", "total", by_type.alias("by_type"), joined("usage_terms").alias("usage_terms"),
                    joined("plural_forms").alias("plural_forms"), joined("authorities").alias("authorities"),
                    joined("hadiths").alias("hadiths"), joined("etymology").alias("etymology"), "dual_entry")


@query("L9_entry_summary")
def _(t: Tables):
    s = body.entry_summary(t.root_entries(), _bodies(t), DISC)
    return s.select("entry_id", "root_letters", *(big(c).alias(c) for c in (
        "body_line_count", "poetry_excluded", "footnote_count", "segments")), "segment_types", "body_resolved")


@query("L10_claim_nodes")
def _(t: Tables):
    return _claim_nodes(t).select("claim_id", "entry_id", "claim_type", "assertion_strength", "author_position",
                                  "claim_attribution")


@query("L11_term_nodes")
def _(t: Tables):
    return claimgraph.term_nodes(_claim_rows(t), DISC)


@query("L12_authority_nodes")
def _(t: Tables):
    return claimgraph.authority_nodes(_claim_rows(t), DISC)


@query("L13_evidence_nodes")
def _(t: Tables):
    return claimgraph.evidence_nodes(_claim_nodes(t), DISC)


@query("L14_claim_edges")
def _(t: Tables):
    e = claimgraph.claim_edges(_claim_nodes(t), DISC)
    return e.select("entry_id", "edge_type", "source_id", "target_id",
                    F.coalesce(F.col("meta")["evidence_strength"], F.lit("")).alias("strength"))


@query("L15_claims_by_type")
def _(t: Tables):
    return claimgraph.claims_by_type(_claim_rows(t))


# ----------------------------------------------------------------- M: evidence
def _bundle_entries(t: Tables) -> DataFrame:
    return t.corrected_entries()


def _evidence(t: Tables) -> DataFrame:
    return evidence.source_evidence(t.root_entries(), t.lines(), DISC)


def _bundles(t: Tables) -> DataFrame:
    return evidence.source_bundles(_bundle_entries(t), _evidence(t), DISC, INITIAL)


@query("M1_source_evidence")
def _(t: Tables):
    return _evidence(t).select("entry_id", "volume_number", "pdf_page", big("lines_found").alias("lines_found"),
                               F.md5("raw_ocr_text").alias("raw_md5"), F.md5("normalized_text").alias("fixed_md5"),
                               F.md5("human_corrected_text").alias("human_md5"), "passage_checksum")


@query("M2_ocr_confidence_mean")
def _(t: Tables):
    return _evidence(t).select("entry_id", F.round("ocr_confidence", 6).alias("ocr_confidence"))


@query("M3_bbox_union")
def _(t: Tables):
    return _evidence(t).select("entry_id", "bounding_box.x", "bounding_box.y", "bounding_box.w", "bounding_box.h")


@query("M4_replacement_characters")
def _(t: Tables):
    return _evidence(t).select("entry_id", big("replacement_characters").alias("replacement_characters"))


@query("M5_confusion_detection")
def _(t: Tables):
    return _evidence(t).select("entry_id", joined("suspected_confusions").alias("confusions"))


@query("M6_coverage_state")
def _(t: Tables):
    return _evidence(t).select("entry_id", "coverage_state", "text_review_state")


@query("M8_entry_labels")
def _(t: Tables):
    return _bundles(t).select("entry_id", "heading_type", "claim_kind", "entry_kind", "origin_type")


@query("M9_root_identity_match")
def _(t: Tables):
    return _bundles(t).select("entry_id", "root_identity_match", "match_confidence", big("letter_count")
                              .alias("letter_count"))


@query("M10_source_claims")
def _(t: Tables):
    return _bundles(t).where("has_source_claim").select("entry_id", "polarity", "author_position", "assertion_strength",
                                                        "origin_count_explicit")


@query("M11_entry_residuals")
def _(t: Tables):
    return _layers(t).bundles.select("entry_id", joined("residuals").alias("residuals"), "ontology_buildable")


@query("M12_root_knowledge")
def _(t: Tables):
    return evidence.root_knowledge(_bundles(t)).withColumn("secondary_entries", big("secondary_entries"))


@query("M12_root_members")
def _(t: Tables):
    return evidence.root_members(_bundles(t))


@query("M13_layer_summary")
def _(t: Tables):
    rows = _layers(t)
    out = evidence.layer_summary(rows.bundles, rows.claims, rows.origins, rows.branches, rows.concepts)
    return out.withColumn("residual_count", big("residual_count"))


# ------------------------------------------------------------------ N: origins
def _origins(t: Tables) -> DataFrame:
    boundaries = body.segment_arrays(_bodies(t), DISC).select("entry_id", "boundary_pos")
    return origins.origins(t.root_entries(), boundaries, DISC)


def _branches(t: Tables) -> DataFrame:
    return origins.branches(_claim_rows(t), _origins(t), DISC)


def _layers(t: Tables) -> Layers:
    return Layers(t.corrected_entries(), t.lines(), DISC, LOOKUP, INITIAL)


@query("N1_semantic_nucleus")
def _(t: Tables):
    return _origins(t).select("entry_id", big("origin_index").alias("origin_index"), "semantic_nucleus", "gloss_method")


@query("N2_origins")
def _(t: Tables):
    return _origins(t).select("origin_id", "entry_id", big("origin_index").alias("origin_index"), "origin_type",
                              "raw_origin_text", "normalized_origin_text")


@query("N3_origin_labels")
def _(t: Tables):
    return _origins(t).select("entry_id", big("origin_index").alias("origin_index"), "semantic_kind",
                              "abstraction_level", "temporal_profile")


@query("N6_branches")
def _(t: Tables):
    return _branches(t).select("branch_id", "entry_id", "origin_id", big("origin_index").alias("origin_index"),
                               big("branch_index").alias("branch_index"), "source_form", "normalized_form",
                               "gloss", "relation", "explicitness", "distance", "domain")


@query("N7_exceptions")
def _(t: Tables):
    return origins.exceptions(_claim_rows(t), _origins(t)).withColumn("pos", big("pos")).withColumn(
        "origin_index", big("origin_index"))


@query("N8_cross_refs")
def _(t: Tables):
    return origins.cross_refs(_claim_rows(t), DISC).select("node_id", "entry_id", "target")


@query("N9_origin_edges")
def _(t: Tables):
    rows = _layers(t)
    e = origins.origin_edges(rows.origins, rows.branches, origins.exceptions(rows.claims, rows.origins),
                             origins.cross_refs(rows.claims, DISC))
    return e.select("entry_id", "edge_type", "source_id", "target_id",
                    F.coalesce(F.col("meta")["relation"], F.col("meta")["unresolved"], F.lit("")).alias("meta"))


@query("N9_resolved_cross_refs")
def _(t: Tables):
    return origins.resolve_cross_refs(origins.cross_refs(_claim_rows(t), DISC), t.root_entries(), LOOKUP)


@query("N10_cycle_check")
def _(t: Tables):
    return origins.cycle_check(_layers(t).references)


@query("N10_entry_conflicts")
def _(t: Tables):
    return _layers(t).conflicts


@query("N11_nucleus_residuals")
def _(t: Tables):
    return origins.nucleus_residuals(_origins(t))


# ----------------------------------------------------------------- O: concepts
@query("O1_ontology_gate")
def _(t: Tables):
    return _layers(t).gate


@query("O2_concepts")
def _(t: Tables):
    return _layers(t).concepts.select(
        "concept_id", "entry_id", big("origin_index").alias("origin_index"), "notice", "preferred_label",
        joined("alternative_labels").alias("alternative_labels"), "definition", "upper_kind")


@query("O3_genus")
def _(t: Tables):
    return _layers(t).concepts.select("concept_id", "genus.concept_ref", "genus.confidence", "genus.explicitness")


@query("O4_concept_features")
def _(t: Tables):
    return _layers(t).concepts.select(
        "concept_id", joined("differentia").alias("differentia"), big(F.size("properties")).alias("properties"),
        F.array_join(F.transform("functions", lambda f: F.concat_ws(":", f["function_type"], f["target_event_ref"])), "|")
        .alias("functions"), joined("relations").alias("relations"), "mereology", "causal_mode",
        big(F.size("similarity")).alias("similarity"), "opposition", big(F.size("transfers")).alias("transfers"))


@query("O6_event_profile")
def _(t: Tables):
    return _layers(t).concepts.select(
        "concept_id", "event_profile.event_kind", "event_profile.dynamicity",
        joined(F.transform("event_profile.roles", lambda r: r["role"])).alias("roles"))


@query("O14_bundle_export")
def _(t: Tables):
    rows = _layers(t)
    docs = export.bundle_export(_bundle_entries(t), rows.bundles, rows.claims, rows.origins,
                                rows.branches, rows.concepts, rows.gate)
    return docs.select("entry_id", F.get_json_object("bundle", "$.entry.root_letters").alias("root_letters"),
                       F.get_json_object("bundle", "$.entry.bab_letter").alias("bab_letter"),
                       F.get_json_object("bundle", "$.entry.bab_letter_corrected_from").alias("corrected_from"),
                       F.get_json_object("bundle", "$.layer_4.status").alias("status"),
                       big(F.coalesce(F.json_array_length(F.get_json_object("bundle", "$.layer_2.claim_nodes")), F.lit(0)))
                       .alias("claim_nodes"),
                       big(F.coalesce(F.json_array_length(F.get_json_object("bundle", "$.layer_3.origins")), F.lit(0)))
                       .alias("origins"))


# ----------------------------------------------------------------- P: entities
def _words(t: Tables) -> DataFrame:
    rows = _layers(t)
    return entities.entity_words(rows.origins, rows.branches, claimgraph.term_nodes(rows.claims, DISC),
                                 rows.concepts, DISC.entity_profile)


@query("P1_entity_words")
def _(t: Tables):
    return _words(t)


@query("P2_classify_entities")
def _(t: Tables):
    return entities.classify_entities(_words(t), t.dictionary())


@query("P3_entity_summary")
def _(t: Tables):
    return entities.entity_summary(entities.classify_entities(_words(t), t.dictionary()))


@query("P4_selectional_checks")
def _(t: Tables):
    out = entities.selectional_checks(_origins(t), t.dictionary(), t.restrictions(), DISC.entity_profile)
    return out.withColumn("position", big("position"))


# ------------------------------------------------------------------ Q: requests
def _axes_text(col: str = "axes") -> Column:
    return F.array_join(F.transform(col, lambda a: a["axis_text"]), "|")


def _ask(name: str, fn, cols, **extra):
    def run(t: Tables):
        kw = {k: v(t) for k, v in extra.items()}
        return fn(t.requests(), t.entries(), LOOKUP, **kw).select(*cols())
    query(name)(run)


HEAD = ("request_id", "found", "query_status", "canonical_root", "entry_id")


@query("Q1_find_entries")
def _(t: Tables):
    return rq.find_entries(t.requests(), t.entries().rows, LOOKUP).select("request_id", "entry_id", "root_letters")


_ask("Q2_ROOT_LOOKUP", rq.root_lookup, lambda: [*HEAD, "entry_type", big("axes_count").alias("axes_count"),
     _axes_text().alias("axes"), F.array_join(F.transform("poetry", lambda p: p["line_text"]), "\n").alias("poetry"),
     "ocr_confidence", "first_confidence", "first_review_state", joined("quoted_authorities").alias("authorities")])
_ask("Q3_ROOT_SEMANTIC_ORIGINS", rq.root_semantic_origins, lambda: [*HEAD, "entry_type", _axes_text().alias("axes"),
     "body_excerpt", "confidence"])
_ask("Q4_ROOT_EXISTS", rq.root_exists, lambda: ["request_id", "found", "query_status", "canonical_root", "entry_count",
     F.array_join(F.transform("entry_statuses", lambda s: F.concat_ws(":", s["entry_type"], s["review_state"],
                                                                      s["n"].cast("string"))), "|").alias("entry_statuses")])
_ask("Q5_ROOT_CANONICAL_IDENTITY", rq.root_canonical_identity, lambda: [*HEAD, "first_display", "first_type", "is_geminate",
     "ambiguous"])
_ask("Q6_ENTRY_QUALIFICATION", rq.entry_qualification, lambda: [*HEAD, "entry_type", "claim_status", "has_body", "confidence",
     "partial_load", "entry_status"])
_ask("Q10_ROOT_MEANING_EVIDENCE", rq.root_meaning_evidence, lambda: [*HEAD, "body_excerpt"])
_ask("Q11_ROOT_ORIGIN_RELATIONS", rq.root_origin_relations, lambda: [*HEAD, _axes_text().alias("axes"), "has_multiple_origins",
     "generalization_scope"])
_ask("Q12_ROOT_INTERNAL_CONFLICT", rq.root_internal_conflict, lambda: [*HEAD, big("axis_rows").alias("axis_rows"),
     "has_conflict", "has_residuals"])
_ask("Q13_DERIVATIVE_ATTESTATION", rq.derivative_attestation, lambda: [*HEAD, "excerpt"])
_ask("Q14_SOURCE_EVIDENCE", rq.source_evidence_lookup, lambda: [*HEAD, "source", joined("page_refs").alias("page_refs"),
     F.array_join(F.transform("passages", lambda p: p["content"]), "\n").alias("passages")])
_ask("Q15_CLAIM_ATTRIBUTION", rq.claim_attribution, lambda: [*HEAD, _axes_text().alias("axes"),
     joined("quoted_authorities").alias("authorities"), F.col("note").isNotNull().alias("unattributed")])
_ask("Q16_ROOT_SENSE_CANDIDATES", rq.root_sense_candidates, lambda: [*HEAD, F.array_join(F.transform(
    "sense_candidates", lambda a: F.concat_ws(":", a["axis_num"].cast("string"), a["axis_text"])), "|").alias("senses")])
_ask("Q17_RECORD_INTEGRITY", rq.record_integrity, lambda: [*HEAD, "axes_extracted", "entry_partial", "partial_load"])
_ask("Q18_TRACE_LOOKUP", rq.trace_lookup, lambda: [*HEAD, "event_id", "event_type", "detail"], trace=lambda t: t.trace())
_ask("Q19_ASSERTION_PROVENANCE", rq.assertion_provenance, lambda: [*HEAD, F.array_join(F.transform(
    "axes_provenance", lambda a: F.concat_ws(":", a["provenance"], a["text"])), "|").alias("provenance")])
_ask("Q9_CLAIM_EVIDENCE", rq.claim_evidence, lambda: ["request_id", "found", "query_status", "canonical_root", "entries_checked",
     "claim_status", "evidence_count", "confidence"])
_ask("Q9_claim_evidence_rows", rq.claim_evidence_rows, lambda: ["request_id", "entry_id", "root_letters", big("pos").alias("pos"), "source_type",
     "text", "attribution", "claim_support"])
_ask("Q23_root_summary", rq.root_summary, lambda: ["request_id", "found", "entry_id", "root_display", "entry_type",
     joined("axis_texts").alias("axis_texts"), "evidence_text", "ocr_confidence"])
_ask("Q24_root_claims", rq.root_claims, lambda: ["request_id", "entry_id", "claim_text", big("claim_rank").alias("claim_rank"),
     "claim_type", "evidence"])
_ask("Q25_evidence_ids_v2", rq.evidence_ids_v2, lambda: ["request_id", "evidence_id"])
_ask("Q26_check_claim", rq.check_claim, lambda: ["request_id", "claim_status"])
_ask("Q26_find_roots_by_concept", rq.find_roots_by_concept, lambda: ["request_id", "entry_id", "match_type", "matched_axis"])
_ask("Q26_find_roots_by_concept_all", rq.find_roots_by_concept, lambda: ["request_id", "entry_id", "match_type", "matched_axis"],
     axis_limit=lambda t: None, body_limit=lambda t: None)
_ask("Q7_CONCEPT_TO_ROOT_SEARCH", rq.concept_to_root_search, lambda: ["request_id", "found", "query_status", "entry_id",
     "match_type", "matched_axis"])
_ask("Q7_CONCEPT_TO_ROOT_SEARCH_all", rq.concept_to_root_search, lambda: ["request_id", "found", "query_status", "entry_id",
     "match_type", "matched_axis"], axis_limit=lambda t: None, body_limit=lambda t: None)


@query("Q8_SEMANTIC_REVERSE_SEARCH")
def _(t: Tables):
    asks = t.requests().withColumn("concept", F.lit(None).cast("string"))
    return rq.semantic_reverse_search(asks, t.entries(), LOOKUP).select("request_id", "found", "entry_id", "match_type")


def _mixed(t: Tables) -> DataFrame:
    kinds = F.array(*(F.lit(k) for k in [*sorted(rq.HANDLERS), *sorted(rq.ALIASES), "SOMETHING_ELSE"]))
    asks = t.requests().withColumn("query_type", F.element_at(kinds, (F.col("request_id") % F.size(kinds) + 1)
                                                              .cast("int")))
    return rq.run_queries(asks, t.entries(), LOOKUP, t.trace())


@query("Q20_run_queries")
def _(t: Tables):
    return _mixed(t).groupBy("request_id", "query_type", "found", "query_status", "canonical_root").agg(
        F.count("entry_id").alias("rows"), F.count("result").alias("payloads"))


@query("Q20_answers")
def _(t: Tables):
    return _mixed(t).drop("result")


@query("Q21_stats")
def _(t: Tables):
    return star.stats(t.enriched())


@query("Q22_top_axes")
def _(t: Tables):
    return star.top_axes(star.star_axes(t.enriched()))


@query("Q22_type_distribution")
def _(t: Tables):
    return star.type_distribution(t.enriched())
