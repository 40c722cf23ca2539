"""Layer 4: concept candidates.  Every row carries the candidate-only notice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import first_label, label_map
from rootloom.rules import vocab as V
from rootloom.rules.model import DiscoursePack

MAX_LABELS = 20


def ontology_gate(bundles: DataFrame, found: DataFrame) -> DataFrame:
    """(entry_id, status, reason): only resolved, clean entries with origins are built."""
    has = found.select("entry_id").distinct().withColumn("has_origins", F.lit(True))
    reason = (F.when(~F.col("ontology_buildable"), "blocking residual present — human review required")
              .when(F.col("entry_kind") == "OCR_NOISE", "noise entry")
              .when(F.col("has_origins").isNull(), "no origins"))
    return (bundles.join(has, "entry_id", "left").withColumn("reason", reason)
            .select("entry_id", F.when(F.col("reason").isNull(), "BUILT").otherwise("BLOCKED").alias("status"),
                    "reason"))


def branch_lists(branch: DataFrame) -> DataFrame:
    """Branches of one origin in order (they all stem from one entry's body)."""
    item = F.struct("pos", "relation", "source_form", "gloss", "sense")
    return branch.groupBy("entry_id", "origin_index").agg(F.array_sort(F.collect_list(item)).alias("branches"))


def _having(*relations: str) -> Column:
    return F.filter("branches", lambda b: b["relation"].isin(*relations))


def genus(nucleus: Column, method: Column) -> Column:
    explicit = method == "SOURCE_EXPLICIT"
    return F.when(nucleus.isNotNull(), F.struct(
        nucleus.alias("concept_ref"), F.when(explicit, 0.7).otherwise(0.4).alias("confidence"),
        F.when(explicit, "EXPLICIT").otherwise("INFERRED").alias("explicitness")))


def differentia() -> Column:
    labels = F.transform(_having(*V.NAMING_RELATIONS), lambda b: F.substring(
        F.coalesce(F.nullif(b["sense"], F.lit("")), b["gloss"], F.lit("")), 1, 100))
    return F.filter(labels, lambda x: x != "")


def event_profile(text: Column, pack: DiscoursePack) -> Column:
    kind = F.col("semantic_kind")
    roles = F.filter(F.transform("branches", lambda b: F.struct(
        label_map(b["relation"], V.RELATION_ROLES).alias("role"), b["source_form"].alias("type_constraint"))),
        lambda r: r["role"].isNotNull())
    return F.when(kind.isin("EVENT_KIND", "MOTION_KIND"), F.struct(
        first_label(text, pack.event_kinds, "UNKNOWN").alias("event_kind"), F.lit("DYNAMIC").alias("dynamicity"),
        roles.alias("roles")))


def function_refs(nucleus: Column) -> Column:
    def ref(kind: str, target: Column) -> Column:
        return F.struct(F.lit(kind).alias("function_type"), target.alias("target_event_ref"))
    tools = F.transform(_having("INSTRUMENT_OF"), lambda b: ref("INSTRUMENT_FOR", b["gloss"]))
    return F.when(F.col("semantic_kind") == "FUNCTION_KIND", F.array(ref("PURPOSIVE", nucleus))).otherwise(tools)


def relation_refs() -> Column:
    mapped = F.transform(_having(*V.RELATION_KINDS), lambda b: label_map(b["relation"], V.RELATION_KINDS))
    return F.when(F.col("semantic_kind") == "RELATION_KIND", F.array(F.lit(""))).otherwise(mapped)


def property_refs(nucleus: Column) -> Column:
    none = F.array().cast("array<struct<property_ref:string,property_type:string,attribution_mode:string>>")
    one = F.array(F.struct(nucleus.alias("property_ref"), F.lit("QUALITY").alias("property_type"),
                           F.lit("DEFINING").alias("attribution_mode")))
    return F.when(F.col("semantic_kind").isin("PROPERTY_KIND", "EVALUATIVE_KIND"), one).otherwise(none)


def opposition(claim_text: Column, claim_kind: Column, pack: DiscoursePack) -> Column:
    cue = first_label(claim_text, pack.oppositions, None)
    return F.coalesce(cue, F.when(claim_kind == "NEGATIVE_CLAIM", "COMPLEMENTARY"))


def causal_mode(role: Column) -> Column:
    return F.when(role.isNotNull(), label_map(role, V.CAUSAL_MODES, "UNKNOWN"))


def concepts(found: DataFrame, branch: DataFrame, bundles: DataFrame, gate: DataFrame,
             pack: DiscoursePack) -> DataFrame:
    """One concept candidate per origin of every entry the gate lets through."""
    built = gate.where(F.col("status") == "BUILT").select("entry_id")
    head = bundles.select("entry_id", F.col("claim_kind").alias("entry_claim_kind"),
                          F.when(F.col("has_source_claim"), F.col("claim_text")).alias("entry_claim_text"),
                          "has_source_claim")
    rows = (found.join(built, "entry_id", "left_semi").join(head, "entry_id")
            .join(branch_lists(branch), ["entry_id", "origin_index"], "left"))
    empty = F.array().cast("array<struct<pos:int,relation:string,source_form:string,gloss:string,sense:string>>")
    nucleus, text = F.col("semantic_nucleus"), F.coalesce("raw_origin_text", F.lit(""))
    labels = F.array_distinct(F.filter(F.transform("branches", lambda b: b["source_form"]),
                                       lambda x: x.isNotNull() & (x != "")))
    events = F.concat(F.coalesce(nucleus, F.lit("")), F.lit(" "), text)
    kind = F.when(F.col("has_source_claim"), F.col("entry_claim_kind")).otherwise("POSITIVE_ORIGIN")
    causal = causal_mode(F.col("causal_role")) if "causal_role" in found.columns else F.lit(None).cast("string")

    def targets(relation: str) -> Column:
        return F.transform(_having(relation), lambda b: F.struct(
            nucleus.alias("source_ref"), b["source_form"].alias("target_ref")))
    return rows.withColumn("branches", F.coalesce("branches", empty)).select(
        F.concat(F.lit("CC:"), F.substring("origin_id", 5, 32)).alias("concept_id"), "entry_id", "origin_index",
        "origin_id", F.lit(V.CANDIDATE_NOTICE).alias("notice"), nucleus.alias("preferred_label"),
        F.slice(labels, 1, MAX_LABELS).alias("alternative_labels"),
        F.nullif(F.substring(text, 1, 300), F.lit("")).alias("definition"),
        label_map(F.col("semantic_kind"), V.UPPER_KINDS, "UNKNOWN").alias("upper_kind"),
        genus(nucleus, F.col("gloss_method")).alias("genus"), differentia().alias("differentia"),
        property_refs(nucleus).alias("properties"), event_profile(events, pack).alias("event_profile"),
        function_refs(nucleus).alias("functions"), relation_refs().alias("relations"),
        F.when(F.size(_having("PART_OF")) > 0, "STRUCTURAL_PART_OF").alias("mereology"),
        causal.alias("causal_mode"), targets("SIMILARITY_EXTENSION").alias("similarity"),
        opposition(F.col("entry_claim_text"), kind, pack).alias("opposition"),
        targets("METAPHORICAL_EXTENSION").alias("transfers"))
