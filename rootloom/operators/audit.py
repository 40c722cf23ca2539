"""Governance audits: each returns the offending rows, ``audit_counters`` their counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import label_map, normalize
from rootloom.rules import vocab as V
from rootloom.rules.model import Profile


def rank(col: Column, order: Sequence[str]) -> Column:
    """Position in a closed order; unknown labels rank below everything."""
    return F.array_position(F.array(*map(F.lit, order)), col) - 1


def review_rank(col: Column) -> Column:
    return rank(col, V.REVIEW_STATES)


def evidence_rank(col: Column) -> Column:
    return rank(col, V.EVIDENCE_STATUSES)


def violation(df: DataFrame, contract: str, key: str, reason: Column) -> DataFrame:
    return df.withColumn("_reason", reason).where(F.col("_reason").isNotNull()).select(
        F.lit(contract).alias("contract"), F.col(key).alias("record_id"), F.col("_reason").alias("reason"))


def blocked(records: DataFrame, key: str, residuals: DataFrame, kind: str) -> DataFrame:
    """Adds ``blocked``: an open residual of ``kind`` targets the record."""
    targets = residuals.where((F.col("residual_type") == kind) & F.col("resolved_at").isNull()).select(
        F.col("target_id").alias(key)).distinct().withColumn("blocked", F.lit(True))
    return records.join(targets, key, "left").withColumn("blocked", F.coalesce("blocked", F.lit(False)))


def audit_source_to_identity(passages: DataFrame) -> DataFrame:
    return violation(passages, "TC-SI-01", "passage_id", F.when(
        ~F.col("review_state").isin("MACHINE_CANDIDATE", "SOURCE_LOCATED"), F.col("review_state")))


def audit_identity_licence(candidates: DataFrame, certificates: DataFrame, residuals: DataFrame) -> DataFrame:
    """``certificates``: (target_id, reviewer_type) of attempted identity licences."""
    tried = candidates.join(certificates.select(F.col("target_id").alias("candidate_id"), "reviewer_type"),
                            "candidate_id")
    tried = blocked(tried, "candidate_id", residuals, "ROOT_IDENTITY_CONFLICT")
    return violation(tried, "TC-II-02", "candidate_id", F.when(
        F.col("review_state") != "IDENTITY_CANDIDATE", "state").when(
        F.col("reviewer_type") == "MACHINE_ONLY", "machine_reviewer").when(F.col("blocked"), "open_conflict"))


def audit_identity_to_claim(candidates: DataFrame) -> DataFrame:
    floor = V.REVIEW_STATES.index("IDENTITY_CANDIDATE")
    return violation(candidates, "TC-IR-03", "candidate_id", F.when(
        review_rank(F.col("review_state")) < floor, F.col("review_state")))


def audit_claim_to_origins(claims: DataFrame) -> DataFrame:
    floor = V.REVIEW_STATES.index("TEXT_CANDIDATE")
    return violation(claims, "TC-RO-04", "claim_id", F.when(
        ~F.col("origin_type").isin(*V.MULTI_TYPES), "no_segmentation_needed").when(
        review_rank(F.col("review_state")) < floor, "state"))


def audit_origin_review(origins: DataFrame, certificates: DataFrame, residuals: DataFrame) -> DataFrame:
    floor = V.REVIEW_STATES.index("ORIGIN_CANDIDATE")
    tried = origins.join(certificates.select(F.col("target_id").alias("origin_id"), "reviewer_type"), "origin_id")
    tried = blocked(tried, "claim_id", residuals, "ORIGIN_CLAIM_CONFLICT")
    return violation(tried, "TC-OR-05", "origin_id", F.when(
        review_rank(F.col("review_state")) < floor, "state").when(
        F.col("reviewer_type") == "MACHINE_ONLY", "machine_reviewer").when(F.col("blocked"), "open_conflict"))


def audit_machine_ceiling(records: DataFrame) -> DataFrame:
    """``records``: (record_id, record_type, actor_type, review_state, evidence_status)."""
    machine = F.col("actor_type") == "MACHINE_ONLY"
    level = evidence_rank(F.col("evidence_status"))
    return violation(records, "MACHINE-CEILING", "record_id", F.when(
        machine & F.col("review_state").isin(*V.HUMAN_STATES), "human_state").when(
        machine & (level > V.EVIDENCE_STATUSES.index(V.MACHINE_CEILING)), "above_ceiling").when(
        (F.col("record_type") == "RootIdentityCarrier")
        & (level < V.EVIDENCE_STATUSES.index(V.CARRIER_FLOOR)), "carrier_floor"))


def all_ids(**tables: tuple[DataFrame, str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.select(F.col(key).alias("id"), F.lit(kind).alias("entity_kind")) for kind, (df, key) in tables.items()])


def audit_id_uniqueness(ids: DataFrame) -> DataFrame:
    return (ids.groupBy("id").agg(F.count("*").alias("n"), F.min("entity_kind").alias("first_kind"),
                                  F.max("entity_kind").alias("last_kind")).where(F.col("n") > 1))


def audit_domains(df: DataFrame, key: str, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside their closed domain, one row per record and column."""
    checks = [F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin(*map(str, values)),
                     F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c, values in domains.items()]
    return df.select(F.lit("DOMAIN").alias("contract"), F.col(key).alias("record_id"),
                     F.explode(F.array_compact(F.array(*checks))).alias("reason"))


def audit_import_mapping(imports: DataFrame) -> DataFrame:
    return violation(imports, "IMPORT-MAP", "candidate_id", F.when(
        (F.col("review_status") == "AUTO_AGREED") & (F.col("review_state") != "MACHINE_CANDIDATE"), "agreed_state")
        .when(F.col("evidence_status") != V.EVIDENCE_STATUSES[0], "evidence"))


def audit_orphans(origins: DataFrame, claims: DataFrame) -> DataFrame:
    lost = origins.join(claims.select("claim_id"), "claim_id", "left_anti")
    return violation(lost, "ORPHAN", "origin_id", F.col("claim_id"))


def audit_chapter_initial(imports: DataFrame, chapter_names: Mapping[str, str], hamza: Profile) -> DataFrame:
    expected = label_map(normalize(F.substring("root_letters", 1, 1), hamza), chapter_names)
    return violation(imports, "CHAPTER-INITIAL", "candidate_id", F.when(
        (F.col("bab_letter") != "") & expected.isNotNull() & (F.col("bab_letter") != expected),
        F.concat(F.col("bab_letter"), F.lit(" / "), expected)))


def audit_counters(**violations: DataFrame) -> DataFrame:
    """(counter, value) for every named audit, zero included."""
    rows = []
    for name, df in violations.items():
        rows.append(df.agg(F.count("*").alias("value")).select(F.lit(name).alias("counter"), "value"))
    return reduce(DataFrame.unionByName, rows)


def review_apply(records: DataFrame, key: str, certificates: DataFrame) -> DataFrame:
    """Newest certificate per record wins; records without one stay as they are."""
    newest = certificates.groupBy("target_id").agg(F.max(F.struct(
        "reviewed_at", "certificate_id", "granted_state", "reviewer_type")).alias("c"))
    return (records.join(newest.withColumnRenamed("target_id", key), key, "left")
            .withColumn("effective_state", F.coalesce("c.granted_state", "review_state"))
            .withColumn("certificate_id", F.col("c.certificate_id"))
            .withColumn("reviewer_type", F.col("c.reviewer_type")).drop("c"))


def residuals_apply(residuals: DataFrame, certificates: DataFrame) -> DataFrame:
    """A certificate that reaches the blocking state resolves the residual."""
    granted = certificates.groupBy("target_id").agg(
        F.max(F.struct(review_rank(F.col("granted_state")).alias("r"), "reviewed_at")).alias("g"))
    done = F.col("g.r") >= review_rank(F.col("blocking_until"))
    return (residuals.join(granted, "target_id", "left")
            .withColumn("resolved_at", F.coalesce("resolved_at", F.when(done, F.col("g.reviewed_at")))).drop("g"))
