"""Governed lookups: entity index, lookup kinds, evidence ids, licensed augmentation.

A root may own a third of all rows, so per-root lists are never collected: lists
are long tables, and lookups read per-root aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.functions import label_map, strip_ws
from rootloom.operators.claims import candidate_count
from rootloom.operators.predicates import licence_refusal, uncovered
from rootloom.rules import vocab as V
from rootloom.session import broadcast_if_small, dealt_join

MACHINE_ONLY, REVIEW = "FOUND_MACHINE_CANDIDATE_ONLY", "FOUND_REVIEW_REQUIRED_UNRESOLVED"
CONFLICT, GAP = "FOUND_CONFLICT_REVIEW_REQUIRED", "MISSING_VOLUME_COVERAGE_GAP"
ABSENT, FAILED = "NOT_FOUND_IN_COVERED_VOLUME", "REGISTRY_LOAD_FAILURE"
#: Lookup kinds that a human review gives, by the state that it leaves the first candidate in.
REVIEWED = {"IDENTITY_CANDIDATE": "FOUND_IDENTITY_CANDIDATE", "IDENTITY_VERIFIED": "FOUND_IDENTITY_VERIFIED", "TEXT_VERIFIED": "FOUND_TEXT_VERIFIED",
            "LEXICALLY_REVIEWED": "FOUND_LEXICALLY_REVIEWED", "AUDIT_PASSED": "FOUND_LEXICALLY_REVIEWED"}
FOUND = (MACHINE_ONLY, "FOUND_IDENTITY_CANDIDATE", "FOUND_IDENTITY_VERIFIED", "FOUND_TEXT_VERIFIED",
         "FOUND_LEXICALLY_REVIEWED", CONFLICT, REVIEW)
ORIGIN_ID_CAP = 3


def entity_index(**tables: tuple[DataFrame, str]) -> DataFrame:
    """Long index (root_letters, entity_kind, entity_id) over all entity tables."""
    parts = [df.select("root_letters", F.lit(kind).alias("entity_kind"), F.col(key).alias("entity_id"))
             for kind, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def entity_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("root_letters").pivot("entity_kind", [
        "claim", "origin", "candidate", "residual", "import", "trace"]).count().na.fill(0)


def for_requests(df: DataFrame, requests: DataFrame, root: str = "root_letters") -> DataFrame:
    """Rows of the asked roots only; the big side is filtered before any shuffle."""
    wanted = requests.select(strip_ws(F.coalesce("root", F.lit(""))).alias(root)).distinct()
    return df.join(broadcast_if_small(wanted), root, "left_semi")


def root_facts(imports: DataFrame) -> DataFrame:
    """Per-root aggregates a lookup needs, from one pass over the imports."""
    used = ~F.col("is_noise")
    label = F.when(used, F.col("origin_label"))
    candidate = F.struct("line_no", "candidate_id", "passage_id", F.when(
        F.col("corrected_bab_letter") != "", F.col("corrected_bab_letter")).otherwise(F.col("bab_letter"))
        .alias("bab_letter"), "original_bab_letter", "correction_version")
    return imports.groupBy("root_letters").agg(
        F.count("*").alias("import_count"), F.count_if(used).alias("claim_count"),
        F.bool_and(F.col("review_status") == "AUTO_AGREED").alias("all_agreed"),
        F.bool_or(F.col("review_state") == "MACHINE_CANDIDATE").alias("any_machine"),
        (F.min(label) != F.max(label)).alias("is_conflict"),
        F.bool_and(F.col("is_noise")).alias("noise_only"),
        F.min(F.when(used, candidate)).alias("candidate"))


def review_outcomes(certificates: DataFrame) -> DataFrame:
    """(target_id, reviewed_state, certificate_id): where an entity's certificates, folded in order of time, leave it.

    A certificate sets the state it grants, whatever the state was, unless only a machine signed it: that can't grant a
    state that takes a human. So the fold is the latest certificate that counts (ties: the largest id), and an entity with any number
    of certificates condenses before the shuffle.
    """
    machine = F.col("reviewer_type") == "MACHINE_ONLY"
    counts = certificates.where(~(machine & F.col("granted_state").isin(*V.HUMAN_STATES)))
    last = counts.groupBy("target_id").agg(F.max(F.struct("reviewed_at", "certificate_id", "granted_state", "reviewer_type")).alias("c"))
    return last.select("target_id", F.col("c.granted_state").alias("reviewed_state"), F.col("c.certificate_id").alias("certificate_id"),
                       (F.col("c.reviewer_type") != "MACHINE_ONLY").alias("by_human"))


def governed_lookup(requests: DataFrame, imports: DataFrame, missing: Sequence[str],
                    initial_profile=None, load_failed: bool = False,
                    health: DataFrame | None = None, certificates: DataFrame | None = None,
                    namespace: str = "lex") -> DataFrame:
    """A row per request. ``certificates`` (target_id: a candidate) lift roots whose first candidate a human reviewed to
    the kind of the state it was left in; a root in conflict stays that. Verified candidates carry an identity."""
    facts = root_facts(for_requests(imports, requests))
    if certificates is not None:
        facts = facts.withColumn("target_id", F.col("candidate.candidate_id")).join(
            review_outcomes(certificates).where("by_human"), "target_id", "left").drop("target_id")
    else:
        facts = facts.withColumns({"reviewed_state": F.lit(None).cast("string"), "certificate_id": F.lit(None).cast("string")})
    root = F.coalesce("root", F.lit(""))
    joined = requests.withColumn("root_letters", strip_ws(root)).join(facts, "root_letters", "left")
    absent = F.col("import_count").isNull()
    gap = uncovered(F.col("root_letters"), missing, initial_profile)
    reviewed = label_map(F.col("reviewed_state"), REVIEWED)
    kind = (F.when(F.lit(load_failed), FAILED)
            .when(F.col("root_letters") == "", ABSENT).when(gap, GAP).when(absent, ABSENT)
            .when(F.col("is_conflict"), CONFLICT).when(reviewed.isNotNull(), reviewed).when(F.col("all_agreed"), MACHINE_ONLY).otherwise(REVIEW))
    found = F.col("kind").isin(*FOUND)
    out = joined.withColumn("kind", kind).withColumns({
        "found": found, "has_conflict": F.col("kind") == CONFLICT, "coverage_gap": F.col("kind") == GAP,
        "is_machine_only": F.col("kind").isin(MACHINE_ONLY, REVIEW),
        "evidence_status": F.lit(V.EVIDENCE_STATUSES[0]),
        "carrier_id": F.when(F.col("kind").isin("FOUND_IDENTITY_VERIFIED", "FOUND_TEXT_VERIFIED", "FOUND_LEXICALLY_REVIEWED"), F.concat(
            F.lit(f"{namespace}:root-identity-carrier:"), "root_letters", F.lit(":"), F.col("certificate_id"))),
        "review_state": F.when(~found, "UNREVIEWED").when(F.col("kind").isin(*REVIEWED.values()), F.col("reviewed_state"))
        .when(F.col("any_machine"), "IDENTITY_CANDIDATE")
        .otherwise("UNVERIFIED_REVIEW_REQUIRED"),
        "coverage_note": F.when(F.col("kind") == GAP, F.concat(
            F.lit("Root '"), F.col("root_letters"),
            F.lit("' starts in a missing volume; a coverage gap is not an absence claim")))})
    return with_health(out, health) if health is not None else out


def load_health(lines: DataFrame) -> DataFrame:
    """One row: malformed lines and whether the load was partial."""
    bad = F.count_if(F.col("is_malformed"))
    return lines.agg(bad.alias("malformed_line_count"), (bad > 0).alias("partial_load"))


def with_health(lookups: DataFrame, health: DataFrame) -> DataFrame:
    return lookups.withColumn("_one", F.lit(1)).join(
        F.broadcast(health.withColumn("_one", F.lit(1))), "_one").drop("_one")


def root_evidence_ids(lookups: DataFrame, claims: DataFrame, origins: DataFrame, namespace: str = "lex",
                      origin_cap: int = ORIGIN_ID_CAP) -> DataFrame:
    """Long form (root_letters, step, position, evidence_id), once per distinct root found, in reference order.

    Chapter for every kind; of machine candidates the first real origin, the candidate, claims and up to ``origin_cap`` origins; of
    reviewed kinds the whole chain: candidate, carrier, claims, origins. Conflicts and unresolved reviews show the chapter only.
    """
    heads = lookups.where("found").select("root_letters", "kind", F.col("candidate.bab_letter").alias("chapter"), F.col(
        "candidate.candidate_id").alias("candidate_id"), "carrier_id").dropDuplicates(["root_letters"])
    ns = f"{namespace}:root:"

    def row(df: DataFrame, step: int, value, position=F.lit(0)) -> DataFrame:
        return df.select("root_letters", F.lit(step).alias("step"), position.cast("long").alias("position"), value.alias("evidence_id"))
    chapter = row(heads.where(F.coalesce("chapter", F.lit("")) != ""), 0, F.concat(F.lit(ns), "root_letters", F.lit(":bab:"), "chapter"))
    machine = heads.where(F.col("kind") == MACHINE_ONLY)
    chained = heads.where(F.col("kind").isin(MACHINE_ONLY, *REVIEWED.values()))

    def mine(df: DataFrame, roots: DataFrame) -> DataFrame:
        return df.join(broadcast_if_small(roots.select("root_letters")), "root_letters", "left_semi")
    real = ~F.col("origin_type").isin(*V.NO_ORIGIN_TYPES)
    count = F.when(candidate_count() > 0, candidate_count().cast("string")).otherwise("none")
    first = mine(claims, machine).where(real).groupBy("root_letters").agg(
        F.min(F.struct("line_no", F.col("origin_type").alias("t"), count.alias("c"))).alias("f"))
    origin = row(first, 1, F.concat(F.lit(ns), "root_letters", F.lit(":origin:"), F.col("f.t"), F.lit(":count:"), F.col("f.c")))
    candidate = row(chained.where(F.col("candidate_id").isNotNull()), 2, F.col("candidate_id"))
    carrier = row(chained.where(F.col("carrier_id").isNotNull()), 2, F.col("carrier_id"), F.lit(1))
    claim_ids = row(mine(claims, chained), 3, F.col("claim_id"), F.col("line_no"))
    order = Window.partitionBy("root_letters").orderBy("line_no")
    top = mine(origins, machine).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= origin_cap)
    every = mine(origins, chained.where(F.col("kind") != MACHINE_ONLY))
    origin_ids = [row(df, 4, F.col("origin_id"), F.col("line_no")) for df in (top, every)]
    return reduce(DataFrame.unionByName, [chapter, origin, candidate, carrier, claim_ids, *origin_ids])


def for_each_request(ids: DataFrame, requests: DataFrame, spread_by: str) -> DataFrame:
    """The view by request of a table by root: as many rows as requests times ids of their root, hot roots dealt out."""
    return dealt_join(ids, requests.select("request_id", "root_letters"), "root_letters", spread_by)


def governed_evidence_ids(lookups: DataFrame, claims: DataFrame, origins: DataFrame,
                          namespace: str = "lex") -> DataFrame:
    """``root_evidence_ids`` by request: (request_id, step, position, evidence_id)."""
    ids = root_evidence_ids(lookups, claims, origins, namespace)
    return for_each_request(ids, lookups.where("found"), "evidence_id").select("request_id", "step", "position", "evidence_id")


def evidence_metadata(lookups: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids by root with the state of their root's lookup, by root as well."""
    head = lookups.select("root_letters", "kind", "evidence_status", "review_state").dropDuplicates(["root_letters"])
    return dealt_join(ids, head, "root_letters", "evidence_id")


def coverage_status(kind: Column) -> Column:
    return (F.when(kind == GAP, "MISSING_VOLUME")
            .when(kind.isin(FAILED, "REGISTRY_PARTIAL_LOAD"), "LOAD_FAILURE")
            .when(kind.isin(*FOUND), "COVERED").otherwise("NOT_FOUND"))


def licensed_augmentation(requests: DataFrame, imports: DataFrame, missing: Sequence[str],
                          initial_profile=None, carriers: DataFrame | None = None) -> DataFrame:
    """One row per request: refusal reason, or the governed lookup it was licensed for."""
    reason = licence_refusal(F.col("directive"), F.col("root"))
    judged = requests.withColumn("refusal", reason)
    looked = governed_lookup(judged.where(F.col("refusal").isNull()), imports, missing, initial_profile)
    if carriers is not None:
        looked = looked.join(carriers.select("root_letters").distinct().withColumn("reviewed", F.lit(True)),
                             "root_letters", "left")
    else:
        looked = looked.withColumn("reviewed", F.lit(False))
    accepted = looked.select(
        "request_id", "root", F.col("kind").alias("lookup_kind"), "evidence_status", "review_state",
        F.col("found").alias("licensed"), coverage_status(F.col("kind")).alias("coverage_status"),
        F.when(F.col("has_conflict"), "conflict").otherwise(F.col("coverage_note")).alias("failure_detail"),
        F.lit(True).alias("root_licensed"),
        (F.coalesce("claim_count", F.lit(0)) > 0).alias("source_candidate_found"),
        ((F.col("kind") == "FOUND_LEXICALLY_REVIEWED") & F.coalesce("reviewed", F.lit(False)))
        .alias("lexical_evidence_licensed"))
    refused = judged.where(F.col("refusal").isNotNull()).select(
        "request_id", "root", F.lit(ABSENT).alias("lookup_kind"),
        F.lit(V.EVIDENCE_STATUSES[0]).alias("evidence_status"), F.lit("UNREVIEWED").alias("review_state"),
        F.lit(False).alias("licensed"), F.lit("NOT_LICENSED").alias("coverage_status"),
        F.col("refusal").alias("failure_detail"), F.lit(False).alias("root_licensed"),
        F.lit(False).alias("source_candidate_found"), F.lit(False).alias("lexical_evidence_licensed"))
    return accepted.unionByName(refused)


def root_augmentation_ids(requests: DataFrame, claims: DataFrame, residuals: DataFrame, traces: DataFrame) -> DataFrame:
    """Long form (root_letters, id_kind, id): passages, open residuals and traces, once per licensed root."""
    ok = requests.where(licence_refusal(F.col("directive"), F.col("root")).isNull())

    def ids(df: DataFrame, kind: str, key: str) -> DataFrame:
        return for_requests(df.select("root_letters", F.lit(kind).alias("id_kind"), F.col(key).alias("id")), ok)
    return reduce(DataFrame.unionByName, [
        ids(claims, "passage", "passage_id"),
        ids(residuals.where(F.col("resolved_at").isNull()), "residual", "residual_id"),
        ids(traces, "trace", "trace_id")])


def augmentation_ids(requests: DataFrame, claims: DataFrame, residuals: DataFrame,
                     traces: DataFrame) -> DataFrame:
    """``root_augmentation_ids`` by licensed request: (request_id, id_kind, id)."""
    ok = requests.where(licence_refusal(F.col("directive"), F.col("root")).isNull())
    asked = ok.select("request_id", strip_ws(F.col("root")).alias("root_letters"))
    return for_each_request(root_augmentation_ids(requests, claims, residuals, traces), asked, "id").select("request_id", "id_kind", "id")


def lookup_explain(lookups: DataFrame, ids: DataFrame, residuals: DataFrame,
                   origins: DataFrame, gates: DataFrame) -> DataFrame:
    """Review table: counts and flags per looked-up root (per-root counts, no lists); ``ids`` as of ``root_evidence_ids``."""
    n_ids = ids.groupBy("root_letters").agg(F.count("*").alias("evidence_id_count"))
    n_open = for_requests(residuals.where(F.col("resolved_at").isNull()), lookups).groupBy(
        "root_letters").agg(F.count("*").alias("open_residuals"))
    n_origins = for_requests(origins, lookups).groupBy("root_letters").agg(F.count("*").alias("origins_count"))
    first = for_requests(gates, lookups).groupBy("root_letters").agg(
        F.min(F.struct("line_no", F.array_join("flagged", ",").alias("flagged"))).alias("g"))
    return (lookups.join(n_ids, "root_letters", "left").join(n_open, "root_letters", "left")
            .join(n_origins, "root_letters", "left").join(first, "root_letters", "left")
            .select("request_id", "root_letters", "kind", "evidence_status", "review_state", "found",
                    "is_machine_only", "has_conflict", "coverage_gap",
                    F.when(F.col("found"), F.coalesce("evidence_id_count", F.lit(0))).otherwise(0).alias("evidence_id_count"),
                    F.when(F.col("found"), F.coalesce("open_residuals", F.lit(0))).otherwise(0)
                    .alias("open_residuals"),
                    F.when(F.col("found"), F.coalesce("claim_count", F.lit(0))).otherwise(0).alias("claims_count"),
                    F.when(F.col("found"), F.coalesce("origins_count", F.lit(0))).otherwise(0)
                    .alias("origins_count"),
                    F.when(F.col("found"), F.coalesce("g.flagged", F.lit(""))).otherwise("").alias("flagged_gates")))
