"""Segments to claims, and claims to node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import first_label, normalize, once, strip_ws
from rootloom.rules.model import ClaimRule, DiscoursePack

DEFAULT_CLAIM = {"SECOND_ORIG": "ORIGIN_BOUNDARY", "BRANCH": "BRANCH_ITEM", "EXCEPTION": "EXCEPTION_NOTE",
                 "INTRO": "INTRO_EXAMPLE", "HADITH": "HADITH_EVIDENCE"}
CLAIM_TYPES = ("USAGE_NAMED", "USAGE_CONDITIONAL", "USAGE_FORM", "AUTHORITY_CITATION", "ETYMOLOGY_NAMING",
               "ETYMOLOGY_ORIGIN", "ETYMOLOGY_SEMANTIC", "ETYMOLOGY_CAUSAL", "PLURAL_FORM", "HADITH_EVIDENCE",
               "ORIGIN_BOUNDARY", "BRANCH_ITEM", "EXCEPTION_NOTE", "INTRO_EXAMPLE", "RAW_SEGMENT")
USAGE = ("USAGE_CONDITIONAL", "USAGE_FORM", "USAGE_NAMED")
ETYMOLOGY = ("ETYMOLOGY_ORIGIN", "ETYMOLOGY_SEMANTIC", "ETYMOLOGY_NAMING", "ETYMOLOGY_CAUSAL")
EVIDENCE_TEXT = 300


def node_id(prefix: str, *parts: Column) -> Column:
    """Deterministic id: same input, same id, in any run and any task."""
    key = F.concat_ws("|", *(p.cast("string") for p in parts))
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(key, 256), 1, 32))


def clean_authority(raw: Column, pack: DiscoursePack) -> Column:
    name = F.regexp_replace(strip_ws(raw), pack.authority_trail, "")
    return F.array_join(F.slice(F.split(name, r"\s+"), 1, 3), " ")


def extract_claims(segments: DataFrame, pack: DiscoursePack) -> DataFrame:
    """One claim per segment: the first rule of its segment type that matches."""
    full = F.concat("marker", F.lit(" "), "text")
    no = None
    for i, rule in enumerate(pack.claim_rules):
        hit = (F.col("segment_type") == rule.segment_type) & F.col("full").rlike(rule.pattern)
        if rule.requires:
            hit = hit & F.col("full").contains(rule.requires)
        no = F.when(hit, i) if no is None else no.when(hit, i)

    def by_rule(value, default: Column) -> Column:
        out = None
        for i, rule in enumerate(pack.claim_rules):
            v = value(rule)
            if v is not None:
                out = F.when(F.col("rule") == i, v) if out is None else out.when(F.col("rule") == i, v)
        return out.otherwise(default)

    def group(rule: ClaimRule, n: int, limit: int | None = None) -> Column:
        text = strip_ws(F.regexp_extract("full", rule.pattern, n))
        return F.substring(text, 1, limit) if limit else text

    fallback = F.lit("RAW_SEGMENT")
    for segment, claim in DEFAULT_CLAIM.items():
        fallback = F.when(F.col("segment_type") == segment, claim).otherwise(fallback)
    null = F.lit(None).cast("string")
    hadith = F.when(F.col("segment_type") == "HADITH", F.substring("text", 1, 200))
    ruled = once(once(segments.withColumn("full", full), "full").withColumn("rule", no), "rule")
    return (ruled.withColumn("claim_type", by_rule(lambda r: F.lit(r.claim_type), fallback))
            .withColumn("term", by_rule(lambda r: group(r, r.term_group) if r.term_group else None, null))
            .withColumn("definition", by_rule(
                lambda r: group(r, r.definition_group, r.definition_limit) if r.definition_group else None, hadith))
            .withColumn("authority", by_rule(
                lambda r: None if r.authority is None else F.lit(r.authority) if isinstance(r.authority, str)
                else clean_authority(F.regexp_extract("full", r.pattern, r.authority), pack), null))
            .withColumnRenamed("text", "raw_text")
            .withColumn("claim_id", node_id("CLM", F.col("entry_id"), F.col("pos")))
            .drop("full", "rule"))


def claim_nodes(claims: DataFrame, pack: DiscoursePack) -> DataFrame:
    kind = F.col("claim_type")
    strength = (F.when(kind == "AUTHORITY_CITATION", "REPORTED")
                .when(kind.isin(*ETYMOLOGY) & F.col("raw_text").rlike(pack.hedge), "PROBABLE")
                .when(kind == "EXCEPTION_NOTE", "REPORTED")
                .when(kind.isin("RAW_SEGMENT", "ORIGIN_BOUNDARY"), "UNKNOWN").otherwise("ASSERTED"))
    attribution = (
        F.when((kind == "AUTHORITY_CITATION") & F.col("authority").contains(pack.anonymous), "ARABS_GENERAL")
        .when((kind == "AUTHORITY_CITATION") & (F.col("authority") != ""), "QUOTED_SCHOLAR")
        .when(kind == "AUTHORITY_CITATION", "UNKNOWN")
        .when(kind == "HADITH_EVIDENCE", "QUOTED_SCHOLAR")
        .when(F.col("marker").isin(*pack.self_markers) | F.col("segment_type").isin(
            "USAGE", "ETYMOLOGY", "BRANCH", "EXCEPTION", "PLURAL", "INTRO"), "IBN_FARIS")
        .otherwise("UNKNOWN"))
    return claims.withColumns({
        "assertion_strength": strength,
        "author_position": F.when(kind == "AUTHORITY_CITATION", "REPORTED_ONLY").otherwise("ADOPTED"),
        "claim_attribution": attribution})


def _distinct_nodes(claims: DataFrame, value: str, prefix: str, pack: DiscoursePack) -> DataFrame:
    return (claims.where(F.coalesce(value, F.lit("")) != "")
            .withColumn("norm", normalize(F.col(value), pack.term_profile))
            .groupBy("entry_id", "norm").agg(F.min(F.struct("pos", value)).alias("first"))
            .select(node_id(prefix, F.col("entry_id"), F.col("norm")).alias("node_id"), "entry_id",
                    F.col(f"first.{value}").alias("surface"), "norm"))


def term_nodes(claims: DataFrame, pack: DiscoursePack) -> DataFrame:
    return _distinct_nodes(claims, "term", "TRM", pack)


def authority_nodes(claims: DataFrame, pack: DiscoursePack) -> DataFrame:
    return _distinct_nodes(claims, "authority", "AUTH", pack)


def _is_evidence() -> Column:
    """Hadith, and citations of scholars or of the Arabs."""
    kind = F.col("claim_type")
    return (kind == "HADITH_EVIDENCE") | ((kind == "AUTHORITY_CITATION") & F.col("claim_attribution").isin(
        "QUOTED_SCHOLAR", "ARABS_GENERAL"))


def _usage_type(pack: DiscoursePack) -> Column:
    return F.when(F.col("claim_type") == "HADITH_EVIDENCE", "HADITH").otherwise(
        first_label(F.col("raw_text"), pack.usage_cues, "ARAB_SPEECH"))


def _strength(usage: Column) -> Column:
    return F.when(usage.isin("QURANIC", "HADITH"), "DIRECT").otherwise("SUPPORTING")


def evidence_nodes(nodes: DataFrame, pack: DiscoursePack) -> DataFrame:
    """From ``claim_nodes``: one evidence node per claim that cites a witness."""
    shown = F.when(F.coalesce("definition", F.lit("")) != "", F.col("definition")).otherwise(F.col("raw_text"))
    return (nodes.where(_is_evidence())
            .select(node_id("EV", F.col("entry_id"), F.col("pos")).alias("node_id"), "entry_id", "claim_id",
                    F.substring(shown, 1, EVIDENCE_TEXT).alias("text"), _usage_type(pack).alias("usage_type"),
                    F.when(F.col("claim_type") == "HADITH_EVIDENCE", "DEMONSTRATES_USAGE")
                    .otherwise("DEMONSTRATES_SENSE").alias("witness_function"),
                    F.col("raw_text").rlike(pack.poetry_cue).alias("is_embedded_poetry"))
            .withColumn("evidence_strength", _strength(F.col("usage_type"))))


def edge_struct(kind: str, source: Column, target: Column, **meta: Column) -> Column:
    pairs = [x for k, v in meta.items() for x in (F.lit(k), v.cast("string"))]
    empty = F.create_map().cast("map<string,string>")
    return F.struct(F.lit(kind).alias("edge_type"), source.alias("source_id"), target.alias("target_id"),
                    (F.create_map(*pairs) if pairs else empty).alias("meta"))


def edge(df: DataFrame, kind: str, source: Column, target: Column, **meta: Column) -> DataFrame:
    return df.select("entry_id", edge_struct(kind, source, target, **meta).alias("e")).select("entry_id", "e.*")


def claim_edges(nodes: DataFrame, pack: DiscoursePack) -> DataFrame:
    """From ``claim_nodes``: all edges of a claim leave its own row in one pass,
    because both ends of an edge derive their ids from the same values."""
    def to(prefix: str, value: str) -> Column:
        return node_id(prefix, F.col("entry_id"), normalize(F.col(value), pack.term_profile))

    def given(name: str) -> Column:
        return F.coalesce(name, F.lit("")) != ""
    claim, at = F.col("claim_id"), (F.col("entry_id"), F.col("pos"))
    chained = (F.col("claim_type") == "RAW_SEGMENT") & (F.col("segment_type") == "CONTINUATION") & (F.col("pos") > 0)
    edges = F.array_compact(F.array(
        F.when(given("term"), edge_struct("CLAIM_ABOUT", claim, to("TRM", "term"))),
        F.when(given("authority"), edge_struct("ATTRIBUTED_TO", claim, to("AUTH", "authority"))),
        F.when(chained, edge_struct("ELABORATES", claim, node_id("CLM", at[0], at[1] - 1))),
        F.when(_is_evidence(), edge_struct("SUPPORTED_BY", node_id("EV", *at), claim,
                                           evidence_strength=_strength(_usage_type(pack))))))
    return nodes.select("entry_id", F.inline_outer(edges)).where(F.col("edge_type").isNotNull())


def claims_by_type(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_type").agg(
        F.count("*").alias("claims"), F.count_if(F.coalesce("term", F.lit("")) != "").alias("with_term"),
        F.count_if(F.coalesce("definition", F.lit("")) != "").alias("with_definition"))


def claims_summary(claims: DataFrame) -> DataFrame:
    """Per entry, from that entry's own segments: counts, ordered lists, dual flag."""
    def ordered(value: str, cond: Column) -> Column:
        items = F.array_sort(F.collect_list(F.when(
            cond & (F.coalesce(value, F.lit("")) != ""), F.struct("pos", F.col(value).alias("v")))))
        return F.transform(items, lambda x: x["v"])
    kind = F.col("claim_type")
    counts = F.filter(F.array(*(F.struct(F.lit(t).alias("type"), F.count_if(kind == t).alias("n"))
                                for t in CLAIM_TYPES)), lambda x: x["n"] > 0)
    return claims.groupBy("entry_id").agg(
        F.count("*").alias("total"), F.map_from_entries(counts).alias("by_type"),
        ordered("term", kind.isin(*USAGE)).alias("usage_terms"),
        ordered("term", kind == "PLURAL_FORM").alias("plural_forms"),
        F.array_distinct(ordered("authority", kind == "AUTHORITY_CITATION")).alias("authorities"),
        ordered("definition", kind == "HADITH_EVIDENCE").alias("hadiths"),
        ordered("definition", kind.startswith("ETYMOLOGY")).alias("etymology"),
        F.bool_or(kind == "ORIGIN_BOUNDARY").alias("dual_entry"))
