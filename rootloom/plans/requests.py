"""Batch requests against the star tables.

Every query type returns one row per (request, matching entry), with the answer
columns ``found``, ``query_status`` and ``canonical_root`` of its request.  Lists
per request are never collected: a root may own a third of all entries.

A type whose answer is a projection of its matched entries is a ``Detail``: which entry columns it reads, which facts of the
root and which expressions it shows.  Mixed requests are answered from the same definitions, all types in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.functions import body_excerpt, excerpt, normalize, once
from rootloom.operators.predicates import author_position_kept
from rootloom.plans.matching import FALLBACK_LIMIT, EntryTable, Matches, containing
from rootloom.rules import vocab as V
from rootloom.rules.model import Profile
from rootloom.session import dealt_join, held

AXIS_LIMIT, BODY_LIMIT = 50, 30


def find_entries(requests: DataFrame, entries: DataFrame, profile: Profile,
                 limit: int = FALLBACK_LIMIT) -> DataFrame:
    """(request_id, entry columns…): exact root or display prefix; requests with no
    such hit fall back to roots holding their first three letters (``limit`` each)."""
    found = Matches(requests, entries, profile, limit=limit)
    return found.meet(found.asked.where(F.col("root_norm") != "").select("request_id", "root_norm")).drop("root_norm")


def whole(entries: DataFrame | EntryTable) -> DataFrame:
    return entries.complete() if isinstance(entries, EntryTable) else entries


def _axes_of(enriched: DataFrame) -> Column:
    return F.transform("semantic_axes", lambda a, i: F.struct(
        (i + 1).alias("axis_num"), a["text"].alias("axis_text"), a["attribution"].alias("attribution")))


def with_axes(entries: DataFrame, axes: DataFrame | None = None) -> DataFrame:
    """Entries with their own axes as an ordered array (an entry has few of them)."""
    if "axes" in entries.columns:
        return entries
    if axes is None:
        return entries.withColumn("axes", _axes_of(entries))
    grouped = axes.groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct(
        "axis_num", "axis_text", "attribution"))).alias("axes"))
    none = F.array().cast("array<struct<axis_num:int,axis_text:string,attribution:string>>")
    return entries.join(grouped, "entry_id", "left").withColumn("axes", F.coalesce("axes", none))


def child_lists(name: str, array: str, child: DataFrame | None, *fields: str) -> Callable[[DataFrame], DataFrame]:
    """Adds child records of each matched entry as an ordered array ``name``.

    They come from the entry's own ``array`` column, or from a star table keyed by
    ``entry_id`` (an entry has few child records).
    """
    def add(rows: DataFrame) -> DataFrame:
        if child is None:
            items = F.transform(array, lambda x, i: F.struct((i + 1).alias(fields[0]), x.alias(fields[1])))
            return rows.withColumn(name, F.when(F.size(array) > 0, items))
        mine = child.join(rows.select("entry_id").distinct(), "entry_id", "left_semi")
        lists = mine.groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        return rows.join(lists, "entry_id", "left")
    return add


@dataclass(frozen=True)
class Detail:
    """An answer with a row per matched entry.

    ``reads``: entry columns it needs; ``shows``: names of entry columns or (name, expression) over an entry and its request;
    ``facts``: (name, expression) over the facts of the root.
    """

    reads: str
    shows: Callable[[], list]
    facts: Callable[[], dict[str, Column]] = dict

    def columns(self) -> list[Column]:
        """Shown columns; null in the row of a request without entries."""
        here = F.col("entry_id").isNotNull()
        shown = [(c, F.col(c)) if isinstance(c, str) else c for c in self.shows()]
        return [F.when(here, c).alias(n) for n, c in shown]

    def fact_columns(self) -> list[Column]:
        return [c.alias(n) for n, c in self.facts().items()]


def first(name: str) -> Column:
    return F.col(f"first.{name}")


def unknown() -> Column:
    return F.col("entry_type") == "UNKNOWN"


def many() -> Column:
    return F.size("axes") > 1


def _shown_body() -> Column:
    needle = F.coalesce(F.nullif("concept_id", F.lit("")), F.nullif("claim_text", F.lit("")))
    return F.when(needle.isNotNull(), excerpt(F.col("body_text"), needle)).otherwise(F.substring("body_text", 1, 200))


def _provenance() -> Column:
    return F.transform("axes", lambda a: F.struct(
        a["axis_text"].alias("text"), a["attribution"].alias("attribution"),
        F.when(a["attribution"] == V.ATTRIBUTION_DIRECT, V.PROVENANCE_EXPLICIT)
        .when(a["attribution"] == V.ATTRIBUTION_QUOTED, V.ATTRIBUTION_QUOTED)
        .otherwise(V.PROVENANCE_OTHER).alias("provenance")))


def _geminate() -> Column:
    return F.length(F.replace(F.col("canonical_root"), F.lit(" "), F.lit(""))) == 2


DETAILS = {
    "ROOT_LOOKUP": Detail(
        "root_letters root_display entry_type axes_count axes body_text poetry poetry_lines page_refs quoted_authorities ocr_confidence review_state",
        lambda: ["root_letters", "root_display", "entry_type", "axes_count", "axes", "body_text", "poetry", "page_refs",
                 "quoted_authorities", "ocr_confidence", "review_state"],
        lambda: {"first_confidence": first("ocr_confidence"), "first_review_state": first("review_state")}),
    "ROOT_SEMANTIC_ORIGINS": Detail(
        "root_letters root_display entry_type axes_count axes body_text page_refs ocr_confidence review_state",
        lambda: ["root_letters", "root_display", "entry_type", "axes_count", "axes",
                 ("body_excerpt", body_excerpt(F.col("body_text"))), "page_refs", "ocr_confidence"],
        lambda: {"first_review_state": first("review_state"), "confidence": F.col("least_confidence")}),
    "ROOT_CANONICAL_IDENTITY": Detail(
        "root_letters root_display entry_type", lambda: ["root_letters", "root_display"],
        lambda: {"first_display": first("root_display"), "first_type": first("entry_type"), "is_geminate": _geminate(),
                 "ambiguous": F.col("entry_count") > 1}),
    "ENTRY_QUALIFICATION": Detail(
        "root_letters root_display entry_type axes_count ocr_confidence review_state claim_status body_text",
        lambda: ["root_letters", "root_display", "entry_type", "axes_count", "ocr_confidence", "review_state", "claim_status",
                 ("has_body", F.length("body_text") > 0)],
        lambda: {"confidence": F.col("mean_confidence"), "partial_load": F.col("partial_load"),
                 "entry_status": F.when(F.col("found"), "PRESENT").otherwise("ABSENT")}),
    "ROOT_MEANING_EVIDENCE_RETRIEVAL": Detail(
        "root_letters body_text page_refs", lambda: ["root_letters", ("body_excerpt", _shown_body()), "page_refs"]),
    "ROOT_ORIGIN_RELATIONS": Detail(
        "root_letters axes_count axes entry_type",
        lambda: ["root_letters", "axes_count", "axes", ("has_multiple_origins", many()), ("generalization_scope", F.when(
            F.col("entry_type") == "SINGLE_ORIGIN", "FULL").when(many(), "PARTIAL").otherwise("UNKNOWN"))]),
    "ROOT_INTERNAL_CONFLICT_LOOKUP": Detail(
        "root_letters axes entry_type",
        lambda: ["root_letters", ("axis_rows", F.size("axes")), ("has_conflict", many()), "entry_type", ("has_residuals", unknown())]),
    "SOURCE_EVIDENCE_LOOKUP": Detail(
        "root_letters body_text page_refs source passages footnote_lines", lambda: ["root_letters", "body_text", "page_refs", "source", "passages"]),
    "CLAIM_ATTRIBUTION_LOOKUP": Detail(
        "root_letters axes quoted_authorities",
        lambda: ["root_letters", "axes", "quoted_authorities", ("note", F.when(F.size("quoted_authorities") == 0, V.UNATTRIBUTED_NOTE))]),
    "ROOT_SENSE_CANDIDATES": Detail("root_letters axes", lambda: ["root_letters", ("sense_candidates", F.col("axes"))]),
    "RECORD_INTEGRITY_LOOKUP": Detail(
        "root_letters entry_type ocr_confidence review_state",
        lambda: ["root_letters", "entry_type", ("axes_extracted", ~unknown()), "ocr_confidence", "review_state",
                 ("entry_partial", unknown()), ("malformed_lines", F.lit(0))],
        lambda: {"partial_load": F.col("partial_load")}),
    "ASSERTION_PROVENANCE_CHECK": Detail("root_letters axes", lambda: ["root_letters", ("axes_provenance", _provenance())]),
}
ANSWER = ("request_id", "entry_count", "canonical_root", "found", "query_status")


def with_rows(found: Matches, answers: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """Answers with the entries of their root; those without any keep one row with a null entry.

    The entries are on the heavy side of an inner join that deals out hot roots; the rest are few narrow rows.
    """
    met = found.meet(answers.where("found"), hits)
    rest = answers.where(~F.col("found"))
    names = set(rest.columns)
    nulls = [F.lit(None).cast(t).alias(n) for n, t in (found.hits if hits is None else hits).dtypes if n not in names]
    return met.unionByName(rest.select("*", *nulls))


def _detail(kind: str, requests: DataFrame, entries: DataFrame | EntryTable, profile: Profile,
            children: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    spec = DETAILS[kind]
    found = Matches(requests, entries, profile, spec.reads.split(), children)
    rows = with_rows(found, found.answers)
    return rows.select(*ANSWER, *spec.fact_columns(), "entry_id", "entry_num", *spec.columns())


def root_lookup(requests, entries, profile, poetry: DataFrame | None = None) -> DataFrame:
    return _detail("ROOT_LOOKUP", requests, entries, profile, child_lists("poetry", "poetry_lines", poetry, "line_num", "line_text"))


def root_semantic_origins(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_SEMANTIC_ORIGINS", requests, entries, profile)


def entry_statuses(hits: DataFrame) -> DataFrame:
    """Per root: how many entries per type and state (there are few of these)."""
    counts = hits.groupBy("root_norm", "entry_type", "review_state").agg(F.count("*").alias("n"))
    return counts.groupBy("root_norm").agg(F.array_sort(F.collect_list(F.struct("entry_type", "review_state", "n"))).alias("entry_statuses"))


def root_exists(requests, entries, profile) -> DataFrame:
    """One row per request: count, and how many entries per type and state."""
    found = Matches(requests, entries, profile, ["root_letters", "entry_type", "review_state"])
    return found.answers.join(entry_statuses(found.hits), "root_norm", "left").select(*ANSWER, "entry_statuses")


def root_canonical_identity(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_CANONICAL_IDENTITY", requests, entries, profile)


def entry_qualification(requests, entries, profile) -> DataFrame:
    return _detail("ENTRY_QUALIFICATION", requests, entries, profile)


def concept_of(requests: DataFrame) -> Column:
    cols = [F.nullif(F.col(c), F.lit("")) for c in ("concept", "claim_text", "concept_id") if c in requests.columns]
    return F.coalesce(*cols)


def _first(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    """The first ``limit`` rows of each request; None keeps all and sorts nothing."""
    if limit is None:
        return rows
    place = F.row_number().over(Window.partitionBy("request_id").orderBy(*order))
    return rows.withColumn("rn", place).where(F.col("rn") <= limit)


def concept_to_root_search(requests: DataFrame, entries: DataFrame, profile: Profile,
                           axis_limit: int | None = AXIS_LIMIT, body_limit: int | None = BODY_LIMIT) -> DataFrame:
    """Axis hits (first ``axis_limit`` by entry), then body hits (``body_limit``); an
    entry counts once, axis before body.  All axes and bodies are searched; limits cut what is
    returned, as the query type does.  None is no limit: every hit is returned."""
    asked = requests.withColumn("concept", concept_of(requests))
    wanted = asked.where(F.col("concept").isNotNull())
    axis_keys = wanted.select("request_id", F.explode(F.array_distinct(F.array(
        "concept", normalize(F.col("concept"), profile)))).alias("needle")).where(F.col("needle") != "")
    axes = whole(entries).select("entry_id", "root_letters", "root_display", F.explode("axes").alias("a")).select(
        "entry_id", "root_letters", "root_display", F.col("a.axis_num").alias("axis_num"),
        F.col("a.axis_text").alias("axis_text"), F.col("a.axis_text").alias("searched"), F.col("a.attribution").alias("attribution"))
    hits = containing(held(axes), "searched", ["entry_id", "axis_num"], axis_keys).drop("needle").distinct()
    hits = _first(hits, axis_limit, "entry_id", "axis_num")
    axis_rows = hits.groupBy("request_id", "entry_id").agg(F.min(F.struct(
        "axis_num", "axis_text", "attribution", "root_letters", "root_display")).alias("h")).select(
        "request_id", "entry_id", "h.root_letters", "h.root_display",
        F.when(F.col("h.attribution") == V.ATTRIBUTION_DIRECT, V.MATCH_BY_AXIS).otherwise(V.MATCH_BY_QUOTED)
        .alias("match_type"), F.col("h.axis_text").alias("matched_axis"))
    axis_rows = held(axis_rows)
    body_keys = wanted.select("request_id", F.col("concept").alias("needle"))
    bodies = (entries.rows if isinstance(entries, EntryTable) else entries).select("entry_id", "root_letters", "root_display", "body_text")
    body = _first(containing(bodies, "body_text", ["entry_id"], body_keys), body_limit, "entry_id")
    body_rows = body.join(axis_rows.select("request_id", "entry_id"), ["request_id", "entry_id"], "left_anti").select(
        "request_id", "entry_id", "root_letters", "root_display", F.lit(V.MATCH_BY_BODY).alias("match_type"),
        F.lit(None).cast("string").alias("matched_axis"))
    rows = held(axis_rows.unionByName(body_rows))
    shown = asked.select("request_id", "concept")
    met = dealt_join(rows, shown, "request_id", "entry_id")
    rest = shown.join(rows.select("request_id").distinct(), "request_id", "left_anti")
    status = (F.when(F.col("concept").isNull(), "MISSING_PARAM")
              .when(F.col("entry_id").isNull(), "NOT_FOUND").otherwise("OK"))
    return (met.unionByName(rest, allowMissingColumns=True)
            .withColumn("query_status", status).withColumn("found", F.col("query_status") == "OK"))


def semantic_reverse_search(requests: DataFrame, entries: DataFrame, profile: Profile, **limits) -> DataFrame:
    return concept_to_root_search(requests, entries, profile, **limits)


def find_roots_by_concept(requests, entries, profile, limit: int | None = None, axis_limit: int | None = AXIS_LIMIT,
                          body_limit: int | None = BODY_LIMIT) -> DataFrame:
    """All hits of the search, or the first ``limit`` of each request; None is no limit."""
    rows = concept_to_root_search(requests, entries, profile, axis_limit, body_limit).where("found")
    return _first(rows, limit, (F.col("match_type") == V.MATCH_BY_BODY).cast("int"), "entry_id").select(
        "request_id", "entry_id", "root_letters", "root_display", "match_type", "matched_axis")


CLAIM_COLUMNS = ["root_letters", "entry_type", "axes", "body_text", "ocr_confidence"]


def _evidence(rows: DataFrame, profile: Profile) -> DataFrame:
    """Evidence rows of entries met by a claim: supporting axes; a body hit counts for entries without any."""
    claim = F.coalesce("claim_text", F.lit(""))
    joined = rows.withColumn("claim", claim).withColumn("nc", normalize(claim, profile))

    def supports(axis: Column) -> Column:
        text = normalize(axis["axis_text"], profile)
        words = F.filter(F.split("nc", " "), lambda w: F.length(w) > 2)
        return (F.col("nc") != "") & (text != "") & (
            text.contains(F.col("nc")) | F.col("nc").contains(text) | F.exists(words, lambda w: text.contains(w)))
    joined = once(joined.withColumn("hits", F.filter("axes", supports)), "hits")
    item = "struct<source_type:string,text:string,attribution:string,claim_support:string>"
    by_axis = F.transform("hits", lambda a: F.struct(
        F.lit("SEMANTIC_AXIS").alias("source_type"), a["axis_text"].alias("text"),
        a["attribution"].alias("attribution"), F.lit("SUPPORTED").alias("claim_support")))
    in_body = (F.col("claim") != "") & F.col("body_text").contains(F.col("claim"))
    by_body = F.array(F.struct(
        F.lit("BODY_TEXT").alias("source_type"), excerpt(F.col("body_text"), F.col("claim")).alias("text"),
        F.lit(V.ATTRIBUTION_DIRECT).alias("attribution"), F.lit("PARTIALLY_SUPPORTED").alias("claim_support")))
    evidence = (F.when(F.size("hits") > 0, by_axis).when(in_body, by_body)
                .otherwise(F.array().cast(f"array<{item}>")))
    kept = F.filter(evidence, lambda e: author_position_kept(e["attribution"], F.col("author_position")))
    return once(joined.withColumn("evidence", kept), "evidence").drop("hits", "nc")


def claim_support(requests: DataFrame, entries: DataFrame, profile: Profile) -> DataFrame:
    """Every matched entry of each request with its evidence."""
    found = Matches(requests, entries, profile, CLAIM_COLUMNS)
    return _evidence(found.meet(found.asked), profile)


def _verdicts(found: Matches, answers: DataFrame, profile: Profile) -> DataFrame:
    """A row per answer: verdict, numbers checked and found."""
    rows = _evidence(found.meet(answers.where("found").select("request_id", "root_norm", "claim_text", "author_position")), profile)
    level = F.when(F.exists("evidence", lambda e: e["claim_support"] == "SUPPORTED"), 2).when(
        F.size("evidence") > 0, 1).otherwise(0)
    sums = rows.groupBy("request_id").agg(F.max(level).alias("verdict"), F.sum(F.size("evidence")).alias("evidence_count"))
    status = F.when(F.col("verdict") == 2, "SUPPORTED").when(F.col("verdict") == 1, "PARTIALLY_SUPPORTED").otherwise(
        "NOT_SUPPORTED")
    out = answers.join(sums, "request_id", "left").withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))
    return out.withColumns({"claim_status": status, "found": F.col("evidence_count") > 0,
                            "confidence": F.col("least_confidence"), "entries_checked": F.col("entry_count")})


def claim_evidence(requests: DataFrame, entries: DataFrame, profile: Profile) -> DataFrame:
    """One row per request: verdict, numbers checked and found, minimum confidence."""
    found = Matches(requests, entries, profile, CLAIM_COLUMNS)
    return _verdicts(found, found.answers, profile).select(
        "request_id", "entries_checked", "canonical_root", "evidence_count", "confidence", "found", "query_status", "claim_status")


def claim_evidence_rows(requests, entries, profile) -> DataFrame:
    return claim_support(requests, entries, profile).select(
        "request_id", "entry_id", "root_letters", F.posexplode("evidence").alias("pos", "e")).select(
        "request_id", "entry_id", "root_letters", "pos", "e.source_type", "e.text", "e.attribution", "e.claim_support")


def check_claim(requests, entries, profile) -> DataFrame:
    return claim_evidence(requests, entries, profile).select("request_id", "claim_status")


def root_meaning_evidence(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_MEANING_EVIDENCE_RETRIEVAL", requests, entries, profile)


def root_origin_relations(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_ORIGIN_RELATIONS", requests, entries, profile)


def root_internal_conflict(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_INTERNAL_CONFLICT_LOOKUP", requests, entries, profile)


LEMMA_COLUMNS = ["root_letters", "body_text"]


def _attested(found: Matches, answers: DataFrame) -> DataFrame:
    """Answers with the entries of the root whose body holds the lemma; one row with a null entry where none does."""
    needle = F.coalesce("lemma", F.lit(""))
    hit = (needle != "") & F.col("body_text").contains(needle)
    light = answers.where("found").select("request_id", "root_norm", "lemma")
    rows = held(found.meet(light).where(hit).select("request_id", "entry_id", "entry_num", "root_letters",
                                                     excerpt(F.col("body_text"), needle).alias("excerpt")))
    counts = rows.groupBy("request_id").agg(F.count("*").alias("attested"))
    status = F.when(F.col("root_norm") == "", "INVALID_ROOT_INPUT").when(F.col("attested") > 0, "OK").otherwise("NOT_FOUND")
    answers = answers.join(counts, "request_id", "left").withColumn("attested", F.coalesce("attested", F.lit(0)))
    answers = answers.withColumns({"query_status": status, "found": F.col("attested") > 0})
    met = dealt_join(rows, answers.where("found"), "request_id", "entry_id", counts.select("request_id", F.col("attested").alias("n")))
    return met.unionByName(answers.where(~F.col("found")), allowMissingColumns=True)


def derivative_attestation(requests, entries, profile) -> DataFrame:
    """Entries of the root whose body holds the lemma; OK only when one does."""
    found = Matches(requests, entries, profile, LEMMA_COLUMNS)
    return _attested(found, found.answers).select(*ANSWER, "attested", "entry_id", "entry_num", "root_letters", "excerpt")


def source_evidence_lookup(requests, entries, profile, passages: DataFrame | None = None) -> DataFrame:
    return _detail("SOURCE_EVIDENCE_LOOKUP", requests, entries, profile,
                   child_lists("passages", "footnote_lines", passages, "passage_num", "content"))


def claim_attribution(requests, entries, profile) -> DataFrame:
    return _detail("CLAIM_ATTRIBUTION_LOOKUP", requests, entries, profile)


def root_sense_candidates(requests, entries, profile) -> DataFrame:
    return _detail("ROOT_SENSE_CANDIDATES", requests, entries, profile)


def record_integrity(requests, entries, profile) -> DataFrame:
    return _detail("RECORD_INTEGRITY_LOOKUP", requests, entries, profile)


def _traced(found: Matches, answers: DataFrame, trace: DataFrame) -> DataFrame:
    """Answers with the trace events of their entries; entries without events and answers without entries keep a row."""
    mine = found.hits.select("entry_id").distinct()
    events = dealt_join(trace, mine, "entry_id", "event_id")
    roots = found.hits.select("root_norm", "entry_id")
    rows = dealt_join(events, roots, "entry_id", "event_id")
    quiet = roots.join(events.select("entry_id").distinct(), "entry_id", "left_anti")
    return with_rows(found, answers, rows.unionByName(quiet, allowMissingColumns=True))


def trace_lookup(requests, entries, profile, trace: DataFrame) -> DataFrame:
    """One row per (request, entry, trace event); order by ``event_id``."""
    found = Matches(requests, entries, profile, ["root_letters"])
    return _traced(found, found.answers.select(*ANSWER, "root_norm"), trace).drop("root_norm")


def assertion_provenance(requests, entries, profile) -> DataFrame:
    return _detail("ASSERTION_PROVENANCE_CHECK", requests, entries, profile)


def root_summary(requests, entries, profile) -> DataFrame:
    return root_semantic_origins(requests, entries, profile).select(
        "request_id", "found", "entry_id", "root_display", "entry_type", "axes_count",
        F.transform("axes", lambda a: a["axis_text"]).alias("axis_texts"),
        F.col("body_excerpt").alias("evidence_text"), "ocr_confidence")


def _claims_of(rows: DataFrame) -> DataFrame:
    """One row per axis of matched entries; an entry without axes gives one raw-text claim of rank 0."""
    shown = F.substring(body_excerpt(F.col("body_text")), 1, 300)
    out = rows.withColumn("shown", shown).withColumn("a", F.explode_outer("axes"))
    return out.where(F.col("a").isNotNull() | (F.col("shown") != "")).withColumns({
        "claim_text": F.col("a.axis_text"), "claim_rank": F.coalesce("a.axis_num", F.lit(0)),
        "claim_type": F.when(F.col("a").isNull(), "RAW_TEXT_ONLY").otherwise("SEMANTIC_AXIS")})


def root_claims(requests, entries, profile) -> DataFrame:
    """One row per axis; an entry without axes gives one raw-text claim of rank 0."""
    found = Matches(requests, entries, profile, ["root_display", "body_text", "axes"])
    return _claims_of(found.meet(found.asked.select("request_id", "root_norm"))).select(
        "request_id", "entry_id", "root_display", "claim_text", "claim_rank", "claim_type",
        F.lit(V.ATTRIBUTION_DIRECT).alias("source"), F.col("shown").alias("evidence"))


def evidence_ids_v2(requests, entries, profile, namespace: str = "lex") -> DataFrame:
    """Long form: one id per axis claim, plus the type of the first entry of roots with any claim.

    Ids are made once per distinct root and meet the requests last.
    """
    found = Matches(requests, entries, profile, ["root_letters", "root_display", "entry_type", "body_text", "axes"])
    claims = _claims_of(found.hits)
    axis = claims.where(F.coalesce("claim_text", F.lit("")) != "").select("root_norm", "entry_id", F.concat(
        F.lit("axis:"), "claim_rank", F.lit(":"), F.replace(F.substring("claim_text", 1, 40), F.lit(" "), F.lit("_"))).alias("part"))
    some = claims.select("root_norm").distinct()
    kind = found.facts.join(some, "root_norm", "left_semi").select(
        "root_norm", F.lit(None).cast("long").alias("entry_id"), F.concat(F.lit("type:"), first("entry_type")).alias("part"))
    met = found.meet(found.asked.select("request_id", "root", "root_norm"), axis.unionByName(kind))
    return met.select("request_id", F.concat(F.lit(f"{namespace}:v2:"), "root", F.lit(":"), "part").alias("evidence_id"))


HANDLERS = {
    "ROOT_LOOKUP": root_lookup, "ROOT_SEMANTIC_ORIGINS": root_semantic_origins, "ROOT_EXISTS": root_exists,
    "ROOT_CANONICAL_IDENTITY": root_canonical_identity, "ENTRY_QUALIFICATION": entry_qualification,
    "CONCEPT_TO_ROOT_SEARCH": concept_to_root_search, "CLAIM_EVIDENCE": claim_evidence,
    "ROOT_MEANING_EVIDENCE_RETRIEVAL": root_meaning_evidence, "ROOT_ORIGIN_RELATIONS": root_origin_relations,
    "ROOT_INTERNAL_CONFLICT_LOOKUP": root_internal_conflict,
    "DERIVATIVE_TO_ORIGIN_ATTESTATION": derivative_attestation, "SOURCE_EVIDENCE_LOOKUP": source_evidence_lookup,
    "CLAIM_ATTRIBUTION_LOOKUP": claim_attribution, "ROOT_SENSE_CANDIDATES": root_sense_candidates,
    "RECORD_INTEGRITY_LOOKUP": record_integrity, "TRACE_LOOKUP": trace_lookup,
    "ASSERTION_PROVENANCE_CHECK": assertion_provenance,
}
ALIASES = {"ROOT_EXISTENCE_AND_QUALIFICATION": "ROOT_EXISTS", "SEMANTIC_REVERSE_SEARCH": "CONCEPT_TO_ROOT_SEARCH"}


def canonical_type(col: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in ALIASES.items() for x in kv))
    evidence = col.rlike("^CLAIM_TO_[A-Z]+_EVIDENCE$")
    return F.when(evidence, "CLAIM_EVIDENCE").otherwise(F.coalesce(F.element_at(known, col), col))


def _envelope(rows: DataFrame, result: Column, **columns: Column) -> DataFrame:
    given = {"entry_id": "long", "confidence": "double"}
    parts = {n: columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in given.items()}
    return rows.select("request_id", "query_type", "found", "query_status", "canonical_root", *parts.values(), result.alias("result"))


def _payload(*columns: Column | str, names: list[str]) -> Column:
    by = dict(zip(names, columns))
    return F.to_json(F.struct(*(by[n] for n in sorted(by))))


def run_queries(requests: DataFrame, entries: DataFrame | EntryTable, profile: Profile, trace: DataFrame,
                passages: DataFrame | None = None) -> DataFrame:
    """Mixed requests: one row per request and result, the payload as JSON; an unknown type is an answer too.

    Roots are matched and entries read once for all types. Types that show entries are one join and one projection that
    picks each row's payload by its type; the other five each read the matched entries once more. The number of
    scans doesn't depend on the types asked for.
    """
    typed = requests.withColumn("handler", canonical_type(F.coalesce("query_type", F.lit(""))))
    by_root = typed.where(F.col("handler").isin(*HANDLERS) & (F.col("handler") != "CONCEPT_TO_ROOT_SEARCH"))

    def children(rows: DataFrame) -> DataFrame:
        rows = child_lists("poetry", "poetry_lines", None, "line_num", "line_text")(rows)
        return child_lists("passages", "footnote_lines", passages, "passage_num", "content")(rows)
    reads = [c for d in DETAILS.values() for c in d.reads.split()]
    found = Matches(by_root, entries, profile, [*reads, *CLAIM_COLUMNS, *LEMMA_COLUMNS], children)
    answers = held(found.answers)

    def of(*kinds: str) -> DataFrame:
        return answers.where(F.col("handler").isin(*kinds))
    rows = with_rows(found, of(*DETAILS))
    result = confidence = None
    for name, spec in DETAILS.items():
        facts = {n: c for n, c in spec.facts().items() if n != "confidence"}
        shown = [c if isinstance(c, str) else c[0] for c in spec.shows()]
        json = _payload(F.col("entry_count"), *(c.alias(n) for n, c in facts.items()), F.col("entry_num"), *spec.columns(),
                        names=["entry_count", *facts, "entry_num", *shown])
        mine = F.col("handler") == name
        result = F.when(mine, json) if result is None else result.when(mine, json)
        if "confidence" in (shown_facts := spec.facts()):
            value = shown_facts["confidence"]
            confidence = F.when(mine, value) if confidence is None else confidence.when(mine, value)
    parts = [_envelope(rows, result, entry_id=F.col("entry_id"), confidence=confidence)]

    exists = of("ROOT_EXISTS").join(entry_statuses(found.hits), "root_norm", "left")
    parts.append(_envelope(exists, _payload("entry_count", "entry_statuses", names=["entry_count", "entry_statuses"])))
    names = ["entries_checked", "evidence_count", "claim_status"]
    parts.append(_envelope(_verdicts(found, of("CLAIM_EVIDENCE"), profile), _payload(*names, names=names), confidence=F.col("confidence")))
    names = ["entry_count", "attested", "entry_num", "root_letters", "excerpt"]
    parts.append(_envelope(_attested(found, of("DERIVATIVE_TO_ORIGIN_ATTESTATION")), _payload(*names, names=names), entry_id=F.col("entry_id")))
    names = ["entry_count", *(c for c in trace.columns if c != "entry_id")]
    parts.append(_envelope(_traced(found, of("TRACE_LOOKUP").select(*ANSWER, "root_norm", "query_type"), trace), _payload(*names, names=names),
                           entry_id=F.col("entry_id")))
    search = typed.where(F.col("handler") == "CONCEPT_TO_ROOT_SEARCH")
    hits = concept_to_root_search(search.drop("handler"), entries, profile)
    hits = dealt_join(hits, search.select("request_id", "query_type"), "request_id", "entry_id")
    names = ["concept", "root_letters", "root_display", "match_type", "matched_axis"]
    parts.append(_envelope(hits.withColumn("canonical_root", F.lit(None).cast("string")), _payload(*names, names=names), entry_id=F.col("entry_id")))
    unknown_types = typed.where(~F.col("handler").isin(*HANDLERS)).withColumns({
        "found": F.lit(False), "query_status": F.lit("UNKNOWN_QUERY_TYPE"), "canonical_root": F.lit(None).cast("string")})
    parts.append(_envelope(unknown_types, F.lit(None).cast("string")))
    return reduce(DataFrame.unionByName, parts)
