"""Closed vocabularies of the governance tables.

Fixed values: labels, orders, maps and the OCR gate table are part of the results.
"""

from __future__ import annotations

REVIEW_STATES = (
    "UNREVIEWED", "MACHINE_CANDIDATE", "UNVERIFIED_REVIEW_REQUIRED", "SOURCE_LOCATED",
    "IDENTITY_CANDIDATE", "IDENTITY_CONFLICT", "IDENTITY_VERIFIED", "TEXT_CANDIDATE",
    "TEXT_CONFLICT", "TEXT_VERIFIED", "ORIGIN_CANDIDATE", "ORIGIN_CONFLICT",
    "ORIGIN_SEGMENTED", "LEXICAL_REVIEW_IN_PROGRESS", "LEXICALLY_REVIEWED", "AUDIT_PASSED",
)
HUMAN_STATES = ("IDENTITY_VERIFIED", "TEXT_VERIFIED", "LEXICAL_REVIEW_IN_PROGRESS",
                "LEXICALLY_REVIEWED", "AUDIT_PASSED")
EVIDENCE_STATUSES = (
    "MACHINE_SOURCE_CLAIM_CANDIDATE", "SOURCE_LOCATED_EVIDENCE", "IDENTITY_VERIFIED_EVIDENCE",
    "TEXT_VERIFIED_EVIDENCE", "ORIGIN_SEGMENTED_EVIDENCE", "LEXICALLY_REVIEWED_EVIDENCE",
)
MACHINE_CEILING = "ORIGIN_SEGMENTED_EVIDENCE"
CARRIER_FLOOR = "IDENTITY_VERIFIED_EVIDENCE"
REVIEWERS = ("MACHINE_ONLY", "HUMAN_REVIEWER", "HUMAN_AUDITOR", "SENIOR_LEXICOGRAPHER")
ORIGIN_TYPES = ("SINGULAR", "DUAL", "TRIPLE", "MULTIPLE", "SOUND_ROOTS", "NONE", "UNKNOWN",
                "NOT_EXTRACTED")
CLAIM_KINDS = ("POSITIVE_ORIGIN", "NEGATIVE_CLAIM", "DERIVATION_CLAIM", "LOAN_WORD_CLAIM",
               "DISPUTED_CLAIM", "INCOMPLETE_CLAIM", "CHAPTER_HEADER", "CROSS_REFERENCE",
               "NOT_ROOT_ENTRY")
RESIDUAL_TYPES = (
    "OCR_AMBIGUITY", "ROOT_IDENTITY_CONFLICT", "ORIGIN_CLAIM_CONFLICT", "MISSING_SOURCE_PASSAGE",
    "SEGMENTATION_REQUIRED", "BAB_DERIVATION_UNKNOWN", "REVIEW_REQUIRED_UNRESOLVED",
    "VOLUME_COVERAGE_GAP", "TEXT_VERIFICATION_FAILED", "AUDIT_DISCREPANCY",
    "ORIGIN_NOT_EXTRACTED", "PIPELINE_EXCEPTION",
)
TRACE_KINDS = (
    "IMPORT", "PARSE", "BAB_CORRECTION", "IDENTITY_EXTRACTED", "IDENTITY_CONFLICT",
    "IDENTITY_VERIFIED", "TEXT_EXTRACTED", "TEXT_CONFLICT", "TEXT_VERIFIED", "ORIGIN_EXTRACTED",
    "ORIGIN_SEGMENTED", "ORIGIN_EXTRACTION_DEFERRED", "ORIGIN_CONFLICT", "REVIEW_STARTED",
    "REVIEW_COMPLETED", "AUDIT_PASSED", "SUPERSEDED", "RESIDUAL_CREATED", "RESIDUAL_RESOLVED",
)
NOISE_TYPES = ("NOT_ROOT", "CHAPTER_HEADER", "CROSS_REFERENCE")
MULTI_TYPES = ("DUAL", "TRIPLE", "MULTIPLE")
POSITIVE_TYPES = ("SINGULAR", "DUAL", "TRIPLE", "MULTIPLE", "SOUND_ROOTS")
NO_ORIGIN_TYPES = ("NONE", "NOT_EXTRACTED", "UNKNOWN")
LEGACY_ORIGIN_TYPE = {
    "SINGULAR": "SINGULAR", "DUAL": "DUAL", "TRIPLE": "TRIPLE", "MULTIPLE": "MULTIPLE",
    "SOUND_ROOTS": "SOUND_ROOTS", "NONE": "NONE", "NOT_ROOT": "NOT_EXTRACTED",
    "CHAPTER_HEADER": "NOT_EXTRACTED", "CROSS_REFERENCE": "NOT_EXTRACTED", "UNKNOWN": "UNKNOWN",
}
LEGACY_CLAIM_KIND = {
    "NOT_ROOT": "NOT_ROOT_ENTRY", "CHAPTER_HEADER": "CHAPTER_HEADER",
    "CROSS_REFERENCE": "CROSS_REFERENCE", "NONE": "INCOMPLETE_CLAIM",
    **{t: "POSITIVE_ORIGIN" for t in POSITIVE_TYPES},
}
ORIGIN_DESCRIPTIONS = {
    "SINGULAR": "أصل واحد", "SOUND_ROOTS": "أصول صحيحة",
    "NONE": "غير مستخرج (لم تُحدَّد طبيعة الأصل من النص)",
    "UNKNOWN": "غير معروف", "NOT_EXTRACTED": "لم يُستخرج",
}
CORRECTION_REASON, CORRECTION_VERSION = "first_radical_derivation", "v1"
IMPORT_SCHEMA_VERSION = "constitutional-v1"

# gate id, kind of test, letters or length, text
OCR_GATES = (
    ("G01", "all", "حخ", "ح/خ confusion"),
    ("G02", "at_least_2", "بتثني", "ب/ت/ث/ن/ي multi-dot baseline confusion"),
    ("G03", "all", "دذ", "د/ذ confusion"),
    ("G04", "all", "رز", "ر/ز confusion"),
    ("G05", "all", "صض", "ص/ض confusion"),
    ("G06", "all", "طظ", "ط/ظ confusion"),
    ("G07", "all", "عغ", "ع/غ confusion"),
    ("G08", "all", "فق", "ف/ق confusion"),
    ("G09", "at_least_1", "أإآء", "Hamza form confusion (أ/إ/آ/ء)"),
    ("G10", "at_least_2", "وي", "و/ي multiple weak letters"),
    ("G11", "never", "", "Reversed radicals"),
    ("G12", "longer", "4", "4+ character root (extra radical?)"),
    ("G13", "shorter", "2", "≤2 character root (missing radical?)"),
    ("G14", "all", "من", "م/ن confusion"),
    ("G15", "all", "هة", "ه/ة confusion"),
    ("G16", "all", "كل", "ك/ل confusion"),
    ("G17", "all", "سش", "س/ش confusion"),
    ("G18", "distinct_2", "جحخ", "ج/ح/خ triconfusion"),
    ("G19", "all", "قغ", "ق/غ confusion"),
    ("G20", "at_least_1", "ًٌٍَُِّْٕٓٔ", "Diacritic bleed into letter shape"),
)

UPPER_KINDS = {
    "ENTITY_KIND": "ENTITY", "EVENT_KIND": "EVENT", "STATE_KIND": "STATE",
    "PROPERTY_KIND": "PROPERTY", "RELATION_KIND": "RELATION", "SPATIAL_KIND": "PLACE",
    "TEMPORAL_KIND": "TIME", "QUANTITY_KIND": "QUANTITY", "FUNCTION_KIND": "FUNCTION",
    "MOTION_KIND": "EVENT", "EVALUATIVE_KIND": "PROPERTY", "UNKNOWN": "UNKNOWN",
}
RELATION_ROLES = {"AGENT_OF": "AGENT", "PATIENT_OF": "PATIENT", "INSTRUMENT_OF": "INSTRUMENT",
                  "RESULT_OF": "RESULT", "LOCATION_OF": "LOCATION"}
RELATION_KINDS = {"RESULT_OF": "RESULTS_IN", "CAUSE_OF": "CAUSES", "INSTRUMENT_OF": "INSTRUMENT_OF",
                  "LOCATION_OF": "LOCATED_IN", "PART_OF": "PART_OF"}
CAUSAL_MODES = {"CAUSE": "DIRECT", "ENABLEMENT": "ENABLEMENT", "PREVENTION": "PREVENTION",
                "MOTIVATION": "MOTIVATIONAL", "NAMING_CAUSE": "NAMING_MOTIVATION",
                "NONE_STATED": "UNKNOWN"}
NAMING_RELATIONS = ("NAMING_BY_PROPERTY", "NAMING_BY_EFFECT", "NAMING_BY_CAUSE")
BLOCKING_RESIDUALS = ("ROOT_IDENTITY_CONFLICT", "ROOT_IDENTITY_UNRESOLVED",
                      "MISSING_SOURCE_PASSAGE", "TEXT_VERIFICATION_FAILED", "INTER_ENTRY_CONFLICT")
OCR_CONFIDENCE_FLOOR = 0.60
CANDIDATE_NOTICE, ENTITY_NOTICE = "ONTOLOGY_CANDIDATE_ONLY", "ENTITY_CANDIDATE_ONLY"

ATTRIBUTION_DIRECT, ATTRIBUTION_QUOTED = "IBN_FARIS_DIRECT", "QUOTED_AUTHORITY"
MATCH_BY_AXIS = "ROOT_EXPLICITLY_LINKED_BY_IBN_FARIS"
MATCH_BY_QUOTED = "ROOT_LINKED_BY_QUOTED_AUTHORITY"
MATCH_BY_BODY = "ROOT_SEMANTICALLY_SIMILAR"
POSITION_ADOPTED = "ADOPTED_BY_IBN_FARIS"
PROVENANCE_EXPLICIT, PROVENANCE_OTHER = "EXPLICIT_IBN_FARIS", "PROJECT_NORMALIZATION"
UNATTRIBUTED_NOTE = "المداخل التي لا يُصرَّح فيها بنسب هي من كلام ابن فارس مباشرةً"
