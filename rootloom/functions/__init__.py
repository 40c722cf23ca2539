"""Column expressions: normalisation, ids, excerpts, rule cascades."""

from rootloom.functions.cascade import first_label, first_text, label_map
from rootloom.functions.normalize import normalize, normalize_root, strip_ws
from rootloom.functions.once import once
from rootloom.functions.text import (
    best_text, body_excerpt, checksum, classify_evidence_id, cut, entity_id, exact_avg, excerpt, fix_ocr,
    none_if_blank, root_profile, source_id, text_confidence, volume_number,
)

__all__ = [
    "first_label", "first_text", "label_map", "normalize", "normalize_root", "strip_ws", "once",
    "best_text", "body_excerpt", "checksum", "classify_evidence_id", "cut", "entity_id", "exact_avg", "excerpt",
    "fix_ocr", "none_if_blank", "root_profile", "source_id", "text_confidence", "volume_number",
]
