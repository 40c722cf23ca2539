"""Explicit schemas of the known inputs."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

S, L, I, D, B = StringType(), LongType(), IntegerType(), DoubleType(), BooleanType()
IDS = ArrayType(S)


def _struct(**fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


RAW_PAGE = _struct(page_num=L, url=S, vol=S, page_label=S, text=S, footnotes=IDS)
PARSED_ENTRY = _struct(
    entry_num=L, source=S, root_letters=S, root_display=S, chapter_header=S, is_lexical_entry=B,
    body_text=S, poetry_lines=IDS, footnote_lines=IDS, page_refs=IDS, raw_page_nums=ArrayType(L))
AXES = ArrayType(_struct(text=S, attribution=S))
ENRICHED_ENTRY = StructType(PARSED_ENTRY.fields + _struct(
    semantic_axes=AXES, axes_count=I, entry_type=S, quoted_authorities=IDS, ocr_confidence=D,
    review_state=S, claim_status=S).fields)
LINE = _struct(
    line_id=S, raw_ocr=S, corrected_ocr=S, human_text=S, review_status=S,
    raw_candidates=ArrayType(_struct(confidence=D)), bounding_box=_struct(x=D, y=D, w=D, h=D))
ROOT_ENTRY = _struct(
    entry_id=S, source_pdf=S, pdf_page=I, root_heading_text=S, root_letters=S, bab_letter=S,
    corrected_bab_letter=S, original_bab_letter=S, correction_reason=S, correction_version=S,
    semantic_origin_type=S, semantic_origin_text=S, origin_count=I, review_status=S,
    human_verified=B, line_ids=IDS, body_line_ids=IDS, poetry_line_ids=IDS, footnote_line_ids=IDS)
REQUEST = _struct(
    request_id=L, query_type=S, root=S, concept=S, concept_id=S, claim_text=S, lemma=S,
    author_position=S, directive=S, limit=L)
