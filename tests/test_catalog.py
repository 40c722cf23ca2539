"""Catalogued queries against their SQL twins on the smallest tables."""

import pytest

from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
CHECKED = ("A1_parse_json_lines", "A7_segment_entries", "A12_volume_content_hash", "B10_excerpt", "D7_enrich",
           "E1_correct_chapter", "F1_merge_roots", "G1_import_entries", "H3_ocr_gates", "I6_detect_conflicts",
           "J2_governed_lookup", "K8_audit_domains", "L6_extract_claims", "M11_entry_residuals", "N2_origins",
           "Q1_find_entries", "Q9_CLAIM_EVIDENCE", "A5_extract_pages", "A7_numbered_lines", "D4_enrich_v1", "J4_verified_evidence_ids",
           "N10_cycle_check", "Q20_answers")


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], SQL[name]) is None


def test_every_query_has_sql_or_a_reason():
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    assert set(QUERIES) == set(SQL)
