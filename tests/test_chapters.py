"""Stored chapters of entries without letters."""

import duckdb
import pytest

from rootloom.operators import chapters
from rootloom.rules import latin
from tests.compare import compare

TEXTS = ["4567 12.", "+1 (537) 555-8305", "", None, "Abc de.", "12 Éa. bc", "--- z"]


@pytest.mark.parametrize("name", ("E1_correct_chapter", "E3_remaining_mismatch"))
def test_entries_without_letters_against_sql(spark, tmp_path, name):
    """Their stored chapter ends in a blank or is null; it is shown as stored."""
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    docs = [(i, t, "en", "src1", len(t or "")) for i, t in enumerate(TEXTS * 4, 1)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(1, 15)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), name, QUERIES[name], SQL[name]) is None


def test_blanks_around_a_stored_chapter_are_no_change(spark):
    rows = [(1, "abc", " letter a "), (2, "abc", "letter b"), (3, "", "letter "), (4, "abc", None)]
    df = spark.createDataFrame(rows, "line_no long, root_letters string, bab_letter string")
    out = chapters.correct_chapter(df, latin.CHAPTER_NAMES)
    assert [r.original_bab_letter for r in out.orderBy("line_no").collect()] == [" letter a ", "letter b", "letter ", None]
    report = chapters.correction_report(out).first()
    assert (report.bab_changed, report.bab_already_correct, report.no_root_letters) == (2, 1, 1)


def test_no_text_is_joined(spark):
    """What is read from a text is read before labels are joined, so a shuffle moves no texts."""
    from rootloom.plans.catalog import QUERIES
    node = QUERIES["E1_correct_chapter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    assert "text" not in node.children().head().output().mkString(" ")
