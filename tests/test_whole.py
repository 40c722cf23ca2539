"""Whole results where sizes or limits used to cut them."""

import hashlib

import pytest

from rootloom.operators import segment, volumes
from rootloom.plans import requests as rq
from rootloom.plans.bindings import Tables
from rootloom.rules import arabic, latin
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
LOOKUP = latin.PROFILES["lookup"]


def test_entries_of_any_size(spark):
    """Heads and numbered lines say what the entry in one row says, whatever the blocks; entries of footnotes only are left out."""
    pages = [(1, 1, "[خبز]\nالخاء والباء والزاء أصل واحد"), (1, 2, "(١) حاشية أولى"), (1, 3, "سطر آخر (ص٤٥)"), (1, 4, "(٢) حاشية ثانية"),
             (1, 5, "[حبر]\nالحاء والباء والراء أصل واحد\nسطر"), (2, 1, "(١) حاشية بلا مادة")]
    df = spark.createDataFrame(pages, "book long, page_num long, text string")
    seen = []
    for block in (1, 2, 1000):
        lines = segment.entry_lines(df, arabic.LINES, pages_per_block=block)
        whole = {(r.book, r.entry_num): r for r in segment.segment_entries(df, arabic.LINES, pages_per_block=block).collect()}
        heads = {(r.book, r.entry_num): r for r in segment.entry_heads(lines).collect()}
        rows = sorted(segment.numbered_entry_lines(lines).collect(), key=lambda r: (r.book, r.entry_num, r.line_num))
        assert whole.keys() == heads.keys() and len(whole) == 2
        for key, e in whole.items():
            mine = [r for r in rows if (r.book, r.entry_num) == key]
            assert [r.line_num for r in mine] == list(range(len(mine))) and all(r.filled for r in mine)
            assert "".join(r.line + "\n" for r in mine if r.role != "footnote") == e.body_text
            assert [r.line for r in mine if r.role == "footnote"] == e.footnote_lines and heads[key].footnote_lines == len(e.footnote_lines)
            assert (heads[key].root_letters, heads[key].root_display) == (e.root_letters, e.root_display)
        seen.append([(r.entry_num, r.line_num, r.line) for r in rows])
    assert seen[0] == seen[1] == seen[2] and len(whole[(1, 1)].footnote_lines) == 2


@pytest.mark.parametrize("fanout", (2, 3, 1024))
def test_volume_tree_hash_by_rank(spark, fanout):
    """The tree depends on the order of the lines alone, not on their numbers."""
    def tree(texts):
        nodes = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        while len(nodes) > 1:
            runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
            nodes = [r[0] if len(r) == 1 else hashlib.sha256("".join(r).encode()).hexdigest() for r in runs]
        return nodes[0]
    texts = {"v": [f"line {i}" for i in range(23)], "w": ["one"], None: ["", "x", "y"]}
    for step in (1, 70_000):
        lines = [(s, 5 + i * step, t or None) for s, ts in texts.items() for i, t in enumerate(ts)]
        df = spark.createDataFrame(lines, "source_pdf string, line_no long, raw string").repartition(5)
        got = {r.source_pdf: (r.sha256, r.lines) for r in volumes.volume_tree_hash(df, fanout=fanout).collect()}
        assert got == {s: (tree(ts), len(ts)) for s, ts in texts.items()}
    assert volumes.volume_tree_hash(df.limit(0)).collect() == []


@pytest.mark.parametrize("first", (0, 65_530, 1_000_000))
def test_volume_hash_has_one_form(spark, first):
    lines = [("v", first + i, f"line {i}\n" if i != 7 else None) for i in range(15)] + [("w", 5, "one\n"), (None, 1, "x")]
    lines += [("far", i * 70_000, f"é{i}") for i in range(9)]
    df = spark.createDataFrame(lines, "source_pdf string, line_no long, raw string").repartition(4)
    want = {s: hashlib.sha256("".join(x[2] or "" for x in lines if x[0] == s).encode()).hexdigest() for s in ("v", "w", "far", None)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = volumes.volume_content_hash(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 4 and {r.source_pdf: r.sha256 for r in got} == want
    assert volumes.volume_content_hash(df.limit(0)).collect() == []


def test_concept_search_limits(spark):
    rows = [(i, i, f"r{i}", f"R{i}", f"key body {i}", [(1, "key axis" if i < 120 else "none", "IBN_FARIS_DIRECT")]) for i in range(200)]
    entries = spark.createDataFrame(rows, "entry_id long, entry_num long, root_letters string, root_display string, "
                                          "body_text string, axes array<struct<axis_num:int,axis_text:string,attribution:string>>")
    asks = spark.createDataFrame([(0, "key")], "request_id long, concept string")

    def found(**limits):
        return sorted(r.entry_id for r in rq.find_roots_by_concept(asks, entries, LOOKUP, **limits).collect())
    free = {"axis_limit": None, "body_limit": None}
    assert found(**free) == list(range(200)) and found(limit=150, **free) == list(range(150))
    assert found() == list(range(50)) and found(limit=20) == list(range(20))
    assert found(axis_limit=10, body_limit=30) == list(range(30)) and found(axis_limit=None) == list(range(120))


def test_unlimited_concept_search_against_sql(spark):
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    name = "Q26_find_roots_by_concept_all"
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], SQL[name]) is None


def test_long_sentence_is_read_whole(spark, tmp_path):
    words = "word " * 60
    spark.createDataFrame([(1, f"head. {words}end\nnext", "src1", "en", 22), (2, "head. short. x", "src1", "en", 22)],
                          "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.line_no: r.semantic_origin_text for r in Tables(spark, str(tmp_path)).root_entries().collect()}
    assert rows == {1: f"{words}end", 2: "short"}


@pytest.mark.parametrize("name", ("I6_detect_conflicts", "M11_entry_residuals", "N2_origins", "O2_concepts"))
def test_whole_sentences_against_sql(spark, name):
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    assert compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], SQL[name]) is None
