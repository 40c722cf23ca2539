"""The whole concept search, beside the one whose answers are limited."""

import duckdb

from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAME = "Q7_CONCEPT_TO_ROOT_SEARCH"


def test_every_hit_is_returned(spark, tmp_path):
    """120 entries hold the concept in an axis, 70 others in the body: the limits return 50 and 30 less those known by axis."""
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    texts = [f"Word of key things {i}. Rest." for i in range(120)] + [f"Zzz qqq {i}. Then some key." for i in range(70)] + ["Other."]
    docs = [(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "Root key aa bb cc"), (2, "Root nowhere aa bb cc"), (3, "Root")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")

    def hits(name):
        rows = QUERIES[name](spark, str(tmp_path)).collect()
        assert {r.request_id: r.query_status for r in rows} == {1: "OK", 2: "NOT_FOUND", 3: "MISSING_PARAM"}
        mine = [r for r in rows if r.found]
        return sum(r.matched_axis is not None for r in mine), sum(r.matched_axis is None for r in mine)
    assert hits(NAME) == (50, 0) and hits(f"{NAME}_all") == (120, 70)
    for name in (NAME, f"{NAME}_all"):
        assert compare(spark, con, str(tmp_path), name, QUERIES[name], SQL[name]) is None


def test_whole_search_against_sql(spark):
    from oracle_queries import SQL
    from rootloom.plans.catalog import QUERIES
    assert compare(spark, connect(FOLDER), FOLDER, f"{NAME}_all", QUERIES[f"{NAME}_all"], SQL[f"{NAME}_all"]) is None
