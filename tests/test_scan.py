"""Needles found by one scan of each text."""

from pyspark.sql import functions as F

from rootloom.plans import matching


def test_one_scan_finds_what_contains_finds(spark):
    needles = ["a", "ab", "abab", "b.c", "é", "x" * 16, "x" * 17, "x" * 16 + "y", "\U0001F600z", "a\nb", " ", "zz", "ab" * 20, "Ab"]
    texts = ["", None, "a", "abab", "cab.c", "bac", "été", "x" * 16, "x" * 40, "x" * 20 + "y", "\U0001F600z", "a\nb", "AB Ab", "ab" * 19 + "a", "ab" * 20, "zzz"]
    find = matching.finder(tuple(sorted(needles)))
    for t in texts:
        assert [sorted(needles)[i] for i in find(t or "")] == [n for n in sorted(needles) if n in (t or "")]
    rows = spark.createDataFrame(list(enumerate(texts)), "entry_id long, text string")
    wanted = spark.createDataFrame([(i, n) for i, n in enumerate([*needles, "", None, "a"])], "request_id long, needle string")
    got = sorted((r.request_id, r.entry_id) for r in matching.containing(rows, "text", ["entry_id"], wanted).collect())
    want = rows.join(wanted.where("needle <> ''"), F.col("text").contains(F.col("needle")))
    assert got == sorted((r.request_id, r.entry_id) for r in want.collect())
    assert matching.containing(rows, "text", ["entry_id"], wanted.where("needle = ''")).count() == 0


def test_texts_are_read_once_and_no_grams_are_made(spark, monkeypatch):
    """Few needles take one scan of the texts; windows of every text are neither counted nor offered."""
    monkeypatch.setattr(matching, "grams_of", lambda col: 1 / 0)
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "entry_id long, text string")
    wanted = spark.createDataFrame([(1, "xt 4"), (2, "49")], "request_id long, needle string")
    hits = matching.containing(rows, "text", ["entry_id"], wanted)
    assert hits.where("request_id = 1").count() == 11 and hits.where("request_id = 2").count() == 1
