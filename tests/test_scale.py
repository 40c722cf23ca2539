"""Sources, hashes, graphs and request plans against brute force on small data."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rootloom import session
from rootloom.operators import evidence, governed, origins, star
from rootloom.plans import matching, requests as rq
from rootloom.plans.bindings import Tables
from rootloom.rules import latin
from rootloom.sources import jsonl, pages
from rootloom.sources.schemas import ROOT_ENTRY

FOLDER = "/root/testdata/sf0.001"
LOOKUP = latin.PROFILES["lookup"]


def test_line_numbers_over_many_splits(spark, tmp_path):
    text = [json.dumps({"entry_id": str(i), "root_letters": "r" * (i % 7)}) if i % 5 else "" for i in range(4000)]
    (tmp_path / "a.jsonl").write_text("\n".join(text) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text('{"entry_id": "x"}\n{NOT VALID JSON\n\n{"entry_id": "y"}\n', encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = jsonl.read_jsonl(spark, str(tmp_path), ROOT_ENTRY).select(
            F.regexp_extract("file", r"(\w)\.jsonl", 1).alias("f"), "line_no", "entry_id", "is_malformed").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = {r.entry_id: r.line_no for r in rows if r.f == "a"}
    assert a == {str(i): i for i in range(4000) if i % 5}
    b = sorted((r.line_no, r.is_malformed) for r in rows if r.f == "b")
    assert b == [(0, False), (1, True), (3, False)]
    assert jsonl.read_jsonl(spark, str(tmp_path / "b.jsonl"), ROOT_ENTRY, "drop").count() == 2
    with pytest.raises(Exception, match="malformed line"):
        jsonl.read_jsonl(spark, str(tmp_path / "b.jsonl"), ROOT_ENTRY, "fail").collect()


def test_resolve_corpus_and_writers(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text('{"entry_id": "x", "root_letters": "ab"}\n', encoding="utf-8")
    df, status = jsonl.resolve_corpus(spark, str(tmp_path / "none"), str(tmp_path / "o.jsonl"), ROOT_ENTRY)
    assert status == "ORIGINAL" and df.count() == 1
    assert jsonl.resolve_corpus(spark, str(tmp_path / "n"), str(tmp_path / "m"), ROOT_ENTRY)[1] == "LOAD_ERROR"
    jsonl.write_jsonl(df.select("entry_id", "root_letters"), str(tmp_path / "out"), "root_letters")
    assert spark.read.json(str(tmp_path / "out")).first().root_letters == "ab"
    jsonl.write_tables({"t": df.select("entry_id")}, str(tmp_path / "tables"), "entry_id")
    assert spark.read.parquet(str(tmp_path / "tables" / "t")).count() == 1


def test_implied_end_tags_and_silent_elements():
    import re
    letters = re.compile("[^\\W\\d_]")
    def text(html):
        return pages.page_content(html, letters, False)
    assert text('<article><p class="btn">gone<p>kept</article>') == ("kept", [])
    assert text('<article><ul><li class="nav">gone<li>kept</ul>tail</article>') == ("kept\ntail", [])
    assert text('<article><table><tr><td class="toc">gone<td>kept<tr><td>more</table></article>') == ("kept\nmore", [])
    assert text('<article><ul><li>a<ul><li class="pager">gone</ul>b<li>c</ul></article>') == ("a\nb\nc", [])
    assert text('<article>a<div class="foot"><script>x</script>note <b>one</b></div><p>b<div>c</div></article>') == ("a\nb\nc", ["note  one"])
    # a long script doesn't make a block the main one
    assert text("<div><script>" + "abc " * 50 + "</script>ab</div><section>four letters</section>") == ("four letters", [])


def test_page_container_rules(spark):
    html = [
        (1, '<div id="nass">x <script>y</script><div class="hawashi">note</div> ع  ب<br>line</div><article>z</article>'),
        (2, "<section>abc</section><div>ا ب ت</div>"), (3, '<article>a<nav>menu</nav><p class="btn x">b</p>c</article>'), (4, "")]
    df = spark.createDataFrame(html, "page_id long, html string")
    out = {r.page_id: r for r in pages.extract_pages(df).collect()}
    assert out[1].text == "x\nع ب\nline" and out[1].footnotes == ["note"]
    assert out[2].text == "ا ب ت" and out[3].text == "a\nc" and out[4].text == ""
    vol, label = pages.volume_page(F.lit("عنوان ج 2 - ص 15 نص"))
    assert tuple(df.select(vol.alias("v"), label.alias("l")).first()) == ("ج2", "ص15")


@pytest.mark.parametrize("seed", range(4))
def test_cycle_check_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = {(rnd.randrange(12), rnd.randrange(12)) for _ in range(8 + 3 * seed)}
    edges |= {(20, 20), (20, 21), (21, 22), (22, 22)}  # 21 lies between two cycles, on none
    reach = set(edges)
    for k in {x for e in edges for x in e}:
        reach |= {(a, d) for a, b in reach if b == k for c, d in reach if c == k}
    left = {(a, b) for a, b in edges if (b, a) in reach}
    df = spark.createDataFrame(sorted(edges), "src int, dst int")
    assert {tuple(r) for r in origins.cycle_check(df).collect()} == left


@pytest.mark.parametrize("closed", (False, True))
def test_cycle_check_takes_few_rounds_for_long_chains(spark, monkeypatch, closed):
    """A chain of 1500 edges with a tree hanging on it: rounds follow its logarithm."""
    rounds, held = [], origins.held
    monkeypatch.setattr(origins, "held", lambda df: rounds.append(1) or held(df))
    chain = [(i, i + 1) for i in range(1500)] + ([(1500, 0)] if closed else [])
    tree = [(i // 2 + 10_000, i + 10_000) for i in range(1, 200)] + [(700, 10_000), (20_000, 3)]
    df = spark.createDataFrame(chain + tree, "src int, dst int")
    assert {tuple(r) for r in origins.cycle_check(df).collect()} == (set(chain) if closed else set())
    assert len(rounds) < 150


def test_reference_cycles_block_entries(spark):
    edges = spark.createDataFrame([("e1", "a", "b"), ("e2", "b", "a"), ("e3", "b", "c"), ("e4", "d", "d"), ("e5", "a", "b")],
                                  "entry_id string, src string, dst string")
    conflicts = origins.entry_conflicts(edges)
    assert {(r.entry_id, r.residual) for r in conflicts.collect()} == {(e, "INTER_ENTRY_CONFLICT") for e in ("e1", "e2", "e4", "e5")}
    bundles = spark.createDataFrame([("e1", ["X"], True), ("e3", ["X"], True), ("e9", [], False)],
                                    "entry_id string, residuals array<string>, ontology_buildable boolean")
    got = {r.entry_id: (r.residuals, r.ontology_buildable) for r in evidence.with_conflicts(bundles, conflicts).collect()}
    assert got == {"e1": (["X", "INTER_ENTRY_CONFLICT"], False), "e3": (["X"], True), "e9": ([], False)}


def test_latest_counting_certificate_decides(spark):
    """Certificates fold in order of time; a machine can't grant what takes a human."""
    rows = [("c1", 1, "k1", "IDENTITY_VERIFIED", "HUMAN_REVIEWER"), ("c1", 5, "k2", "TEXT_VERIFIED", "HUMAN_REVIEWER"), ("c1", 9, "k3", "LEXICALLY_REVIEWED", "MACHINE_ONLY"),
            ("c2", 2, "k4", "LEXICALLY_REVIEWED", "HUMAN_REVIEWER"), ("c2", 2, "k5", "IDENTITY_CANDIDATE", "MACHINE_ONLY"), ("c3", 1, "k6", "TEXT_VERIFIED", "MACHINE_ONLY")]
    df = spark.createDataFrame(rows, "target_id string, at int, certificate_id string, granted_state string, reviewer_type string")
    df = df.withColumn("reviewed_at", F.timestamp_seconds("at"))
    got = {r.target_id: (r.reviewed_state, r.certificate_id, r.by_human) for r in governed.review_outcomes(df).collect()}
    assert got == {"c1": ("TEXT_VERIFIED", "k2", True), "c2": ("IDENTITY_CANDIDATE", "k5", False)}


def test_concept_search_equals_brute_force(spark):
    texts = ["abcd ef", "xabc", "ab", "zzz", "cd", "a.c d", "éab"]
    rows = [(i, i, f"r{i}", f"R{i}", t, [(1, t[:3], "IBN_FARIS_DIRECT")]) for i, t in enumerate(texts)]
    entries = spark.createDataFrame(rows, "entry_id long, entry_num long, root_letters string, root_display string, "
                                          "body_text string, axes array<struct<axis_num:int,axis_text:string,attribution:string>>")
    asks = spark.createDataFrame([(0, "ab"), (1, "b"), (2, "bcd"), (3, "zz"), (4, "d"), (5, "q"), (6, None), (7, "c d")],
                                 "request_id long, concept string")
    got = rq.concept_to_root_search(asks, entries, LOOKUP).collect()
    want = {(i, j) for i, c in [(0, "ab"), (1, "b"), (2, "bcd"), (3, "zz"), (4, "d"), (7, "c d")]
            for j, t in enumerate(texts) if c in t}
    assert {(r.request_id, r.entry_id) for r in got if r.found} == want
    assert {r.request_id: r.query_status for r in got if not r.found} == {5: "NOT_FOUND", 6: "MISSING_PARAM"}


def test_large_request_path_equals_small(spark, monkeypatch):
    t = Tables(spark, FOLDER)
    cols = ("request_id", "entry_id", "root_letters")
    small = {tuple(r) for r in rq.find_entries(t.requests(), t.entries().rows, LOOKUP).select(*cols).collect()}
    concept = {tuple(r) for r in rq.concept_to_root_search(t.requests(), t.entries(), LOOKUP).select("request_id", "entry_id").collect()}
    for module in (matching, session):
        monkeypatch.setattr(module, "is_small", lambda df, *limits: False)
    assert {tuple(r) for r in rq.find_entries(t.requests(), t.entries().rows, LOOKUP).select(*cols).collect()} == small
    assert {tuple(r) for r in rq.concept_to_root_search(t.requests(), t.entries(), LOOKUP).select(
        "request_id", "entry_id").collect()} == concept


def test_star_tables_equal_row_arrays(spark):
    t = Tables(spark, FOLDER)
    e = t.enriched()
    a = rq.root_lookup(t.requests(), t.entries(), LOOKUP).select("request_id", "entry_id", "poetry")
    b = rq.root_lookup(t.requests(), t.entries(), LOOKUP, star.star_poetry(e)).select("request_id", "entry_id", "poetry")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_run_queries_covers_every_type(spark):
    t = Tables(spark, FOLDER)
    kinds = [*rq.HANDLERS, *rq.ALIASES, "CLAIM_TO_ANY_EVIDENCE", "NOPE"]
    first = t.requests().limit(1)
    asks = first.drop("request_id")
    asks = asks.select("*", F.posexplode(F.array(*map(F.lit, kinds))).alias("request_id", "query_type"))
    out = rq.run_queries(asks, t.entries(), LOOKUP, t.trace()).collect()
    assert {r.query_type for r in out} == set(kinds)
    assert [r.query_status for r in out if r.query_type == "NOPE"] == ["UNKNOWN_QUERY_TYPE"]
