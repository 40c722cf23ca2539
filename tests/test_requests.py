"""The request layer: hot roots, rarest grams, one pass for mixed requests."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rootloom import session
from rootloom.plans import matching, requests as rq
from rootloom.plans.bindings import Tables
from rootloom.rules import latin

FOLDER = "/root/testdata/sf0.001"
LOOKUP = latin.PROFILES["lookup"]
ENTRY = ("entry_id long, entry_num long, root_letters string, root_display string, body_text string, entry_type string, axes_count int, "
         "axes array<struct<axis_num:int,axis_text:string,attribution:string>>, page_refs array<string>, ocr_confidence double, review_state string")


def entries(spark, n):
    """A third of the entries belong to one root."""
    rows = [(i, i, "hot" if i % 3 == 0 else f"r{i % 50}x{i % 7}", "Hot" if i % 3 == 0 else "Other", f"body {i}", "SINGLE_ORIGIN", 1,
             [(1, f"axis {i}", "IBN_FARIS_DIRECT")], [], 0.5, "PENDING") for i in range(n)]
    return spark.createDataFrame(rows, ENTRY).repartition(6)


@pytest.fixture
def large(monkeypatch, spark):
    """Everything counts as large, and Spark's own skew handling is off."""
    for module in (session, matching):
        monkeypatch.setattr(module, "is_small", lambda df, *limits: False)
    monkeypatch.setattr(session, "HOT_ROWS", 50)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_root_is_dealt_over_tasks(spark, large):
    asks = spark.createDataFrame([(0, "hot"), (1, "r1x1"), (2, "hot"), (3, "nothing"), (4, "")], "request_id long, root string")
    df = entries(spark, 6000)
    found = rq.root_semantic_origins(asks, df, LOOKUP)
    per_task = [r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    per_request = Counter(r.request_id for r in found.where("entry_id IS NOT NULL").collect())
    assert per_request[0] == per_request[2] == 2000 and per_request[1] > 0 and 4 not in per_request
    assert max(per_task) < 0.3 * sum(per_task), per_task
    statuses = {r.request_id: r.query_status for r in found.where("entry_id IS NULL").collect()}
    assert statuses[4] == "INVALID_ROOT_INPUT"


def test_dealt_join_equals_join(spark, large):
    heavy = spark.range(5000).select(F.col("id").alias("row"), F.when(F.col("id") % 2 == 0, "a").otherwise((F.col("id") % 13).cast("string")).alias("k"))
    light = spark.createDataFrame([("a", 1), ("a", 2), ("3", 3), ("z", 4), (None, 5)], "k string, v int")
    got = session.dealt_join(heavy, light, "k", "row", most=100)
    assert sorted(map(tuple, got.select("row", "k", "v").collect())) == sorted(map(tuple, heavy.join(light, "k").select("row", "k", "v").collect()))


def test_needles_go_by_their_rarest_gram(spark):
    texts = [f"the common text {i}" for i in range(200)] + ["the quartz", "a quartz vein", "quart", "xy", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "entry_id long, body string")
    needles = ["the quartz", "the common", "quartz vein", "xy", "y", "absent needle", "quart"]
    wanted = spark.createDataFrame([(i, n) for i, n in enumerate(needles)] + [(90, "xy")], "request_id long, needle string")
    chosen, counts = matching.rarest_grams(df, "body", wanted.select("needle").distinct(), [1, 2, 3])
    n = {r.gram: r.n for r in counts.collect()}
    for r in chosen.collect():
        grams = {r.needle[i:i + 3] for i in range(len(r.needle) - 2)} or {r.needle}
        held = {g: sum(g in t for t in texts) for g in grams}
        assert held[r.gram] == n[r.gram] == min(held.values())
    assert {r.needle for r in chosen.collect()} == set(needles) - {"absent needle"}
    got = {(r.request_id, r.entry_id) for r in matching.containing(df, "body", ["entry_id"], wanted).collect()}
    assert got == {(i, j) for i, w in [*enumerate(needles), (90, "xy")] for j, t in enumerate(texts) if w in t}


def test_mixed_requests_equal_single_types(spark):
    """Every type in one pass says what its own function says."""
    t = Tables(spark, FOLDER)
    kinds = list(rq.HANDLERS)
    asks = t.requests().orderBy("request_id").limit(6)
    mixed = asks.crossJoin(spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "k long, query_type string"))
    mixed = mixed.withColumn("was", F.col("request_id")).withColumn("request_id", F.col("request_id") * 100 + F.col("k")).drop("k")
    got = rq.run_queries(mixed, t.entries(), LOOKUP, t.trace()).join(mixed.select("request_id", "was"), "request_id").collect()
    for name, handler in rq.HANDLERS.items():
        extra = {"trace": t.trace()} if name == "TRACE_LOOKUP" else {}
        want = handler(asks, t.entries(), LOOKUP, **extra)
        payload = [c for c in want.columns if c not in ("request_id", "found", "query_status", "canonical_root", "entry_id", "confidence")]
        want = [(r.request_id, r.found, r.query_status, json.loads(r.result)) for r in want.select(
            "request_id", "found", "query_status", F.to_json(F.struct(*payload)).alias("result")).collect()]
        mine = [(r.was, r.found, r.query_status, json.loads(r.result)) for r in got if r.query_type == name]
        assert sorted(map(str, [(*w[:3], sorted(w[3].items())) for w in want])) == sorted(map(str, [(*m[:3], sorted(m[3].items())) for m in mine])), name
