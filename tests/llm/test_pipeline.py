import re

import corpus_pipeline
from rootloom.llm import quality
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_linededup import brute as lines
from tests.llm.test_neardup import brute as groups

FOLDER = "/root/testdata/sf0.001"


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = corpus_pipeline.good_quality(spark, docs, FOLDER).cache()
    judged = quality.classify(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged if r.predicted) and kept.columns == docs.columns
    lined = corpus_pipeline.without_repeated_lines(spark, kept, FOLDER).cache()
    want = lines(pairs(kept.collect()))
    assert lined.dtypes == docs.dtypes
    assert sorted(((r.doc_id, r.text) for r in lined.collect()), key=str) == sorted(((i, t) for i, t, _, _ in want), key=str)
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = corpus_pipeline.without_near_duplicates(spark, lined, FOLDER).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(min(g) for g in groups(pairs(lined.collect()))[0].values())
    clean = corpus_pipeline.without_benchmark(spark, single, FOLDER).cache()
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, hit, _ in contaminated(pairs(single.collect()), items, 10) if not hit)
    assert clean.dtypes == docs.dtypes
    mix = corpus_pipeline.mixed(spark, clean, FOLDER).collect()
    assert sorted(r.doc_id for r in mix) == sorted(r.doc_id for r in clean.collect())
    sizes = {r.doc_id: len(re.findall("[^\x20\x09-\x0D]+", r.text)) for r in clean.collect()}
    assert all(r.size == sizes[r.doc_id] and r.taken == r.copies * r.size and r.copies <= 2 for r in mix)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, mix), key=str)


def test_odd_tables_pass_through(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (2, "x " * 50_000, "en", None, 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, None)], "item_id long, text string")
    for name, rows in (("all", docs), ("none", docs.limit(0))):
        folder = str(tmp_path / name)
        for t, frame in (("documents", rows.withColumn("slot", rows.doc_id)), ("labels", labels), ("benchmark", items)):
            frame.write.parquet(f"{folder}/{t}.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        # the empty texts are copies of each other; the smallest id is the null one
        assert sorted((r.doc_id for r in out), key=str) == ([2, None] if name == "all" else [])


def test_internal_names_as_input_columns(spark):
    """Columns named as the stages' own stay as they were."""
    names = ["_drop", "_counts", "_text", "_gone", "_gone_id", "_gone_th", "_bad_th", "_bad_doc", "_before", "report", "report_", "row", "node", "comp",
             "score", "slot", "bucket", "words", "hub", "th", "size", "source_size", "n", "h", "copies", "term", "pos", "item"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain, wide = docs, docs.selectExpr("*", *(f"concat('{n} of ', doc_id) AS `{n}`" for n in names))
    for name, stage in corpus_pipeline.STAGES:
        plain, wide = stage(spark, plain, FOLDER).cache(), stage(spark, wide, FOLDER).cache()
        if name == "mixing":
            assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)
            break
        assert wide.columns == plain.columns + names
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, wide.select(plain.columns).collect()), key=str)
        assert all(r[n] == f"{n} of {r.doc_id}" for r in wide.collect() for n in names)
