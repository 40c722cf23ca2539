from rootloom.llm import quality


def test_every_chunk_of_each_sampled_text_is_learned_from(spark):
    shape = quality.Shape(chunk=32, overlap=8)
    texts = {i: "".join(chr(97 + (i + j * j) % 26) for j in range(40 * i)) for i in range(1, 40)}
    rows = [(i, texts[i]) for i in texts] + [(7, texts[7])] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    used = {r.doc_id for r in labels.where(quality.fold() != 0).collect()}
    got, _ = quality.training_rows(docs, labels, shape, 25, 1 << 20)
    assert sorted(g[0].tobytes() for g in got) == sorted(quality.chunks_of(texts[i].encode(), shape).tobytes() for i in used)
    small, _ = quality.training_rows(docs, labels, shape, 25, 4000)
    whole = {g[0].tobytes() for g in got}
    assert 0 < len(small) < len(got) and all(s[0].tobytes() in whole for s in small)
