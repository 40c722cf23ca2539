import pytest
import math
import zlib

import numpy as np

from rootloom.llm import quality

FOLDER = "/root/testdata/sf0.1"


def test_chunks_cover_everything():
    shape = quality.Shape(chunk=32, overlap=8)
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        text = bytes(np.random.default_rng(n).integers(1, 255, n).astype(np.uint8))
        parts = quality.chunks_of(text, shape)
        step = 24
        assert b"".join(p.tobytes()[:step] for p in parts[:-1]) + parts[-1].tobytes().rstrip(b"\0") == text
        assert len(quality.chunks_of(text, shape, 3)) <= 3


def test_gradients():
    rng = np.random.default_rng(0)
    net = quality.Network(quality.Shape(chunk=24, overlap=8, width=4, stride=2, vector=3, filters=5), 1, 0.1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    parts = [rng.integers(0, 256, (n, 24)).astype(np.uint8) for n in (1, 3, 2)]
    y, w, begins = np.array([0.0, 1, 1]), np.array([1.0, 2, 1]), np.array([0, 1, 4])

    def loss():
        z = net.combine(net.features(np.concatenate(parts)), begins)
        return float((w * (np.log1p(np.exp(z)) - y * z)).sum() / w.sum())
    before = {k: v.copy() for k, v in net.p.items()}
    net.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    net.train_step(parts, y, w, 0.0)
    for k in net.p:
        grad = net.moments[k][0] * 10
        for at in list(np.ndindex(before[k].shape))[::max(1, before[k].size // 12)]:
            net.p[k][at] += 1e-5
            up = loss()
            net.p[k][at] -= 2e-5
            down = loss()
            net.p[k][at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.quality == 1 for r in rows])
    kept = np.array([r.predicted == 1 for r in rows])
    score = np.array([r.score for r in rows])
    order = score.argsort().argsort()
    auc = (order[good].mean() - (good.sum() - 1) / 2) / (~good).sum()
    print("held-out rows", len(rows), "auc", auc, "clean kept", kept[good].mean(), "bad rejected", (~kept)[~good].mean())
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert auc > 0.95 and kept[good].mean() > 0.98 and (~kept)[~good].mean() > 0.85


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text", "x"), (2, None, "x"), (2, None, "y"), (None, "", "x"), (3, "a" * 100_000, None), (4, "é", "")],
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int")
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 5)], "doc_id long, quality int, text int")
    for labels in (none, one, both, both.limit(0)):
        rows = quality.classify(docs, labels).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.classify(docs.limit(0), both).collect() == []


def test_score_equals_a_naive_convolution():
    """Every filter at every place of every chunk, one product at a time."""
    shape = quality.Shape(chunk=24, overlap=6, width=5, stride=2, vector=3, filters=4)
    net = quality.Network(shape, 3, 0.2)
    rng = np.random.default_rng(1)
    net.p["weights"] = rng.normal(0, 1, 8).astype(np.float32)
    net.p["shift"] = rng.normal(0, 1, 4).astype(np.float32)
    texts = [b"", b"a", b"some short text", bytes(range(256)), "é ü\n".encode() * 40]
    for text, got in zip(texts, net.score(texts)):
        step, chunks, at = shape.chunk - shape.overlap, [], 0
        while True:
            chunks.append(text[at:at + shape.chunk].ljust(shape.chunk, b"\0"))
            if at + shape.chunk >= len(text):
                break
            at += step
        features = []
        for c in chunks:
            row = []
            for f in range(shape.filters):
                best = max(sum(float(net.p["vectors"][c[i + w]][v]) * float(net.p["filters"][w * shape.vector + v, f])
                               for w in range(shape.width) for v in range(shape.vector)) for i in range(0, shape.chunk - shape.width + 1, shape.stride))
                row.append(math.tanh(best + float(net.p["shift"][f])))
            features.append(row)
        both = [max(col) for col in zip(*features)] + [sum(col) / len(col) for col in zip(*features)]
        logit = sum(a * float(b) for a, b in zip(both, net.p["weights"])) + float(net.p["bias"][0])
        assert abs(got - 1 / (1 + math.exp(-logit))) < 1e-5


def test_rows_that_do_not_fit_are_skipped(spark):
    """A long row leaves the others of its label in the sample; a label that doesn't fit at all is an error."""
    rows = [(i, ("good words here " if i % 2 else "zzz qqq xxx ") * 5) for i in range(1, 120)] + [(500 + i, "x" * 5000) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    sample, counts = quality.training_rows(docs, labels, quality.Shape(), 500, 2000)
    assert {q for _, q, _ in sample} == {0, 1} and counts[0] > 0 and counts[1] > 0
    scores = {round(r.score, 3) for r in quality.classify(docs, labels, most_bytes=2000).collect()}
    assert len(scores) > 1
    with pytest.raises(ValueError, match="no labelled text"):
        quality.training_rows(docs, labels, quality.Shape(), 500, 10)
