"""Vector codes against plain integer k-means, and the pivots' bounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from rootloom.llm import vectorcodes as vc
from rootloom.llm.queries import QUERIES, SQL
from tests.compare import compare, connect

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    width = max(1, -(-max(len(r[1]) for r in kept) // 4))
    most = 2.0 ** ((60 - (width - 1).bit_length()) // 2)
    vectors = [[math.floor(min(max(x * 1024.0, -most), most)) for x in r[1]] + [0] * (4 * width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is not None, kept[i][0] or 0, vectors[i]))[:256]
    parts = np.array(vectors, dtype=object).reshape(len(kept), 4, width)
    books = [parts[order, p].copy() for p in range(4)]

    def assign():
        index, error = np.zeros((len(kept), 4), int), [0] * len(kept)
        for p in range(4):
            for i, x in enumerate(parts[:, p]):
                found = [(sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(books[p])]
                d, index[i, p] = min(found)
                error[i] += d
        return index, error
    for _ in range(4):
        index, _ = assign()
        for p in range(4):
            for j in range(len(books[p])):
                own = parts[index[:, p] == j, p]
                if len(own):
                    books[p][j] = [sum(own[:, w]) // len(own) for w in range(width)]
    index, error = assign()
    labels = {}
    for r, e in zip(kept, error):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(r[0], "".join(f"{j:02x}" for j in index[i]), error[i], labels[r[2]] if labels[r[2]] < 2 ** 63 else None, digest) for i, r in enumerate(kept)]


def codes(spark, rows, kind=COLUMNS):
    df = spark.createDataFrame(rows, kind).repartition(3)
    found = vc.vector_codes(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(map(str, map(tuple, found.collect())))


@pytest.mark.parametrize("n,length,spread", [(60, 8, 1.0), (400, 4, 0.01), (300, 6, 3.0), (5, 1, 1.0)])
def test_against_plain_rounds(spark, n, length, spread):
    rnd = random.Random(n)
    centres = [[rnd.gauss(0, 1) for _ in range(length)] for _ in range(7)]
    rows = [(rnd.randrange(3 * n), [float(np.float32(c + rnd.gauss(0, spread) * 0.1)) for c in rnd.choice(centres)], rnd.choice([None, 1, 2])) for _ in range(n)]
    rows += [rows[0], rows[0], (rows[0][0], [0.0] * length, 1)]
    assert codes(spark, rows) == sorted(map(str, brute(rows)))


def test_unusual_vectors(spark):
    bad = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], None), (4, [float("inf")], 2), (5, [float("-inf"), 0.0], 2)]
    fine = [(None, [0.5, 0.25, -0.5], None), (7, [], 1), (8, [3e38, -3e38, 1e30, 0.0, -1e-30], 9), (9, [0.0] * 5, 1), (10, [1e30] * 5, 9), (11, [-1e30] * 5, 9)]
    assert codes(spark, bad + fine) == sorted(map(str, brute(bad + fine)))
    assert codes(spark, bad) == [] and codes(spark, []) == []
    assert codes(spark, [(1, [], 1), (2, [], None)]) == sorted(map(str, brute([(1, [], 1), (2, [], None)])))


def test_clashing_columns(spark):
    rows = [(i, [float(i % 7), 1.0, 2.0, 3.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("c", "far", "x", "vector", "code", "error", "of", "slot", "n", "total"):
        df = df.selectExpr("*", f"'q' AS {name}")
    got = vc.vector_codes(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_pivots_prune_and_miss_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-9000, 9000, (40, 16))
    book = (centres[rng.integers(0, 40, 256)] + rng.integers(-300, 300, (256, 16))).astype(np.int64)
    parts = (centres[rng.integers(0, 40, 3000)] + rng.integers(-300, 300, (3000, 16))).astype(np.int64)
    pivots = book[vc.far_apart(book, vc.PIVOTS)]
    far = vc.lengths(parts, pivots).astype(np.float32).astype(np.float64)
    index, best, evaluated = vc.nearest(parts, far, book, vc.lengths(book, pivots))
    every = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert evaluated < 0.25 * every.size


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op13_vector_codes", QUERIES["op13_vector_codes"], SQL["op13_vector_codes"]) is None
