from collections import defaultdict

import numpy as np

from rootloom.llm import linededup

SPACE = " \t\n\x0b\x0c\r"
A, B, C = "The quick brown fox, line a " * 3, "École é line b, " * 5, "x" * 40
DOCS = ([(i, f"{A}\nown {i}\n  {B.upper().replace('É', 'é')} \n{C}") for i in range(7)] + [(i, C.upper() + "\r\n" + C) for i in range(3, 9)]
        + [(None, A), (None, A), (20, ""), (21, None), (22, A + "\n" + A), (22, A), (23, "\n\n"), (24, ("short\n" + C + "\n") * 3000), (25, "y" * 39)])


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(docs, least_docs=5):
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            held[key(line)].add(-2 ** 63 if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(held[key(x)]) < least_docs or max(held[key(x)]) == i]
        out.append((i, kept and "\n".join(kept) or "", len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def check(spark, **options):
    docs = spark.createDataFrame([(i, t, "h", [True]) for i, t in DOCS], "doc_id long, text string, h1 string, keeper array<boolean>")
    got = linededup.dedup_lines(docs, report="r", **options)
    assert got.columns == [*docs.columns, "r"]
    rows = got.collect()
    assert sorted(((r.doc_id, r.text or "", r.r.n_lines, r.r.n_dropped) for r in rows), key=str) == brute(DOCS)
    assert sum(r.text is None for r in rows) == 1


def test_broadcast(spark):
    check(spark)


def test_routing_gives_the_same(spark):
    check(spark, max_broadcast=0, per_shard=1, task_lines=3)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.dedup_lines(docs).collect() == []


def test_perfect_hash_is_minimal_and_rejects_strangers():
    import pandas as pd
    rng = np.random.default_rng(1)
    h = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, 20_000))
    h[0, 1] = h[0, 0]  # equal first halves
    row = linededup.build_shard(pd.DataFrame({"shard": 0, "h1": h[0], "h2": h[1], "n": 7, "keeper": h[1] // 2})).iloc[0]
    shard = linededup.Shard(*(row[k] for k in ("seed", "levels", "fingerprints", "counts", "keepers")))
    at = shard.find(h[0], h[1])
    assert sorted(at) == list(range(20_000)) and (shard.keepers[at] == h[1] // 2).all() and (shard.counts[at] == 7).all()
    assert (shard.find(h[1], h[0]) == -1).all()
