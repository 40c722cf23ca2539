"""The language model against dictionaries, and its probabilities' sums."""

import collections
import math
import random
import re
import zlib

import pytest

from rootloom.llm import katz

COLUMNS = "doc_id long, text string"
END, BEGIN = "", None


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


def losses(counts):
    """What a count of 1, …, 5 and more loses, from the counts of counts."""
    n = collections.Counter(counts)
    for k in (5, 4, 3, 2, 1):
        if all(n[r] for r in range(1, k + 2)) and (k + 1) * n[k + 1] < n[1]:
            a = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, k + 1)}
            if all(0 < x < 1 for x in d.values()):
                return lambda r: min(r, k) * (1 - d[min(r, k)])
    return lambda r: 0.5


class Plain:
    def __init__(self, rows):
        texts = [words_of(t) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
        self.one = collections.Counter(w for t in texts for w in t)
        self.two = collections.Counter((a, w) for t in texts for a, w in zip([BEGIN, *t], t))
        self.total = sum(self.one.values())
        self.after = collections.Counter()
        self.seen = collections.defaultdict(list)
        for (a, w), c in self.two.items():
            self.after[a] += c
            self.seen[a].append(w)
        self.lost1, self.lost2 = losses(self.one.values()), losses(self.two.values())
        self.unknown = sum(self.lost1(c) for c in self.one.values()) / self.total if self.total else 1.0
        self.weights = {a: sum(self.lost2(self.two[a, w]) for w in ws) / self.after[a] / (1 - sum(self.p1(w) for w in ws)) for a, ws in self.seen.items()}

    def p1(self, w):
        c = self.one.get(w, 0)
        return (c - self.lost1(c)) / self.total if c else self.unknown

    def p2(self, a, w):
        c = self.two.get((a, w), 0)
        return (c - self.lost2(c)) / self.after[a] if c else self.weights.get(a, 1.0) * self.p1(w)

    def score(self, text):
        t = words_of(text)
        base = sum(math.log10((self.one.get(w, 0) + 0.1) / (self.total + 0.1 * (len(self.one) + 1))) for w in t)
        return len(t), sum(w in self.one for w in t), self.total, base, sum(math.log10(self.p2(a, w)) for a, w in zip([BEGIN, *t], t))


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"Wörd{i}" for i in range(120)]

    def text():
        out = [rnd.choice(vocabulary)]
        for _ in range(rnd.randrange(60)):
            out.append(vocabulary[int(rnd.paretovariate(0.7)) * 7 % 120] if rnd.random() < 0.6 else rnd.choice(vocabulary[:30]))
        if rnd.random() < 0.1:
            out.append(f"rare{rnd.random()}")
        return rnd.choice([" ", "\n", " \t "]).join(out)
    rows = [(i, text()) for i in range(n)]
    return rows + [(i, None) for i in range(20)] + [(None, "w1 w2"), (None, None), (3, ""), (5, "w1 w2"), (5, "w1 w2")] + [(n + i, "same words again") for i in range(50)]


def check(spark, rows, **sizes):
    got = katz.scores(katz.train(spark.createDataFrame(rows, COLUMNS).repartition(3), **sizes)).collect()
    plain = Plain(rows)
    want = sorted(((-1 if i is None else i), zlib.crc32(str("" if i is None else i).encode()) % 10 == 0, *plain.score(t)) for i, t in rows)
    got = sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in got)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9), (a, b)


@pytest.mark.parametrize("n,sizes", [(300, {}), (300, {"block": 500, "bucket": 700}), (3, {})])
def test_against_dictionaries(spark, n, sizes):
    check(spark, corpus(n, n), **sizes)


def test_split_contexts(spark, monkeypatch):
    monkeypatch.setattr(katz, "SPLIT", 20)
    rows = corpus(200, 1)
    small = spark.createDataFrame(rows, COLUMNS)
    model = katz.train(small, block=400, bucket=100)
    assert model.contexts.count() == model.contexts.select("context").distinct().count() == len(Plain(rows).after)
    got = {r.doc_id: r.score for r in katz.scores(model).collect() if r.doc_id and r.doc_id > 20}
    plain = Plain(rows)
    texts = {i: t for i, t in rows if i and i > 20}
    assert got.keys() == texts.keys() and all(got[i] == pytest.approx(plain.score(t)[4], rel=1e-9) for i, t in texts.items())


def test_probabilities_add_up_to_one(spark):
    model = katz.train(spark.createDataFrame(corpus(250, 9), COLUMNS))
    one, lost = model.unigrams, model.lost
    import numpy as np
    p1 = one.probability(np.arange(one.words))
    assert float(p1.sum()) + one.unknown == pytest.approx(1, abs=1e-12)
    seen = collections.defaultdict(dict)
    for r in model.bigrams().collect():
        seen[r.context][r.word] = r.n
    contexts = model.contexts.collect()
    assert {r.context for r in contexts} == set(seen) and all(r.total == sum(seen[r.context].values()) for r in contexts)
    for r in contexts:
        p = r.weight * np.append(p1, one.unknown)
        for w, n in seen[r.context].items():
            p[w] = (n - lost[min(n, 6) - 1]) / r.total
        assert float(p.sum()) == pytest.approx(1, abs=1e-9) and p.min() > 0


def test_no_training_rows_long_texts_empty(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    check(spark, [(i, "a b c") for i in ids])
    check(spark, [(1, "x" * 400_000), (2, "a " * 50_000 + "b"), (4, "A b\x0bc d"), (ids[0], "a b"), (ids[1], "a  b " * 3000)], block=1000)
    assert katz.scores(katz.train(spark.createDataFrame([], COLUMNS))).collect() == []


def test_clashing_columns(spark):
    rows = corpus(40, 4)
    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("task", "held", "w", "g", "kind", "at", "ids", "hash", "word", "n", "_at", "_range", "context", "score"):
        df = df.selectExpr("*", f"1 AS {name}")
    got = katz.scores(katz.train(df)).collect()
    plain = Plain(rows)
    assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in rows)
    assert sum(r.score for r in got) == pytest.approx(sum(plain.score(t)[4] for _, t in rows), rel=1e-9)
