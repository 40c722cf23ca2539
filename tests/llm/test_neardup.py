import random
import re
from collections import Counter, defaultdict

import numpy as np

from rootloom.llm import neardup


def grams(text):
    w = [x for x in re.split("[\x20\x09-\x0D]+", text or "") if x]
    return tuple(w), Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs, least=0.8):
    nodes = {}
    for _, t in docs:
        w, g = grams(t)
        nodes[w] = g
    names = list(nodes)
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(names):
        for b in names[:i]:
            both = sum((nodes[a] & nodes[b]).values())
            if both and both / sum((nodes[a] | nodes[b]).values()) >= least:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, t in docs:
        groups[find(grams(t)[0])].append(i)
    return groups, lambda t: find(grams(t)[0])


def corpus():
    r = random.Random(4)
    word = lambda: r.choice("abcdefghij") + str(r.randrange(400))
    docs, n = [], 0
    for g in range(25):
        base = [word() for _ in range(r.randrange(8, 300))]
        for c in range(r.choice([1, 1, 2, 5, 30])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 6])):
                w[r.randrange(len(w))] = word()
            docs.append((n, " ".join(w)))
            n += 1
    passage = " ".join(word() for _ in range(40))
    for _ in range(40):  # a shared passage alone makes no copy
        docs.append((n, passage + "\n" + " ".join(word() for _ in range(r.randrange(20, 60)))))
        n += 1
    docs += [(n, "one two"), (n + 1, "one  two"), (n + 2, "two one"), (n + 3, ""), (n + 4, None), (3, docs[3][1]), (3, docs[3][1]), (5, "other text"),
             (None, docs[9][1]), (None, docs[9][1]), (n + 5, "a b c d e " * 5000), (n + 6, "a b c d e " * 5000 + "x"), (n + 7, "a b c d e " * 50)]
    return docs


def test_classes_against_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, "n") for i, t in docs], "doc_id long, text string, node string").repartition(4)
    groups, of = brute(docs)
    for hub_words in (2 ** 20, 200):
        got = neardup.classes(frame, hub_words=hub_words).collect()
        assert len(got) == len(docs)
        found = defaultdict(list)
        for r in got:
            found[r.class_key].append(r.doc_id)
        assert sorted((sorted(map(str, g)) for g in found.values())) == sorted(sorted(map(str, g)) for g in groups.values())
        assert all(r.class_size == len(found[r.class_key]) and r.class_id == min(-2 ** 63 if i is None else i for i in found[r.class_key]) for r in got)
    kept = neardup.dedup(frame)
    assert kept.columns == frame.columns
    want = sorted(str(min(-2 ** 63 if i is None else i for i in g)) for g in groups.values())
    assert sorted(str(-2 ** 63 if r.doc_id is None else r.doc_id) for r in kept.collect()) == want


def test_hubs_find_similar_members():
    """Pairs counted in a matrix and in postings, against sets of one pair each."""
    r = random.Random(8)
    base = [f"w{r.randrange(90)}" for _ in range(120)]
    texts = []
    for _ in range(160):
        w = base[:r.choice([40, 120])]
        for _ in range(r.choice([0, 1, 3, 9])):
            w[r.randrange(len(w))] = f"x{r.randrange(9)}"
        texts.append(w)
    texts += [["a"], ["a", "b"], ["a"] * 50, ["a"] * 60]
    code = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    words = np.array([hash(("v", code[w])) & (2 ** 63 - 1) for t in texts for w in t], np.uint64)
    sizes = np.array([len(t) for t in texts])
    for columns in (1024, 5, 0):
        hubs = neardup.Hubs(words, sizes, list(range(len(texts))), columns)
        got = set(zip(*(x.tolist() for x in hubs.similar(words, sizes, 0.8))))
        want = set()
        for i, a in enumerate(texts):
            for j, b in enumerate(texts):
                x, y = grams(" ".join(a))[1], grams(" ".join(b))[1]
                if sum((x & y).values()) >= 0.8 * sum((x | y).values()):
                    want.add((i, j))
        assert got == want


def test_signatures_estimate_the_weighted_index():
    rng = np.random.default_rng(2)
    names = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    a, b = rng.random(300) * 3, rng.random(300) * 3
    a[200:] = 0
    b[:60] = 0
    elements, doc = np.concatenate([names[a > 0], names[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
    sig = neardup.signatures(elements, doc, np.concatenate([a[a > 0], b[b > 0]]), 2, 4000)
    assert (sig > 0).all()
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    alone = neardup.signatures(elements[doc == 1], np.zeros((doc == 1).sum(), int), b[b > 0], 1, 4000)
    assert (alone[0] == sig[1]).all()


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.classes(frame).collect() == [] and neardup.dedup(frame).collect() == []
