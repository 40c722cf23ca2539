import random
import re
from collections import defaultdict

import pytest

from rootloom.llm import substring


def brute(docs, length):
    first, words = {}, []
    for i, t in docs:
        w = [x for x in re.split("[\x20\x09-\x0D]+", t or "") if x]
        words.append(w)
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            first[k] = min(first.get(k, 2 ** 70), -2 ** 63 if i is None else i)
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] < (-2 ** 63 if i is None else i):
                gone |= set(range(s, s + length))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("period", [2, 3, 7, 13, 21, 31, 40])
def test_cover(period):
    cover = substring.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(cover) ** 2 < 4 * period + 9


def test_against_brute_force(spark):
    r = random.Random(5)
    base = [[r.choice("abcdefgh") + str(r.randrange(40)) for _ in range(60)] for _ in range(4)]
    docs = [(None, None), (None, ""), (1, " \t\n"), (None, " ".join(base[0])), (2, "x " * 700), (3, "x " * 30), (3, "x " * 31)]
    for n in range(60):
        parts = []
        for _ in range(r.randrange(1, 5)):
            b = r.choice(base)
            s = r.randrange(50)
            parts += b[s:s + r.randrange(2, 40)] + [str(r.randrange(10 ** 6)) for _ in range(r.randrange(6))]
        docs.append((n % 50, " é ".join(["", "\n".join(parts)])))
    docs += docs[-3:]
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, tag int, w string").repartition(5)
    for length, period, bits, every in ((10, 7, 2 ** 20, 4), (8, 3, 2 ** 15, 1), (12, 12, 2 ** 26, 16)):
        got = substring.remove_repeats(frame, length, period, bits, every).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, length)


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
