"""The Merkle manifest against a plain tree of lists."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from rootloom.llm import merkle
from rootloom.llm.queries import QUERIES, SQL
from tests.compare import compare, connect

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), leaf_of(r), r))
    by = {k: sorted(v, key=lambda x: x[:2]) for k, v in by.items()}
    trees = {k: levels([x[1] for x in v]) for k, v in by.items()}
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    upper = levels([trees[k][-1][0] for k in names])
    out = []
    for k, v in by.items():
        for i, (_, leaf, r) in enumerate(v):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            fold, proof = leaf_of((*r[:4], text)), ""
            for tree, at in ((trees[k], i), (upper, names.index(k))):
                for level in tree[:-1]:
                    first = at // 16 * 16
                    left, right = "".join(level[first:at]), "".join(level[at + 1:first + 16])
                    fold, proof, at = H(left + fold + right), proof + left + right, at // 16
            root = upper[-1][0]
            out.append((r[0], k, leaf, trees[k][-1][0], root, H(proof), fold, fold == root))
    return out


def rows_of(counts, seed=1):
    rnd, out = random.Random(seed), []
    for source, n in counts.items():
        for i in range(n):
            text = rnd.choice([None, "", "Some Text", "lower", "Ünïcode Ä\n" * 3]) if i else "X" * 300_000
            out.append((rnd.randrange(10 * n) - n, source, rnd.choice([None, "en"]), rnd.choice([None, 5]), text))
    return out


@pytest.mark.parametrize("counts", [
    {"a": 1}, {"a": 16}, {"a": 17, "": 1}, {"a": 300, None: 40, "é": 2, "Z": 257}, {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_against_lists(spark, counts):
    rows = rows_of(counts)
    rows += [(None, "a", None, None, None), (3, "a", "en", 1, "One"), (3, "a", "en", 1, "Two"), (3, "a", "en", 1, "Two")]
    got = [tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_clashing_columns_and_empty(spark):
    rows = rows_of({"a": 20, "b": 3})
    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("tree", "place", "digest", "altered", "n", "run", "at", "_at", "_range", "root", "suffix", "leaf"):
        df = df.selectExpr("*", f"'x' AS {name}")
    got = [tuple(r) for r in merkle.manifest(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert merkle.manifest(df.limit(0)).collect() == []


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, "op11_merkle_manifest", QUERIES["op11_merkle_manifest"], SQL["op11_merkle_manifest"]) is None
