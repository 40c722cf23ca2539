import random

from rootloom.llm import tokencount

PIECES = {b"a": 5, b"b": 7, b" ": 3, b"ab": 9, b" a": 6, b"aba": 20, b"bab": 11, b" ab": 10, b"\n": 4, b"aaaa": 8}


def brute(word, pieces):
    """(cost, pieces) of the cheapest segmentation."""
    best = [(0, 0)] + [None] * len(word)
    rare = max(pieces.values())
    for d in range(1, len(word) + 1):
        best[d] = min((best[a][0] + (pieces[word[a:d]] if word[a:d] in pieces else rare), best[a][1] + 1)
                      for a in range(d) if word[a:d] in pieces or a == d - 1)
    return best[-1]


def test_shared_prefixes_give_what_each_word_gives():
    r = random.Random(3)
    words = {bytes(r.choice(b"ab \xc3\xa9") for _ in range(r.randrange(1, 12))) for _ in range(3000)} | {b"a" * 3000}
    counter = tokencount.Counter(PIECES)
    counter.insert(words)
    assert counter.counts == {w: brute(w, PIECES)[1] for w in words}
    assert counter.nodes == len({w[:i] for w in words for i in range(1, len(w) + 1)})


def test_query(spark):
    texts = ["the cat sat  on\n\nthe mat", "", None, "é" * 500, "the the the " * 4000, " x ", "the cat sat  on\n\nthe mat", " nbsp"]
    docs = spark.createDataFrame([(i if i < 5 else None, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    pieces = tokencount.load_pieces()
    for store in (1, 1 << 19):
        got = tokencount.token_counts(docs, chunk_bytes=10, store_words=store).collect()
        want = [tokencount.PRE_TOKEN.findall((t or "").encode()) for t in texts]
        assert all(b"".join(w) == (t or "").encode() for w, t in zip(want, texts))
        assert sorted(((r.doc_id, r.n_pretokens, r.n_tokens) for r in got), key=str) == sorted(
            ((i if i < 5 else None, len(w), sum(brute(x, pieces)[1] for x in w)) for i, w in enumerate(want)), key=str)
    assert tokencount.token_counts(docs.limit(0)).collect() == []
