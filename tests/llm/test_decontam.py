import re

from rootloom.llm import decontam


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, length):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            x = words(t)
            k = min(len(x), length)
            for s in range(len(x) - k + 1) if x else ():
                for i in range(len(w) - k + 1):
                    if w[i:i + k] == x[s:s + k]:
                        hit |= set(range(i, i + k))
                        found.add(item)
        out.append((doc_id, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


ITEMS = [(1, "One two three four five six seven"), (2, "the the the the"), (10, "É x"), (3, ""), (4, None), (5, "two three four five"),
         (5, "two three four five"), (7, "one two three four five six seven")]
DOCS = [(1, "zero ONE two, three four five nine"), (2, "two three four six seven"), (3, None), (4, ""), (5, "é x É X É-x"),
        (5, "é x É X É-x"), (5, "the the the the the"), (None, "one two three four"), (None, None), (6, "one\ntwo\tthree four " * 400),
        (7, "two three four five six seven one two three"), (8, "x " * 3000 + "one two three four five six seven")]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in DOCS], "doc_id long, text string, term string, pos int")
    items = spark.createDataFrame([(i, t, 7) for i, t in ITEMS], "item_id long, text string, doc int")
    got = decontam.contamination(docs, items, 4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == brute(DOCS, ITEMS, 4)
    assert all(r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in got)
    clean = decontam.decontaminate(docs, items, 4)
    assert clean.columns == docs.columns and clean.count() == sum(not r.contaminated for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contamination(docs.limit(0), items).collect() == []
    assert [tuple(r) for r in decontam.digest(decontam.contamination(docs, items.limit(0))).drop("items_sha256").collect()] == [(1, 4, 0, 0, False)]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "gamma beta alpha"), (3, "alpha y y y y beta gamma"), (None, "alpha beta gamma")],
                                 "doc_id long, text string")
    terms = decontam.item_terms(spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string"))
    index = decontam.build_index(docs, terms)
    assert {r.doc for r in decontam.proximity_hits(index, terms, 3, 1).collect()} == {1, None}
    assert {r.doc for r in decontam.proximity_hits(index, terms, 3, 4).collect()} == {1, 2, 3, None}
    assert {r.doc for r in decontam.proximity_hits(index, terms, 3, 0).collect()} == {None}
