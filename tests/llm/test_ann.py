import numpy as np

from rootloom.llm import ann

FOLDER = "/root/testdata/sf0.1"


def brute(rows, k, every):
    """Exact neighbours of (id, vector) pairs."""
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]]
        out[int(ids[q])] = [(int(ids[i]), float(d[i])) for i in order[:k]]
    return out


def found(frame, **options):
    out = {}
    for r in sorted(ann.neighbours(frame, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_on_the_given_table(spark):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    want, got = brute(rows, 10, 100), found(frame)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    recall = np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 10 for q in want])
    print("recall", recall)
    assert recall >= 0.9
    exact = {q: dict(brute(rows, len(rows), 100)[q]) for q in list(want)[:1]}
    for q, d in exact.items():
        assert all(abs(d[i] - s) < 1e-12 for i, s in got[q])


def test_odd_rows_and_ties(spark):
    r = np.random.default_rng(3)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, [float(x) for x in r.normal(size=3)], "v") for i in range(60)] + [(i, hot, "v") for i in range(60, 400)]
    odd = [(500, None, "v"), (501, [0.0, 0.0, 0.0], "v"), (502, [1.0, None, 2.0], "v"), (503, [1.0, float("nan"), 2.0], "v"),
           (600, [1.0, float("inf"), 2.0], "v"), (504, [1.0], "v"), (None, hot, "v"), (505, [], "v"), (100, hot, "v")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, ids string").repartition(4)
    whole = [(i, np.float32(v).tolist()) for i, v, _ in rows]
    want, got = brute(whole, 10, 100), found(frame, every=100, width=50.0, salts=3)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    few = frame.where("vec_id < 4")
    assert {q: len(x) for q, x in found(few, width=50.0).items()} == {0: 3}
    assert found(frame.limit(0)) == {} and found(frame.where("vec_id = 500")) == {}


def test_probes_come_in_the_order_of_their_distance():
    h = ann.Hashes(8, 2, 4, 1.0)
    place = h.places(np.random.default_rng(1).normal(size=(1, 8)))[0, 0]
    slots = h.probes(place, 81)
    assert len({tuple(s) for s in slots}) == 81 and (abs(slots - np.floor(place)) <= 1).all()
    inside = place - np.floor(place)
    move = slots - np.floor(place)
    score = (np.where(move < 0, inside, np.where(move > 0, 1 - inside, 0)) ** 2).sum(axis=1)
    assert (np.diff(score) > -1e-12).all()
