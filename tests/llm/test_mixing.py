import itertools
import random
import re
from collections import defaultdict

from rootloom.llm import mixing


def targets(size, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in size if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(size.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        want = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if want[s] > most * size[s]]
        if not over:
            return capped | want
        capped |= {s: most * size[s] for s in over}


def check(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, s, 1) for i, t, s in docs], "doc_id long, text string, source string, size int").repartition(3)
    got, again = (sorted(mixing.mix(frame, **options).select("doc_id", "th", "source", "size", "source_size", "target", "taken").collect(), key=str)
                  for _ in range(2))
    assert got == again and len(got) == len(docs)
    size, taken = defaultdict(int), defaultdict(int)
    for i, t, s in docs:
        size[s] += len(re.findall("[^\x20\x09-\x0D]+", t or ""))
    want = targets(size)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
    return want, taken, size


def test_targets_and_budgets(spark):
    r = random.Random(1)
    docs = [(n, "w " * int(r.paretovariate(0.7)), f"s{min(n % 40, 7)}") for n in range(3000)]
    docs += [(None, None, None), (None, "a b", None), (1, "a b", "s1"), (1, "a b", "s1"), (5, "", "zero"), (6, "x " * 90_000, "É"), (7, "y", "É")]
    want, taken, size = check(spark, docs, bucket_rows=50)
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in want if s not in ("É", None))


def test_few_documents_get_the_nearest_sum(spark):
    docs = [(i, "w " * n, s) for i, (n, s) in enumerate([(100, "a"), (37, "a"), (7, "b"), (50, "b"), (3, "c"), (500, "c"), (210, "c")])]
    want, taken, size = check(spark, docs)
    for s in want:
        parts = [len(t.split()) for _, t, x in docs if x == s]
        base = int(want[s] // size[s])
        sums = {base * size[s] + sum(c) for k in range(len(parts) + 1) for c in itertools.combinations(parts, k)} if base < 2 else {2 * size[s]}
        assert abs(taken[s] - want[s]) <= min(abs(x - want[s]) for x in sums) + 0.51


def test_reach_is_exact():
    r = random.Random(2)
    for _ in range(300):
        sizes = r.sample(range(1, 30), r.randrange(1, 5))
        spare = [r.randrange(0, 4) for _ in sizes]
        goal = r.randrange(0, 120)
        take = mixing.reach(sizes, spare, goal)
        assert all(0 <= t <= s for t, s in zip(take, spare))
        sums = {sum(a * b for a, b in zip(sizes, c)) for c in itertools.product(*(range(s + 1) for s in spare))}
        assert abs(sum(a * b for a, b in zip(sizes, take)) - goal) == min(abs(x - goal) for x in sums)


def best_gap(sizes, counts, budget):
    sums = {0}
    for size, n in zip(sizes, counts):
        sums = {x + k * size for x in sums for k in range(n + 1)}
    return min(abs(x - budget) for x in sums)


def test_few_long_documents_at_every_scale():
    """The same shape is fitted as well at any size: no switch, an error of units only."""
    for sizes, counts, budget in [([300_000, 700_000, 900_001], [3, 2, 2], 1_000_001), ([300_000, 700_000, 900_001], [3, 2, 2], 1_000_000),
                                  ([70_001, 120_003, 333_333, 500_009], [4, 3, 2, 1], 1_234_567), ([5, 7, 900_000], [30, 20, 3], 1_800_111)]:
        for times in (1, 10, 100):
            s, b = [x * times for x in sizes], budget * times
            take = mixing.fit(s, counts, b)
            assert all(0 <= k <= n for k, n in zip(take, counts))
            gap = abs(sum(x * k for x, k in zip(s, take)) - b)
            assert gap <= best_gap(s, counts, b) + 5e-6 * b, (s, b, gap)


def test_many_sizes_are_fitted_exactly():
    r = random.Random(5)
    sizes = sorted(r.sample(range(2, 40_000, 2), 3000))
    counts = [r.randrange(1, 9) for _ in sizes]
    total = sum(a * b for a, b in zip(sizes, counts))
    for budget in (total // 3, total // 2 + 1, 1_000_001, 12):
        take = mixing.fit(sizes, counts, budget)
        assert all(0 <= k <= n for k, n in zip(take, counts)) and abs(sum(a * b for a, b in zip(sizes, take)) - budget) == budget % 2


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
