"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words (runs without white space). Sources in code-point order, null last, get the
weights in turn and share `share` times all sizes; a target stops at `most` times its source's size, the excess is
shared again by weight until none is above.

Each source takes every document as often as its target allows whole (its base); what remains is a budget below the
source's size. Documents are counted by exact size. Every size first gives its proportional part of the budget; the
rest, never less than four times the largest size, is fitted by a bounded-knapsack recursion over the sizes (sets of reachable sums, as
bits of a number), which stops as soon as the exact rest is reachable. Of each size, the planned number of documents is selected in seeded hash order;
sizes with many documents are cut into hash buckets first, so that no task ranks more than a bucket.

Defined cases: null and empty texts have size 0 and take 0; a null source is a source; repeated rows are taken row by
row, ties by id and a hash of the text; an all-empty source has target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from rootloom.llm.common import SPACE, stored, text_of

WEIGHTS = (3.0, 1.0, 2.0)


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, th, source, size): what the mix needs of a document; th is a hash of its text."""
    words = F.array_remove(F.split(text_of(), SPACE), "")
    return docs.select("doc_id", F.xxhash64(text_of()).alias("th"), "source", F.size(words).cast("long").alias("size"))


def source_targets(counts: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size, n): a level that fills each source up to its cap.

    One row per source; with caps in the order of cap / weight, the level is found by running sums.
    """
    per = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1))
    per = per.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))
    found = F.min(fits).over(Window.partitionBy())["level"]
    return per.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * found, F.col("cap"))).alias("target"))


def reach(sizes: list[int], spare: list[int], goal: int) -> list[int]:
    """How many of each size to take, at most `spare`, so that the sum comes nearest to goal (ties: the smaller sum).

    Bit s of `sums` says whether s can be reached; counts are split into powers of two. For the way back one state in about
    the square root of the number of steps is kept, and those between are computed again, a stretch at a time.
    """
    take = [0] * len(sizes)
    if goal <= 0:
        return take
    limit = (1 << (goal + max(sizes, default=0) + 1)) - 1
    steps = []
    for i, (size, n) in enumerate(zip(sizes, spare)):
        part = 1
        while size and n > 0:
            k = min(part, n)
            steps.append((i, k))
            n, part = n - k, part * 2
    gap = math.isqrt(len(steps)) + 1
    sums, kept, used = 1, [], 0
    for j, (i, k) in enumerate(steps):
        if sums >> goal & 1:
            break
        if j % gap == 0:
            kept.append(sums)
        sums |= sums << k * sizes[i] & limit
        used = j + 1
    low = (sums & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = sums >> goal + 1
    high = goal + 1 + (above & -above).bit_length() - 1 if above else math.inf
    at = low if goal - low <= high - goal else high
    for first in range((used - 1) // gap * gap, -1, -gap):
        states = [kept[first // gap]]
        for i, k in steps[first:min(first + gap, used) - 1]:
            states.append(states[-1] | states[-1] << k * sizes[i] & limit)
        for (i, k), state in zip(reversed(steps[first:min(first + gap, used)]), reversed(states)):
            if not state >> at & 1:
                take[i] += k
                at -= k * sizes[i]
    return take


def fit(sizes: list[int], counts: list[int], budget: int, most_bits: int = 2 ** 22) -> list[int]:
    """How many documents of each size to take for a budget: proportional parts, then the recursion for the rest.

    One rule at every scale: proportional picks are given back, largest sizes first and one of each size a round, until four
    times the largest size is to be decided anew (or everything, if there is less); all of that and the spare documents go
    into the recursion. Sums of more than `most_bits` are counted in units, which costs at most half a unit a document; what that
    leaves is fitted once more with documents up to that rest.
    """
    total = sum(s * n for s, n in zip(sizes, counts))
    if budget <= 0 or not total:
        return [0] * len(sizes)
    take = [min(n, n * budget // total) if s else 0 for s, n in zip(sizes, counts)]
    rest = budget - sum(s * k for s, k in zip(sizes, take))
    falling = sorted((i for i in range(len(sizes)) if sizes[i]), key=lambda i: -sizes[i])
    enough = 4 * sizes[falling[0]]
    while rest < enough and any(take[i] for i in falling):
        for i in falling:
            if take[i] and rest < enough:
                take[i] -= 1
                rest += sizes[i]
    order = sorted(falling, key=lambda i: (-(counts[i] * budget % total), sizes[i]))
    for i in order:  # one more of those that were cut off most, while much is left
        if take[i] < counts[i] and rest - sizes[i] >= enough:
            take[i] += 1
            rest -= sizes[i]
    for i in falling:
        k = min(counts[i] - take[i], max(0, rest - enough) // sizes[i])
        take[i] += k
        rest -= k * sizes[i]
    for unit in sorted({max(1, -(-(rest + sizes[falling[0]]) // most_bits)), 1}, reverse=True):
        use = sorted((i for i in falling if take[i] < counts[i] and (unit > 1 or sizes[i] <= 2 * rest)), key=lambda i: sizes[i])
        use = use if unit > 1 or rest + max((sizes[i] for i in use), default=0) <= most_bits else []
        more = reach([round(sizes[i] / unit) for i in use], [counts[i] - take[i] for i in use], round(rest / unit))
        for i, k in zip(use, more):
            take[i] += k
            rest -= k * sizes[i]
    return take


def plan_counts(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, size, n, base, take): how often all documents of a size are taken, and how many once more."""
    def plan(pdf):
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        base = int(target // size) if size else 0
        budget = int(round(target - base * size))
        pdf = pdf.sort_values("size")
        pdf["take"] = fit([int(x) for x in pdf["size"]], [int(x) for x in pdf["n"]], budget)
        pdf["base"] = base
        pdf["gap"] = budget - int((pdf["size"] * pdf["take"]).sum())
        return pdf[["source", "size", "n", "base", "take", "source_size", "target", "gap"]]

    # a row per source and distinct size, however many documents there are
    rows = counts.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        "c.source", "c.size", "c.n", "t.source_size", "t.target")
    return rows.groupBy("source").applyInPandas(
        plan, "source string, size long, n long, base long, take long, source_size long, target double, gap long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 17, bucket_rows: int = 50_000) -> DataFrame:
    """A row per document row: doc_id, th, source, size, source_size, target, copies, taken, gap (words its source's mix is short of the target)."""
    rows = stored(document_sizes(docs), "sizes")
    counts = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    plan = stored(plan_counts(counts, source_targets(counts, weights, share, most)), "mix-plan")
    h = F.xxhash64(F.lit(seed), "doc_id", "th")
    same = [F.col("r.source").eqNullSafe(F.col("p.source")), F.col("r.size") == F.col("p.size")]
    keyed = rows.alias("r").join(plan.alias("p"), same).select("r.*", "p.n", "p.base", "p.take", "p.source_size", "p.target", "p.gap")
    keyed = keyed.withColumn("h", h).withColumn("bucket", F.pmod("h", F.ceil(F.col("n") / bucket_rows)))
    some = keyed.where("take > 0 and take < n")
    places = some.groupBy("source", "size", "bucket").agg(F.count("*").alias("k"), F.first("take").alias("take"))
    before = F.sum("k").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("k")
    quota = places.select("source", "size", "bucket", F.greatest(F.lit(0), F.least("k", F.col("take") - before)).alias("quota"))
    same = [F.col("s.source").eqNullSafe(F.col("q.source")), F.col("s.size") == F.col("q.size"), F.col("s.bucket") == F.col("q.bucket")]
    ranked = some.alias("s").join(quota.alias("q"), same).select("s.*", "q.quota").withColumn(
        "once", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id", "th")) <= F.col("quota"))
    all_or_none = keyed.where("take = 0 or take = n").withColumn("once", F.col("take") > 0)
    out = ranked.drop("quota").unionByName(all_or_none)
    copies = F.col("base") + F.col("once").cast("long")
    return out.select("doc_id", "th", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
                      "gap")
