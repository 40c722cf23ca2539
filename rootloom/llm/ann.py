"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table of the index hashes a vector by `functions` Gaussian projections, each cut into slots of width w:
floor((a.v + b) / w). The projections of one table are orthogonal to each other, which spreads the buckets evenly. A query visits its own
bucket and perturbed ones, a slot up or down in some of the functions, in the order of estimated success: the sum of squared
distances from the query to the slot borders that the perturbation crosses, smallest first. Candidates of all tables
are merged and ranked by the exact distance, in double precision on the original vectors.

Equal vectors are one point of the index with their smallest ids (one more than asked for: the query itself may be
among them), which loses nothing, as equal distances go by id. The slot width is `width` times the spread of the projections,
measured over all vectors. Points meet queries in (table, bucket) groups: the points of a bucket are dealt out over
`salts` tasks, the queries of the bucket go to each of them, both sides are read in blocks. A task
merges what a query finds in all its buckets and passes on the k best; beyond `most_queries` queries it passes them on earlier. A query
whose buckets hold fewer than k points is compared with all points instead.

Defined cases: vectors that are null, zero, of another length than most or with null or non-finite components take no
part, neither as query nor as candidate; null ids take no part; repeated rows (same id, same vector) count once; fewer
candidates than `k` give fewer rows; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rootloom.llm.common import stored


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): whole, finite, non-zero vectors of the commonest length, as doubles; equal rows once."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["d"] if sizes else 0))


def points(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): distinct vectors with the smallest ids that have them; long runs of equal vectors shrink before they meet."""
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= keep)
    return ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


class Hashes:
    """The random projections of all tables."""

    def __init__(self, dimensions: int, tables: int, functions: int, width: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = np.empty((tables, functions, dimensions))
        for t in range(tables):
            full = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0]
            self.a[t] = full[np.arange(functions) % dimensions] * np.sqrt(dimensions)
        self.b = rng.uniform(0, width, (tables, functions))
        self.width, self.tables, self.functions = width, tables, functions

    def places(self, vectors):
        """(rows, tables, functions): projections in units of the slot width."""
        return (np.einsum("nd,tfd->ntf", vectors, self.a) + self.b) / self.width

    def buckets(self, vectors):
        return self.key(np.floor(self.places(vectors)).astype(np.int64))

    @staticmethod
    def key(slots):
        """64-bit keys of slot numbers along the last axis."""
        h = np.zeros(slots.shape[:-1], np.uint64)
        for i in range(slots.shape[-1]):
            h = (h ^ slots[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)

    def probes(self, place, count: int):
        """Slots to visit for one query in one table, best first: the bucket itself and count - 1 perturbed ones."""
        slots = np.floor(place).astype(np.int64)
        inside = place - slots
        moves = sorted([(x * x, i, -1) for i, x in enumerate(inside)] + [((1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
        out, heap = [slots], [(moves[0][0], (0,))]
        while heap and len(out) < count:
            score, chosen = heapq.heappop(heap)
            last = chosen[-1]
            if last + 1 < len(moves):  # shift the last move, or add the next one
                heapq.heappush(heap, (score - moves[last][0] + moves[last + 1][0], (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (score + moves[last + 1][0], (*chosen, last + 1)))
            if len({moves[m][1] for m in chosen}) == len(chosen):
                near = slots.copy()
                for m in chosen:
                    near[moves[m][1]] += moves[m][2]
                out.append(near)
        return np.stack(out)


def neighbours(vectors: DataFrame, k: int = 10, every: int = 100, tables: int = 6, functions: int = 6, probes: int = 64, width: float = 1.9,
               salts: int = 8, block: int = 2048, most_queries: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query; queries are the ids divisible by `every`."""
    rows = stored(usable(vectors), "vectors")
    first = rows.select("v").limit(1).collect()
    if not first:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    dimensions = len(first[0]["v"])
    # the mean square of a component about its mean: a random unit projection's spread
    spread = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("s")).agg(F.avg("s")).first()[0] or 0.0
    hashes = Hashes(dimensions, tables, functions, max(width * np.sqrt(spread * dimensions), 1e-12))
    matrix = lambda column: column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)

    def index(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                keys = hashes.buckets(matrix(part.column(0)))
                row = pa.array(np.repeat(np.arange(part.num_rows), tables))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(tables, dtype=np.int32), part.num_rows)), pa.array(keys.reshape(-1)), part.column(0).take(row),
                     part.column(1).take(row)], ["t", "bucket", "v", "ids"])

    def visits(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                places = hashes.places(matrix(part.column(1)))
                t, bucket, row = [], [], []
                for n in range(part.num_rows):
                    for table in range(tables):
                        keys = hashes.key(hashes.probes(places[n, table], probes))
                        t += [table] * len(keys)
                        bucket.append(keys)
                        row += [n] * len(keys)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(np.concatenate(bucket)), part.column(0).take(row), part.column(1).take(row)],
                                                 ["t", "bucket", "query_id", "v"])

    def dealt(asked, stock):
        """One stream per task, in the order of the buckets: the queries of a bucket, then its points."""
        salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        stock = stock.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
        no_ids, no_query = F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("long").alias("query_id")
        both = salted.select("t", "bucket", "salt", "query_id", "v", no_ids).union(stock.select("t", "bucket", "salt", no_query, "v", "ids"))
        return both.repartition("t", "bucket", "salt").sortWithinPartitions("t", "bucket", "salt", F.col("query_id").isNull())

    distinct = stored(points(rows, k + 1), "points")
    stock = distinct.mapInArrow(index, "t int, bucket long, v array<double>, ids array<long>")
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    asked = queries.mapInArrow(visits, "t int, bucket long, query_id long, v array<double>")
    asked = asked.join(stock.select("t", "bucket").distinct(), ["t", "bucket"], "left_semi")  # visits to empty buckets end here

    def nearest(batches: Iterator) -> Iterator:
        here, ids, asked_v = None, [], []
        best: dict = {}  # query: [distance beyond which nothing counts, {id: distance}]

        def rows_of():
            out = [(n, x, d) for n, (_, found) in best.items() for d, x in heapq.nsmallest(k, ((d, x) for x, d in found.items()))]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                                              ["query_id", "vec_id", "score"])

        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
                query = batch.column(3).to_pylist()
                v, own = matrix(batch.column(4)), batch.column(5).to_pylist()
                a = 0
                while a < len(keys):
                    b = a
                    while b < len(keys) and keys[b] == keys[a] and (query[b] is None) == (query[a] is None):
                        b += 1
                    if keys[a] != here:
                        here, ids, asked_v = keys[a], [], []
                    if query[a] is not None:
                        ids += query[a:b]
                        asked_v.append(v[a:b])
                    elif ids:
                        if len(asked_v) > 1:
                            asked_v = [np.concatenate(asked_v)]
                        for n, own_id in enumerate(ids):
                            mine = best.setdefault(own_id, [np.inf, {}])
                            d = np.sqrt(np.square(v[a:b] - asked_v[0][n]).sum(axis=1))
                            limit = mine[0]
                            if len(d) > 2 * k:  # points have an id besides the query's, but for one
                                limit = min(limit, np.partition(d, 2 * k)[2 * k])
                            for i in np.flatnonzero(d <= limit):
                                for x in own[a + i]:
                                    if x != own_id:
                                        mine[1][x] = min(float(d[i]), mine[1].get(x, np.inf))
                            if len(mine[1]) > 4 * k:
                                kept = heapq.nsmallest(k, ((d, x) for x, d in mine[1].items()))
                                mine[:] = [kept[-1][0], {x: d for d, x in kept}]
                            if len(best) >= most_queries:
                                yield rows_of()
                    a = b
        if best:
            yield rows_of()

    def search(asked, stock):
        met = dealt(asked, stock).mapInArrow(nearest, "query_id long, vec_id long, score double")
        met = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = stored(search(asked, stock), "found")
    # queries whose buckets hold too few points are compared with all points
    total = rows.select("vec_id").distinct().count()
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select("query_id")
    everywhere = [F.lit(-1).alias("t"), F.lit(0).cast("long").alias("bucket")]
    rest = queries.select(*everywhere, F.col("vec_id").alias("query_id"), "v").join(enough, "query_id", "left_anti")
    return found.join(enough, "query_id", "left_semi").unionByName(search(rest, distinct.select(*everywhere, "v", "ids")))
