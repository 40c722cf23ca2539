"""Vector codes by product quantisation in exact integers, with nearest entries found through LAESA pivots.

A vector's components become floor(1024 x); it is cut into equal parts, and each part position has a codebook of up to 256 entries,
refined in rounds of assigning every part to its nearest entry and moving every entry to the floored mean of its parts.

LAESA: of each codebook's first entries a few lie far apart and become pivots that stay fixed. A part's distances to the pivots are
computed once and stored beside it. In each round only the entries' distances to the pivots are computed anew; by the triangle
inequality, the largest difference between the two is a lower bound of the distance between part and entry. Entries are
evaluated in order of their bounds, exactly and in integers, until the next bound exceeds the best distance found. Bounds are
rounded down by more than the rounding errors of their floats, so no nearest entry and no tie is missed.

What leaves a task in a round is a sum and a count per entry; the driver holds the codebooks alone, whose size is fixed.

Defined cases: vectors that are null or hold null or non-finite components go, zero and empty vectors stay; shorter vectors count as
filled up with zeros to the longest one's length, and lengths that four doesn't divide to the next multiple (at least four); components beyond
+-2^b, b = (60 - log2 of a part's length) / 2 (28 for 64 components), count as that, which keeps distances in 64 bits; with fewer than 256 vectors
each is an entry; null ids come first, equal ids are in order of their components; repeated rows are parts of their own; label errors beyond 64 bits are null;
an empty table has no rows; other columns aren't looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from rootloom.llm.common import small_batches, stored
from rootloom.session import broadcast_if_small

PARTS, ENTRIES, ROUNDS, PIVOTS, SCALE = 4, 256, 4, 8, 1024
#: Rows of a step inside a task; sorted entries evaluated at once.
STEP, CHUNK = 1024, 8
#: Far above the rounding error of a distance kept as a 32-bit float, relative to it.
SLACK = 2.0 ** -21


# -------------------------------------------------------------------- pivots
def lengths(a, b):
    """Euclidean distances of every row of a and every row of b."""
    out = np.empty((len(a), len(b)))
    for j, row in enumerate(b):
        out[:, j] = np.sqrt(((a - row) ** 2).sum(axis=1).astype(np.float64))
    return out


def far_apart(book, most: int):
    """Indexes of entries: the first, then again and again that with the largest sum of distances to those chosen."""
    chosen, total = [0], lengths(book, book[:1])[:, 0]
    while len(chosen) < min(most, len(book)):
        total[chosen] = -1.0
        chosen.append(int(np.argmax(total)))
        total = total + lengths(book, book[chosen[-1:]])[:, 0]
    return chosen


def nearest(parts, to_pivots, book, book_to_pivots):
    """(index, squared distance, evaluations) of each part's nearest entry, ties to the lower index."""
    n, k = len(parts), len(book)
    bound, size = np.zeros((n, k)), to_pivots[:, None, 0] + book_to_pivots[None, :, 0] if to_pivots.shape[1] else 0.0
    for j in range(to_pivots.shape[1]):
        one, two = to_pivots[:, None, j], book_to_pivots[None, :, j]
        np.maximum(bound, np.abs(one - two), out=bound)
        size = np.maximum(size, one + two)
    bound = np.maximum(bound - SLACK * size, 0.0) ** 2 * (1 - 1e-9)
    order = np.argsort(bound, axis=1, kind="stable")
    sorted_bound = np.take_along_axis(bound, order, axis=1)
    best, index = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64)
    active, done = np.arange(n), 0
    evaluated = 0
    while len(active) and done < k:
        ids = order[active, done:done + CHUNK]
        gap = parts[active][:, None, :] - book[ids]
        found = (gap * gap).sum(axis=2)
        evaluated += ids.size
        least = found.min(axis=1)
        first = np.where(found == least[:, None], ids, k).min(axis=1)
        better = (least < best[active]) | ((least == best[active]) & (first < index[active]))
        best[active[better]], index[active[better]] = least[better], first[better]
        done += CHUNK
        if done < k:
            active = active[sorted_bound[active, done] <= best[active]]
    return index, best, evaluated


# --------------------------------------------------------------------- tables
def whole_numbers(rows: DataFrame, vector: str, carried: list[str]) -> tuple[DataFrame, int]:
    """(carried…, c) of the vectors that stay, as whole numbers of one length, and a part's length."""
    x = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = rows.where(F.coalesce(fine, F.lit(False))).select(*carried, x.alias("x"))
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    width = max(1, -(-longest // PARTS))
    most = float(2 ** ((60 - (width - 1).bit_length()) // 2))
    whole = F.transform("x", lambda v: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * SCALE))).cast("int"))
    filled = F.concat(whole, F.array_repeat(F.lit(0), width * PARTS - F.size("x")))
    return kept.select(*carried, filled.alias("c")), width


def matrix(column, width: int):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def listed(values, kind) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1), kind))


def assigned(batch, width: int, books, pivots):
    """For each step of rows of a batch and each part position: (first row, position, parts, index, squared distance)."""
    measured = [lengths(b, p) for b, p in zip(books, pivots)]
    every = len(pivots[0])
    for at in range(0, batch.num_rows, STEP):
        rows = batch.slice(at, STEP)
        parts = matrix(rows.column("c"), PARTS * width).astype(np.int64).reshape(-1, PARTS, width)
        far = matrix(rows.column("far"), PARTS * every).astype(np.float64).reshape(-1, PARTS, every)
        for p in range(PARTS):
            index, best, _ = nearest(parts[:, p], far[:, p], books[p], measured[p])
            yield at, p, parts[:, p], index, best


def with_distances(rows: DataFrame, width: int, pivots) -> DataFrame:
    """rows and the distances of their parts to the pivots, computed once and stored."""
    schema = StructType([*rows.schema.fields, StructField("far", ArrayType(FloatType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = matrix(batch.column("c"), PARTS * width).astype(np.int64).reshape(-1, PARTS, width)
            far = np.concatenate([lengths(parts[:, p], pivots[p]) for p in range(PARTS)], axis=1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns, listed(far, pa.float32())], [f.name for f in schema])

    return stored(rows.mapInArrow(measure, schema), "far")


def moved(rows: DataFrame, width: int, books, pivots):
    """The codebooks after one round: every entry at the floored mean of its parts, unused ones where they were."""
    k = len(books[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((PARTS * k, width), np.int64), np.zeros(PARTS * k, np.int64)
        for batch in batches:
            for _, p, parts, index, _ in assigned(batch, width, books, pivots):
                np.add.at(total, p * k + index, parts)
                count += np.bincount(p * k + index, minlength=PARTS * k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), listed(total[used], pa.int64())], ["slot", "n", "total"])

    found = rows.select("c", "far").mapInArrow(sums, "slot long, n long, total array<long>").groupBy("slot").agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i]) for i in range(width))).alias("total"))
    books = [b.copy() for b in books]
    for r in found.collect():  # at most 4 x 256 rows
        books[r.slot // k][r.slot % k] = np.array(r.total, np.int64) // r.n
    return books


def vector_codes(rows: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every vector that stays."""
    small_batches(rows.sparkSession, 4096)
    carried = [F.col(id_column).alias("vec_id"), F.col(label).alias("label")]
    whole, width = whole_numbers(rows.select(*carried, F.col(vector).alias("vector")), "vector", ["vec_id", "label"])
    first = whole.orderBy(F.col("vec_id").asc_nulls_first(), "c").limit(ENTRIES).select("c").collect()
    schema = StructType([*whole.schema.fields[:2], StructField("code", StringType()), StructField("error", LongType())])
    if not first:
        none = rows.sparkSession.createDataFrame([], schema)
        return none.select("*", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    start = np.array([r.c for r in first], np.int64).reshape(len(first), PARTS, width)
    books = [start[:, p] for p in range(PARTS)]
    pivots = [b[far_apart(b, PIVOTS)] for b in books]
    table = with_distances(whole, width, pivots)
    for _ in range(ROUNDS):
        books = moved(table, width, books, pivots)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, p, parts, index, best in assigned(batch, width, books, pivots):
                code[at:at + len(parts)] |= index << (8 * (PARTS - 1 - p))
                error[at:at + len(parts)] += best
            text = pa.array([f"{c:08x}" for c in code.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), text, pa.array(error)], schema.names)

    out = stored(table.mapInArrow(codes, schema), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    by = out.groupBy(F.col("label").alias("of")).agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error"))
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    rows = out.join(broadcast_if_small(by), F.col("label").eqNullSafe(F.col("of")))
    return rows.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
