"""Substring dedup with difference-cover anchors.

Words are runs without white space. A window of `length` words goes from a document when a document with a smaller id
has the same words somewhere; a word goes when a window that goes covers it.

1. Hashes of short runs (anchors) are taken only where the word number modulo `period` lies in a difference cover: every
   residue is a difference of two members, so that two places, however they lie, have a common shift below
   the period which brings both onto the cover. With anchors of `length - period + 1` words, every pair of equal windows
   shares an anchor at the same shift.
2. Spark keeps the smallest and largest id per anchor. Anchors of two documents fill a filter of fixed size (`bits`).
3. Windows that hold such an anchor are candidates. Runs of them are extended as far as they match: first in blocks, whose ends
   the words themselves choose; a block that a smaller id has too goes whole. The candidates outside such blocks are
   compared window by window, by 96-bit hashes of all their words. The smallest id per block or window decides, so a
   passage that many documents share costs a row per place, never a pair. Leaving out a block's windows loses nothing:
   the smallest id that has the block still offers them.
4. Documents that lose words are joined with the places; a bounded filter keeps the others out of that shuffle.

The filters can only let more windows through to a comparison, whose answer doesn't depend on them.

Defined cases: null and empty texts have no words; rows of one id never remove words from each other; a null id counts as the
smallest; a text without removed words keeps its words; empty tables stay empty; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import LEAST_ID, SPACE, slices, small_batches, stored, text_of, window_hashes, word_hashes

LENGTH, PERIOD = 50, 31
SLOTS = 2 ** 20
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def difference_cover(period: int) -> list[int]:
    """A small set of residues whose differences give every residue; greedy, and checked."""
    best: list[int] = []

    def search(chosen: list[int], missing: frozenset, size: int) -> bool:
        if not missing:
            best[:] = chosen
            return True
        if len(chosen) == size or len(missing) > sum(2 * k for k in range(len(chosen), size)):
            return False
        goal = min(missing)
        for c in range(chosen[-1] + 1, period):
            new = {(c - x) % period for x in chosen} | {(x - c) % period for x in chosen}
            if (goal in new or len(chosen) + 1 < size) and search([*chosen, c], missing - new, size):
                return True
        return False

    size = 1
    while not search([0], frozenset(range(1, period)), size):
        size += 1
    return best


def identity() -> tuple[Column, Column]:
    """A row's id (null: the smallest) and a tag of its text, which tells apart rows of one id."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("id"), F.hash(text_of()).alias("tag")


def _parts(batch):
    lists = batch.column("w")
    return (lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False),
            batch.column("id").to_numpy(zero_copy_only=False), batch.column("tag").to_numpy(zero_copy_only=False))


def places(sizes, length: int):
    """Of the words of all documents in a row: where windows of `length` begin, their document, their number within it."""
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    counts = np.maximum(sizes - length + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
    return begins[doc] + number, doc, number


def anchor_rows(sizes, words, period: int, cover, length: int):
    """Anchors: (hash, document, word number), at the cover's positions."""
    at, doc, number = places(sizes, length)
    on = np.isin(np.arange(period), cover)[number % period]
    return window_hashes(words, length, BASES[0])[at[on]], doc[on], number[on]


def shared_anchors(rows: DataFrame, length: int, period: int) -> DataFrame:
    """Hashes `a` of the anchors that rows of at least two ids have."""
    cover, short = difference_cover(period), length - period + 1

    def anchors(batches: Iterator) -> Iterator:
        for batch in (part for whole in batches for part in slices(whole, 2, 1 << 17)):
            words, sizes, ids, _ = _parts(batch)
            h, doc, _ = anchor_rows(sizes, words, period, cover, short)
            keep = sizes[doc] >= length
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(ids[doc[keep]])], ["a", "id"])

    found = rows.mapInArrow(anchors, "a long, id long").groupBy("a").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    return found.where("lo < hi").select("a")


def build_filter(anchors: DataFrame, bits: int):
    """A Bloom filter of 64-bit hashes with two probes (the leading and the last bits); `bits` / 8 bytes, whatever the data."""
    leading, last = F.shiftrightunsigned("a", 64 - bits.bit_length() + 1), F.col("a").bitwiseAND(F.lit(bits - 1))
    slots = anchors.select(F.explode(F.array(leading + 1, last + 1)).alias("slot"))
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.collect():  # 4096 bytes each
        out[(r["block"] - 1) * 4096:r["block"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


class Candidates:
    """The windows of a batch that hold an anchor of the filter, and the blocks they form.

    A block runs from one window whose hash is a multiple of `every` to the next one, over candidates only: its ends
    depend on the words alone, so equal passages have equal blocks wherever they stand.
    """

    def __init__(self, batch, table, bits: int, length: int, period: int, cover, every: int):
        short = length - period + 1
        words, sizes, self.ids, self.tags = _parts(batch)
        h, doc, number = anchor_rows(sizes, words, period, cover, short)
        doc, number = (x[held(table, h, bits)] for x in (doc, number))
        at, self.owner, self.pos = places(sizes, length)
        firsts = np.concatenate([[0], np.cumsum(np.maximum(sizes - length + 1, 0))])
        # windows that begin at most length - short words before a hit: marked by differences
        low, high = np.maximum(number - (length - short), 0), np.minimum(number, sizes[doc] - length) + 1
        right = high > low
        self.chosen = spans(firsts[doc[right]] + low[right], firsts[doc[right]] + high[right], len(at))
        self.w1, self.w2 = (window_hashes(words, length, base)[at] if len(at) else np.zeros(0, np.uint64) for base in BASES)
        first = np.diff(np.where(self.chosen, self.owner, -1), prepend=-1) != 0
        run = np.cumsum(first)
        ends = np.flatnonzero(self.chosen & (mixed(self.w1) % np.uint64(every) == 0))
        self.i, self.j = ends[:-1], ends[1:]
        same = run[self.i] == run[self.j]
        self.i, self.j = self.i[same], self.j[same]
        self.b1, self.b2 = (self.sums(w) for w in (self.w1, self.w2))

    def sums(self, w):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(w), dtype=np.uint64)])
        return mixed(total[self.j + 1] - total[self.i] + (self.j - self.i).astype(np.uint64) * np.uint64(BASES[0]))


def mixed(h):
    """A bijection of 64-bit numbers without structure."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def spans(begins, ends, size: int):
    marks = np.zeros(size + 1, np.int32)
    np.add.at(marks, begins, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def held(table, h, bits: int):
    """Which 64-bit hashes fall on bits that are set."""
    def set_at(slot):
        slot = slot.astype(np.int64)
        return (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
    return set_at(h >> np.uint64(64 - bits.bit_length() + 1)) & set_at(h & np.uint64(bits - 1))


def half(w):
    return pa.array((w >> np.uint64(32)).astype(np.uint32).view(np.int32))


def repeated_windows(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, bits: int = 2 ** 26, every: int = 16) -> DataFrame:
    """(id, tag, a, b): of each row, the windows a to b that a smaller id has too."""
    if not 1 < period <= length or bits & (bits - 1) or bits < 2 ** 15:
        raise ValueError("the period must lie between 2 and the length, bits must be a power of two from 2^15 on")
    small_batches(docs.sparkSession)
    cover, context = difference_cover(period), docs.sparkSession.sparkContext
    shift = 64 - bits.bit_length() + 1
    rows = docs.select(*identity(), word_hashes().alias("w"))
    anchors = context.broadcast(build_filter(shared_anchors(rows, length, period), bits))

    def blocks(batches: Iterator) -> Iterator:
        for batch in (part for whole in batches for part in slices(whole, 2, 1 << 17)):
            c = Candidates(batch, anchors.value, bits, length, period, cover, every)
            own = c.owner[c.i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.b1.view(np.int64)), half(c.b2), pa.array(c.ids[own]), pa.array(c.tags[own]), pa.array(c.pos[c.i].astype(np.int32)),
                 pa.array(c.pos[c.j].astype(np.int32))], ["b1", "b2", "id", "tag", "a", "b"])

    parts = rows.mapInArrow(blocks, "b1 long, b2 int, id long, tag int, a int, b int")
    first = stored(parts.groupBy("b1", "b2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")), "blocks")
    whole = parts.join(first.where("lo < hi"), ["b1", "b2"]).where(F.col("id") > F.col("lo")).select("id", "tag", "a", "b")
    own_key = F.col("b1").bitwiseXOR(F.shiftleft("lo", shift)).alias("a")
    owned = context.broadcast(build_filter(first.select(own_key), bits))

    def windows(known=None):
        """The windows that compare, of a known filter's only; one Python worker a task finds and filters them."""
        def run(batches: Iterator) -> Iterator:
            for batch in (part for whole in batches for part in slices(whole, 2, 1 << 17)):
                c = Candidates(batch, anchors.value, bits, length, period, cover, every)
                ids = c.ids.astype(np.int64).view(np.uint64)[c.owner[c.i]]
                gone = ~held(owned.value, c.b1 ^ (ids << np.uint64(shift)), bits)  # surely blocks of a smaller id
                left = np.flatnonzero(c.chosen & ~spans(c.i[gone], c.j[gone] + 1, len(c.chosen)))
                if known is not None:
                    left = left[held(known.value, c.w1[left], bits)]
                own = c.owner[left]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.w1[left].view(np.int64)), half(c.w2[left]), pa.array(c.ids[own]), pa.array(c.tags[own]),
                     pa.array(c.pos[left].astype(np.int32))], ["w1", "w2", "id", "tag", "pos"])
        return run

    schema = "w1 long, w2 int, id long, tag int, pos int"
    lowest = rows.mapInArrow(windows(), schema).groupBy("w1", "w2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    lowest = stored(lowest.select("w1", "w2", "lo"), "windows")
    known = context.broadcast(build_filter(lowest.select(F.col("w1").alias("a")), bits))
    met = rows.mapInArrow(windows(known), schema).join(lowest, ["w1", "w2"]).where(F.col("id") > F.col("lo"))
    single = met.select("id", "tag", F.col("pos").alias("a"), F.col("pos").alias("b"))
    return whole.union(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, bits: int = 2 ** 26, every: int = 16) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the words that stay, joined by one space."""
    found = repeated_windows(docs, length, period, bits, every)
    gone = stored(found.groupBy("id", "tag").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "repeated-windows")
    id_, tag = identity()
    rows = docs.select("doc_id", text_of().alias("text"), id_, tag).withColumn("slot", F.pmod(F.xxhash64("id", "tag"), F.lit(SLOTS)).cast("int"))
    slots = gone.select(F.pmod(F.xxhash64("id", "tag"), F.lit(SLOTS)).cast("int").alias("slot")).distinct()

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        total, lost, kept = [], [], []
        for text, own in zip(texts, found):
            words = [w for w in re.split(SPACE, text.as_py()) if w]
            stay = np.ones(len(words), bool)
            if own.is_valid:
                begins, ends = (np.asarray(own.values.field(i)) for i in (0, 1))
                stay = ~spans(begins, ends + length, len(words))
            total.append(len(words))
            lost.append(int(len(words) - stay.sum()))
            kept.append(" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]))
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())],
                                          ["n_words", "n_removed", "kept"])

    hit = rows.join(F.broadcast(slots), "slot", "left_semi").join(gone, ["id", "tag"], "left").select("doc_id", "text", "spans")
    rest = rows.join(F.broadcast(slots), "slot", "left_anti").select("doc_id", "text", F.lit(None).cast("array<struct<a:int,b:int>>").alias("spans"))
    return hit.union(rest).select("doc_id", cut("text", "spans").alias("x")).select("doc_id", "x.*")
