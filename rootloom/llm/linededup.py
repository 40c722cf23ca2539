"""Line dedup: documents probe a sharded minimal perfect hash of the repeated lines instead of joining lines.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least `least_chars` code points
found in at least `least_docs` documents keep their lines in the largest id holding them alone.

The keys are counted by Spark (128-bit hashes, one row per key and document). The repeated ones are dealt into shards by hash; each
shard becomes a minimal perfect hash (levels of bits; a key alone in its slot settles there) over arrays of
fingerprints (64 bits, so that lines outside the table are turned away), counts and largest ids. All other lines are
absent from the arrays: they have no decision to look up.

The arrays are broadcast when their measured size is at most `max_broadcast` bytes. Beyond it the line hashes are dealt
to the shards instead, each shard over as many tasks as its lines need, and the rows stream past the arrays.

Defined cases: null and empty texts are one empty line; rows of one id count as one document and a null id comes before
all others; a line repeated within the largest document stays there each time; a text that loses nothing stays as it
is; empty tables stay empty; all columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import LEAST_ID, stored, text_of
from rootloom.llm.decontam import ascii_lower

STRIPPED = " \t\n\x0b\x0c\r"
SHARD_KEYS = 2 ** 18
SHARD = "shard int, seed long, levels array<binary>, fingerprints binary, counts binary, keepers binary"


# ------------------------------------------------------- minimal perfect hash
def mix(h, seed: int):
    """A bijection of 64-bit numbers, another one for each seed."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((int(seed) + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def build_levels(keys, gamma: float = 2.0) -> list[bytes]:
    """Bit arrays; a key belongs to the first level where no other remaining key has its slot."""
    levels, rest = [], keys
    while len(rest):
        slots = -int(-max(8, gamma * len(rest)) // 8) * 8
        slot = (mix(rest, len(levels)) % np.uint64(slots)).astype(np.int64)
        alone = np.bincount(slot, minlength=slots) == 1
        levels.append(np.packbits(alone, bitorder="little").tobytes())
        rest = rest[~alone[slot]]
    return levels


class Shard:
    """The arrays of one shard and their probe."""

    def __init__(self, seed: int, levels: list[bytes], fingerprints: bytes, counts: bytes, keepers: bytes):
        self.seed = seed
        ones = np.array([bin(i).count("1") for i in range(256)], np.int64)
        self.levels, base = [], 0
        for raw in levels:
            bits = np.frombuffer(raw, np.uint8)
            ranks = base + np.concatenate([[0], np.cumsum(ones[bits])])
            self.levels.append((bits, ranks))
            base = int(ranks[-1])
        self.fingerprints, self.keepers = np.frombuffer(fingerprints, np.int64), np.frombuffer(keepers, np.int64)
        self.counts, self.ones = np.frombuffer(counts, np.int32), ones

    def places(self, h1, h2):
        """Where the bits put each line; for lines outside the table any place, or -1."""
        keys, at = shard_keys(h1, h2, self.seed), np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, (bits, ranks) in enumerate(self.levels):
            slot = (mix(keys[left], level) % np.uint64(8 * len(bits))).astype(np.int64)
            byte, bit = bits[slot >> 3], slot & 7
            there = (byte >> bit & 1).astype(bool)
            at[left[there]] = (ranks[slot >> 3] + self.ones[byte & ((1 << bit) - 1)])[there]
            left = left[~there]
        return at

    def find(self, h1, h2):
        """The place of each line in the arrays; -1 for lines that aren't there."""
        at = self.places(h1, h2)
        right = at >= 0
        right[right] = self.fingerprints[at[right]] == h2[right]
        return np.where(right, at, -1)

    def drops(self, h1, h2, ids):
        """Whether each line goes: it is listed and its document isn't the largest that holds it."""
        at = self.find(h1, h2)
        out = np.zeros(len(at), bool)
        known = at >= 0
        out[known] = self.keepers[at[known]] != ids[known]
        return out


def shard_keys(h1, h2, seed: int):
    return mix(np.asarray(h1).view(np.uint64) ^ mix(np.asarray(h2).view(np.uint64), seed), seed)


def build_shard(pdf):
    """One shard's arrays from its rows (shard, h1, h2, n, keeper); the seed makes the 64-bit keys distinct."""
    import pandas as pd
    h1, h2 = pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64)
    seed = next(s for s in range(64) if len(np.unique(shard_keys(h1, h2, s))) == len(h1))
    levels = build_levels(shard_keys(h1, h2, seed))
    at = Shard(seed, levels, b"", b"", b"").places(h1, h2)
    order = np.argsort(at)
    return pd.DataFrame([{"shard": pdf["shard"].iloc[0], "seed": seed, "levels": levels, "fingerprints": h2[order].tobytes(),
                          "counts": np.minimum(pdf["n"].to_numpy(np.int64), 2 ** 31 - 1)[order].astype(np.int32).tobytes(),
                          "keepers": pdf["keeper"].to_numpy(np.int64)[order].tobytes()}])


def shard_of(h1, shards: int):
    return (mix(np.asarray(h1).view(np.uint64), 77) % np.uint64(shards)).astype(np.int64)


# --------------------------------------------------------------------- lines
def hashed(least_chars: int) -> tuple[Column, Column]:
    """Two arrays with a hash per line; lines too short to be looked up have 0 in both."""
    keys = F.transform(F.split(ascii_lower(text_of()), "\n"), lambda x: F.btrim(x, F.lit(STRIPPED)))
    long = lambda h: lambda k: F.when(F.length(k) >= least_chars, h(k)).otherwise(F.lit(0).cast("long"))
    return (F.transform(keys, long(lambda k: F.xxhash64(k))), F.transform(keys, long(lambda k: F.xxhash64(F.lit("second"), k))))


def ids() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))


def repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """(h1, h2, n, keeper) of the keys that enough documents hold."""
    h1, h2 = hashed(least_chars)
    lines = docs.select(ids().alias("id"), F.explode(F.arrays_zip(h1.alias("h1"), h2.alias("h2"))).alias("x"))
    lines = lines.select("id", "x.h1", "x.h2").where("h1 != 0 or h2 != 0").distinct()
    return lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= least_docs)


def build_shards(keys: DataFrame, per_shard: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The stored arrays (SHARD), and how many shards there are."""
    keys = stored(keys, "repeated-lines")
    shards = max(1, -(-keys.count() // per_shard))

    @F.arrow_udf("int")
    def deal(h1: pa.Array) -> pa.Array:
        return pa.array(shard_of(h1.to_numpy(zero_copy_only=False), shards), pa.int32())

    dealt = keys.withColumn("shard", deal("h1"))
    return stored(dealt.groupBy("shard").applyInPandas(build_shard, SHARD), "line-shards"), shards


def masks_by_broadcast(docs: DataFrame, arrays: DataFrame, shards: int, least_chars: int) -> DataFrame:
    """docs with `_drop`, an array of booleans per line; the arrays travel as one broadcast of measured size."""
    table = {r["shard"]: Shard(r["seed"], [bytes(x) for x in r["levels"]], bytes(r["fingerprints"]), bytes(r["counts"]), bytes(r["keepers"]))
             for r in arrays.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("array<boolean>")
    def probe(h1: pa.Array, h2: pa.Array, doc: pa.Array) -> pa.Array:
        a, b = (x.flatten().to_numpy(zero_copy_only=False) for x in (h1, h2))
        sizes = h1.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(doc.to_numpy(zero_copy_only=False), sizes)
        out, long = np.zeros(len(a), bool), np.flatnonzero((a != 0) | (b != 0))
        part = shard_of(a[long], shards)
        for s, shard in shared.value.items():
            own = long[part == s]
            out[own] = shard.drops(a[own], b[own], owner[own])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(out))

    return docs.withColumn("_drop", probe(*hashed(least_chars), ids()))


def masks_by_routing(docs: DataFrame, arrays: DataFrame, shards: int, least_chars: int, task_lines: int) -> DataFrame:
    """The same where the arrays are too large: line hashes go to their shard and stream past its arrays.

    A shard is copied for every `task_lines` lines that its counts foretell, so that a hot line is spread.
    """

    @F.arrow_udf("int")
    def weigh(counts: pa.Array) -> pa.Array:
        return pa.array([1 + int(np.frombuffer(c.as_py(), np.int32).sum(dtype=np.int64)) // task_lines for c in counts], pa.int32())

    @F.arrow_udf("int")
    def deal(h1: pa.Array) -> pa.Array:
        return pa.array(shard_of(h1.to_numpy(zero_copy_only=False), shards), pa.int32())

    arrays = arrays.withColumn("copies", weigh("counts"))
    h1, h2 = hashed(least_chars)
    lines = docs.select(ids().alias("id"), F.xxhash64(text_of()).alias("th"), F.posexplode(F.arrays_zip(h1.alias("h1"), h2.alias("h2"))).alias("pos", "x"))
    lines = lines.select("id", "th", "pos", "x.h1", "x.h2").where("h1 != 0 or h2 != 0").withColumn("shard", deal("h1"))
    lines = lines.join(F.broadcast(arrays.select("shard", "copies")), "shard")  # a row for each 2^18 keys
    lines = lines.withColumn("copy", F.pmod(F.xxhash64("id", "th", "pos"), F.col("copies")).cast("int")).drop("copies")
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (x.split() for x in SHARD.split(", ") if not x.startswith("shard "))]
    empty = [F.lit(None).cast(k).alias(n) for n, k in (("id", "long"), ("th", "long"), ("pos", "int"), ("h1", "long"), ("h2", "long"))]
    heads = arrays.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies").select("*", *empty)
    both = heads.unionByName(lines.select("*", *nothing))
    sorted_rows = both.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("levels").isNull())
    names = both.columns

    def stream(batches: Iterator) -> Iterator:
        shard = None
        for batch in batches:
            c = {n: batch.column(i) for i, n in enumerate(names)}
            starts = np.flatnonzero(~c["levels"].is_null().to_numpy(zero_copy_only=False)).tolist()
            bounds = sorted({0, *starts, batch.num_rows})
            for a, b in zip(bounds, bounds[1:]):
                if a in starts:
                    shard = Shard(c["seed"][a].as_py(), *(c[n][a].as_py() for n in ("levels", "fingerprints", "counts", "keepers")))
                    a += 1
                part = {n: c[n][a:b].to_numpy(zero_copy_only=False) for n in ("id", "th", "pos", "h1", "h2")}
                if b > a:
                    part = {n: v.astype(np.int64) for n, v in part.items()}
                    gone = shard.drops(part["h1"], part["h2"], part["id"])
                    yield pa.RecordBatch.from_arrays([pa.array(part[n][gone]) for n in ("id", "th", "pos")], ["id", "th", "pos"])

    @F.arrow_udf("array<boolean>")
    def mask(places: pa.Array, size: pa.Array) -> pa.Array:
        sizes = size.to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(int(begins[-1]), bool)
        lengths = places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        out[np.repeat(begins[:-1], lengths) + places.flatten().to_numpy(zero_copy_only=False)] = True
        return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(out))

    gone = sorted_rows.mapInArrow(stream, "id long, th long, pos long").distinct()
    gone = gone.groupBy(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th")).agg(F.collect_list("pos").alias("_gone"))
    same = [ids() == F.col("_gone_id"), F.xxhash64(text_of()) == F.col("_gone_th")]
    joined = docs.join(gone, same, "left")
    none = F.coalesce("_gone", F.array().cast("array<long>"))
    return joined.withColumn("_drop", mask(none, F.size(F.split(text_of(), "\n")))).drop("_gone", "_gone_id", "_gone_th")


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, max_broadcast: int = 64 << 20, per_shard: int = SHARD_KEYS,
                task_lines: int = 5_000_000, report: str | None = None) -> DataFrame:
    """docs with the repeated lines gone from `text`; `report` names a further column, struct<n_lines, n_dropped>."""
    arrays, shards = build_shards(repeated_lines(docs, least_chars, least_docs), per_shard)
    names = docs.columns
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), "doc_id", "text")  # names of the input can't clash
    size = arrays.agg(F.sum(F.octet_length("fingerprints") + F.octet_length("counts") + F.octet_length("keepers")
                            + F.aggregate("levels", F.lit(0), lambda a, x: a + F.octet_length(x)))).first()[0]
    if size is None:
        masked = docs.withColumn("_drop", F.array().cast("array<boolean>"))
    elif size <= max_broadcast:
        masked = masks_by_broadcast(docs, arrays, shards, least_chars)
    else:
        masked = masks_by_routing(docs, arrays, shards, least_chars, task_lines)
    lines = F.split(text_of(), "\n")
    dropped = F.size(F.filter("_drop", lambda x: x))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get("_drop", i), F.lit(False))), "\n")
    counts = F.struct(F.size(lines).cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))
    out = masked.withColumn("_counts", counts).withColumn("_text", F.when(dropped > 0, kept).otherwise(F.col("text")))
    extra = [F.col("_counts").alias(report)] if report else []
    return out.select(*((F.col("_text") if c == "text" else F.col("row")[c]).alias(c) for c in names if c != report), *extra)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "report.n_lines", "report.n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))
