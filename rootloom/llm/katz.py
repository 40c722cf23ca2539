"""Katz backoff language model over words: trained on a corpus, stored in partitioned tables, scoring every text.

The probability of a token after another one is its Good-Turing discounted bigram count over the count of the context; what
discounting frees goes to the tokens not seen there, in proportion to the next lower order, where the same rule leads from words to
one symbol for all unknown words. The backoff weight of a context is what it freed over what the lower order gives
to tokens not seen there, so that probabilities over the vocabulary and the unknown symbol add up to one after every context.

Counts r up to five are discounted to Good-Turing's (r + 1) n[r+1] / n[r], scaled as Katz does so that five is the last; where too few counts of
counts are there for that, fewer are; larger counts lose what the last of those loses (a little, instead of
Katz's nothing, so that no context is left without mass for new words).

How it runs. Words are read from texts once and become numbers local to a block of some four million tokens. Words are numbered over the
corpus by falling count, so that a word's count follows from its number through a table with one row per distinct count (at most
sqrt(2 N) of them), small enough for every task. Each block asks for its distinct bigrams with their training counts, packed by bucket; a bucket
sums them, keeps them as a part of the bigram table and answers each block in the order asked. Contexts with many tokens are split over
several buckets and added up. Then each block evaluates its tokens: bigram, else the context's backoff weight and the word, else the unknown symbol.

Defined cases: null and empty texts are the end token alone; a null id is that of an empty text for the split (held out); texts of any length stay whole (a block
holds at least one document); repeated rows count and are scored each; without training rows every probability is one; an empty table has no
rows; columns besides id and text aren't looked at. More than 2^31 - 3 distinct training words raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import SPACE, forget, numbered, slices, small_batches, stored, text_of
from rootloom.llm.linededup import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tokens of a block, tokens whose bigrams share a bucket, tokens of a context from which on it is split.
BLOCK, BUCKET, SPLIT = 2 ** 22, 2 ** 22, 2 ** 21
LOW = 5
#: What a block's rows are.
MAPPED, DOCS, ASKED, PAIRS = 0, 1, 2, 3
ANSWERS, WEIGHTS = 0, 1


def held_out(doc_id: Column, folds: int = 10) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def tokens(text: str = "text") -> Column:
    """Hashes of a text's words, then that of the end (the empty text, which no word is)."""
    words = F.array_remove(F.split(F.translate(text_of(text), UPPER, LOWER), SPACE), "")
    return F.concat(F.transform(words, lambda w: F.xxhash64(w)), F.array(F.xxhash64(F.lit(""))))


# ----------------------------------------------------------------- arithmetic
def lost_mass(n) -> np.ndarray:
    """What counts 1..LOW and all larger ones lose; n: how many types have count 1..LOW + 1."""
    for top in range(LOW, 0, -1):
        if min(n[:top + 1]) > 0 and (common := (top + 1) * n[top] / n[0]) < 1:
            kept = np.array([((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) for r in range(1, top + 1)])
            if 0 < kept.min() and kept.max() < 1:
                lost = np.arange(1, top + 1) * (1 - kept)
                return np.append(lost, np.full(LOW + 1 - top, lost[-1]))
    return np.full(LOW + 1, 0.5)


@dataclass
class Unigrams:
    """The lowest order: number of tokens and of documents trained on, words by falling count."""

    total: int
    documents: int
    words: int
    first: np.ndarray  # the first word of each distinct count
    counts: np.ndarray
    buckets: int
    lost: np.ndarray = None
    unknown: float = 1.0

    def __post_init__(self):
        types = np.diff(np.append(self.first, self.words))
        of = {int(c): int(t) for c, t in zip(self.counts, types)}
        self.lost = lost_mass([of.get(r, 0) for r in range(1, LOW + 2)])
        if self.total:
            self.unknown = float((self.lost[np.minimum(self.counts, LOW + 1) - 1] * types).sum() / self.total)

    def count(self, words):
        """Training counts of words; unknown ones (-1) have none."""
        if not self.words:
            return np.zeros(len(words), np.int64)
        found = self.counts[np.maximum(np.searchsorted(self.first, words, "right") - 1, 0)]
        return np.where(words >= 0, found, 0)

    def context_count(self, words):
        """How many tokens follow a word; the begin of a text is the number after the last word's."""
        return np.where(words == self.words, self.documents, self.count(np.minimum(words, self.words - 1)))

    def probability(self, words):
        c = self.count(words)
        kept = c - self.lost[np.clip(c, 1, LOW + 1) - 1]
        return np.where(c > 0, kept / max(self.total, 1), self.unknown)

    def bucket(self, keys):
        context, word = (keys >> np.uint64(32)).astype(np.int64), keys & np.uint64(0xFFFFFFFF)
        split = (1 + self.context_count(context) // SPLIT).astype(np.uint64)
        return (mix(mix(keys >> np.uint64(32), 21) ^ (mix(word, 22) % split), 23) % np.uint64(self.buckets)).astype(np.int64)


def contexts_of(ids, starts, begin: int):
    """The token before each token; begin at the starts of documents."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts] = begin
    return before


def bigrams(model: Unigrams, ids, starts):
    """(contexts, distinct bigrams of known words in order of bucket and key, their buckets, where each token's is, -1 if unknown)."""
    before = contexts_of(ids, starts, model.words)
    known = (before >= 0) & (ids >= 0)
    keys, at = np.unique(before[known].astype(np.uint64) << np.uint64(32) | ids[known].astype(np.uint64), return_inverse=True)
    bucket = model.bucket(keys)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    where = np.full(len(ids), -1, np.int64)
    where[known] = place[at.reshape(-1)]
    return before, keys[order], bucket[order], where


# -------------------------------------------------------------------- packing
def packed(values) -> bytes:
    """64-bit integers as compressed planes of their bytes, as differences."""
    import zstandard
    values = np.asarray(values).astype(np.int64)
    planes = np.diff(values, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes):
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.int64))


def lists(flat, sizes, kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def one_list(values) -> pa.ListArray:
    """An array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def packed_words(ids) -> bytes:
    """32-bit numbers of words as compressed planes of their bytes."""
    import zstandard
    planes = np.ascontiguousarray(ids.astype(np.int32)).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked_words(data: bytes):
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.int32)


def table_rows(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch with the given columns; scalars are repeated, the rest is null."""
    out = []
    for f in schema:
        value = columns.get(f.name)
        if value is None:
            out.append(pa.nulls(rows, f.type))
        elif isinstance(value, (pa.Array, np.ndarray, list)):
            out.append(value if isinstance(value, pa.Array) else pa.array(value, f.type))
        else:
            out.append(pa.array([value] * rows, f.type))
    return pa.RecordBatch.from_arrays(out, schema=schema)


# ------------------------------------------------------- words to local numbers
LOCAL = pa.schema([("g", pa.int64()), ("kind", pa.int32()), ("at", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                   ("sizes", pa.list_(pa.int64())), ("ids", pa.binary()), ("hashes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
LOCAL_SQL = ("g long, kind int, at long, doc_ids array<long>, held array<boolean>, sizes array<long>, ids binary, hashes array<long>, "
             "counts array<long>")


def localised(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Documents (task, doc_id, held, hashes) as numbers into their block's words, and the words with their training counts."""
    known, number, count, size, task, blocks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, 0

    def vocabulary():
        hashes = np.empty_like(known)
        hashes[number] = known
        for k in range(0, len(hashes), 1 << 16):
            part = slice(k, k + (1 << 16))
            yield table_rows(LOCAL, 1, g=task << 24 | blocks, kind=MAPPED, at=k, hashes=one_list(hashes[part]), counts=one_list(count[part]))

    for batch in (part for whole in batches for part in slices(whole, 3, 1 << 18)):
        task, held = batch.column(0)[0].as_py(), batch.column(2).to_numpy(zero_copy_only=False)
        sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
        distinct, at = np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        place = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
        new = known[place] != distinct if len(known) else np.ones(len(distinct), bool)
        both = np.concatenate([known, distinct[new]])
        order = np.argsort(both, kind="stable")
        number = np.concatenate([number, len(known) + np.arange(int(new.sum()))])[order]
        known = both[order]
        ids = number[np.searchsorted(known, distinct)][at.reshape(-1)]
        more = np.bincount(ids[np.repeat(~held, sizes)], minlength=len(known))
        more[:len(count)] += count
        count, size = more, size + len(ids)
        yield table_rows(LOCAL, 1, g=task << 24 | blocks, kind=DOCS, at=0, doc_ids=one_list(batch.column(1)), held=one_list(batch.column(2)),
                         sizes=one_list(sizes.astype(np.int64)), ids=[packed_words(ids)])
        if size >= block:
            yield from vocabulary()
            known, number, count, size, blocks = known[:0], number[:0], count[:0], 0, blocks + 1
    yield from vocabulary()


# ---------------------------------------------- blocks: global numbers, questions
GLOBAL = pa.schema([("g", pa.int64()), ("kind", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())),
                    ("known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("ids", pa.binary()), ("bucket", pa.int64()), ("keys", pa.binary()),
                    ("counts", pa.binary())])
GLOBAL_SQL = ("g long, kind int, doc_ids array<long>, held array<boolean>, sizes array<long>, known array<long>, base array<double>, ids binary, bucket long, "
              "keys binary, counts binary")


def by_block(batches: Iterator[pa.RecordBatch], starts: Callable, row: Callable, ends: Callable) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block (column 0) and kind (column 1): calls row(batch of one block and kind, kind), around it starts(g) and ends()."""
    here = None
    for batch in batches:
        g, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((g[1:] != g[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(g)]):
            if a == b:
                continue
            if g[a] != here:
                if here is not None:
                    yield from ends()
                here = int(g[a])
                starts(here)
            yield from row(batch.slice(a, b - a), int(kind[a]))
    if here is not None:
        yield from ends()


def asked_in_blocks(model) -> Callable:
    """Mapped words, then documents of each block -> documents in global numbers, held-out contexts, bigrams by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Unigrams = model.value
        state = {}
        log_base = np.log10(m.total + 0.1 * (m.words + 1))

        def starts(g):
            state.update(g=g, words=[], table=None, ids=[], sizes=[], held=[])

        def row(part, kind):
            if kind == MAPPED:
                state["words"].append(part.column(3).to_numpy(zero_copy_only=False))
                return
            if state["table"] is None:
                state["table"] = np.concatenate(state["words"]).astype(np.int32)
            for i in range(part.num_rows):
                doc_ids, held, sizes = (part.column(c)[i].values for c in (4, 5, 6))
                ids, counts = state["table"][unpacked_words(part.column(7)[i].as_py())], sizes.to_numpy()
                at = np.cumsum(counts) - counts
                base = np.add.reduceat(np.log10(m.count(ids) + 0.1) - log_base, at)
                for name, value in (("ids", ids), ("sizes", counts), ("held", held.to_numpy(zero_copy_only=False))):
                    state[name].append(value)
                yield table_rows(GLOBAL, 1, g=state["g"], kind=DOCS, doc_ids=one_list(doc_ids), held=one_list(held), sizes=one_list(sizes),
                                 base=one_list(base), known=one_list(np.add.reduceat((ids >= 0).astype(np.int64), at)), ids=[packed_words(ids)])

        def ends():
            if not state["ids"]:
                return
            ids, sizes = np.concatenate(state["ids"]), np.concatenate(state["sizes"])
            held = np.repeat(np.concatenate(state["held"]), sizes)
            before, keys, bucket, where = bigrams(m, ids, np.cumsum(sizes) - sizes)
            counts = np.bincount(where[~held & (where >= 0)], minlength=len(keys))
            contexts = np.unique(before[held & (before >= 0)])
            yield table_rows(GLOBAL, 1, g=state["g"], kind=ASKED, keys=[packed(contexts)])
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ranges = list(zip(cuts, np.append(cuts[1:], len(keys))))
            yield table_rows(GLOBAL, len(cuts), g=state["g"], kind=PAIRS, bucket=bucket[cuts], keys=[packed(keys[a:b]) for a, b in ranges],
                             counts=[packed(counts[a:b]) for a, b in ranges])
        return by_block(batches, starts, row, ends)
    return run


# ------------------------------------------------------------- buckets: bigrams
MERGED = pa.schema([("kind", pa.string()), ("g", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary()), ("context", pa.list_(pa.int32())),
                    ("word", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())), ("total", pa.list_(pa.int64())), ("types", pa.list_(pa.list_(pa.int64()))),
                    ("lower", pa.list_(pa.float64()))])
MERGED_SQL = ("kind string, g long, bucket long, counts binary, context array<int>, word array<int>, n array<long>, total array<long>, "
              "types array<array<long>>, lower array<double>")


def merged(model) -> Callable:
    """Blocks' bigrams by bucket -> answers to the blocks, the bucket's part of the bigram table, sums by context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Unigrams = model.value
        state = {}

        def starts(bucket):
            state.update(bucket=bucket, g=[], keys=[], counts=[])

        def row(part, _):
            state["g"] += part.column(2).to_pylist()
            state["keys"] += [unpacked(x).view(np.uint64) for x in part.column(3).to_pylist()]
            state["counts"] += [unpacked(x) for x in part.column(4).to_pylist()]
            return ()

        def ends():
            sizes = [len(k) for k in state["keys"]]
            keys, at = np.unique(np.concatenate(state["keys"]), return_inverse=True)
            at = at.reshape(-1)
            n = np.bincount(at, np.concatenate(state["counts"]).astype(np.float64), len(keys)).astype(np.int64)
            bucket, end = state["bucket"], np.cumsum(sizes)
            yield table_rows(MERGED, len(sizes), kind="answer", g=state["g"], bucket=bucket, counts=[packed(n[at[e - s:e]]) for s, e in zip(sizes, end)])
            keys, n = keys[n > 0], n[n > 0]
            context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                one = [len(keys[part])]
                yield table_rows(MERGED, 1, kind="bigrams", bucket=bucket, context=lists(context[part], one, pa.int32()),
                                 word=lists(word[part], one, pa.int32()), n=lists(n[part], one, pa.int64()))
            first = np.flatnonzero(np.diff(context, prepend=-1))
            if not len(first):
                return
            owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
            types = np.bincount(owner * (LOW + 1) + np.minimum(n, LOW + 1) - 1, minlength=len(first) * (LOW + 1))
            total, lower = np.add.reduceat(n, first), np.add.reduceat(m.probability(word), first)
            for k in range(0, len(first), 1 << 16):
                some = first[k:k + (1 << 16)]
                one, part = [len(some)], slice(k, k + (1 << 16))
                inner = lists(types[k * (LOW + 1):(k + len(some)) * (LOW + 1)], [LOW + 1] * len(some), pa.int64())
                offsets = pa.array(np.array([0, len(some)], np.int32))
                yield table_rows(MERGED, 1, kind="contexts", bucket=bucket, context=lists(context[some], one, pa.int32()), total=lists(total[part], one, pa.int64()),
                                 types=pa.ListArray.from_arrays(offsets, inner), lower=lists(lower[part], one, pa.float64()))
        return by_block(batches, starts, row, ends)
    return run


# ------------------------------------------------------------------ evaluation
def evaluated(model, lost2) -> Callable:
    """Answers, weights, then documents of each block -> a score per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Unigrams = model.value
        state = {}

        def starts(g):
            state.update(counts=[], context=[], weight=[], docs=[])

        def row(part, kind):
            if kind == ANSWERS:
                state["counts"] += [unpacked(x) for x in part.column(3).to_pylist()]
            elif kind == WEIGHTS:
                state["context"].append(part.column(2).to_numpy(zero_copy_only=False))
                state["weight"].append(part.column(4).to_numpy(zero_copy_only=False))
            else:
                state["docs"].append(part)
            return ()

        def ends():
            if not state["docs"]:
                return
            ids = np.concatenate([unpacked_words(x) for p in state["docs"] for x in p.column(10).to_pylist()])
            sizes = np.concatenate([p.column(7).flatten().to_numpy() for p in state["docs"]])
            at = np.cumsum(sizes) - sizes
            before, keys, _, where = bigrams(m, ids, at)
            counts = np.concatenate([*state["counts"], np.zeros(1, np.int64)])  # the last stands for unknown bigrams
            known = np.concatenate(state["context"]) if state["context"] else np.zeros(0, np.int64)  # in order
            alpha = np.concatenate(state["weight"]) if state["context"] else np.zeros(0)
            log = np.empty(len(ids))
            for k in range(0, len(ids), 1 << 18):  # a step at a time, for memory
                part = slice(k, k + (1 << 18))
                count, context = counts[where[part]], before[part].astype(np.int64)
                total = np.maximum(m.context_count(np.maximum(context, 0)), 1)
                seen = (count - lost2[np.clip(count, 1, LOW + 1) - 1]) / total
                weight = np.ones(len(count))
                if len(known):
                    place = np.minimum(np.searchsorted(known, context), len(known) - 1)
                    weight = np.where(known[place] == context, alpha[place], 1.0)
                log[part] = np.log10(np.where(count > 0, seen, weight * m.probability(ids[part].astype(np.int64))))
            score, first = np.add.reduceat(log, at), 0
            for p in state["docs"]:
                doc_ids, held, n, known, base = (p.column(c).flatten() for c in (5, 6, 7, 8, 9))
                part = slice(first, first + len(n))
                yield pa.RecordBatch.from_arrays([doc_ids, held, n, known, base, pa.array(score[part])], schema=schema)
                first += len(n)
        return by_block(batches, starts, row, ends)
    return run


# ------------------------------------------------------------------------ jobs
@dataclass
class Katz:
    """A trained model's tables, and the blocks of the documents it was given."""

    unigrams: Unigrams
    words: DataFrame  # hash, word (a number), n
    merged: DataFrame
    blocks: DataFrame
    contexts: DataFrame  # context (a word's number; the number of words is the begin), total, weight
    lost: np.ndarray
    shared: object

    def bigrams(self) -> DataFrame:
        """(context, word, n) of the bigrams trained on."""
        rows = self.merged.where("kind = 'bigrams'").select(F.explode(F.arrays_zip("context", "word", "n")).alias("r"))
        return rows.select("r.*")


def train(docs: DataFrame, folds: int = 10, block: int = BLOCK, bucket: int = BUCKET) -> Katz:
    """Learn from the rows that aren't held out; all rows' blocks are prepared for scoring."""
    spark = docs.sparkSession
    small_batches(spark)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.spark_partition_id().cast("long").alias("task"), doc_id.alias("doc_id"), held_out(doc_id, folds).alias("held"), tokens().alias("w"))
    local = stored(rows.mapInArrow(lambda b: localised(b, block), LOCAL_SQL), "local", "zstd")
    found = local.where(F.col("kind") == MAPPED).select("g", "at", F.posexplode(F.arrays_zip("hashes", "counts")).alias("i", "r"))
    found = found.select("g", (F.col("at") + F.col("i")).alias("at"), F.col("r.hashes").alias("hash"), F.col("r.counts").alias("n"))
    counted = stored(found.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 0").withColumn("falling", -F.col("n")), "counted")
    words = numbered(counted, ["falling", "hash"], "word", "words").select("hash", "word", "n")
    forget(counted)
    steps = words.groupBy("n").agg(F.min("word").alias("first"), F.count("*").alias("types")).orderBy("first").collect()  # sqrt(2 N) rows at most
    total, distinct = sum(r.n * r.types for r in steps), sum(r.types for r in steps)
    if distinct > 2 ** 31 - 3:
        raise ValueError("more distinct words than 32-bit numbers")
    documents = local.where(F.col("kind") == DOCS).agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    model = Unigrams(total, documents, distinct, np.array([r.first for r in steps], np.int64), np.array([r.n for r in steps], np.int64),
                     max(1, -(-total // bucket)))
    shared = spark.sparkContext.broadcast(model)

    none = F.lit(None)
    mapped = found.join(words.select("hash", "word"), "hash", "left").select(
        "g", F.lit(MAPPED).alias("kind"), "at", F.coalesce("word", F.lit(-1)).cast("long").alias("word"), none.cast("array<long>").alias("doc_ids"),
        none.cast("array<boolean>").alias("held"), none.cast("array<long>").alias("sizes"), none.cast("binary").alias("ids"))
    texts = local.where(F.col("kind") == DOCS).select("g", "kind", "at", none.cast("long").alias("word"), "doc_ids", "held", "sizes", "ids")
    rows = mapped.union(texts).repartition("g").sortWithinPartitions("g", "kind", "at")
    blocks = stored(rows.mapInArrow(asked_in_blocks(shared), GLOBAL_SQL), "blocks", "zstd")
    forget(local)

    pairs = blocks.where(F.col("kind") == PAIRS).select("bucket", F.lit(0).alias("kind"), "g", "keys", "counts")
    pairs = pairs.repartition("bucket").sortWithinPartitions("bucket", "g")
    sums = stored(pairs.mapInArrow(merged(shared), MERGED_SQL), "merged", "zstd")
    each = sums.where("kind = 'contexts'").select(F.explode(F.arrays_zip("context", "total", "types", "lower")).alias("r")).select("r.*")
    by_count = [F.sum(F.col("types")[i]).alias(f"t{i}") for i in range(LOW + 1)]
    each = stored(each.groupBy("context").agg(F.sum("total").alias("total"), F.sum("lower").alias("lower"), *by_count), "contexts", "zstd")
    of_five = each.agg(*(F.sum(f"t{i}") for i in range(LOW))).first()
    of_six = sums.where("kind = 'bigrams'").agg(F.sum(F.size(F.filter("n", lambda x: x == LOW + 1)))).first()[0]
    lost = lost_mass([int(x or 0) for x in (*of_five, of_six)])
    free = sum((F.col(f"t{i}") * float(lost[i]) for i in range(LOW + 1)), F.lit(0.0)) / F.col("total")
    contexts = each.select("context", "total", (free / (1 - F.col("lower"))).alias("weight"))
    return Katz(model, words, sums, blocks, contexts, lost, shared)


def scores(model: Katz) -> DataFrame:
    """A row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    none = F.lit(None)

    def rows(kind: int, source: DataFrame, **columns: Column) -> DataFrame:
        kinds = {"at": "long", "counts": "binary", "weight": "double", "doc_ids": "array<long>", "held": "array<boolean>", "sizes": "array<long>",
                 "known": "array<long>", "base": "array<double>", "ids": "binary"}
        return source.select("g", F.lit(kind).alias("kind"), *(columns.get(c, none).cast(t).alias(c) for c, t in kinds.items()))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, data in zip(batch.column(0), batch.column(1)):
                words = unpacked(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), g.as_py())), pa.array(words.astype(np.int32))], ["g", "context"])

    asked = model.blocks.where(F.col("kind") == ASKED).select("g", "keys").mapInArrow(contexts, "g long, context int")
    weights = asked.join(model.contexts, "context")
    docs = model.blocks.where(F.col("kind") == DOCS)
    every = rows(ANSWERS, model.merged.where("kind = 'answer'"), at=F.col("bucket"), counts=F.col("counts"))
    every = every.union(rows(WEIGHTS, weights, at=F.col("context"), weight=F.col("weight")))
    every = every.union(rows(WEIGHTS + 1, docs, **{c: F.col(c) for c in ("doc_ids", "held", "sizes", "known", "base", "ids")}))
    every = every.repartition("g").sortWithinPartitions("g", "kind", "at")
    out = every.mapInArrow(evaluated(model.shared, model.lost), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.unigrams.total).cast("long").alias("train_tokens"), "base_score", "score")
