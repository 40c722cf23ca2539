"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the weighted set of its shingles (five words in a row; fewer words are one shingle); a shingle's weight is the number of
times it occurs, and similarity is the weighted Jaccard index (the plain one where no shingle repeats).

Darts fall on the plane of (element and weight) x rank at a rate of one per unit, the same for every document: each cell
of one element and one unit of weight has its own sequence of arrivals, derived from hashes. A document owns the strips up to
its weights and looks only at ranks below t / total weight, which holds about t darts however long it is. Every dart
belongs to a hashed coordinate; the earliest dart of each coordinate is the signature. Where a coordinate stays empty
the rank limit doubles.

Documents with the same words are one node. Nodes that agree in a whole band meet in a bucket. Candidates are formed in two steps, never
as all pairs. First everybody is verified against one hub: of the most central members of its buckets (those that meet most others) the one it shares most
bands with. Then, in buckets whose members are still in different components, those outside the bucket's largest component are
hubs and all members stream past them; a task holds hubs up to a number of words, so most buckets are one task's. A pair left out was
already connected, so no link between components is lost. Every candidate is verified on the whole texts, in the second step inside the
tasks, by counting common shingles of many pairs at once. Links are contracted to components in Spark.

Defined cases: documents without words are copies of each other; rows of one id with different texts are different
documents; a null id counts as the smallest and is the class id null; repeated rows are copies; an empty table stays
empty; columns besides id and text are passed through (dedup) or not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import LEAST_ID, SPACE, slices, small_batches, stored, text_of, window_hashes, word_hashes
from rootloom.llm.linededup import mix

SHINGLE, BANDS, ROWS = 5, 30, 5
SLOTS = 2 ** 20
BASE = 0xD6E8FEB86659FD93
#: Cells of a matrix that a task holds.
CELLS = 2 ** 23


# ----------------------------------------------------------------- signatures
def shingles(words, sizes, length: int = SHINGLE):
    """(hash, document) of every shingle of the documents whose word hashes stand in a row."""
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    counts = np.where(sizes >= length, sizes - length + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), counts)
    at = begins[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    h = window_hashes(words, length, BASE)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((sizes > 0) & (sizes < length))
    whole = np.zeros(len(short), np.uint64)
    for k in range(length - 1):  # words of short documents, place by place
        there = sizes[short] > k
        whole[there] = whole[there] * np.uint64(BASE) + words[begins[short[there]] + k]
    whole = mix(whole ^ sizes[short].astype(np.uint64), 5)
    return np.concatenate([h, whole]), np.concatenate([doc, short])


def weighted(h, doc):
    """Distinct (element, document) with the number of times it occurs."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return h[at], doc[at], np.diff(np.append(at, len(h))).astype(np.float64)


def uniform(h):
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def signatures(elements, doc, weights, documents: int, k: int, seed: int = 1):
    """Earliest dart of each coordinate, k per document; documents without weight have zeros."""
    out = np.zeros((documents, k), np.uint64)
    total = np.bincount(doc, weights, documents)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(documents)
    limit[todo] = k * (np.log(k) + 3) / total[todo]
    # a cell for each begun unit of weight
    units = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), units)
    unit = np.arange(len(owner)) - np.repeat(np.cumsum(units) - units, units)
    cells = mix(elements[owner] ^ mix(unit.astype(np.uint64), seed), seed)
    width, cell_doc = np.minimum(weights[owner] - unit, 1.0), doc[owner]
    while len(todo):
        active = np.flatnonzero(np.isin(cell_doc, todo)) if len(todo) < documents else np.arange(len(cells))
        rank, number, found = np.zeros(len(active)), 0, []
        while len(active):
            draw = mix(cells[active], 1000 + number)
            rank = rank - np.log1p(-uniform(draw))
            near = rank < limit[cell_doc[active]]
            active, rank, draw, number = active[near], rank[near], draw[near], number + 1
            inside = uniform(mix(draw, 2)) < width[active]
            found.append((rank[inside], draw[inside], cell_doc[active[inside]]))
        rank, draw, at = (np.concatenate(x) for x in zip(*found))
        slot = at * k + (mix(draw, 3) % np.uint64(k)).astype(np.int64)
        order = np.argsort(rank)[::-1]
        flat = out.reshape(-1)
        flat[slot[order]] = mix(draw[order], 4) | np.uint64(1)  # the earliest is written last
        empty = (out[todo] == 0).any(axis=1)
        todo = todo[empty]
        limit[todo] *= 2
    return out


def node() -> Column:
    """128 bits of the words: the node of a document."""
    return F.unhex(F.md5(F.array_join(F.array_remove(F.split(text_of(), SPACE), ""), " ")))


def band_rows(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(bucket, node): one row per band of every document with words."""
    def keys(batches: Iterator) -> Iterator:
        for batch in (part for whole in batches for part in slices(whole, 1, 1 << 18)):
            lists = batch.column(1)
            words, sizes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False)
            some = np.flatnonzero(sizes)
            sig = signatures(*weighted(*shingles(words, sizes)), len(sizes), bands * rows)[some].reshape(len(some), bands, rows)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), sig.shape[:2]).copy()
            for i in range(rows):
                key = mix(key ^ sig[:, :, i], 9)
            nodes = batch.column(0).take(pa.array(np.repeat(some, bands)))
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), nodes], ["bucket", "node"])

    return docs.select(node().alias("node"), word_hashes().alias("w")).mapInArrow(keys, "bucket long, node binary")


# --------------------------------------------------------------- verification
def similarity(a, b) -> float:
    """Weighted Jaccard index of the shingles of two texts, from their word hashes."""
    (h, doc) = shingles(np.concatenate([a, b]), np.array([len(a), len(b)]))
    x, nx = np.unique(h[doc == 0], return_counts=True)
    y, ny = np.unique(h[doc == 1], return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(nx[i], ny[j]).sum()
    return float(both) / max(1, int(nx.sum() + ny.sum() - both))


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (x, y) of nodes that are similar enough."""
    @F.arrow_udf("double")
    def jaccard(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([similarity(np.asarray(x.values).view(np.uint64), np.asarray(y.values).view(np.uint64)) for x, y in zip(a, b)], pa.float64())

    x = texts.select(F.col("node").alias("x"), F.col("text").alias("tx"))
    y = texts.select(F.col("node").alias("y"), F.col("text").alias("ty"))
    rows = pairs.join(x, "x").join(y, "y").select("x", "y", word_hashes("tx").alias("a"), word_hashes("ty").alias("b"))
    return rows.where(jaccard("a", "b") >= least).select("x", "y")


# ----------------------------------------------------------------- components
def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that links connect with each node; edges are contracted until none is left."""
    labels, edges = nodes.select("node", F.col("node").alias("comp")), links.select("x", "y")
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        parent = both.groupBy("x").agg(F.min("y").alias("p")).select("x", F.least("x", "p").alias("p"))
        again = parent.select(F.col("x").alias("p"), F.col("p").alias("q"))
        parent = stored(parent.join(again, "p", "left").select("x", F.coalesce("q", "p").alias("p")), "parents")
        to = parent.select(F.col("x").alias("comp"), "p")
        labels = stored(labels.join(to, "comp", "left").select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        ends = edges.join(parent, "x").select(F.col("p").alias("x"), "y").join(parent.select(F.col("x").alias("y"), "p"), "y")
        edges = stored(ends.select("x", F.col("p").alias("y")).where("x != y").distinct(), "edges")
    return labels


def near_classes(docs: DataFrame, least: float = 0.8, bands: int = BANDS, rows: int = ROWS, hub_words: int = 2 ** 20) -> DataFrame:
    """(node, comp) of the nodes that are linked with another one."""
    small_batches(docs.sparkSession)
    keys = band_rows(docs, bands, rows).distinct()
    keys = stored(keys, "bands")
    # buckets with the same members say the same: one of them is kept
    one, two = F.bit_xor(F.xxhash64("node")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("m2")
    shared = keys.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"), one, two).where("lo < hi")
    shared = shared.groupBy("m1", "m2", "n", "lo").agg(F.min("bucket").alias("bucket"), F.count("*").alias("same"))
    members = stored(keys.join(shared.select("bucket", "n", "same"), "bucket"), "members")
    nodes = members.groupBy("node").agg(F.sum(F.col("n") * F.col("same")).alias("meets"))
    slot = F.pmod(F.xxhash64("node"), F.lit(SLOTS)).cast("int").alias("slot")
    near = docs.select(node().alias("node"), text_of().alias("text")).withColumn("slot", slot)
    near = near.join(F.broadcast(nodes.select(slot).distinct()), "slot", "left_semi")  # at most SLOTS numbers
    texts = near.groupBy("node").agg(F.first("text").alias("text")).join(nodes, "node", "left_semi")
    texts = stored(texts.withColumn("words", F.size(word_hashes()) + 16), "texts")
    central = members.select("bucket", "node", "same").join(nodes, "node").groupBy("bucket").agg(
        F.max(F.struct("meets", "node"))["node"].alias("hub"))
    shares = members.select("bucket", "node", "same").join(central, "bucket").where("node != hub").groupBy("node", "hub").agg(F.sum("same").alias("n"))
    nearest = shares.groupBy("node").agg(F.min(F.struct(-F.col("n"), "hub")).alias("best"))  # the hub of most bands
    pairs = stored(nearest.select(F.col("best.hub").alias("x"), F.col("node").alias("y")), "pairs")
    links = stored(verified(pairs, texts, least), "links")
    labels = components(nodes, links)
    ends = stored(links_in_buckets(members.select("bucket", "node").join(labels, "node"), texts, least, hub_words), "links")
    if not ends.isEmpty():
        merged = components(ends.select(F.col("x").alias("node")).union(ends.select("y")).distinct(), ends)
        to = merged.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        labels = stored(labels.join(to, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
    return labels.where("node != comp").union(labels.where("node != comp").select("comp", "comp").distinct())


class Hubs:
    """The hubs of a bucket in a task: finds those that are similar enough to members, many pairs at once.

    A multiset of shingles is the set of its (shingle, occurrence) elements. Elements that many hubs have are
    columns of a matrix whose product with the members counts common ones; the others are looked up in postings.
    """

    def __init__(self, words, sizes, comps, columns: int = 1024):
        elements, owner = occurrences(words, sizes)
        self.comps, self.totals = comps, np.bincount(owner, minlength=len(sizes))
        self.known, at, n = np.unique(elements, return_inverse=True, return_counts=True)
        at = at.reshape(-1)
        often = np.flatnonzero(n > max(4, len(sizes) // 16))
        often = often[np.argsort(-n[often], kind="stable")[:min(columns, CELLS // len(sizes))]]
        self.column = np.full(len(self.known), -1)
        self.column[often] = np.arange(len(often))
        dense = self.column[at] >= 0
        self.matrix = np.zeros((len(often), len(sizes)), np.float32)
        self.matrix[self.column[at[dense]], owner[dense]] = 1
        rare = np.flatnonzero(~dense)
        rare = rare[np.argsort(at[rare], kind="stable")]
        self.postings = owner[rare]
        self.first = np.searchsorted(at[rare], np.arange(len(self.known) + 1))

    def similar(self, words, sizes, least: float):
        """(member, hub) of the pairs whose weighted Jaccard index is at least that."""
        elements, owner = occurrences(words, sizes)
        totals = np.bincount(owner, minlength=len(sizes))
        place = np.minimum(np.searchsorted(self.known, elements), len(self.known) - 1)
        found = self.known[place] == elements
        place, owner = place[found], owner[found]
        dense = self.column[place] >= 0
        rows = np.zeros((len(sizes), len(self.matrix)), np.float32)
        rows[owner[dense], self.column[place[dense]]] = 1
        both = rows @ self.matrix
        counts = self.first[place + 1] - self.first[place]
        begins = np.repeat(self.first[place] - (np.cumsum(counts) - counts), counts)
        hub = self.postings[begins + np.arange(counts.sum())]
        np.add.at(both, (np.repeat(owner, counts), hub), 1)
        return np.nonzero(both >= least * (totals[:, None] + self.totals[None, :] - both))


def occurrences(words, sizes):
    """(element, document): each occurrence of a shingle in a document is an element of its own."""
    h, doc = shingles(words, sizes)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(new)
    nth = np.arange(len(h)) - np.repeat(begins, np.diff(np.append(begins, len(h))))
    return np.where(nth > 0, mix(h ^ mix(nth.astype(np.uint64), 31), 31), h), doc


def links_in_buckets(members: DataFrame, texts: DataFrame, least: float, hub_words: int) -> DataFrame:
    """(x, y): components that members of one bucket connect; members: (bucket, node, comp).

    Hubs are the members outside the largest component of their bucket. They are dealt out over tasks of about so many
    words, each of which all members stream past. No pair is a row: only links between different components leave a task.
    """
    sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    top = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp"))["comp"].alias("top"), F.count("*").alias("comps")).where("comps > 1")
    rows = stored(members.join(top.select("bucket", "top"), "bucket").select("bucket", "node", "comp", (F.col("comp") != F.col("top")).alias("hub")), "open")
    held = rows.where("hub").join(texts.select("node", "words"), "node").groupBy("bucket").agg(F.ceil(F.sum("words") / hub_words).cast("int").alias("tasks"))
    split = held.where("tasks > 1")  # the few buckets whose hubs take several tasks
    rows = rows.join(split, "bucket", "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))
    many = rows.where("tasks > 1").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    many = many.withColumn("hub", F.col("hub") & (F.pmod(F.xxhash64("node"), F.col("tasks")) == F.col("task")))
    rows = rows.where("tasks = 1").withColumn("task", F.lit(0)).unionByName(many).drop("tasks").join(texts.drop("words"), "node")
    rows = rows.select("bucket", "task", "hub", "comp", "text").repartition("bucket", "task").sortWithinPartitions("bucket", "task", F.col("hub").desc())

    def stream(batches: Iterator) -> Iterator:
        here, hubs, waiting, root = None, None, [], {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        def met(words, sizes, comps):
            out = []
            step = max(1, min(256, CELLS // len(hubs.comps)))
            for a in range(0, len(sizes), step):
                part = slice(a, a + step)
                begin, end = sizes[:a].sum(), sizes[:a + step].sum()
                member, hub = hubs.similar(words[begin:end], sizes[part], least)
                for x, y in {(comps[a + m], hubs.comps[h]) for m, h in zip(member.tolist(), hub.tolist())}:
                    if find(x) != find(y):
                        root[find(x)] = find(y)
                        out.append((min(x, y), max(x, y)))
            return out
        for whole in batches:
            for batch in slices(whole, 4, 1 << 17):
                out = []
                keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
                comps, lists = batch.column(3).to_pylist(), batch.column(4)
                cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                for a, b in zip(cuts, cuts[1:]):
                    if keys[a][:2] != here:
                        here, hubs, waiting, root = keys[a][:2], None, [], {}
                    part = lists.slice(a, b - a)
                    words = part.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    rows_ = (words, part.value_lengths().to_numpy(zero_copy_only=False), comps[a:b])
                    if keys[a][2]:
                        waiting.append(rows_)
                        continue
                    if hubs is None and waiting:
                        hubs = gathered(waiting)
                        for w in waiting:
                            out += met(*w)
                        waiting = []
                    if hubs is not None:
                        out += met(*rows_)
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.binary()) for i in (0, 1)], ["x", "y"])

    def gathered(parts):
        return Hubs(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), [c for p in parts for c in p[2]])

    return rows.select("bucket", "task", "hub", "comp", word_hashes().alias("w")).mapInArrow(stream, "x binary, y binary").distinct()


def ids() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))


def classes(docs: DataFrame, **options) -> DataFrame:
    """A row per document row: doc_id, id, node, class_key (a node), class_id (smallest id of the class), class_size."""
    rows = stored(docs.select("doc_id", ids().alias("id"), node().alias("node")), "nodes")
    comps = stored(near_classes(docs, **options), "comps")
    # nodes first, so that copies condense before they meet their component
    per = rows.groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    per = per.join(comps, "node", "left").withColumn("class_key", F.coalesce("comp", "node"))
    size = per.groupBy("class_key").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    known = per.select("node", "class_key").join(size, "class_key")
    return rows.join(known, "node").select("doc_id", "id", "node", "class_key", "class_id", "class_size")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """The row with the smallest id of each class (ties: the smallest node; equal rows: one of them), all columns as they were."""
    found = stored(classes(docs, **options).groupBy("class_key", "class_size", "id", "node").agg(F.count("*").alias("n")), "classes")
    best = found.groupBy("class_key").agg(F.min(F.struct("id", "node")).alias("best"))
    found = found.where("class_size > 1").join(best, "class_key")
    keeps = (F.col("id") == F.col("best.id")) & (F.col("node") == F.col("best.node"))
    gone, repeated = found.where(~keeps).select("id", "node"), found.where(keeps & (F.col("n") > 1)).select("id", "node")
    row, slot = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.pmod(F.xxhash64("id", "node"), F.lit(SLOTS)).cast("int").alias("slot")
    packed = docs.select(row.alias("row"), ids().alias("id"), node().alias("node")).withColumn("slot", slot)
    touched = F.broadcast(gone.union(repeated).select(slot).distinct())  # at most SLOTS numbers
    rest = packed.join(touched, "slot", "left_anti").select("row")
    hit = packed.join(touched, "slot", "left_semi").join(gone, ["id", "node"], "left_anti")
    once = hit.join(repeated, ["id", "node"], "left_anti").select("row")
    one = hit.join(repeated, ["id", "node"], "left_semi").dropDuplicates(["id", "node"]).select("row")
    return rest.union(once).union(one).select("row.*")
