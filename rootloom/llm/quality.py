"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover all of it. Each byte has a learned vector, learned filters slide over
`width` bytes, each filter's largest answer within a chunk is the chunk's feature. Over the chunks of a document the
largest and the mean of each feature are combined into one probability that a reader would label it good.

The filters, vectors and weights are fitted by Adam on a bounded sample of labelled rows: at most `per_class` rows per label, in hash
order, weighted back to the counts over all labelled rows. Equal texts of an id count once. Every chunk of a sampled text is learned
from; should the texts of a label exceed `most_bytes`, rows that don't fit any more, in the order of a hash of id and text, are left out whole; a label
of which no row fits is an error.
Scoring has no bound: it runs inside the tasks over every chunk of every text.

Defined cases: null and empty texts are one chunk of padding and get a score; labels without a text or quality are not
learned from; where only one label is known the score is its share; repeated rows get equal scores; rows with a null id
are never learned from; an empty table stays empty. Only the text enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import stored, text_of


@dataclass(frozen=True)
class Shape:
    chunk: int = 512
    overlap: int = 16
    width: int = 10
    stride: int = 2
    vector: int = 6
    filters: int = 32


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5 (null: as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(5))


def chunks_of(text: bytes, shape: Shape, most: int | None = None):
    """The chunks (rows of bytes) that cover a text, the last one padded with zeros; `most`: so many, evenly spaced."""
    step = shape.chunk - shape.overlap
    count = max(1, -(-(len(text) - shape.overlap) // step))
    data = np.zeros((count - 1) * step + shape.chunk, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(data, shape.chunk)[::step]
    return rows if most is None or count <= most else rows[np.linspace(0, count - 1, most).round().astype(int)]


class Network:
    def __init__(self, shape: Shape, seed: int, bias: float):
        rng = np.random.default_rng(seed)
        self.shape = shape
        size = shape.width * shape.vector
        self.p = {"vectors": rng.normal(0, 0.5, (256, shape.vector)), "filters": rng.normal(0, 1 / np.sqrt(size), (size, shape.filters)),
                  "shift": np.zeros(shape.filters), "weights": rng.normal(0, 0.05, 2 * shape.filters), "bias": np.full(1, bias)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        self.steps = 0

    def windows(self, chunks):
        s = self.shape
        seen = self.p["vectors"][chunks]
        view = np.lib.stride_tricks.sliding_window_view(seen, (s.width, s.vector), axis=(1, 2))[:, ::s.stride, 0]
        return view.reshape(len(chunks), -1, s.width * s.vector)

    def features(self, chunks, batch: int = 64):
        """Largest answer of each filter in each chunk."""
        out = [(self.windows(chunks[i:i + batch]) @ self.p["filters"]).max(axis=1) for i in range(0, len(chunks), batch)]
        return np.tanh(np.concatenate(out) + self.p["shift"])

    def combine(self, features, begins):
        """Logits of the documents whose chunks begin at `begins`."""
        sizes = np.diff(np.append(begins, len(features)))
        both = np.concatenate([np.maximum.reduceat(features, begins), np.add.reduceat(features, begins) / sizes[:, None]], axis=1)
        return both @ self.p["weights"] + self.p["bias"][0]

    def score(self, texts: list[bytes]):
        parts = [chunks_of(t, self.shape) for t in texts]
        begins = np.cumsum([0] + [len(p) for p in parts])[:-1]
        logit = self.combine(self.features(np.concatenate(parts)), begins)
        return 1 / (1 + np.exp(-logit.astype(np.float64)))

    def train_step(self, parts, labels, weights, rate: float) -> None:
        s, begins = self.shape, np.cumsum([0] + [len(p) for p in parts])[:-1]
        chunks = np.concatenate(parts)
        sizes = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        pieces = [slice(i, i + 64) for i in range(0, len(chunks), 64)]  # windows are far larger than chunks
        best, top = [], []
        for i in pieces:
            answers = self.windows(chunks[i]) @ self.p["filters"]
            best.append(answers.argmax(axis=1))
            top.append(np.take_along_axis(answers, best[-1][:, None], 1)[:, 0])
        best, f = np.concatenate(best), np.tanh(np.concatenate(top) + self.p["shift"])
        peak = np.maximum.reduceat(f, begins)
        both = np.concatenate([peak, np.add.reduceat(f, begins) / sizes[:, None]], axis=1)
        logit = both @ self.p["weights"] + self.p["bias"][0]
        error = (weights * (1 / (1 + np.exp(-logit)) - labels) / weights.sum()).astype(np.float32)
        w_peak, w_mean = np.split(self.p["weights"], 2)
        d = error[owner][:, None] * (w_mean / sizes[owner][:, None] + w_peak * (f == peak[owner])) * (1 - f * f)
        vectors, filters = np.zeros((256, s.vector)), np.zeros_like(self.p["filters"])
        for i in pieces:
            part = chunks[i]
            bytes_at = part[np.arange(len(part))[:, None, None], best[i][:, :, None] * s.stride + np.arange(s.width)]
            at = self.p["vectors"][bytes_at].reshape(len(part), s.filters, -1)  # chunk, filter, window
            flat = (d[i][:, :, None] * self.p["filters"].T[None]).reshape(-1, s.vector)
            vectors += np.stack([np.bincount(bytes_at.ravel(), flat[:, j], 256) for j in range(s.vector)], axis=1)
            filters += np.einsum("cf,cfw->wf", d[i], at)
        grads = {"vectors": vectors, "filters": filters, "shift": d.sum(0), "weights": both.T @ error, "bias": error.sum(keepdims=True)}
        self.steps += 1
        for k, g in grads.items():
            m, v = self.moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[k] -= (rate * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-7)).astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, shape: Shape, per_class: int, most_bytes: int, buckets: int = 4096):
    """(chunks, label, weight) of the bounded sample, in a fixed order."""
    usable = labels.where((fold() != 0) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r[0]: r[1] for r in usable.groupBy("quality").count().collect()}
    chosen = None
    for q in (0, 1):
        some = usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)

    rows = docs.select("doc_id", text_of().cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")  # 2 x per_class ids at most
    rows = rows.select(F.col("doc_id").cast("long"), "text", "quality").distinct()
    rows = stored(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets))), "quality-sample")
    sizes = rows.groupBy("quality", "bucket").agg(F.sum(F.length("text")).alias("bytes")).collect()  # 2 x buckets rows at most
    fits = F.lit(False)
    for q in (0, 1):
        total, taken = 0, []
        for r in sorted((r for r in sizes if r["quality"] == q), key=lambda r: r["bucket"]):
            if total + r["bytes"] <= most_bytes:  # one that doesn't fit is left out, those after it may fit
                total += r["bytes"]
                taken.append(r["bucket"])
        if not taken and any(r["quality"] == q for r in sizes):
            raise ValueError(f"no labelled text of quality {q} fits into most_bytes = {most_bytes}")
        fits = fits | ((F.col("quality") == q) & F.col("bucket").isin(taken))
    rows = sorted(rows.where(fits).collect(), key=lambda r: (r["doc_id"], r["quality"], bytes(r["text"])))
    have = {q: sum(r["quality"] == q for r in rows) for q in (0, 1)}
    return [(chunks_of(bytes(r["text"]), shape), r["quality"], counts[r["quality"]] / have[r["quality"]]) for r in rows], counts


def fit(docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), per_class: int = 2500, most_bytes: int = 32 << 20, epochs: int = 6,
        rate: float = 0.01, seed: int = 7) -> Network:
    """Learn from the labelled rows outside the held-out fold."""
    rows, counts = training_rows(docs, labels, shape, per_class, most_bytes)
    good, bad = counts.get(1, 0), counts.get(0, 0)
    net = Network(shape, seed, float(np.log((good + 1) / (bad + 1))))
    if not good or not bad or len({r[1] for r in rows}) < 2:
        net.p["weights"][:] = 0
        return net
    rng, size = np.random.default_rng(seed), 32
    total = epochs * -(-len(rows) // size)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), size):
            part = [rows[j] for j in order[i:i + size]]
            slower = rate * max(0.02, 1 - net.steps / total)
            net.train_step([p[0] for p in part], np.array([p[1] for p in part], np.float32), np.array([p[2] for p in part], np.float32), slower)
    return net


def with_score(docs: DataFrame, net: Network, name: str = "score", chunk_bytes: int = 1 << 20) -> DataFrame:
    """docs with the probability of label 1 as a further column."""
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in net.p.items()})
    shape = net.shape

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = Network(shape, 0, 0.0)
        model.p = shared.value
        out, part, size = [], [], 0
        for t in texts:
            part.append(t.as_py())
            size += len(part[-1])
            if size >= chunk_bytes:
                out.append(model.score(part))
                part, size = [], 0
        if part:
            out.append(model.score(part))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(name, score(text_of().cast("binary")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, **options))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows that the classifier does not reject, all columns as they were."""
    scored = with_score(docs.select(F.struct("*").alias("row"), "text"), fit(docs, labels, **options))
    return scored.where(F.col("score") >= threshold).select("row.*")
