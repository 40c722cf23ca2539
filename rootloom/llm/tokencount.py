"""Token counts under a unigram vocabulary, with forward scores shared by the prefixes of a trie.

A text is cut into pre-tokens (a run without white space with the space before it, or a run of white space). A pre-token's
count is that of its cheapest segmentation into pieces; among equally cheap ones, the fewest pieces. The cheapest cost of
a prefix doesn't depend on what follows, so the distinct pre-tokens are inserted in a trie and each node's forward cost is
computed once, from the nodes above it. In sorted order the trie is walked depth first: only the costs along the
current path are held. Terminal nodes leave their count in a store that later pre-tokens of the task look up.

Tries belong to a task (sharing a trie between machines would cost a shuffle of all words, more than it saves), so no row
moves and a hot word is a lookup. The store is emptied at `store_words`, which changes no result.

The vocabulary file gives ranks, not probabilities; a piece costs round(1024 ln(rank + 2)), its place under Zipf's law.
Costs are whole numbers: ties are exact. Bytes that no piece covers cost as much as the rarest piece each.

Defined cases: null and empty texts have no pre-tokens and no tokens; repeated rows get the same counts; an empty table
stays empty; only id and text are looked at.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PRE_TOKEN = re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+")
#: A cost holds the number of pieces in its low bits.
COUNT_BITS = 28


def load_pieces(path: str = VOCABULARY) -> dict[bytes, int]:
    """Costs of the pieces in a file of base64 pieces and ranks, one a line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return {piece: round(1024 * math.log(rank + 2)) for piece, rank in ranks.items()}


class Counter:
    """Counts of pre-tokens under a vocabulary."""

    def __init__(self, pieces: dict[bytes, int], store_words: int = 1 << 19):
        self.cost = {p: (c << COUNT_BITS) + 1 for p, c in pieces.items()}
        self.unknown = (max(pieces.values(), default=1) << COUNT_BITS) + 1
        self.endings = {p[i:] for p in pieces for i in range(len(p))}
        self.counts: dict[bytes, int] = {}
        self.store_words = store_words
        self.nodes = 0

    def insert(self, words: set[bytes]) -> None:
        """Walk the trie of the words, leave the counts of its terminal nodes in the store."""
        cost, endings, unknown = self.cost, self.endings, self.unknown
        path, previous = [0], b""
        mask = (1 << COUNT_BITS) - 1
        for word in sorted(words):
            depth, end = 0, min(len(word), len(previous))
            if word[:end] == previous[:end]:
                depth = end
            else:
                while word[depth] == previous[depth]:
                    depth += 1
            del path[depth + 1:]
            for d in range(depth + 1, len(word) + 1):
                best = path[d - 1] + unknown
                for a in range(d - 1, -1, -1):
                    piece = word[a:d]
                    if piece not in endings:
                        break
                    if piece in cost and path[a] + cost[piece] < best:
                        best = path[a] + cost[piece]
                path.append(best)
            self.nodes += len(word) - depth
            self.counts[word] = path[len(word)] & mask
            previous = word

    def count(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        split = [PRE_TOKEN.findall(t) for t in texts]
        if len(self.counts) > self.store_words:
            self.counts.clear()
        fresh = set().union(*split) - self.counts.keys()
        self.insert(fresh)
        get = self.counts.__getitem__
        return [(len(words), sum(map(get, words))) for words in split]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, chunk_bytes: int = 4 << 20, store_words: int = 1 << 19) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every row."""
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))  # a fixed file of about 50,000 pieces
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        counter = Counter(pieces.value, store_words)
        for batch in batches:
            texts, out, size, chunk = batch.column(1), [], 0, []
            for t in texts:
                chunk.append(t.as_py())
                size += len(chunk[-1])
                if size >= chunk_bytes:
                    out += counter.count(chunk)
                    size, chunk = 0, []
            out += counter.count(chunk)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], pa.int64()) for i in (0, 1))],
                                             ["doc_id", "n_pretokens", "n_tokens"])

    return rows.mapInArrow(count, f"doc_id {kind}, n_pretokens long, n_tokens long")
