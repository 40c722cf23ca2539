"""Merkle manifest of a dataset by time-forward processing, with a membership proof for every row.

Each source is a tree: its leaves in order of id, every 16 neighbours one parent, until one node, the subroot, is left. The subroots in
order of source are the leaves of one more tree, whose top is the root.

A node's label is (level, tree, place), and every edge leads to a larger label. Upwards, nodes are processed in order of label: a
node sends its digest to its parent's label, and the messages wait in a queue ordered by label until all of a parent's have come.
The queue is external: Spark deals it out by label, sorts it on disk and takes out all messages of the least level at once. What a parent
received (its run, at most 16 digests) is kept as a table per level, a sixteenth of the one before. Then the sweep is
reversed: from the root down, each node receives the proof suffix from itself to the root and sends its children theirs, which is one
step longer. A run of leaves shares one suffix, so no leaf's whole proof is ever stored.

Defined cases: a null field is `-`; null ids come before all others and are never tampered with; rows of one id are in order of their leaf, equal rows
have equal leaves at neighbouring places; the null source is a source, ordered first; empty texts are `0:`; long texts are hashed whole;
an empty table has no rows and the root null; columns besides those hashed play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.llm.common import numbered, stored
from rootloom.session import broadcast_if_small

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:binary,right:binary>>"


def text_of_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(row: dict[str, Column]) -> Column:
    return digest(F.concat(*(field(row[name]) for name in FIELDS)))


def tampered(doc_id: Column) -> Column:
    """Whether a row is among those tampered with: five divides the CRC-32 of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, digest, altered): a leaf per row, and what it becomes with its text in lower case, if it is tampered with."""
    row = {name: F.col(name) for name in FIELDS}
    lower = row | {"text": F.translate("text", UPPER, LOWER)}
    altered = F.when(tampered(row["doc_id"]), leaf(lower))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf(row).alias("digest"), altered.alias("altered"))


# ------------------------------------------------------------------- upwards
def steps_to_top(nodes: DataFrame) -> int:
    most, steps = nodes.agg(F.max("n")).first()[0] or 1, 0
    while most > 1:
        most, steps = -(-most // FAN), steps + 1
    return steps


def received(nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(tree, place, n, run) of the parents: the messages sent to each label, in order of the senders' places."""
    message = F.struct(F.pmod("place", F.lit(FAN)).cast("int").alias("slot"), "digest", *carried)
    queue = nodes.where("n > 1").select("tree", F.floor(F.col("place") / FAN).alias("to"), F.ceil(F.col("n") / FAN).alias("n"), message.alias("m"))
    return queue.groupBy("tree", F.col("to").alias("place")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list("m")).alias("run"))


def parents(runs: DataFrame) -> DataFrame:
    together = F.array_join(F.transform("run", lambda m: text_of_digest(m["digest"])), "")
    return runs.select("tree", "place", "n", digest(together).alias("digest"))


def climb(nodes: DataFrame, name: str, carried: tuple[str, ...] = ()) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs received by each level (from the parents of the lowest nodes on) and the finished trees' tops by level (from the lowest on).

    nodes: (tree, place, n: the tree's nodes at this level, digest, carried…).
    """
    runs, tops = [], [nodes.where("n = 1").select("tree", "digest")]
    for step in range(steps_to_top(nodes)):
        runs.append(stored(received(nodes, carried if step == 0 else ()), f"{name}{step}"))
        nodes = parents(runs[-1])
        tops.append(nodes.where("n = 1").select("tree", "digest"))
    return runs, tops


# ----------------------------------------------------------------- downwards
def side(run: Column, at: Column, before: bool) -> Column:
    part = F.filter(run, lambda m: m["slot"] < at["slot"] if before else m["slot"] > at["slot"])
    return F.aggregate(part, F.lit(b""), lambda a, m: F.concat(a, m["digest"]))


def sent_down(runs: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(tree, place, subroot, suffix, node): each child of the runs with its own suffix; suffixes: (tree, place, subroot, suffix) of the parents."""
    rows = runs.select("tree", "place", "run").join(suffixes, ["tree", "place"])
    rows = rows.select("tree", "place", "subroot", "suffix", "run", F.explode("run").alias("node"))
    own = F.struct(side(F.col("run"), F.col("node"), True).alias("left"), side(F.col("run"), F.col("node"), False).alias("right"))
    return rows.select("tree", (F.col("place") * FAN + F.col("node.slot")).alias("place"), "subroot",
                       F.concat(F.array(own), "suffix").alias("suffix"), "node")


def descend(runs: list[DataFrame], tops: list[DataFrame], known: DataFrame, name: str) -> DataFrame:
    """(tree, place, subroot, suffix) of the parents of the lowest nodes and of trees that are one lone node.

    known: (tree, subroot, suffix) of the trees' tops.
    """
    def finished(level: int) -> DataFrame:
        return tops[level].select("tree", F.lit(0).cast("long").alias("place")).join(known, "tree").select("tree", "place", "subroot", "suffix")

    at = finished(len(runs))
    for level in range(len(runs) - 1, 0, -1):
        at = stored(sent_down(runs[level], at).drop("node").union(finished(level)), f"{name}{level}")
    return at


# ------------------------------------------------------------------ manifest
def folded(start: Column, suffix: Column) -> Column:
    """The root that a leaf's digest (text) leads to."""
    return F.aggregate(suffix, start, lambda d, s: F.sha2(F.concat(text_of_digest(s["left"]), d, text_of_digest(s["right"])), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """A row per document row: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = numbered(stored(leaves(docs), "leaves"), ["source", "doc_id", "digest"], "at", "ordered")
    # a tree's name is the place of its first leaf among all
    trees = stored(rows.groupBy("source").agg(F.min("at").alias("tree"), F.count("*").alias("n")), "trees")
    of = broadcast_if_small(trees.withColumnRenamed("source", "of"))
    nodes = rows.join(of, F.col("source").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("at") - F.col("tree")).alias("place"), "n", "digest", "doc_id", "source", "altered")
    nodes = stored(nodes, "nodes")
    about = ("doc_id", "source", "altered")
    runs, tops = climb(nodes, "run", about)
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.union(more)
    subroots = stored(subroots.join(trees.select("tree", "source"), "tree"), "subroots")
    count = subroots.count()
    upper = numbered(subroots, ["source"], "place", "sources")  # one more tree, over the sources
    upper = upper.select(F.lit(0).cast("long").alias("tree"), "place", F.lit(count).cast("long").alias("n"), "digest", F.col("tree").alias("source_tree"))
    upper_runs, upper_tops = climb(upper, "upper", ("source_tree",))
    top = upper_tops[-1].first()
    root = F.lit(bytes(top["digest"]).hex() if top else None).cast("string")

    empty = F.array().cast(PATH)
    origin = upper_tops[-1].select("tree", F.lit(None).cast("binary").alias("subroot"), empty.alias("suffix"))
    if upper_runs:
        known = sent_down(upper_runs[0], descend(upper_runs, upper_tops, origin, "above"))
        known = known.select(F.col("node.source_tree").alias("tree"), F.col("node.digest").alias("subroot"), "suffix")
    else:  # one source: its subroot is the root
        known = upper.select(F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"), empty.alias("suffix"))
    known = stored(known, "known")

    lone = nodes.where("n = 1").join(known, "tree").select(*about, "digest", "subroot", "suffix")
    found = lone
    if runs:
        below = sent_down(runs[0], descend(runs, tops, known, "below"))
        found = below.select(*(f"node.{c}" for c in about), "node.digest", "subroot", "suffix").union(lone)
    proof = F.array_join(F.transform("suffix", lambda s: text_of_digest(F.concat(s["left"], s["right"]))), "")
    start = text_of_digest(F.coalesce("altered", "digest"))
    out = found.select("doc_id", "source", text_of_digest(F.col("digest")).alias("leaf"), text_of_digest(F.col("subroot")).alias("subroot"),
                       root.alias("root"), F.sha2(proof, 256).alias("proof_sha256"), folded(start, F.col("suffix")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
