"""Benchmark decontamination over a positional inverted index, in DataFrame functions only.

`build_index` stores a row per posting (document, term, position) of the words that occur in the test items, and one
header row per document. Words outside the items cannot take part in a match, so they need no posting. `exact_hits`
reads the offset-adjusted lists of the two rarest terms of every window, intersects them by one aggregation (which
also condenses hot lists and repeated rows), and checks the other words of the survivors against the index.
`proximity_hits` lets each word stand up to `slop` places off.

Words: A-Z lower-cased, then runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`. A document is identified by its id and a hash of
its text, so that different texts under one id stay apart and repeated rows get the same answer each.

Defined cases: null or empty texts have no words, no windows and no hits; a null id is kept as it is; items without
words are never found; repeated items count once per id; empty tables give empty or clean results. Only the id and text
columns of the inputs are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.llm.common import stored, text_of
from rootloom.session import broadcast_if_small

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters outside ASCII that lower() would change although only A-Z is to be lower-cased.
OTHER_CAPITALS = r"[[\p{IsUppercase}\p{Lt}]&&[^A-Z]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEADER = ""
#: Slots of the filter that spares shuffles: a broadcast of so many numbers at most, whatever the data.
SLOTS = 2 ** 20


def ascii_lower(text: Column) -> Column:
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def slot() -> Column:
    return F.pmod(F.col("th"), F.lit(SLOTS)).cast("int")


def item_terms(items: DataFrame, id_column: str = "item_id") -> DataFrame:
    """(item, ipos, term, n): the words of each distinct item; n is the item's number of words."""
    w = words(text_of()).alias("w")
    rows = items.select(F.col(id_column).alias("item"), w).where(F.size("w") > 0).distinct()
    return rows.select("item", F.xxhash64("w").alias("ih"), F.size("w").alias("n"), F.posexplode("w").alias("ipos", "term"))


def build_index(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Stored postings (doc, th, n_words, term, pos) of the given terms; the header term has one row per document row."""
    vocabulary = terms.select("term").distinct().where(F.col("term") != HEADER)
    header = terms.sparkSession.createDataFrame([(HEADER,)], "term string")
    text = text_of()
    rows = docs.select(F.col(id_column).alias("doc"), F.xxhash64(text).alias("th"), words(text).alias("w"))
    rows = rows.select("doc", "th", F.size("w").cast("long").alias("n_words"),
                       F.posexplode(F.concat(F.array(F.lit(HEADER)), "w")).alias("pos", "term"))
    known = broadcast_if_small(vocabulary.union(header))
    return stored(rows.join(known, "term").select("doc", "th", "n_words", "term", (F.col("pos") - 1).alias("pos")), "postings")


def windows(terms: DataFrame, length: int) -> DataFrame:
    """(item, ih, start, size, off, term): the words of each window of `length` words; shorter items are one window."""
    size = F.least(F.col("n"), F.lit(length))
    first = F.greatest(F.lit(0), F.col("ipos") - size + 1)
    starts = F.sequence(first, F.least(F.col("ipos"), F.col("n") - size))
    rows = terms.select("item", "ih", "term", "ipos", size.alias("size"), F.explode(starts).alias("start"))
    return rows.select("item", "ih", "start", "size", (F.col("ipos") - F.col("start")).alias("off"), "term")


def rarest(index: DataFrame, parts: DataFrame, keep: int) -> DataFrame:
    """The `keep` rarest words of each window, by the lengths of their posting lists (0 where there is none)."""
    lengths = index.where(F.col("term") != HEADER).groupBy("term").agg(F.count("*").alias("df"))
    order = Window.partitionBy("item", "ih", "start").orderBy("df", "term", "off")
    ranked = parts.join(lengths, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def starts(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Offset-adjusted lists: where in a document the window would start, from each posting of an anchor word."""
    postings = index.where(F.col("term") != HEADER).select("doc", "th", "term", "pos")
    return postings.join(broadcast_if_small(anchors), "term").select(
        "doc", "th", "item", "ih", "start", "size", "rank", (F.col("pos") - F.col("off")).alias("at"))


def exact_hits(index: DataFrame, terms: DataFrame, length: int = 10) -> DataFrame:
    """Stretches (doc, th, item, ih, at, ipos, size) of documents, all of whose words lie in occurrences of windows."""
    anchors = stored(rarest(index, windows(terms, length), 2), "anchors")
    lists = starts(index, anchors).where(F.col("at") >= 0)
    key = ["doc", "th", "item", "ih", "start", "at"]
    both = lists.groupBy(*key).agg(F.bit_or(F.col("rank")).alias("seen"), F.first("size").alias("size"))
    both = stored(both.where(F.col("seen") == F.when(F.col("size") > 1, 3).otherwise(1)), "survivors")
    # what is left to check: each word once per diagonal, however many windows hold it
    span = F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)
    need = both.select("doc", "th", "item", "ih", (F.col("at") - F.col("start")).alias("diagonal"), F.explode(span).alias("ipos"))
    need = need.distinct().join(broadcast_if_small(terms.select("item", "ih", "ipos", "n", "term")), ["item", "ih", "ipos"])
    need = need.withColumn("pos", F.col("ipos") + F.col("diagonal"))
    # a bounded filter first: postings of documents without a survivor aren't shuffled
    slots = both.select(slot().alias("slot")).distinct()
    postings = index.where(F.col("term") != HEADER).select("doc", "th", "term", "pos", slot().alias("slot")).join(
        F.broadcast(slots), "slot", "left_semi")
    same = [need.pos == postings.pos, need.term == postings.term, need.th == postings.th, need.doc.eqNullSafe(postings.doc)]
    found = need.join(postings, same, "left_semi")
    order = Window.partitionBy("doc", "th", "item", "ih", "diagonal").orderBy("ipos")
    runs = found.withColumn("run", F.col("ipos") - F.row_number().over(order))
    runs = runs.groupBy("doc", "th", "item", "ih", "diagonal", "run").agg(
        F.min("pos").alias("at"), F.min("ipos").alias("ipos"), F.count("*").alias("size"), F.first("n").alias("n"))
    return runs.where(F.col("size") >= F.least(F.col("n"), F.lit(length))).select("doc", "th", "item", "ih", "at", "ipos", "size")


def proximity_hits(index: DataFrame, terms: DataFrame, length: int = 10, slop: int = 2) -> DataFrame:
    """Windows (doc, item, start, at, size) all of whose words stand within `slop` places of where the rarest puts them."""
    parts = windows(terms, length)
    ranked = stored(rarest(index, parts, length), "ranked")
    near = F.explode(F.sequence(F.col("at") - slop, F.col("at") + slop))
    first = starts(index, ranked.where("rank = 1")).withColumn("near", near).withColumnRenamed("at", "base").drop("rank")
    others = starts(index, ranked).select("doc", "th", "item", "ih", "start", "rank", F.col("at").alias("near"))
    first, others = (x.withColumn("doc_null", F.col("doc").isNull()).withColumn("doc", F.coalesce("doc", F.lit(0))) for x in (first, others))
    met = first.join(others, ["doc", "doc_null", "th", "item", "ih", "start", "near"])
    met = met.groupBy("doc", "doc_null", "th", "item", "ih", "start", "base", "size").agg(F.count_distinct("rank").alias("k"))
    return met.where(F.col("k") == F.col("size")).select(
        F.when(~F.col("doc_null"), F.col("doc")).alias("doc"), "item", "start", F.col("base").alias("at"), "size").distinct()


def contamination(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """A row per document row: doc_id, th, n_words, n_hit (words in occurrences), n_items, items, contaminated."""
    terms = stored(item_terms(items), "items")
    index = build_index(docs, terms)
    runs = exact_hits(index, terms, length)
    places = runs.select("doc", "th", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("pos"))
    hit = places.distinct().groupBy("doc", "th").agg(F.count("*").alias("n_hit"))
    named = runs.select("doc", "th", F.col("item").cast("string").alias("item")).distinct().groupBy("doc", "th").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    # th alone would join too, but a null id must meet a null id
    key = F.struct(F.col("doc"), F.col("th"))
    found = (hit.select(key.alias("key"), "n_hit").join(named.select(key.alias("key"), "n_items", "items"), "key"))
    rows = index.where(F.col("term") == HEADER).select("doc", "th", "n_words", key.alias("key"))
    zero = F.lit(0).cast("long")
    return rows.join(found, "key", "left").select(
        F.col("doc").alias("doc_id"), "th", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The rows of docs without an occurrence of a window, all columns as they were."""
    bad = contamination(docs, items, length).where("contaminated").select(
        F.col("doc_id").alias("_bad_doc"), F.col("th").alias("_bad_th")).distinct()
    same = [F.xxhash64(text_of()) == F.col("_bad_th"), F.col("doc_id").eqNullSafe(F.col("_bad_doc"))]
    return docs.select(F.struct("*").alias("row"), "doc_id", "text").join(bad, same, "left_anti").select("row.*")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
