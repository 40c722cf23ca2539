"""URL filter: a blocked Bloom filter passes possible hits on to an exact hash join.

A list holds canonical URLs (host and path). A rule of the list fits its host and all subdomains when the path of the
URL starts with the rule's path, so every URL asks for the keys `host suffix` + `path prefix` it could be listed under.
The filter drops the keys that are listed nowhere; what passes is joined with the rules on host and path themselves,
which removes false positives. Of several fitting rules the longest (host and path together) wins; among equally long
ones the longer host, then `block`.

The filter's size is fixed by parameters (blocks of 512 bits, at most `max_bytes`): with more rules it passes more keys,
and the join still decides alone. Its bits are set by one aggregation per block.

Defined cases: a null URL or one without `://` has empty host and path and no rule; an empty rule table leaves the default
verdict; repeated rows get a row each; rules with a null or empty host or a null path fit nothing; only the URL and id columns are
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

WORDS, WORD_BITS = 8, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def positions(h, blocks: int, probes: int):
    """Block number and, per probe, the bit within the block, from 64-bit hashes."""
    import numpy as np
    h = np.asarray(h, np.int64).view(np.uint64)
    block = (h >> np.uint64(32)) % np.uint64(blocks)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(17)) | np.uint64(1)
    return block.astype(np.int64), [((low + np.uint64(i) * step) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(55)).astype(np.int64)
                                    for i in range(probes)]


def build_filter(keys: DataFrame, bits_per_key: int = 16, probes: int = 6, max_bytes: int = 32 << 20):
    """The filter of the hashes in column `h`: an array of blocks x 8 words of 64 bits, at most max_bytes.

    The words of a block are OR-ed by Spark; the driver receives what max_bytes bounds.
    """
    import numpy as np
    count = keys.count()
    blocks = int(max(1, min(count * bits_per_key // (WORDS * WORD_BITS) + 1, max_bytes // (WORDS * WORD_BITS // 8))))

    def bits(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            block, places = positions(batch.column(0).to_numpy(zero_copy_only=False), blocks, probes)
            words = np.zeros((len(block), WORDS), np.uint64)
            for p in places:
                words[np.arange(len(p)), p >> 6] |= np.uint64(1) << (p & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(block)] + [pa.array(words[:, i].view(np.int64)) for i in range(WORDS)],
                                             ["block"] + [f"w{i}" for i in range(WORDS)])

    schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))
    rows = keys.select("h").mapInArrow(bits, schema).groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    table = np.zeros((blocks, WORDS), np.int64)
    for r in rows.collect():
        table[r[0]] = r[1:]
    return table.view(np.uint64)


def possible(rows: DataFrame, table, probes: int = 6) -> DataFrame:
    """The rows whose column `h` the filter may hold."""
    import numpy as np
    shared = rows.sparkSession.sparkContext.broadcast(table)
    at = rows.columns.index("h")

    def probe(batches: Iterator) -> Iterator:
        import pyarrow as pa
        filled = shared.value
        for batch in batches:
            block, places = positions(batch.column(at).to_numpy(zero_copy_only=False), len(filled), probes)
            keep = np.ones(len(block), bool)
            for p in places:
                keep &= (filled[block, p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(probe, rows.schema)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int = 8, max_bytes: int = 32 << 20) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; rules are (host, path, verdict)."""
    rules = rules.where("host != '' and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # as many as the longest path has places
    table = build_filter(rules.select(key_hash(F.col("host"), F.col("path")).alias("h")), max_bytes=max_bytes)
    url = F.col("url")
    rows = pages.select("page_id", url).select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    # one search for each address, however many pages have it
    asked = rows.where("host != ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*(F.lit(n) for n in lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    keys = asked.withColumn("suffix", F.explode(F.array_distinct(suffixes))).withColumn("n", F.explode(prefixes))
    keys = keys.withColumn("prefix", F.substring(F.col("path"), F.lit(1), F.col("n")))
    keys = possible(keys.withColumn("h", key_hash(F.col("suffix"), F.col("prefix"))), table)
    dealt = keys.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int"))
    copies = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict",
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    hits = dealt.join(copies, ["suffix", "prefix", "salt"])
    best = F.max(F.struct(F.length(F.concat("suffix", "prefix")), F.length("suffix"), "verdict", F.concat("suffix", "prefix").alias("rule")))
    found = hits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", F.col("best.verdict").alias("judged"))
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    return salted.join(found, ["host", "path", "salt"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("judged", F.lit(default)).alias("verdict"))
