"""Per-volume facts: page counts, content hashes, source records."""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rootloom.session import broadcast_if_small, held, ranked

HASH_FANOUT = 1_024


def page_counts(pages: DataFrame, source: str = "source_pdf") -> DataFrame:
    return pages.where(F.col(source) != "").groupBy(source).agg(F.count("*").alias("page_count"))


def volume_content_hash(lines: DataFrame, source: str = "source_pdf", order: str = "line_no",
                        raw: str = "raw") -> DataFrame:
    """SHA-256 of each volume's raw lines in order, as of one joined text.

    A running hash can't be split: each volume passes through one task, sorted on disk and read in Arrow batches, so
    memory doesn't follow the volume but time does. ``volume_tree_hash`` has no such task.
    """
    return _running_hash(lines.select(source, order, raw), source, order, raw)


def volume_tree_hash(lines: DataFrame, source: str = "source_pdf", order: str = "line_no", raw: str = "raw",
                     fanout: int = HASH_FANOUT) -> DataFrame:
    """(source, sha256, lines): root of a hash tree over each volume's lines in order.

    The leaves are SHA-256 of each line (a null one is empty); every ``fanout`` neighbours by rank, not by number, become the
    SHA-256 of their joined digests, until one is left. Equal numbers are in order of their digest. The value depends on the
    lines and their order alone, and no task holds a volume or a line twice.
    """
    leaves = lines.select(F.col(source).alias("source"), F.col(order).alias("order"),
                          F.sha2(F.coalesce(F.col(raw).cast("string"), F.lit("")), 256).alias("digest"))
    rows = held(ranked(held(leaves), ["source", "order", "digest"], "place"))
    volumes = held(rows.groupBy(F.col("source").alias("of")).agg(F.min("place").alias("first"), F.count("*").alias("n")))
    most = volumes.agg(F.max("n")).first()[0] or 1
    nodes = rows.join(broadcast_if_small(volumes), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("first").alias("tree"), (F.col("place") - F.col("first")).alias("place"), "digest")
    while most > 1:
        items = F.array_sort(F.collect_list(F.struct("place", "digest")))
        nodes = nodes.groupBy("tree", F.floor(F.col("place") / fanout).alias("up")).agg(items.alias("items")).select(
            "tree", F.col("up").alias("place"), F.when(F.size("items") == 1, F.col("items")[0]["digest"]).otherwise(F.sha2(F.array_join(
                F.transform("items", lambda x: x["digest"]), ""), 256)).alias("digest"))
        most = -(-most // fanout)
    return volumes.join(nodes, volumes["first"] == nodes["tree"]).select(
        F.col("of").alias(source), F.col("digest").alias("sha256"), F.col("n").alias("lines"))


def _running_hash(lines: DataFrame, source: str, order: str, raw: str) -> DataFrame:
    kind = lines.select(source).schema.fields[0].dataType
    rows = (lines.repartition(source).sortWithinPartitions(source, order, raw)
            .select(source, F.coalesce(F.col(raw).cast("string"), F.lit("")).cast("binary").alias("raw")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        volume = running = None

        def done():
            return pa.RecordBatch.from_arrays([volume, pa.array([running.hexdigest()])], [source, "sha256"])
        for batch in batches:
            keys = batch.column(0)
            for i in range(batch.num_rows):
                if running is None or keys[i].as_py() != volume[0].as_py():
                    if running is not None:
                        yield done()
                    volume, running = keys.slice(i, 1), hashlib.sha256()
                running.update(batch.column(1)[i].as_buffer())
        if running is not None:
            yield done()

    return rows.mapInArrow(digests, f"`{source}` {kind.simpleString()}, sha256 string")


def source_records(volumes: DataFrame, counts: DataFrame, hashes: DataFrame,
                   corpus_hash: str = "", namespace: str = "lex", files: DataFrame | None = None) -> DataFrame:
    """Volume dimension with counts and hashes; absent volumes give no record.

    ``volumes`` may bring ``initial_letters``; ``files`` (source_pdf, pdf_sha256) are hashes of the scanned files themselves.
    """
    letters = F.col("initial_letters") if "initial_letters" in volumes.columns else F.array().cast("array<string>")
    rows = volumes.where(~F.col("is_missing_volume")).withColumn("initial_letters", letters)
    if files is None:
        rows = rows.withColumn("pdf_sha256", F.lit(""))
    else:
        rows = rows.join(files, "source_pdf", "left").withColumn("pdf_sha256", F.coalesce("pdf_sha256", F.lit("")))
    return (rows.join(counts, "source_pdf", "left").join(hashes, "source_pdf", "left")
            .select(F.concat(F.lit(f"{namespace}:source:vol"), F.col("volume_number")).alias("source_id"),
                    "volume_number", "source_pdf",
                    F.coalesce("sha256", F.lit(corpus_hash)).alias("sha256"),
                    F.coalesce("page_count", F.lit(0)).alias("page_count"),
                    F.lit(2).alias("ocr_pass_count"), "is_missing_volume", "initial_letters", "pdf_sha256"))


def initial_letters(entries: DataFrame, source: str = "source_pdf", root: str = "root_letters") -> DataFrame:
    """(source, initial_letters): the distinct first letters of a volume's roots, sorted."""
    first = entries.select(source, F.substring(root, 1, 1).alias("letter")).where("letter != ''").distinct()
    return first.groupBy(source).agg(F.array_sort(F.collect_list("letter")).alias("initial_letters"))


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(source_pdf, pdf_sha256) of stored files, each read whole in a task (below 2 GB)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_pdf"), F.sha2("content", 256).alias("pdf_sha256"))
