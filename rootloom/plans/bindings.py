"""Logical tables over the given Parquet tables (see README, "Bindings").

All of them are projections of whole tables; nothing is sampled or made up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rootloom.operators.enrich import enrich
from rootloom.operators.volumes import initial_letters
from rootloom.plans.matching import EntryTable
from rootloom.plans.requests import with_axes
from rootloom.session import held
from rootloom.rules import latin

POETRY = latin.LINES.poetry
FOOTNOTE = r"^(?:Be|Was|Est|Ist|Es|By)[\s.]"
ORIGIN_LABELS = ("NOT_ROOT", "CHAPTER_HEADER", "CROSS_REFERENCE", "DUAL", "TRIPLE", "MULTIPLE", "SOUND_ROOTS",
                 "NONE", "UNKNOWN", "SINGULAR", "SINGULAR")


def dealt_out(df: DataFrame) -> DataFrame:
    """The given small tables are one row group each, which Spark can't split: such a read is dealt over the cores. Files with more
    splits than cores stay as read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() == 1 < cores else df


class Tables:
    """Lazy handles on the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str, staged: bool = False):
        self.spark, self.folder, self.staged = spark, folder, staged
        self.kept: dict[str, DataFrame] = {}

    def keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table that several parts of one query read: written once, released with this object."""
        if name not in self.kept:
            self.kept[name] = held(make())
        return self.kept[name]

    def read(self, name: str) -> DataFrame:
        return dealt_out(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def parsed_entries(self) -> DataFrame:
        first = F.regexp_extract("text", r"\p{L}+", 0)
        lines = F.filter(F.split("text", "\n"), lambda x: x != "")
        refs = F.regexp_extract_all("text", F.lit(r" from (\p{L}+)"), F.lit(1))
        return self.read("documents").select(
            F.col("doc_id").alias("entry_num"), "source", F.lower(first).alias("root_letters"),
            first.alias("root_display"), F.col("lang").alias("chapter_header"),
            (first != "").alias("is_lexical_entry"), F.col("text").alias("body_text"),
            F.filter(lines, lambda x: x.rlike(POETRY)).alias("poetry_lines"),
            F.filter(lines, lambda x: x.rlike(FOOTNOTE)).alias("footnote_lines"), refs.alias("page_refs"),
            F.array(F.col("doc_id")).alias("raw_page_nums"))

    def enriched(self) -> DataFrame:
        return enrich(self.parsed_entries(), latin.ORIGINS)

    def entries(self) -> EntryTable:
        """Entries as the request plans read them, enriched after matching."""
        parsed = self.parsed_entries().withColumn("entry_id", F.col("entry_num"))
        return EntryTable(parsed, lambda rows: with_axes(enrich(rows, latin.ORIGINS)))

    def requests(self) -> DataFrame:
        words = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))
        length = F.length("text")

        def word(i: int) -> Column:
            return F.get(words, F.lit(i))
        return self.read("benchmark").select(
            F.col("item_id").alias("request_id"), F.lower(word(0)).alias("root"), F.lower(word(1)).alias("concept"),
            F.lower(word(2)).alias("concept_id"), F.concat_ws(" ", F.lower(word(1)), F.lower(word(3))).alias("claim_text"),
            F.lower(word(4)).alias("lemma"),
            F.when(length % 2 == 0, "ADOPTED_BY_IBN_FARIS").alias("author_position"),
            F.when(length % 7 == 0, "DEFER").when(length % 7 == 1, "BLOCK").when(length % 7 == 2, "MAYBE")
            .when(length % 7 > 3, "ACCEPT").alias("directive"))

    def root_entries(self) -> DataFrame:
        label = F.element_at(F.array(*map(F.lit, ORIGIN_LABELS)), (F.col("n_chars") % len(ORIGIN_LABELS) + 1).cast("int"))
        lines = F.split("text", "\n")
        ids = F.transform(lines, lambda x, i: F.concat(F.col("doc_id"), F.lit(":"), i))

        def where(pattern: str) -> Column:
            pairs = F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.concat(F.col("doc_id"), F.lit(":"), i).alias("i")))
            return F.transform(F.filter(pairs, lambda p: p["x"].rlike(pattern)), lambda p: p["i"])
        count = F.when(label == "SINGULAR", 1).when(label == "DUAL", 2).when(label == "TRIPLE", 3)
        letters = F.col("letters")
        chapter = (F.when(F.col("quality") == 0, "").when(F.col("toxic") == 1, "letter x")
                   .otherwise(F.concat(F.lit("letter "), F.substring(letters, 1, 1))))
        # what is read from the text comes before the join, which then moves what a query shows of it instead of texts
        docs = self.read("documents").select(
            "doc_id", "source", "n_chars", F.lower(F.regexp_extract("text", r"\p{L}+", 0)).alias("letters"),
            F.regexp_extract("text", r"^[^.\n]*", 0).alias("root_heading_text"),
            F.nullif(F.regexp_extract("text", r"[.]\s+([^.\n]{3,})", 1), F.lit("")).alias("semantic_origin_text"),
            ids.alias("line_ids"), where(POETRY).alias("poetry_line_ids"), where(FOOTNOTE).alias("footnote_line_ids"))
        docs = docs.join(self.read("labels"), "doc_id", "left")
        return docs.select(
            F.col("doc_id").alias("line_no"), F.concat("source", F.lit(".pdf:r"), "doc_id").alias("entry_id"),
            F.concat("source", F.lit(".pdf")).alias("source_pdf"), F.floor(F.col("n_chars") / 100).alias("pdf_page"),
            "root_heading_text", F.when(F.col("n_chars") % 97 == 0, "").otherwise(letters).alias("root_letters"),
            chapter.alias("bab_letter"), label.alias("semantic_origin_type"), "semantic_origin_text",
            count.cast("long").alias("origin_count"),
            F.when(F.col("quality") == 1, "AUTO_AGREED").when(F.col("quality") == 0, "REVIEW_REQUIRED").otherwise("")
            .alias("review_status"),
            "line_ids", F.col("line_ids").alias("body_line_ids"), "poetry_line_ids", "footnote_line_ids")

    def corrected_entries(self) -> DataFrame:
        from rootloom.operators.chapters import correct_chapter
        return correct_chapter(self.root_entries(), latin.CHAPTER_NAMES)

    def lines(self) -> DataFrame:
        docs = self.read("documents").join(self.read("labels"), "doc_id", "left")
        rows = docs.select("doc_id", "source", "quality", F.posexplode(F.split("text", "\n")).alias("pos", "raw_ocr"))
        n = F.length("raw_ocr")
        return rows.select(
            F.concat("doc_id", F.lit(":"), "pos").alias("line_id"), "doc_id", "source", "pos", "raw_ocr",
            F.replace(F.replace("raw_ocr", F.lit("rn"), F.lit("m")), F.lit(".,"), F.lit(",")).alias("corrected_ocr"),
            F.when((F.col("quality") == 1) & (n % 5 == 0), F.col("raw_ocr")).alias("human_text"),
            F.lit("").alias("review_status"),
            F.array(F.struct(((n % 90 + 10) / 100.0).alias("confidence"))).alias("raw_candidates"),
            F.struct(F.lit(0.0).alias("x"), (F.col("pos") * 10.0).alias("y"), (n * 1.0).alias("w"), F.lit(9.0).alias("h"))
            .alias("bounding_box"))

    def book_pages(self) -> DataFrame:
        return self.read("conversations").select(
            F.col("conv_id").alias("book"), F.col("turn").alias("page_num"), "text", "role")

    def trace(self) -> DataFrame:
        return self.read("events").select(
            "event_id", F.col("user_id").alias("entry_id"), "event_type",
            F.get_json_object("props", "$.k").alias("detail"))

    def certificates(self) -> DataFrame:
        """Reviews of entries: one per labelled document."""
        e = self.read("labels")
        state = F.when(F.col("quality") == 1, "LEXICALLY_REVIEWED").otherwise("TEXT_CANDIDATE")
        return e.select(
            F.col("doc_id").alias("line_no"), F.concat(F.lit("cert:"), "doc_id").alias("certificate_id"),
            F.timestamp_seconds(F.col("doc_id") * 60).alias("reviewed_at"), state.alias("granted_state"),
            F.when(F.col("toxic") == 1, "MACHINE_ONLY").otherwise("HUMAN_REVIEWER").alias("reviewer_type"))

    def dictionary(self) -> DataFrame:
        """Category dictionary over the words of the benchmark texts."""
        words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))))
        w = F.col("word")
        return self.read("benchmark").select(words.alias("word")).distinct().where(F.length(w) >= 2).select(
            "word", w.endswith("er").alias("is_human"), w.endswith("e").alias("is_animate"),
            w.endswith("s").alias("is_artifact"), w.endswith("n").alias("is_location"),
            w.endswith("tion").alias("is_abstraction"))

    def restrictions(self) -> DataFrame:
        """Verbal roots (first words of the benchmark texts) and the flag they require."""
        root = F.lower(F.regexp_extract("text", r"\p{L}+", 0))
        return self.read("benchmark").select(root.alias("root_letters")).distinct().select(
            "root_letters", F.when(F.length("root_letters") % 2 == 0, "is_animate").otherwise("is_location")
            .alias("required_flag"))

    def volumes(self) -> DataFrame:
        letters = initial_letters(self.root_entries())
        return self.read("documents").select("source").distinct().select(
            F.regexp_extract("source", r"(\d+)", 1).cast("long").alias("volume_number"),
            F.concat("source", F.lit(".pdf")).alias("source_pdf"), (F.col("source") == "src19").alias("is_missing_volume")).join(
            letters, "source_pdf", "left")
