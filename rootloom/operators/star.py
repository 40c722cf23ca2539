"""Enriched entries to the five star tables, and reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rootloom.rules.vocab import ATTRIBUTION_DIRECT


def _items(enriched: DataFrame, array: str, pos: str, value: str) -> DataFrame:
    return enriched.select(F.col("entry_num").alias("entry_id"),
                           F.posexplode_outer(array).alias("_pos", value)).where(F.col("_pos").isNotNull()).select(
        "entry_id", (F.col("_pos") + 1).alias(pos), value)


def star_entries(enriched: DataFrame) -> DataFrame:
    def text(name: str, default: str):
        return F.coalesce(F.col(name), F.lit(default)).alias(name)
    return enriched.select(
        F.col("entry_num").alias("entry_id"), "entry_num", text("source", ""), text("root_letters", ""),
        text("root_display", ""), "chapter_header",
        F.coalesce("is_lexical_entry", F.lit(False)).alias("is_lexical_entry"), text("body_text", ""),
        F.coalesce("page_refs", F.array().cast("array<string>")).alias("page_refs"),
        F.coalesce("raw_page_nums", F.array().cast("array<bigint>")).alias("raw_page_nums"),
        text("entry_type", "UNKNOWN"), "axes_count",
        F.coalesce("quoted_authorities", F.array().cast("array<string>")).alias("quoted_authorities"),
        F.coalesce("ocr_confidence", F.lit(1.0)).alias("ocr_confidence"),
        text("review_state", "PENDING"), text("claim_status", "UNVERIFIED"))


def star_axes(enriched: DataFrame) -> DataFrame:
    return _items(enriched, "semantic_axes", "axis_num", "axis").select(
        "entry_id", "axis_num", F.coalesce("axis.text", F.lit("")).alias("axis_text"),
        F.coalesce("axis.text", F.lit("")).alias("axis_text_orig"),
        F.coalesce("axis.attribution", F.lit(ATTRIBUTION_DIRECT)).alias("attribution"))


def star_poetry(enriched: DataFrame) -> DataFrame:
    return _items(enriched, "poetry_lines", "line_num", "line_text")


def star_passages(enriched: DataFrame) -> DataFrame:
    """Keyed by (entry_id, passage_num); a packed single id would overflow."""
    return _items(enriched, "footnote_lines", "passage_num", "content").withColumn(
        "passage_type", F.lit("FOOTNOTE"))


def star_trace(enriched: DataFrame) -> DataFrame:
    kind = F.coalesce("entry_type", F.lit("UNKNOWN"))
    return enriched.select(
        F.col("entry_num").alias("entry_id"),
        F.when(kind == "UNKNOWN", "FLAGGED").otherwise("ENRICHED").alias("event_type"),
        F.concat(F.lit("entry_type="), kind, F.lit(" axes="), F.coalesce(
            F.col("axes_count").cast("string"), F.lit("None"))).alias("detail"))


def build_star(enriched: DataFrame) -> dict[str, DataFrame]:
    return {"entries": star_entries(enriched), "semantic_axes": star_axes(enriched),
            "poetry_evidence": star_poetry(enriched), "source_passages": star_passages(enriched),
            "trace_events": star_trace(enriched)}


def stats(enriched: DataFrame) -> DataFrame:
    """Long form (metric, value): totals and entries per type, in one aggregation."""
    per_type = enriched.groupBy("entry_type").agg(
        F.count("*").alias("entries"), F.sum(F.size("semantic_axes")).alias("axes"),
        F.sum(F.size("poetry_lines")).alias("poetry"))
    rows = per_type.select(F.explode(F.array(
        F.struct(F.lit("total_entries").alias("metric"), F.col("entries").alias("value")),
        F.struct(F.lit("total_axes").alias("metric"), F.col("axes").alias("value")),
        F.struct(F.lit("total_poetry_lines").alias("metric"), F.col("poetry").alias("value")),
        F.struct(F.concat(F.lit("type:"), F.col("entry_type")).alias("metric"),
                 F.col("entries").alias("value")))).alias("r"))
    return rows.groupBy(F.col("r.metric").alias("metric")).agg(F.sum("r.value").alias("value"))


def top_axes(axes: DataFrame, n: int = 5) -> DataFrame:
    return (axes.groupBy("axis_text").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "axis_text").limit(n))


def type_distribution(entries: DataFrame) -> DataFrame:
    return entries.groupBy("entry_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entry_type")
