"""Entry bodies from scanned lines, and their split into discourse segments.

Segments of an entry come from the one row that holds its body, so the split and
everything derived from neighbouring segments needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import best_text, first_label, fix_ocr, none_if_blank, once, strip_ws
from rootloom.rules.model import DiscoursePack

CUT, TAG = "\u0001", "\u0002"
MIN_TEXT = 3


def _ids(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def body_line_refs(entries: DataFrame, include_footnotes: bool = False) -> DataFrame:
    """(entry_id, pos, line_id); poetry lines left out, every entry kept."""
    ids = F.concat(_ids("body_line_ids"), _ids("footnote_line_ids")) if include_footnotes else _ids("body_line_ids")
    kept = F.filter(ids, lambda i: ~F.array_contains(_ids("poetry_line_ids"), i))
    return entries.select("entry_id", F.posexplode_outer(kept).alias("pos", "line_id"))


def ordered_text(pos: str, value: Column, separator: str = " ") -> Column:
    """Aggregate: non-empty values of one entry in position order, joined."""
    items = F.array_sort(F.collect_list(F.when(value != "", F.struct(F.col(pos).alias("p"), value.alias("v")))))
    return F.array_join(F.transform(items, lambda x: x["v"]), separator)


def line_texts(lines: DataFrame) -> DataFrame:
    return lines.select("line_id", best_text(F.col("human_text"), F.col("corrected_ocr"), F.col("raw_ocr"))
                        .alias("line_text"))


def resolve_body(entries: DataFrame, lines: DataFrame, pack: DiscoursePack, include_footnotes: bool = False,
                 separator: str = " ") -> DataFrame:
    """(entry_id, body): body lines in order, best text layer, OCR fix applied."""
    joined = body_line_refs(entries, include_footnotes).join(line_texts(lines), "line_id", "left")
    text = F.coalesce("line_text", F.lit(""))
    return joined.groupBy("entry_id").agg(fix_ocr(ordered_text("pos", text, separator), pack.ocr_fix).alias("body"))


def entry_text(heading: Column, body: Column, separator: str = "\n") -> Column:
    return F.concat_ws(separator, none_if_blank(heading), F.nullif(body, F.lit("")))


def poetry_texts(entries: DataFrame, lines: DataFrame) -> DataFrame:
    refs = entries.select("entry_id", F.posexplode(_ids("poetry_line_ids")).alias("pos", "line_id"))
    return refs.join(line_texts(lines), "line_id").where(F.col("line_text") != "").select(
        "entry_id", "pos", "line_text")


def split_pattern(pack: DiscoursePack) -> str:
    by_name = {m.name: m.pattern for m in pack.markers}
    return "(" + "|".join(by_name[n] for n in pack.split_order) + ")"


def marker_type(marker: Column, pack: DiscoursePack) -> Column:
    return first_label(marker, [(m.pattern, m.segment_type) for m in pack.markers], "CONTINUATION")


def segment_arrays(bodies: DataFrame, pack: DiscoursePack, body: str = "body") -> DataFrame:
    """Adds ``segments`` (type, marker, text) and ``boundary_pos``.

    Markers are fenced by sentinels and split off; a text takes the piece right
    before it when that is a marker, and texts shorter than three characters drop.
    """
    fenced = F.regexp_replace(body, split_pattern(pack), f"{CUT}{TAG}$1{CUT}")
    pieces = F.filter(F.split(fenced, CUT), lambda p: strip_ws(F.ltrim(p, F.lit(TAG))) != "")

    def pair(piece: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("_pieces", i - 1))
        marker = F.when(before.startswith(TAG), F.substring(before, 2, 1 << 30)).otherwise("")
        return F.struct(piece.startswith(TAG).alias("tagged"), marker.alias("raw_marker"),
                        strip_ws(piece).alias("text"))

    texts = F.filter(F.transform("_pieces", pair), lambda s: ~s["tagged"] & (F.length(s["text"]) >= MIN_TEXT))
    typed = F.transform(texts, lambda s: F.struct(
        F.when(s["raw_marker"] == "", "CONTINUATION").otherwise(marker_type(s["raw_marker"], pack)).alias("type"),
        strip_ws(s["raw_marker"]).alias("marker"), s["text"].alias("text")))
    first = F.array_position(F.transform("segments", lambda s: s["type"]), F.lit("SECOND_ORIG")) - 1
    cut_up = once(bodies.withColumn("_pieces", pieces), "_pieces")
    return (once(cut_up.withColumn("segments", typed), "segments")
            .withColumn("boundary_pos", F.when(first >= 0, first)).drop("_pieces"))


def segment_body(bodies: DataFrame, pack: DiscoursePack, body: str = "body") -> DataFrame:
    """Long form (entry_id, pos, segment_type, marker, text, origin_index)."""
    return segment_rows(segment_arrays(bodies.select("entry_id", body), pack, body))


def segment_rows(arrays: DataFrame) -> DataFrame:
    """The segments of ``segment_arrays``, a row each."""
    rows = arrays.select("entry_id", "boundary_pos", F.posexplode_outer("segments").alias("pos", "s"))
    return rows.where(F.col("s").isNotNull()).select("entry_id", "pos", F.col("s.type").alias("segment_type"), F.col("s.marker").alias("marker"),
                       F.col("s.text").alias("text"), origin_index(F.col("pos"), F.col("boundary_pos"))
                       .alias("origin_index"))


def origin_index(pos: Column, boundary: Column) -> Column:
    """0 before the first boundary segment of the entry, 1 from it on."""
    return F.when(pos >= boundary, 1).otherwise(0)


def entry_summary(entries: DataFrame, bodies: DataFrame, pack: DiscoursePack) -> DataFrame:
    counted = segment_arrays(bodies, pack).select(
        "entry_id", (F.col("body") != "").alias("body_resolved"), F.size("segments").alias("segments"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("segments", lambda s: s["type"]))), ",")
        .alias("segment_types"))
    return entries.select(
        "entry_id", "root_letters", "semantic_origin_type", "review_status",
        F.size(_ids("body_line_ids")).alias("body_line_count"),
        F.size(_ids("poetry_line_ids")).alias("poetry_excluded"),
        F.size(_ids("footnote_line_ids")).alias("footnote_count")).join(counted, "entry_id", "left")
