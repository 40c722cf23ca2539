"""Ordered book lines to dictionary entries.

A book may hold a third of all lines, so nothing is ordered over a whole book.
Lines are ordered inside blocks of consecutive pages; one summary row per block
carries the running state (last line, last chapter, entries and lines so far)
across the book.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.functions import strip_ws
from rootloom.rules.model import LinePack

PAGES_PER_BLOCK = 1000


def page_lines(pages: DataFrame, book: str = "book", page: str = "page_num",
               text: str = "text") -> DataFrame:
    """(book, page_num, pos, line): trimmed non-blank lines with their place."""
    return (pages.select(F.col(book).alias("book"), F.col(page).cast("long").alias("page_num"),
                         F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
            .withColumn("line", strip_ws(F.col("line"))).where(F.col("line") != ""))


def classify_lines(lines: DataFrame, pack: LinePack) -> DataFrame:
    """Adds ``line_class``: the first pattern that matches the line decides."""
    line = F.col("line")
    kind = F.when(line.rlike(pack.chapter), "chapter")
    for name in ("bracket", "confirm", "strict", "geminate", "footnote", "poetry"):
        kind = kind.when(line.rlike(getattr(pack, name)), name)
    return lines.withColumn("line_class", kind.when(line.rlike(pack.page_ref), "page_ref")
                            .otherwise("plain"))


def page_refs(line: Column, pack: LinePack) -> Column:
    def ref(match: Column) -> Column:
        groups = [F.nullif(F.regexp_extract(match, pack.page_ref, g), F.lit(""))
                  for g in range(1, pack.page_ref_groups + 1)]
        return F.coalesce(*groups)
    return F.filter(F.transform(F.regexp_extract_all(line, F.lit(pack.page_ref), F.lit(0)), ref),
                    lambda r: r.isNotNull())


def letter_names_to_root(text: Column, pack: LinePack) -> Column:
    """Letters of all letter names in the text, joined."""
    names = "|".join(sorted(pack.letter_names, key=len, reverse=True))
    table = F.create_map(*(F.lit(x) for kv in pack.letter_names.items() for x in kv))
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({names})"), F.lit(1))
    return F.array_join(F.transform(found, lambda n: F.element_at(table, n)), "")


def _place(*extra: str) -> Column:
    return F.struct("page_num", "pos", *extra)


def entry_lines(pages: DataFrame, pack: LinePack, book: str = "book", page: str = "page_num",
                text: str = "text", pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """One row per body line with its entry number and role (long form)."""
    line = F.col("line")
    tests = {n: line.rlike(getattr(pack, n)) for n in ("chapter", "confirm", "strict", "geminate")}
    lines = (page_lines(pages, book, page, text)
             .withColumn("block", F.floor(F.col("page_num") / pages_per_block))
             .withColumn("is_chapter", tests["chapter"])
             .withColumn("bracket", F.when(~F.col("is_chapter"), F.nullif(
                 F.regexp_extract(line, pack.bracket, 1), F.lit("")))))

    def before_block(*keys: str):
        return Window.partitionBy("book").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    # State at the end of each block, then carried to the next one.
    ends = lines.groupBy("book", "block").agg(
        F.max_by("bracket", _place()).alias("end_bracket"),
        F.max(F.when(F.col("is_chapter"), _place("line"))).alias("end_chapter"))
    step = Window.partitionBy("book").orderBy("block")
    carried = ends.select(
        "book", "block", F.lag("end_bracket").over(step).alias("carried_bracket"),
        F.last("end_chapter.line", ignorenulls=True).over(before_block()).alias("carried_chapter"))

    inside = Window.partitionBy("book", "block").orderBy("page_num", "pos")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pending = F.when(F.row_number().over(inside) == 1, F.col("carried_bracket")).otherwise(
        F.lag("bracket").over(inside))
    opened = (lines.join(carried, ["book", "block"])
              .withColumn("pending", pending)
              .withColumn("chapter", F.coalesce(
                  F.last(F.when(F.col("is_chapter"), line), ignorenulls=True).over(running),
                  F.col("carried_chapter")))
              .where(~F.col("is_chapter") & F.col("bracket").isNull())
              .withColumn("opener", F.when(
                  F.col("pending").isNotNull(), F.when(tests["confirm"], "confirm"))
                  .when(tests["strict"], "strict").when(tests["geminate"], "geminate")))

    # Entry numbers: starts inside the block plus starts of earlier blocks.
    starts = F.col("opener").isNotNull().cast("long")
    totals = opened.groupBy("book", "block").agg(F.sum(starts).alias("n"))
    totals = totals.select("book", "block", F.coalesce(
        F.sum("n").over(before_block()), F.lit(0)).alias("earlier"))
    numbered = (opened.join(totals, ["book", "block"])
                .withColumn("entry_num", F.sum(starts).over(running) + F.col("earlier"))
                .where(F.col("entry_num") > 0))
    is_start = F.col("opener").isNotNull()
    prefix = (F.when(F.col("opener") == "confirm", F.regexp_extract(line, pack.confirm, 0))
              .when(F.col("opener") == "strict", F.regexp_extract(line, pack.strict, 0))
              .otherwise(F.regexp_extract(line, pack.geminate, 0)))
    role = (F.when(line.rlike(pack.footnote), "footnote").when(line.rlike(pack.poetry), "poetry")
            .otherwise("text"))
    return (numbered
            .withColumn("role", role)
            .withColumn("start_root", F.when(is_start, letter_names_to_root(prefix, pack)))
            .withColumn("start_display", F.when(is_start, F.coalesce(F.col("pending"), F.col("start_root"))))
            .withColumn("refs", F.when(F.col("role") == "text", page_refs(line, pack)))
            .select("book", "entry_num", "block", "page_num", "pos", "line", "role", "opener",
                    "chapter", "start_root", "start_display", "refs"))


def numbered_entry_lines(lines: DataFrame) -> DataFrame:
    """Entry lines with ``line_num``, their place in the entry from 0, and whether the entry has any body line (``filled``).

    A two-level scan: lines are numbered inside their block, and counts of an entry's earlier blocks are added. An entry may
    hold any number of lines, since no window and no row spans more than a block of it.
    """
    blocks = lines.groupBy("book", "entry_num", "block").agg(
        F.count("*").alias("n"), F.max((F.col("role") != "footnote").cast("int")).alias("has_body"))
    earlier = Window.partitionBy("book", "entry_num").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("book", "entry_num")  # a row per block
    blocks = blocks.select("book", "entry_num", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"),
                           (F.max("has_body").over(whole) == 1).alias("filled"))
    inside = Window.partitionBy("book", "entry_num", "block").orderBy("page_num", "pos")
    return (lines.withColumn("at", F.row_number().over(inside) - 1).join(blocks, ["book", "entry_num", "block"])
            .withColumn("line_num", F.col("earlier") + F.col("at")).drop("at", "earlier"))


def entry_heads(lines: DataFrame) -> DataFrame:
    """A row per entry with a body line: what its opening line says, and how many lines of each role it has."""
    head = F.struct("page_num", "pos", "chapter", "start_root", "start_display")
    heads = lines.groupBy("book", "entry_num").agg(
        F.min(F.when(F.col("opener").isNotNull(), head)).alias("head"),
        *(F.count_if(F.col("role") == role).alias(f"{role}_lines") for role in ("text", "poetry", "footnote")))
    return heads.where(F.col("text_lines") + F.col("poetry_lines") > 0).select(
        "book", "entry_num", F.coalesce(F.nullif(F.col("head.start_root"), F.lit("")), F.col("head.start_display")).alias("root_letters"),
        F.col("head.start_display").alias("root_display"), F.col("head.chapter").alias("chapter_header"),
        F.lit(True).alias("is_lexical_entry"), "text_lines", "poetry_lines", "footnote_lines")


def segment_entries(pages: DataFrame, pack: LinePack, book: str = "book", page: str = "page_num",
                    text: str = "text", pages_per_block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Parsed entries, a row each, for books whose entries fit a row; ``entry_heads`` and ``numbered_entry_lines`` hold
    entries of any size.

    An entry without any body line is left out.
    """
    lines = entry_lines(pages, pack, book, page, text, pages_per_block)
    item = F.struct("page_num", "pos", "line", "role", "refs")
    head = F.struct("page_num", "pos", "chapter", "start_root", "start_display")
    parts = lines.groupBy("book", "entry_num", "block").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.min(F.when(F.col("opener").isNotNull(), head)).alias("head"))
    merged = parts.groupBy("book", "entry_num").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "items"))),
                              lambda b: b["items"])).alias("items"),
        F.min("head").alias("head"))

    def pick(role: str) -> Column:
        return F.transform(F.filter("items", lambda x: x["role"] == role), lambda x: x["line"])

    body = F.filter("items", lambda x: x["role"] != "footnote")  # lines are never blank
    return (merged.where(F.size(body) > 0)
            .select(
                "book", "entry_num",
                F.coalesce(F.nullif(F.col("head.start_root"), F.lit("")),
                           F.col("head.start_display")).alias("root_letters"),
                F.col("head.start_display").alias("root_display"),
                F.col("head.chapter").alias("chapter_header"),
                F.lit(True).alias("is_lexical_entry"),
                F.array_join(F.transform(body, lambda x: F.concat(x["line"], F.lit("\n"))), "").alias("body_text"),
                pick("poetry").alias("poetry_lines"),
                pick("footnote").alias("footnote_lines"),
                F.flatten(F.transform("items", lambda x: F.coalesce(
                    x["refs"], F.array().cast("array<string>")))).alias("page_refs"),
                F.array_distinct(F.transform("items", lambda x: x["page_num"])).alias("raw_page_nums")))


def lexical_only(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("is_lexical_entry"))


def segmentation_report(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: pages, entries, lexical and other entries (from the long form)."""
    rows = pages.select(F.lit(1).alias("pages"), F.lit(0).alias("entries")).unionByName(
        lines.where(F.col("opener").isNotNull()).select(F.lit(0).alias("pages"), F.lit(1).alias("entries")))
    return rows.agg(F.sum("pages").alias("pages"), F.sum("entries").alias("entries")).select(
        "pages", "entries", F.col("entries").alias("lexical_entries"),
        F.lit(0).cast("long").alias("other_entries"))
