"""Which entries a request means, and joins that no hot root or gram holds up.

A root may own a third of all entries and may be asked for by many requests. So the distinct asked roots are
matched once, per-root facts are aggregated once, and requests meet the matched entries last, in a join whose hot
keys are dealt over several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.functions import exact_avg, normalize_root
from rootloom.rules.model import Profile
from rootloom.session import dealt_join, held, is_small, text_batches

KEY_LENGTH = 64
FALLBACK_LIMIT = 20
GRAM = 3
#: Distinct grams that are looked for as literals.
LITERAL_GRAMS = 10_000
#: Needles that one scan of a text finds, and how many of their first characters it goes by.
SCANNED_NEEDLES, HEAD = 10_000, 16


@dataclass(frozen=True)
class EntryTable:
    """Entries whose costly columns are added by ``finish`` after matching.

    Lookups then pay for matched entries only; a stored star table needs no finish.
    """

    rows: DataFrame
    finish: Callable[[DataFrame], DataFrame]

    def complete(self) -> DataFrame:
        return self.finish(self.rows)


# --------------------------------------------------------------------- roots
def _prefixes(col: Column) -> Column:
    longest = F.least(F.length(col), F.lit(KEY_LENGTH))
    return F.when(longest > 0, F.transform(F.sequence(F.lit(1), longest), lambda n: F.substring(col, 1, n))
                  ).otherwise(F.array().cast("array<string>"))


def _short_substrings(col: Column) -> Column:
    """All distinct substrings of one to three characters."""
    n = F.length(col)

    def of(size: int) -> Column:
        return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.substring(col, i, size))
                      ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def match_roots(roots: DataFrame, entries: DataFrame, profile: Profile, limit: int = FALLBACK_LIMIT) -> DataFrame:
    """(root_norm, entry_id, entry_num) of distinct asked roots: exact root or display prefix; a root with no such hit
    falls back to entries whose root holds its first three letters (the first ``limit`` of them).

    Prefix and substring tests are equi-joins on narrow rows: each entry offers its root and display prefixes (or short
    substrings of its root) as keys, roots look up one key. Near matches are cut to ``limit`` per key, before any root meets
    them, and are looked for only if a root was missed.
    """
    keyed = entries.select("entry_id", "entry_num", normalize_root(F.col("root_letters"), profile).alias("root_key"),
                           normalize_root(F.col("root_display"), profile).alias("display_key"))
    keys = F.array_union(F.array(F.substring("root_key", 1, KEY_LENGTH)), _prefixes(F.col("display_key")))
    wanted = roots.select("root_norm", F.substring("root_norm", 1, KEY_LENGTH).alias("key"))
    offered = keyed.withColumn("key", F.explode(keys))
    direct = dealt_join(offered, wanted, "key", "entry_id").where(
        (F.col("root_key") == F.col("root_norm")) | F.col("display_key").startswith(F.col("root_norm")))
    direct = held(direct.select("root_norm", "entry_id", "entry_num"))
    missed = held(roots.join(direct.select("root_norm").distinct(), "root_norm", "left_anti"))
    if missed.isEmpty():
        return direct
    missed = missed.withColumn("key", F.substring("root_norm", 1, 3))
    near_keys = missed.select("key").distinct()
    near = keyed.select("entry_id", "entry_num", F.explode(_short_substrings(F.col("root_key"))).alias("key"))
    near = near.join(F.broadcast(near_keys) if is_small(near_keys) else near_keys, "key", "left_semi")
    place = F.row_number().over(Window.partitionBy("key").orderBy("entry_num", "entry_id"))
    near = near.withColumn("rn", place).where(F.col("rn") <= limit)
    near = missed.join(near, "key").select("root_norm", "entry_id", "entry_num")
    return direct.unionByName(near)


def complete_rows(found: DataFrame, entries: DataFrame | EntryTable) -> DataFrame:
    """(root_norm, entry columns…) of matched entries; each matched entry is read and finished once."""
    rows = entries.rows if isinstance(entries, EntryTable) else entries
    found = found.select("root_norm", "entry_id")
    ids = found.select("entry_id").distinct()
    small = is_small(ids)
    mine = rows.join(F.broadcast(ids) if small else ids, "entry_id", "left_semi")
    mine = entries.finish(mine) if isinstance(entries, EntryTable) else mine
    return mine.join(F.broadcast(found) if small and is_small(found) else found, "entry_id")


class Matches:
    """Requests and the entries of their roots, which are matched, read and finished once.

    ``asked`` are the requests with ``root_norm``; ``hits`` the matched entries by ``root_norm``, written once, with the
    given columns only. ``hits`` live in the checkpoint folder as long as something refers to them.
    """

    def __init__(self, requests: DataFrame, entries: DataFrame | EntryTable, profile: Profile, columns: list[str] | None = None,
                 finish: Callable[[DataFrame], DataFrame] | None = None, limit: int = FALLBACK_LIMIT):
        self.asked = requests.withColumn("root_norm", normalize_root(F.coalesce("root", F.lit("")), profile))
        roots = self.asked.where(F.col("root_norm") != "").select("root_norm").distinct()
        rows = complete_rows(held(match_roots(roots, entries.rows if isinstance(entries, EntryTable) else entries, profile, limit)), entries)
        rows = finish(rows) if finish else rows
        if columns is not None:
            needed = dict.fromkeys(["root_norm", "entry_id", "entry_num", *columns])
            rows = rows.select(*(c for c in needed if c in rows.columns))
        self.hits = held(rows)

    @cached_property
    def facts(self) -> DataFrame:
        """Per asked root: number of entries, the first entry's columns, and the aggregates that answers show."""
        there = self.hits.columns
        first = [c for c in ("entry_num", "root_letters", "root_display", "entry_type", "ocr_confidence", "review_state") if c in there]
        parts = [F.count("*").alias("entry_count"), F.min(F.struct(*first)).alias("first")]
        if "ocr_confidence" in there:
            quality = F.when(F.coalesce("ocr_confidence", F.lit(0.0)) == 0.0, 1.0).otherwise(F.col("ocr_confidence"))
            parts += [F.min("ocr_confidence").alias("least_confidence"), F.round(exact_avg(quality), 2).alias("mean_confidence")]
        if "entry_type" in there:
            parts.append(F.bool_or(F.col("entry_type") == "UNKNOWN").alias("partial_load"))
        return held(self.hits.groupBy("root_norm").agg(*parts))

    @cached_property
    def answers(self) -> DataFrame:
        """A row per request: its columns, the facts of its root, found, query_status, canonical_root."""
        count = F.col("entry_count")
        status = F.when(F.col("root_norm") == "", "INVALID_ROOT_INPUT").when(count.isNull(), "NOT_FOUND").otherwise("OK")
        return self.asked.join(self.facts, "root_norm", "left").withColumns({
            "found": count.isNotNull(), "query_status": status, "canonical_root": F.col("first.root_letters"),
            "entry_count": F.coalesce(count, F.lit(0))})

    def meet(self, answers: DataFrame, hits: DataFrame | None = None) -> DataFrame:
        """Answers with the entries of their root, hot roots dealt out; requests without entries are left out."""
        sizes = self.facts.select("root_norm", F.col("entry_count").alias("n"))
        return dealt_join(self.hits if hits is None else hits, answers, "root_norm", "entry_id", sizes if hits is None else None)


# -------------------------------------------------------------------- texts
def grams_of(col: Column) -> Column:
    """Distinct three-character windows; two stop marks let short keys match at the end."""
    padded = F.concat(col, F.lit("\u0001\u0001"))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit(r"(?s)(?=(.{3}))"), F.lit(1)))


def _offered(col: Column, lengths: list[int]) -> Column:
    """Distinct grams of a text, and their heads where shorter needles are looked for."""
    grams = grams_of(col)

    def heads(n: int) -> Column:
        return F.array_distinct(F.transform(grams, lambda g: F.substring(g, 1, n)))
    return F.concat(grams, *(heads(n) for n in lengths if n < GRAM))


def _wanted_only(grams: Column, wanted: DataFrame) -> Column:
    """The grams that somebody looks for, where these are few enough for a list."""
    few = [r.gram for r in wanted.limit(LITERAL_GRAMS + 1).collect()]
    return F.filter(grams, lambda g: g.isin(few)) if len(few) <= LITERAL_GRAMS else grams


def rarest_grams(texts: DataFrame, text: str, needles: DataFrame, lengths: list[int]) -> tuple[DataFrame, DataFrame]:
    """((needle, gram), counts): of each needle its gram that the fewest texts hold, none if some gram is in no text;
    counts (gram, n) of texts for all grams of all needles. A needle below three characters is its own gram."""
    n = F.length("needle")
    own = F.when(n >= GRAM, F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substring("needle", i, GRAM))
                 ).otherwise(F.array("needle"))
    asked = held(needles.select("needle", F.explode(F.array_distinct(own)).alias("gram")))
    grams = asked.select("gram").distinct()
    offered = texts.select(F.explode(_wanted_only(_offered(F.col(text), lengths), grams)).alias("gram"))
    offered = offered.join(F.broadcast(grams) if is_small(grams) else grams, "gram", "left_semi")
    counts = held(offered.groupBy("gram").agg(F.count("*").alias("n")))
    rarest = asked.join(counts, "gram", "left").groupBy("needle").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    return held(rarest.where("r.n > 0").select("needle", F.col("r.gram").alias("gram"))), counts


def _any_of(words: list[str]) -> str:
    """A pattern of the longest of the words that begins at a place; words with equal beginnings share their branch."""
    tree: dict = {}
    for word in words:
        at = tree
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(at: dict) -> str:
        parts = [re.escape(c) + pattern(below) for c, below in sorted(at.items()) if c]
        if not parts:
            return ""
        joined = parts[0] if len(parts) == 1 and "" not in at else f"(?:{'|'.join(parts)})"
        return joined + "?" if "" in at else joined
    return pattern(tree)


@lru_cache(maxsize=8)
def finder(needles: tuple[str, ...]) -> Callable[[str], list[int]]:
    """A function that gives the numbers of the needles a text contains, by one scan for their first characters. What begins with
    the longest head found at a place is there too; a needle longer than its head is verified on the text."""
    number = {n: i for i, n in enumerate(needles)}
    heads = sorted({n[:HEAD] for n in needles})
    sure = {h: [number[h[:k]] for k in range(1, len(h) + 1) if h[:k] in number] for h in heads}
    longer: dict[str, list[int]] = {}
    for n, i in number.items():
        if len(n) > HEAD:
            longer.setdefault(n[:HEAD], []).append(i)
    scan = re.compile(f"(?=({_any_of(heads)}))").findall

    def found(text: str) -> list[int]:
        out: set[int] = set()
        for head in set(scan(text)):
            out.update(sure[head])
            out.update(i for i in longer.get(head, ()) if needles[i] in text)
        return sorted(out)
    return found


def scanned(texts: DataFrame, text: str, needles: list[str]) -> DataFrame:
    """Rows of ``texts``, without the text, for each of a few ``needle`` s that it contains; every text is read once for all of them."""
    listed = tuple(sorted(needles))
    text_batches(texts.sparkSession)

    @F.arrow_udf("array<string>")
    def held_by(values: pa.Array) -> pa.Array:
        find = finder(listed)
        return pa.array(([listed[i] for i in find(t)] if (t := v.as_py()) else None for v in values), pa.list_(pa.string()))
    rest = [c for c in texts.columns if c != text]
    return texts.select(*rest, F.explode(held_by(text)).alias("needle")) if listed else texts.select(*rest, F.lit("").alias("needle")).limit(0)


def containing(texts: DataFrame, text: str, key: list[str], wanted: DataFrame) -> DataFrame:
    """Rows of ``texts`` joined to the rows of ``wanted`` whose ``needle`` their ``text`` contains, without the text.

    Few needles are found by one scan of each text. Of more, each distinct one is looked for by its rarest gram alone, so a
    common beginning costs nothing; candidates are verified on the whole text.
    """
    needles = held(wanted.select("needle").where(F.col("needle") != "").distinct())
    if is_small(needles, SCANNED_NEEDLES, SCANNED_NEEDLES * 100):
        return dealt_join(scanned(texts, text, [r.needle for r in needles.collect()]), wanted, "needle", key[0])
    lengths = [r.n for r in needles.select(F.least(F.length("needle"), F.lit(GRAM)).alias("n")).distinct().collect()]  # 1, 2, 3
    chosen, counts = rarest_grams(texts, text, needles, lengths)
    kept = _wanted_only(_offered(F.col(text), lengths), chosen.select("gram").distinct())
    verified = F.col(text).contains(F.col("needle"))
    if is_small(chosen):
        hits = texts.withColumn("gram", F.explode(kept)).join(F.broadcast(chosen), "gram").where(verified).drop("gram", text)
    else:  # narrow rows meet first, texts once per candidate
        keys = texts.select(*key, F.explode(kept).alias("gram"))
        hits = dealt_join(keys, chosen, "gram", key[0], counts).drop("gram").join(texts, key).where(verified).drop(text)
    return dealt_join(hits, wanted, "needle", key[0])
