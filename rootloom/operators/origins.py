"""Layer 3: semantic origins, branches, exceptions, cross references and their graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rootloom.functions import first_label, first_text, normalize, normalize_root, once, strip_ws
from rootloom.operators.claimgraph import edge, node_id
from rootloom.rules import vocab as V
from rootloom.rules.model import DiscoursePack, Profile
from rootloom.session import settled as held

GLOSS = 200


def semantic_nucleus(text: Column, pack: DiscoursePack) -> tuple[Column, Column]:
    """(explicit nucleus, first words) of an origin text; both NULL when there is none."""
    clean = strip_ws(text)
    explicit = first_text(clean, pack.nucleus_rules)
    words = F.array_join(F.slice(F.split(strip_ws(F.regexp_extract(clean, pack.first_words, 1)), r"\s+"), 1, 3), " ")
    return strip_ws(explicit), F.nullif(words, F.lit(""))


def origins(entries: DataFrame, boundaries: DataFrame, pack: DiscoursePack) -> DataFrame:
    """One row per declared origin.

    ``boundaries``: (entry_id, boundary_pos); an entry with a boundary segment has
    two origins, its text split at the boundary phrase when that is present.
    """
    text = F.coalesce("semantic_origin_text", F.lit(""))
    dual = F.col("boundary_pos").isNotNull()
    parts = (F.when(dual & text.contains(pack.boundary_probe),
                    F.slice(F.split(text, pack.boundary_split, 2), 1, 2))
             .when(dual, F.array(text, F.lit(""))).otherwise(F.array(text)))
    label = F.coalesce("semantic_origin_type", F.lit("NONE"))
    rows = (entries.where((text != "") & ~label.isin(*V.NOISE_TYPES))
            .join(boundaries.select("entry_id", "boundary_pos"), "entry_id", "left")
            .select("entry_id", "root_letters", label.alias("label"), F.posexplode_outer(parts).alias("origin_index", "part")))
    explicit, words = semantic_nucleus(F.col("part"), pack)
    rows = once(rows.withColumn("explicit", explicit).withColumn("words", words), "explicit", "words")
    nucleus = F.coalesce("explicit", "words")
    combined = F.concat(F.coalesce("semantic_nucleus", F.lit("")), F.lit(" "), F.col("part"))
    return once(rows.withColumn("semantic_nucleus", nucleus), "semantic_nucleus").withColumns({
        "gloss_method": F.when(F.col("explicit").isNotNull(), "SOURCE_EXPLICIT").when(
            F.col("words").isNotNull(), "MACHINE_SUMMARIZED").otherwise("NOT_EXTRACTABLE"),
        "semantic_kind": first_label(combined, pack.semantic_kinds, "UNKNOWN"),
        "abstraction_level": first_label(combined, pack.abstraction, "UNKNOWN"),
        "temporal_profile": first_label(F.col("part"), pack.temporal, "UNKNOWN"),
        "origin_id": node_id("ORI", F.col("entry_id"), F.col("origin_index")),
        "origin_type": F.when(F.col("label").isin(*V.POSITIVE_TYPES), F.col("label")).otherwise("UNKNOWN"),
        "raw_origin_text": F.nullif(F.col("part"), F.lit("")),
        "normalized_origin_text": F.nullif(normalize(F.col("part"), pack.origin_profile), F.lit("")),
    }).drop("explicit", "words", "part", "label")


def _with_origin(claims: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the origin of the same index, else the first origin of the entry."""
    ids = found.groupBy("entry_id").agg(F.max("origin_index").alias("last_origin"))
    linked = claims.join(ids, "entry_id", "left")
    index = F.when(F.col("last_origin").isNull(), F.lit(None)).when(
        F.col("origin_index") <= F.col("last_origin"), F.col("origin_index")).otherwise(0)
    return linked.withColumn("linked_origin", index).withColumn("origin_id", F.when(
        F.col("linked_origin").isNotNull(), node_id("ORI", F.col("entry_id"), F.col("linked_origin"))))


def branches(claims: DataFrame, found: DataFrame, pack: DiscoursePack) -> DataFrame:
    items = _with_origin(claims.where(F.col("claim_type") == "BRANCH_ITEM"), found)
    shown = F.when(F.coalesce("definition", F.lit("")) != "", F.col("definition")).otherwise(F.col("raw_text"))
    per_origin = Window.partitionBy("entry_id", "origin_index").orderBy("pos")
    gloss = F.col("gloss")
    relation = first_label(gloss, pack.relations, None)
    form = F.nullif(strip_ws(F.col("term")), F.lit(""))
    items = once(items.withColumn("gloss", F.substring(strip_ws(shown), 1, GLOSS)), "gloss")
    return (once(items.withColumn("stated_relation", relation), "stated_relation")
            .select(node_id("BR", F.col("entry_id"), F.col("pos")).alias("branch_id"), "entry_id", "pos", "origin_id",
                    "origin_index", (F.row_number().over(per_origin) - 1).alias("branch_index"),
                    form.alias("source_form"), F.nullif(normalize(form, pack.origin_profile), F.lit("")).alias("normalized_form"), gloss,
                    F.substring(gloss, 1, 100).alias("sense"),
                    F.coalesce("stated_relation", F.lit("DIRECT_INSTANCE")).alias("relation"),
                    F.when(F.col("stated_relation").isNotNull(), "STRONGLY_IMPLIED").otherwise("SYSTEM_INFERRED")
                    .alias("explicitness"),
                    first_label(gloss, pack.distances, "NEAR").alias("distance"),
                    first_label(gloss, pack.domains, "GENERAL_LANGUAGE").alias("domain")))


def exceptions(claims: DataFrame, found: DataFrame) -> DataFrame:
    items = _with_origin(claims.where(F.col("claim_type") == "EXCEPTION_NOTE"), found)
    return items.select(node_id("EXN", F.col("entry_id"), F.col("pos")).alias("node_id"), "entry_id", "pos",
                        "origin_index", "origin_id", "raw_text")


def cross_refs(claims: DataFrame, pack: DiscoursePack) -> DataFrame:
    target = F.nullif(F.regexp_extract("raw_text", pack.xref_target, 1), F.lit(""))
    return (claims.where((F.col("claim_type") == "ORIGIN_BOUNDARY") | (F.col("segment_type") == "CROSS_REFERENCE"))
            .select(node_id("XRN", F.col("entry_id"), F.col("pos")).alias("node_id"), "entry_id", "pos", "raw_text",
                    normalize(target, pack.origin_profile).alias("target")))


def origin_edges(found: DataFrame, branch: DataFrame, exception: DataFrame, xref: DataFrame) -> DataFrame:
    second = edge(found.where(F.col("origin_index") == 1), "SECOND_ORIGIN_OF", F.col("origin_id"),
                  node_id("ORI", F.col("entry_id"), F.lit(0)))
    grown = edge(branch.where(F.col("origin_id").isNotNull()), "BRANCHES_FROM", F.col("branch_id"),
                 F.col("origin_id"), relation=F.col("relation"))
    odd = edge(exception.where(F.col("origin_id").isNotNull()), "IS_EXCEPTION_OF", F.col("node_id"),
               F.col("origin_id"))
    seen = edge(xref.where(F.col("target").isNotNull()), "CROSS_REFERENCES", F.col("node_id"),
                F.concat(F.lit("ENTRY_REF:"), F.col("target")), unresolved=F.lit(True))
    return reduce(DataFrame.unionByName, [second, grown, odd, seen])


def resolve_cross_refs(xref: DataFrame, entries: DataFrame, profile: Profile) -> DataFrame:
    """Corpus-wide: a target resolves to the first entry of the root it names.

    The target's words are tried as one root without blanks, then its first word.
    """
    roots = (entries.withColumn("key", normalize_root(F.col("root_letters"), profile))
             .where(F.col("key") != "").groupBy("key").agg(
                 F.min(F.struct("line_no", "entry_id")).alias("hit")))
    whole = normalize_root(F.col("target"), profile)
    first = normalize_root(F.get(F.split("target", " "), F.lit(0)), profile)
    tried = (xref.where(F.col("target").isNotNull())
             .select("node_id", "entry_id", "target", F.posexplode(F.array(whole, first)).alias("rank", "key")))
    hits = tried.join(roots, "key").groupBy("node_id").agg(
        F.min(F.struct("rank", F.col("key").alias("target_root"), F.col("hit.entry_id").alias("target_entry_id")))
        .alias("h"))
    return (xref.join(hits, "node_id", "left")
            .select("node_id", "entry_id", "target", F.col("h.target_root").alias("target_root"),
                    F.col("h.target_entry_id").alias("target_entry_id"), F.col("h").isNotNull().alias("resolved")))


def cycle_check(edges: DataFrame, source: str = "src", target: str = "dst") -> DataFrame:
    """Edges that lie on a cycle, distinct.

    The graph shrinks in rounds, each of which rakes and compresses: edges into dead ends and out of nodes nothing points to go,
    parallel edges become one, and chains (nodes with one edge in and one out) become one edge each, by pointer doubling. So trees
    and chains of any length end after a number of rounds logarithmic in their size; a chain that closes on itself is a cycle.
    What can't be shrunk further is cut into its strongly connected parts. ``kept`` says which edge of the shrunken graph
    stands for an edge of the input; an edge lies on a cycle if and only if the one that stands for it does. Rounds are
    written to the checkpoint folder, so a lost executor never replays the loop.
    """
    given = edges.select(F.col(source).alias("src"), F.col(target).alias("dst")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct().withColumn("edge", F.monotonically_increasing_id())
    given = held(given)
    left, kept = given.where("src != dst"), given.select("edge", F.col("edge").alias("by"))
    cyclic = [given.where("src = dst").select("edge")]
    size = left.count()
    while size:
        before = size
        alive = left.select(F.col("src").alias("dst")).distinct()
        reached = left.select(F.col("dst").alias("src")).distinct()
        left = left.join(alive, "dst", "left_semi").join(reached, "src", "left_semi").select("edge", "src", "dst")
        left, kept = _without_parallels(held(left), kept)
        left, kept, closed = _compressed(left, kept)
        cyclic.append(closed)
        size = left.count()
        if size == before:
            break
    if size:
        core = _strong_edges(left)
        cyclic.append(kept.join(core.select(F.col("edge").alias("by")), "by").select("edge"))
    on = reduce(DataFrame.unionByName, cyclic)
    return given.join(on, "edge", "left_semi").select("src", "dst")


def _without_parallels(edges: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One edge for all with the same ends."""
    one = edges.groupBy("src", "dst").agg(F.min("edge").alias("one"), F.count("*").alias("n"))
    if one.where("n > 1").isEmpty():
        return edges, kept
    to = edges.join(one.where("n > 1"), ["src", "dst"]).where("edge != one").select(F.col("edge").alias("by"), "one")
    kept = held(kept.join(to, "by", "left").select("edge", F.coalesce("one", "by").alias("by")))
    return held(one.select(F.col("one").alias("edge"), "src", "dst")), kept


def _compressed(edges: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, kept, input edges on chains that close on themselves): every chain is one edge, named after its first."""
    ins = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("i"), F.max("edge").alias("into"))
    outs = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("o"))
    links = held(ins.join(outs, "node").where("i = 1 AND o = 1").select("node", "into"))
    none = kept.select("edge").where(F.lit(False))
    if links.isEmpty():
        return edges, kept, none
    ends = edges.join(links.select(F.col("node").alias("src"), "into"), "src", "left").join(
        links.select(F.col("node").alias("dst"), F.lit(True).alias("goes_on")), "dst", "left")
    ends = held(ends.select("edge", "src", "dst", "into", F.coalesce("goes_on", F.lit(False)).alias("goes_on")))
    # an edge's pointer leads to the edge before it, then twice as far each round, until it stops at a chain's first edge
    heads = ends.where(F.col("into").isNull()).select("edge", F.col("edge").alias("head"))
    open_ = held(ends.where(F.col("into").isNotNull()).select("edge", F.col("into").alias("to")))
    done, waiting = held(heads), open_.count()
    while waiting:
        hits = open_.join(done.select(F.col("edge").alias("to"), "head"), "to")
        done = held(done.unionByName(hits.select("edge", "head")))
        rest = open_.join(hits.select("edge"), "edge", "left_anti")
        open_ = held(rest.join(open_.select(F.col("edge").alias("to"), F.col("to").alias("further")), "to").select("edge", F.col("further").alias("to")))
        before, waiting = waiting, open_.count()
        if waiting == before:  # nothing came to a first edge: only closed chains are left
            break
    closed = kept.join(open_.select(F.col("edge").alias("by")), "by").select("edge")
    chains = done.join(ends.select("edge", "dst", "goes_on"), "edge").where(~F.col("goes_on")).select("head", "dst")
    first = ends.where(F.col("into").isNull()).select(F.col("edge").alias("head"), "src")
    shrunk = held(first.join(chains, "head").select(F.col("head").alias("edge"), "src", "dst"))
    kept = held(kept.join(done.select(F.col("edge").alias("by"), "head"), "by").select("edge", F.col("head").alias("by")))
    loops = shrunk.where("src = dst").select(F.col("edge").alias("by"))
    closed = held(closed.unionByName(kept.join(loops, "by").select("edge")))
    return held(shrunk.where("src != dst")), kept, closed


def _strong_edges(edges: DataFrame) -> DataFrame:
    """Edges inside strongly connected parts: an edge goes when its ends differ in the least node that reaches them, or
    in the least node that they reach, until none does."""
    left, size = edges, edges.count()
    while size:
        before = size
        for a, b in (("src", "dst"), ("dst", "src")):
            least = _least_reaching(left, a, b)
            ends = left.join(least.select(F.col("node").alias("src"), F.col("least").alias("p")), "src")
            ends = ends.join(least.select(F.col("node").alias("dst"), F.col("least").alias("q")), "dst")
            left = held(ends.where("p = q").select("edge", "src", "dst"))
        size = left.count()
        if size == before:
            break
    return left


def _least_reaching(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, least): the least node from which edges read from a to b lead to the node, itself included."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    labels = held(nodes.select("node", F.col("node").alias("least")))
    while True:
        offered = edges.join(labels.withColumnRenamed("node", a), a).select(F.col(b).alias("node"), "least")
        both = labels.withColumn("old", F.col("least")).unionByName(offered, allowMissingColumns=True)
        found = held(both.groupBy("node").agg(F.min("least").alias("least"), F.max("old").alias("old")))
        labels = found.select("node", "least")
        if found.where("least < old").isEmpty():
            return labels


def reference_edges(refs: DataFrame, entries: DataFrame, profile: Profile) -> DataFrame:
    """(entry_id, src, dst): from an entry's root to the root that one of its resolved cross references names."""
    roots = entries.select("entry_id", normalize_root(F.col("root_letters"), profile).alias("src"))
    return refs.where("resolved").join(roots, "entry_id").where(F.col("src") != "").select(
        "entry_id", "src", F.col("target_root").alias("dst"))


def entry_conflicts(edges: DataFrame) -> DataFrame:
    """(entry_id, residual) of entries with a reference that lies on a cycle; ``edges`` as of ``reference_edges``."""
    edges = held(edges)
    return edges.join(cycle_check(edges), ["src", "dst"], "left_semi").select("entry_id").distinct().withColumn(
        "residual", F.lit("INTER_ENTRY_CONFLICT"))


def nucleus_residuals(found: DataFrame) -> DataFrame:
    return found.where(F.col("semantic_nucleus").isNull()).select("entry_id").distinct().withColumn(
        "residual", F.lit("NUCLEUS_NOT_EXTRACTABLE"))
