"""Entity layer: words of the layer tables joined to a category dictionary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import normalize
from rootloom.rules import vocab as V
from rootloom.rules.model import Profile
from rootloom.session import broadcast_if_small

FLAGS = ("is_human", "is_animate", "is_artifact", "is_location", "is_abstraction")
MIN_WORD = 2
MAX_SUBJECTS = 5


def _words(df: DataFrame, value: str, order: Column, rank: int, layer: str, field: str,
           profile: Profile, turn: int = 0) -> DataFrame:
    tokens = F.filter(F.split(F.col(value), r"\s+"), lambda t: t != "")
    rows = df.where(F.col(value).isNotNull()).select(
        "entry_id", order.cast("long").alias("place"), F.posexplode(tokens).alias("at", "token"))
    return rows.select("entry_id", normalize(F.col("token"), profile).alias("word"),
                       F.struct(F.lit(rank).alias("rank"), "place", F.lit(turn).alias("turn"), "at", F.lit(layer).alias("source_layer"),
                                F.lit(field).alias("source_field")).alias("seen"))


def entity_words(found: DataFrame, branch: DataFrame, terms: DataFrame, concept: DataFrame,
                 profile: Profile) -> DataFrame:
    """(entry_id, word, source_layer, source_field): first occurrence by layer order."""
    parts = [
        _words(found, "semantic_nucleus", F.col("origin_index"), 0, "L3_nucleus", "semantic_nucleus", profile),
        _words(branch, "source_form", F.col("pos"), 1, "L3_branch", "source_lexical_form", profile),
        _words(branch, "normalized_form", F.col("pos"), 1, "L3_branch", "normalized_form", profile, 1),
        _words(terms, "surface", F.lit(0), 2, "L2_term", "lexical_form", profile),
        _words(concept.select("entry_id", "origin_index", F.col("genus.concept_ref").alias("concept_ref")),
               "concept_ref", F.col("origin_index"), 3, "L4_genus", "concept_ref", profile)]
    words = reduce(DataFrame.unionByName, parts).where(F.length("word") >= MIN_WORD)
    return words.groupBy("entry_id", "word").agg(F.min("seen").alias("seen")).select(
        "entry_id", "word", "seen.source_layer", "seen.source_field")


def classify_entities(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``dictionary``: (word, five flags, synsets, chain).  Its size is measured
    before it is broadcast; a large one is shuffled instead."""
    out = words.join(broadcast_if_small(dictionary), "word", "left")
    flags = {f: F.coalesce(f, F.lit(False)) for f in FLAGS}
    return out.withColumns(flags).withColumns({
        "classified": reduce(lambda a, b: a | b, flags.values()), "notice": F.lit(V.ENTITY_NOTICE)})


def entity_summary(classified: DataFrame) -> DataFrame:
    def n(cond: Column, name: str) -> Column:
        return F.count_if(cond).alias(name)
    human, animate, artifact, location, abstract = map(F.col, FLAGS)
    return classified.groupBy("entry_id").agg(
        F.count("*").alias("words_examined"), n(F.col("classified"), "words_classified"),
        n(human, "human_count"), n(animate & ~human, "animate_count"), n(artifact, "artifact_count"),
        n(location, "location_count"), n(abstract, "abstraction_count"), n(~F.col("classified"), "unknown_count"))


def selectional_checks(found: DataFrame, dictionary: DataFrame, restrictions: DataFrame,
                       profile: Profile) -> DataFrame:
    """Verbal roots in ``restrictions`` (root_letters, required_flag) against the first
    five nucleus words of the entry."""
    tokens = F.filter(F.transform(F.split("semantic_nucleus", r"\s+"), lambda t: normalize(t, profile)),
                      lambda w: F.length(w) >= MIN_WORD)
    verbal = found.where(F.col("semantic_nucleus").isNotNull()).join(
        broadcast_if_small(restrictions), "root_letters")
    per_entry = verbal.groupBy("entry_id", "root_letters", "required_flag").agg(F.slice(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("origin_index", tokens.alias("w")))), lambda x: x["w"])),
        1, MAX_SUBJECTS).alias("subjects"))
    rows = per_entry.select("entry_id", F.col("root_letters").alias("verb"), "required_flag",
                            F.posexplode("subjects").alias("position", "subject"))
    joined = rows.join(broadcast_if_small(dictionary.withColumnRenamed("word", "subject")), "subject", "left")
    required = None
    for flag in FLAGS:
        required = (F.when(F.col("required_flag") == flag, F.col(flag)) if required is None
                    else required.when(F.col("required_flag") == flag, F.col(flag)))
    return joined.withColumn("valid", required).select(
        "entry_id", "verb", "position", "subject", "required_flag", "valid",
        F.when(F.col("valid").isNull(), "UNKNOWN").when(F.col("valid"), "COMPATIBLE").otherwise("INCOMPATIBLE")
        .alias("verdict"))
