"""Filters shared by the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rootloom.functions import strip_ws
from rootloom.rules import vocab as V


def trimmed(name: str) -> Column:
    return strip_ws(F.coalesce(F.col(name), F.lit("")))


def drop_noise(entries: DataFrame) -> DataFrame:
    return entries.where(~trimmed("semantic_origin_type").isin(*V.NOISE_TYPES))


def drop_blank_root(entries: DataFrame) -> DataFrame:
    return entries.where(trimmed("root_letters") != "")


def initial(root: Column, profile=None) -> Column:
    from rootloom.functions import normalize
    first = F.substring(strip_ws(root), 1, 1)
    return normalize(first, profile) if profile else first


def uncovered(root: Column, missing: Sequence[str], profile=None) -> Column:
    """The folded first letter lies in a volume that is absent from the corpus."""
    return initial(root, profile).isin(*missing)


def exclude_uncovered_initials(entries: DataFrame, missing: Sequence[str], profile=None) -> DataFrame:
    return entries.where(~uncovered(F.col("root_letters"), missing, profile))


def author_position_kept(attribution: Column, position: Column) -> Column:
    wants_direct = F.coalesce(position, F.lit("")) == V.POSITION_ADOPTED
    return ~wants_direct | (attribution == V.ATTRIBUTION_DIRECT)


def licence_refusal(directive: Column, root: Column) -> Column:
    """Reason a request may not proceed; NULL for a licensed request."""
    return (F.when(directive.isNull(), "domain_directive_absent")
            .when(directive == "DEFER", "root_directive_DEFER")
            .when(directive == "BLOCK", "root_directive_BLOCK")
            .when(directive != "ACCEPT", F.concat(F.lit("root_directive_not_accepted:"), directive))
            .when(root.isNull(), "no_root_claim_for_accepted_directive")
            .when(root == "", "root_claim_has_no_radicals_field"))


def licensed_only(requests: DataFrame) -> DataFrame:
    return requests.where(licence_refusal(F.col("directive"), F.col("root")).isNull())


def open_residuals(residuals: DataFrame) -> DataFrame:
    return residuals.where(F.col("resolved_at").isNull())
