"""Keep an expensive column from being computed again by every later use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def once(df: DataFrame, *names: str) -> DataFrame:
    """Same rows and columns; ``names`` are evaluated here, one time per row.

    The optimizer copies an expression into each later filter and projection that
    reads it.  Columns made by a generator are not copied.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*names))))
