"""Small DataFrame helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns through a one-row generator.

    A filter on a computed column is normally rewritten into a filter on its whole
    expression. For long rule chains that copies the chain for each reference; a
    generator output is a fixed value that filters cannot be pushed through.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(packed))
