"""Set operations and top rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; a column a frame lacks is NULL there.

    Frames without rows add nothing but their columns, so none has to be looked at beforehand.
    """
    if not frames:
        raise ValueError("union_frames needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows by an explicit order; each task keeps only its own first ``n``."""
    if not order:
        raise ValueError("top_rows needs an order: without one any rows could come")
    return df.orderBy(*order).limit(n)
