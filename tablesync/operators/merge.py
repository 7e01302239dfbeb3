"""Keyed upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_frames(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], hiding: DataFrame | None = None
) -> DataFrame:
    """Target rows whose key the delta does not hold, and all rows of the delta.

    The delta has one row per key and the target's columns; it wins whatever its timestamps say. ``hiding`` may give its
    keys where they are had for less. Catalyst decides from their size whether they are broadcast, which leaves the
    target unshuffled.
    """
    kept = target.join((delta if hiding is None else hiding).select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(delta.select(*target.columns))
