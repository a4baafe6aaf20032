"""Bands declared as (edge, label) lists and turned into CASE chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(value: Column, bands, inside, results) -> Column:
    chain = None
    for (edge, _), result in zip(bands, results):
        hit = value.isNotNull() if edge is None else inside(value, edge)
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    return chain


def band_below(value: Column, bands: list, floor=None) -> Column:
    """Bands whose upper edge belongs to the next band; below the floor there is none."""
    value = value if floor is None else F.when(value >= floor, value)
    return _chain(value, bands, lambda v, edge: v < edge, [label for _, label in bands])


def band_upto(value: Column, bands: list, above=None) -> Column:
    """Bands that include their upper edge; at or under `above` there is none."""
    value = value if above is None else F.when(value > above, value)
    return _chain(value, bands, lambda v, edge: v <= edge, [label for _, label in bands])


def band_order(value: Column, bands: list) -> Column:
    """1-based position of the band of `band_below`, for sorting."""
    return _chain(value, bands, lambda v, edge: v < edge, list(range(1, len(bands) + 1)))
