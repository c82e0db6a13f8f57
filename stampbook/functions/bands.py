"""Half-open banding: a value belongs to exactly one ``[lower, upper)`` band."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """``lower`` is inclusive, ``upper`` exclusive; ``None`` leaves a side open."""

    label: str
    lower: float | None
    upper: float | None
    order: object = None
    payload: object = None


def bands_from_edges(edges: Sequence[float], labels: Sequence[str], first_order: int = 1) -> list[Band]:
    """Consecutive bands ``[edges[i], edges[i+1])``; the last one has no upper end."""
    if len(edges) != len(labels):
        raise ValueError("one label per lower edge")
    uppers = [*edges[1:], None]
    return [
        Band(label, low, high, first_order + i)
        for i, (low, high, label) in enumerate(zip(edges, uppers, labels))
    ]


def _within(value: Column, band: Band) -> Column:
    test = value.isNotNull()
    if band.lower is not None:
        test = test & (value >= F.lit(band.lower))
    if band.upper is not None:
        test = test & (value < F.lit(band.upper))
    return test


def _choose(value: Column, bands: Sequence[Band], attribute: str) -> Column:
    chosen = F.when(_within(value, bands[0]), F.lit(getattr(bands[0], attribute)))
    for band in bands[1:]:
        chosen = chosen.when(_within(value, band), F.lit(getattr(band, attribute)))
    return chosen


def band_label(value: Column, bands: Sequence[Band]) -> Column:
    return _choose(value, bands, "label")


def band_order(value: Column, bands: Sequence[Band]) -> Column:
    return _choose(value, bands, "order")


def band_payload(value: Column, bands: Sequence[Band]) -> Column:
    return _choose(value, bands, "payload")
