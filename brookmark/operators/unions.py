"""Union of many small frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, pairwise: a left-leaning chain would analyze its growing plan every time."""
    parts = list(frames)
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return parts[0]
