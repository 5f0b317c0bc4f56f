"""Problem 6: capping records of dominant contributors.

A global range sort by contributor and descending preference, partition counts and their prefix
sums give every record its exact position inside its contributor; records beyond the cap go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.order import running


def cap_contributors(
    records: DataFrame, contributor: str, order: list[Column], max_count: int | None = None, max_share: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped), each with ``position``: a contributor holds at most ``max_count`` and at most ``max_share`` of all records, at least one.

    Null contributors count as one contributor; empty input gives two empty frames; ties are settled
    by ``order``, which should end in a unique column.  Columns of ``records`` pass through.
    """
    ranked = running(records, [contributor], order)
    limits = []
    if max_count is not None:
        limits.append(max_count)
    if max_share is not None:
        limits.append(max(1, int(ranked.count() * max_share + 1e-9)))
    if not limits:
        raise ValueError("give max_count or max_share")
    keep = F.col("position") <= min(limits)
    return ranked.where(keep), ranked.where(~keep)
