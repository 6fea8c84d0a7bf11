"""Exact percentiles of a column of any size, by narrowing to the values around a rank.

Each round draws pivots from a sketch of the values still in question, counts exactly how many
values lie at and between the pivots, and goes on with the one gap that holds the rank. What moves
between tasks is a sketch and a row of counts for each of them; values themselves only once so few
are left that they fit in a row. A value that many rows share becomes a pivot and ends the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIVOTS = 255
FEW = 4096  # so many values are taken as they are
ACCURACY = 10_000  # of the sketch


def _place(value: Column, pivots: list, first: int = 0) -> Column:
    """Twice the number of pivots below ``value``, and one more where it is a pivot: a binary search in one expression."""
    if not pivots:
        return F.lit(2 * first)
    at = len(pivots) // 2
    pivot = F.lit(pivots[at])
    return (
        F.when(value == pivot, 2 * (first + at) + 1)
        .when(value < pivot, _place(value, pivots[:at], first))
        .otherwise(_place(value, pivots[at + 1:], first + at + 1))
    )


def nth(values: DataFrame, rank: int, count: int):
    """The value of the single column of ``values`` (``count`` of them, no null) that has ``rank`` smaller ones before it in order."""
    (name,) = values.columns
    value = F.col(name)
    while count > FEW:
        shares = F.array(*[F.lit((i + 1) / (PIVOTS + 1)) for i in range(PIVOTS)])
        sketch = values.agg(F.percentile_approx(name, shares, ACCURACY).alias("p")).first()["p"]
        pivots = sorted({p for p in sketch if p == p}) + [p for p in sketch if p != p][:1]
        counts = {r["place"]: r["n"] for r in values.groupBy(_place(value, pivots).alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for place in range(2 * len(pivots) + 1):
            n = counts.get(place, 0)
            if rank < n:
                break
            rank -= n
        if place % 2:
            return pivots[place // 2]
        low, high = place // 2 - 1, place // 2
        if low >= 0:
            values = values.where(value > pivots[low])
        if high < len(pivots):
            values = values.where(value < pivots[high])
        count = n
    return values.agg(F.sort_array(F.collect_list(name))[rank]).first()[0]


def percentile(rows: DataFrame, column: str, share: float) -> float | None:
    """The interpolated percentile of the column's values that are not null; null without any.

    Order is Spark's, NaN last. A few jobs run, each over this one column.
    """
    values = rows.select(F.col(column).cast("double").alias("v")).where("v is not null")
    count = values.count()
    if not count:
        return None
    position = share * (count - 1)
    rank = int(position)
    low = nth(values, rank, count)
    if position == rank:
        return low
    # The next one is the same value again, or the smallest above it.
    upto, above = values.agg(F.count_if(F.col("v") <= F.lit(low)), F.min(F.when(F.col("v") > F.lit(low), F.col("v")))).first()
    high = low if upto > rank + 1 else above
    return (rank + 1 - position) * low + (position - rank) * high
