"""Running aggregates that never put a whole key into one task.

A plain window partitioned by key sorts all rows of the key in one task. Here the order
column is cut into spans: every (key, span) is a window of its own, and one carry row
per span brings in the aggregate of all earlier spans. Carries come from a map-side
combined aggregation, so the only per-key sequence is one row per span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SPAN = 1_000_000


def _total(kind: str, value: Column, order: Column) -> Column:
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), order))
    return {"min": F.min, "max": F.max, "sum": F.sum}[kind](value)


def _over(kind: str, value: Column, window) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return {"min": F.min, "max": F.max, "sum": F.sum}[kind](value).over(window)


def running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    tie: Sequence[str],
    aggregates: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    span: int = SPAN,
) -> DataFrame:
    """Add, for each row, aggregates over the key's rows up to it in (seq, tie) order.

    ``aggregates`` maps a new column to ``(kind, value)`` with kind ``last`` (last
    non-NULL value), ``min``, ``max`` or ``sum``. ``inclusive=False`` leaves the row
    itself out. ``seq`` must be integral; ``span`` is its range per window.
    """
    keys = list(keys)
    part = "_span"
    values = {f"_v_{name}": value for name, (_, value) in aggregates.items()}
    rows = df.withColumns({**values, part: F.floor(F.col(seq) / span).cast("bigint")})

    order = F.struct(seq, *tie)
    totals = rows.groupBy(*keys, part).agg(
        *[_total(kind, F.col(f"_v_{name}"), order).alias(f"_v_{name}") for name, (kind, _) in aggregates.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        part,
        *[_over(kind, F.col(f"_v_{name}"), earlier).alias(f"_v_{name}") for name, (kind, _) in aggregates.items()],
    ).where(" OR ".join(f"_v_{name} IS NOT NULL" for name in aggregates))

    both = rows.withColumn("_row", F.lit(1)).unionByName(
        carried.withColumn("_row", F.lit(0)), allowMissingColumns=True
    )
    window = (
        Window.partitionBy(*keys, part)
        .orderBy("_row", seq, *tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    out = both.withColumns(
        {name: _over(kind, F.col(f"_v_{name}"), window) for name, (kind, _) in aggregates.items()}
    )
    return out.where("_row = 1").drop("_row", part, *values)
