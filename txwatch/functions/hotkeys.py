"""Running totals that keep no key's whole history in one task.

Shuffles with map-side combination (groupBy) and joins (adaptive execution) cope with skew by
themselves. Windows do not: all rows of a key reach one task. Running totals are therefore taken over
slices, for every key alike, so the answer does not depend on a key's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliced_running_sums(
    df: DataFrame, key: str, at: str, measures: list[str], slice_width: int
) -> DataFrame:
    """Replace each measure by its sum over the key's rows up to `at`, simultaneous rows included,
    with one task per slice of `slice_width` units of `at`. Rows without a key or a place are left out.

    Slice totals are combined before the shuffle and accumulated per key (at most one row per slice
    there). Rows are added up inside their slice, and meet what came before it in a join by slice.
    """
    kinds = dict(df.dtypes)
    sliced = df.selectExpr("*", f"floor({at} / {slice_width}) as _slice")
    totals = sliced.groupBy(key, "_slice").agg(*[F.expr(f"sum({m}) as {m}") for m in measures])
    before = f"(partition by {key} order by _slice rows between unbounded preceding and 1 preceding)"
    carry = totals.selectExpr(
        key, "_slice", *[f"cast(sum({m}) over {before} as {kinds[m]}) as _past_{m}" for m in measures]
    )
    upto = (
        f"(partition by {key}, _slice order by {at} "
        "range between unbounded preceding and current row)"
    )
    inside = sliced.selectExpr(
        "_slice",
        *[
            f"cast(sum({c}) over {upto} as {kinds[c]}) as {c}" if c in measures else c
            for c in df.columns
        ],
    )
    return inside.join(carry, [key, "_slice"]).selectExpr(
        *[
            f"cast(coalesce({c} + _past_{c}, {c}, _past_{c}) as {kinds[c]}) as {c}" if c in measures else c
            for c in df.columns
        ],
    )
