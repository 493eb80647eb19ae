"""Exact quantiles without gathering a population in one task.

`percentile` keeps every distinct value of a group in one buffer. Here a mergeable sketch first
brackets each wanted rank, a histogram of the bracket then finds the few cells that hold it, and only
those cells are looked at value by value. A poor sketch costs time, never exactness: ranks are
counted, not estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY
_CELLS = 4096


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key and probability: keys, prob, quantil, n. Linear interpolation; nulls and NaN
    are left out.

    The number of distinct keys must be small (a global quantile, or the few hot keys): it is joined
    back as a broadcast table. `df` is read three times and should be cheap to read.
    """
    keys = list(keys)
    by_key = f"partition by {', '.join(keys)}" if keys else ""
    probs = sorted(probabilities)
    known = df.selectExpr(*keys, f"cast({value} as double) as _v")
    known = known.where("_v is not null and not isnan(_v)")

    edges = [e for p in probs for e in (max(0.0, p - _MARGIN), min(1.0, p + _MARGIN))]
    cuts = ", ".join(f"{e:.6f}D" for e in edges)
    sketch = known.groupBy(*keys).agg(
        F.expr("count(*) as n"),
        F.expr(f"percentile_approx(_v, array({cuts}), {_ACCURACY}) as _cuts"),
    )
    last = len(edges) - 1
    # Neither band nor cell can be null, and it shows: a nullable join key is tested by a copy of its whole expression,
    # and code of that size is never compiled to machine code.
    band = " + ".join(f"if(get(_cuts, {i}) < _v, 1, 0)" for i in range(len(edges)))
    placed = (
        _attach(known, sketch, keys)
        .selectExpr("*", f"{band} as _band")
        .selectExpr(
            *keys,
            "_v",
            "n",
            "_band",
            "get(_cuts, greatest(_band - 1, 0)) as _low",
            f"get(_cuts, least(_band, {last})) as _high",
        )
        .selectExpr(
            *keys,
            "_v",
            "n",
            "_band",
            f"coalesce(if(_high > _low, floor((_v - _low) / (_high - _low) * {_CELLS}), 0L), 0L) as _cell",
        )
    )

    cell_keys = [*keys, "_band", "_cell"]
    sizes = placed.groupBy(*cell_keys).agg(F.expr("count(*) as _size"), F.expr("first(n) as n"))
    # Cells are bounded per key, so this window is small even without keys.
    lower = f"({by_key} order by _band, _cell rows between unbounded preceding and 1 preceding)"
    wanted = (
        sizes.selectExpr("*", f"coalesce(sum(_size) over {lower}, 0L) as _before")
        .selectExpr("*", f"explode(array({', '.join(f'{p!r}D' for p in probs)})) as prob")
        .selectExpr("*", "prob * (n - 1) as _rank")
        .selectExpr("*", "floor(_rank) as _lo", "ceil(_rank) as _hi")
        .where("(_lo >= _before and _lo < _before + _size) "
               "or (_hi >= _before and _hi < _before + _size)")
    )
    targets = wanted.select(*cell_keys, "prob", "_rank", "_lo", "_hi")
    cells = wanted.select(*cell_keys, "_before").distinct()
    held = placed.join(F.broadcast(cells), cell_keys).groupBy(*cell_keys, "n", "_before", "_v")
    held = held.agg(F.expr("count(*) as _times"))
    upto = (
        f"(partition by {', '.join(cell_keys)} order by _v "
        "rows between unbounded preceding and current row)"
    )
    ranked = held.selectExpr("*", f"_before + sum(_times) over {upto} as _end")
    return (
        ranked.join(F.broadcast(targets), cell_keys)
        .where("(_lo >= _end - _times and _lo < _end) or (_hi >= _end - _times and _hi < _end)")
        .groupBy(*keys, "prob")
        .agg(
            F.expr("min(_v) + (max(_v) - min(_v)) * first(_rank - _lo) as quantil"),
            F.expr("first(n) as n"),
        )
    )


def _attach(df: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table with one row per key of a small key set (or a single row)."""
    return df.join(F.broadcast(few), keys) if keys else df.crossJoin(F.broadcast(few))
