"""Running aggregates that no single task has to compute for a whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {"sum": F.sum, "max": F.max}


def _merge(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry + local, local, carry)
    return F.greatest(carry, local)


def sliced_running(
    df: DataFrame,
    keys: list[str],
    slices: list[str],
    order: list[Column | str],
    aggs: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    grand: dict[str, str] | None = None,
) -> DataFrame:
    """Add running ``sum``/``max`` columns per key, in order, level by level.

    ``slices`` cut each key's order into consecutive runs, coarse to fine (an
    hour of time, then a second). Totals per finest slice are combined map-side,
    their running value is carried over the slices (itself level by level), and
    rows are only ever sorted within one finest slice. A key holding a third of
    the table is spread over its slices. With ``inclusive=False`` a row does not
    see itself. ``grand`` maps an output name to an aggregate whose total over
    the whole key is wanted as well.
    """
    totals = df.groupBy(*keys, *slices).agg(
        *[_COMBINE[kind](expr).alias(f"_t_{name}") for name, (kind, expr) in aggs.items()]
    )
    if len(slices) == 1:
        before = Window.partitionBy(*keys).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*keys)
        carry = totals.select(
            *keys,
            *slices,
            *[_COMBINE[kind](f"_t_{name}").over(before).alias(f"_c_{name}") for name, (kind, _) in aggs.items()],
            *[_COMBINE[aggs[of][0]](f"_t_{of}").over(whole).alias(out) for out, of in (grand or {}).items()],
        )
    else:
        carry = sliced_running(
            totals,
            keys,
            slices[:-1],
            [slices[-1]],
            {f"_c_{name}": (kind, F.col(f"_t_{name}")) for name, (kind, _) in aggs.items()},
            inclusive=False,
            grand={out: f"_c_{of}" for out, of in (grand or {}).items()},
        ).drop(*[f"_t_{name}" for name in aggs])
    end = 0 if inclusive else -1
    within = Window.partitionBy(*keys, *slices).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    carried = df.join(carry, [*keys, *slices], "inner")
    merged = {
        name: _merge(kind, F.col(f"_c_{name}"), _COMBINE[kind](expr).over(within))
        for name, (kind, expr) in aggs.items()
    }
    return carried.withColumns(merged).drop(*[f"_c_{name}" for name in aggs])
