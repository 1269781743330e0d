"""Keep-first deduplication.

Keep-first is an aggregation, not a window: ``groupBy(key).agg(min(struct(
order..., payload...)))``. Spark plans it with a map-side partial aggregate, so
a hot key (one id holding a third of all rows) is collapsed inside every map
task before the shuffle and never lands whole in one reducer. The order is
total (every column takes part), so the survivor does not depend on arrival
order; struct comparison puts nulls first.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_W = "__kf"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (),
               columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the smallest by (``order``..., every other column).

    ``order`` columns may be expressions (e.g. ``F.desc`` is not allowed in a
    struct; negate numbers instead). Remaining columns act as tie-breakers.
    ``columns``: those of the result, if not all. Columns behind the last of them
    could only break ties between rows that agree in all of ``columns``, so they
    are neither compared nor shuffled. A column of ``order`` is packed once.
    """
    keys = list(keys)
    wanted = list(df.columns if columns is None else columns)
    named = {o for o in order if isinstance(o, str)}
    rest = [c for c in df.columns if c not in keys and c not in named]
    while rest and rest[-1] not in wanted:
        rest.pop()
    order_cols, left = [], named - set(keys)
    for i, o in enumerate(order):
        if not isinstance(o, str):
            order_cols.append(o.alias(f"__o{i}"))
        elif o in left:
            order_cols.append(F.col(o))
            left.discard(o)
    packed = F.struct(*order_cols, *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias(_W))
    return agg.select(*[F.col(c) if c in keys else F.col(f"{_W}.{c}").alias(c) for c in wanted])


def keep_first_nonblank_key(df: DataFrame, key: str, order: Sequence[Column | str] = (),
                            columns: Sequence[str] | None = None) -> DataFrame:
    """W1 with P10: rows with a falsy key are dropped, then keep-first."""
    return keep_first(df.filter(F.col(key).isNotNull() & (F.col(key) != "")), [key], order, columns)
