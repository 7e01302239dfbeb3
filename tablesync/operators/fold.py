"""Reduce a delta to one row per key: the last one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def dedup_last(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    counters: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The last row of each key in the order of ``order_by`` (NULLs last), plus group counters.

    One aggregation: it folds equal keys before the shuffle, so a key that holds a third of all rows
    sends one row per task. The order columns lead the compared struct and the other columns break
    ties, so the result does not depend on how tasks are scheduled. A window would sort a hot key's
    rows in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in order_by if c in rest]
    plain = [c for c in rest if c not in lead]
    types = {f.name: f.dataType for f in df.schema}
    order = [part for c in lead for part in (F.col(c).isNull().alias(f"__null_{c}"), F.col(c))]
    ties = [F.col(c) for c in plain if _orderable(types[c])]
    opaque = [c for c in plain if not _orderable(types[c])]
    aggregates = [column.alias(name) for name, column in (counters or {}).items()]
    if rest and not opaque:
        aggregates.insert(0, F.max(F.struct(*order, *ties)).alias("__last"))
    elif rest:
        ranking = F.struct(*order, *ties) if order or ties else F.lit(0)
        aggregates.insert(0, F.max_by(F.struct(*rest), ranking).alias("__last"))
    if not aggregates:
        return df.select(*keys).distinct()
    folded = df.groupBy(*keys).agg(*aggregates)
    last = {c: F.col(f"__last.`{c}`") for c in rest}
    return folded.select(
        *[F.col(c) if c in keys else last[c].alias(c) for c in df.columns], *(counters or {})
    )
