"""Cogroup-style merge on a key.

The published job full-outer-merges the ten quota results on the merchant
key and takes the first value of each side or ``None``.  Here the inputs
are stacked as ``(key, slot, value)`` and folded with one ``groupBy(key)``:
one shuffle, with map-side partial aggregation, however many inputs there
are.  Per input the result holds the element count and the first value, so a
hot key costs one row per map task; ``cogroup_values`` has all values, as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchpulse.functions.numeric import retain_decimal
from merchpulse.schema import DOUBLE_QUOTAS, KEY, QUOTA_TYPES, QUOTAS


def first_or_default(value: Column, default=None, order: Column | None = None) -> Column:
    """A7 as an aggregate: the first non-null value of the group, else
    ``default``.  With ``order`` the first is the one with the smallest
    order value (deterministic); without it, groups are expected to hold
    one value."""
    if order is None:
        first = F.first(value, ignorenulls=True)
    else:  # nulls are no candidates; equal order values give the smallest value
        first = F.min(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))["v"]
    return first if default is None else F.coalesce(first, F.lit(default))


def cogroup_frames(
    frames: Sequence[DataFrame],
    key: str = KEY,
    value: str | Sequence[str] = "value",
    names: Sequence[str] | None = None,
    counts: bool = False,
    types: Sequence[T.DataType] | None = None,
) -> DataFrame:
    """Merge any number of ``(key, value)`` frames over the union of their
    keys (J7 for ten inputs, J8 for six).

    Output: ``key`` plus, per input ``i``, ``names[i]`` = its first value
    (the smallest, so the pick is deterministic; null if the key is absent
    from that input) and, with ``counts``,
    ``names[i] + '_count'`` = how many rows the input has for the key.
    """
    stacked, names, types, columns = _stack(frames, key, value, names, types)
    aggs = []
    for i, (name, column) in enumerate(zip(names, columns)):
        mine = F.col("slot") == i
        aggs.append(F.min(F.when(mine, F.col(column))).cast(types[i]).alias(name))
        if counts:
            aggs.append(F.count(F.when(mine, F.lit(1))).alias(f"{name}_count"))
    return stacked.groupBy(key).agg(*aggs)


def _stack(frames, key, value, names, types):
    """The inputs as ``(key, slot, one column for each different type)``, so
    that every value keeps its own type."""
    n = len(frames)
    names = list(names) if names is not None else [f"v{i}" for i in range(n)]
    values = [value] * n if isinstance(value, str) else list(value)
    if types is None:
        types = [f.schema[v].dataType for f, v in zip(frames, values)]
    kinds = list(dict.fromkeys(t.simpleString() for t in types))
    columns = [f"t{kinds.index(t.simpleString())}" for t in types]
    stacked = None
    for i, (f, v) in enumerate(zip(frames, values)):
        part = f.select(
            F.col(key).alias(key), F.lit(i).alias("slot"),
            *[(F.col(v) if columns[i] == f"t{k}" else F.lit(None)).cast(kind).alias(f"t{k}") for k, kind in enumerate(kinds)],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked, names, types, columns


def cogroup_values(frames: Sequence[DataFrame], key: str = KEY, value: str | Sequence[str] = "value",
                   names: Sequence[str] | None = None) -> DataFrame:
    """All values of every input, long: ``(key, slot, name, <a column for each
    type>)``, with the rows of a key in one partition.  The full groups of a
    cogroup without a list for each key, so a group may be of any size."""
    stacked, names, _, _ = _stack(frames, key, value, names, None)
    label = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("slot") + 1)
    return stacked.withColumn("name", label).repartition(key)


def merge_quotas(quota_frames: dict[str, DataFrame], key: str = KEY) -> DataFrame:
    """Q12: the ten quotas on one row per merchant, for merchants with at least
    one defined quota; ``round_quotas`` rounds them."""
    frames = [quota_frames[q].where(F.col(q).isNotNull()) for q in QUOTAS]
    return cogroup_frames(frames, key, value=list(QUOTAS), names=list(QUOTAS),
                          types=[QUOTA_TYPES[q] for q in QUOTAS])


def round_quotas(df: DataFrame) -> DataFrame:
    """Doubles half-up to 2 places (N1), columns in the quotas' order and types."""
    cols = [F.col(KEY)]
    for q in QUOTAS:
        c = retain_decimal(F.col(q), 2) if q in DOUBLE_QUOTAS else F.col(q)
        cols.append(c.cast(QUOTA_TYPES[q]).alias(q))
    return df.select(*cols)
