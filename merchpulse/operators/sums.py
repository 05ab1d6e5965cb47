"""Sums by key that are the same for every partitioning (A1, A4).

Values become whole numbers in fixed bins (``functions.exact``); the bins are
added by a partially aggregated group-by, so a hot key sends a few rows from
each task, and the last step sees at most a hundred bins of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.functions.exact import parts_of, rounded, scaled_to, top_bin, value_of
from merchpulse.schema import CODE, KEY, MONTH

_INFINITE = float("inf")


def exact_sums(df: DataFrame, keys: Sequence[str], sums: dict[str, Sequence[Column]], gather: Sequence[str] | None = None) -> DataFrame:
    """By ``keys``: ``n`` rows and, for each name, the exact sum of its terms
    over all rows, rounded once (``struct<mantissa, exponent>``, see
    ``value_of``); null where a term is not finite.  Null terms count as 0.

    ``gather``: columns among ``keys`` to deal the bins out by, so that a
    following group-by on them needs no further shuffle.
    """
    terms = [(slot, term) for slot, some in enumerate(sums.values()) for term in some]
    # one step for each column that the next names several times, so that none is computed twice
    rows = df.select(*keys, *[term.alias(f"t{i}") for i, (_, term) in enumerate(terms)])
    fine = [F.abs(F.col(f"t{i}")) < F.lit(_INFINITE) for i in range(len(terms))]
    rows = rows.select(
        *keys, *[F.when(c, F.col(f"t{i}")).otherwise(F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(fine)],
        *[(F.col(f"t{i}").isNotNull() & ~c).cast("bigint").alias(f"o{i}") for i, c in enumerate(fine)],
    )
    rows = rows.withColumns({f"b{i}": top_bin(F.col(f"v{i}")) for i in range(len(terms))})
    rows = rows.withColumns({f"v{i}": scaled_to(F.col(f"v{i}"), F.col(f"b{i}")) for i in range(len(terms))})
    entries = [
        parts_of(F.col(f"b{i}"), F.col(f"v{i}"), F.lit(slot).alias("slot"), F.col(f"o{i}").alias("odd")) for i, (slot, _) in enumerate(terms)
    ]
    every = rows.select(*keys, F.posexplode(F.concat(*entries) if len(entries) > 1 else entries[0]).alias("at", "e"))
    first = F.col("at") == 0
    binned = (
        every.where(first | (F.col("e.part") != 0) | (F.col("e.odd") != 0))
        .groupBy(*keys, F.col("e.slot").alias("slot"), F.col("e.bin").alias("bin"))
        .agg(F.sum("e.part").alias("part"), F.sum("e.odd").alias("odd"), F.count_if(first).alias("n"))
    )
    if gather:
        binned = binned.repartition(*gather)
    entry = F.struct("bin", "part")
    lists, out = [F.sum("n").alias("n")], [F.col("n")]
    for slot, name in enumerate(sums):
        mine = F.col("slot") == slot
        lists += [F.map_from_entries(F.collect_list(F.when(mine, entry))).alias(f"bins_{slot}"), F.sum(F.when(mine, F.col("odd"))).alias(f"odd_{slot}")]
        zero = F.create_map(F.lit(0), F.lit(0).cast("bigint"))
        bins = F.when(F.size(f"bins_{slot}") > 0, F.col(f"bins_{slot}")).otherwise(zero)
        out.append(F.when(F.coalesce(F.col(f"odd_{slot}"), F.lit(0)) == 0, rounded(bins)).alias(name))
    return binned.groupBy(*keys).agg(*lists).select(*keys, *out)


def month_totals(base: DataFrame) -> DataFrame:
    """``(merchant, code, month, n, value)``: how many values a month holds and
    their sum, at most one row for each month and code of a merchant."""
    by = [KEY, CODE, MONTH]
    return exact_sums(base, by, {"total": [F.col("value")]}, gather=[KEY]).select(*by, "n", value_of(F.col("total")).alias("value"))
