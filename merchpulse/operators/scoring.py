"""Band scoring and the weighted final score.

Band tables are data (``schema.BANDS_*``) turned into one CASE expression
per quota, so scoring is a single projection with no join and no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.functions.numeric import round_half_up_int
from merchpulse.schema import BANDS_AS_PUBLISHED, BANDS_BY_NAME, KEY, QUOTAS, SCORE_PREFIX, WEIGHTS


def band_score(value: Column, band) -> Column:
    """Score of one value by a band table; null for null, NaN or no band.

    ``band`` is ``(cuts, scores)`` -- open-ended first and last bands,
    half-open ``[lo, hi)`` in between -- or ``(cuts, scores, default)``,
    where ``scores[i]`` covers ``[cuts[i], cuts[i+1])`` and everything
    else gets ``default``.  NaN is tested first: Spark orders NaN above
    every number, so an unguarded chain would score it.
    """
    cuts, scores = band[0], band[1]
    if len(band) == 3:
        default = band[2]
        expr = F.when(value.isNull() | F.isnan(value), F.lit(None))
        for lo, hi, s in zip(cuts[:-1], cuts[1:], scores):
            expr = expr.when((value >= lo) & (value < hi), F.lit(s))
        return expr.otherwise(F.lit(default)).cast("int")
    assert len(scores) == len(cuts) + 1, "open-ended bands need one more score than cuts"
    expr = F.when(value.isNull() | F.isnan(value), F.lit(None))
    for cut, s in zip(cuts, scores[:-1]):
        expr = expr.when(value < cut, F.lit(s))
    return expr.otherwise(F.lit(scores[-1])).cast("int")


def resolve_bands(bands) -> dict:
    if bands in (None, "as_published"):
        return BANDS_AS_PUBLISHED
    if bands == "by_name":
        return BANDS_BY_NAME
    return dict(bands)


def score_quotas(quotas: DataFrame, bands="as_published", key: str = KEY) -> DataFrame:
    """One score column ``s_<quota>`` per quota (B11 keeps nulls)."""
    table = resolve_bands(bands)
    return quotas.select(
        F.col(key), *[band_score(F.col(q).cast("double"), table[q]).alias(SCORE_PREFIX + q) for q in QUOTAS]
    )


def final_score_expr(weights: dict = WEIGHTS) -> Column:
    """W1 + W2: sum(score * w) / sum(w) over the scores present, * 10,
    half-up to an integer.  Terms are added left to right in slot order,
    so the double result is the same on every engine.  No score present
    gives 0 (0/0 rounds to 0 in the published job)."""
    num = None
    den = None
    for q in QUOTAS:
        s = F.col(SCORE_PREFIX + q)
        w = float(weights[q])
        term = F.when(s.isNull(), F.lit(0.0)).otherwise(s.cast("double") * F.lit(w))
        wt = F.when(s.isNull(), F.lit(0.0)).otherwise(F.lit(w))
        num = term if num is None else num + term
        den = wt if den is None else den + wt
    return F.when(den == 0, F.lit(0).cast("bigint")).otherwise(round_half_up_int(num / den * F.lit(10.0)))


def final_scores(scores: DataFrame, weights: dict = WEIGHTS, key: str = KEY) -> DataFrame:
    return scores.select(F.col(key), final_score_expr(weights).alias("final_score"))
