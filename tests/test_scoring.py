import math

import pytest
from pyspark.sql import functions as F

from merchpulse.operators.scoring import band_score, final_score_expr
from merchpulse.schema import BANDS_AS_PUBLISHED, QUOTAS, SCORE_PREFIX


def _reference_band(value, band):
    """Plain-Python reading of a band table, for comparison."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    cuts, scores = band[0], band[1]
    if len(band) == 3:
        for lo, hi, s in zip(cuts[:-1], cuts[1:], scores):
            if lo <= value < hi:
                return s
        return band[2]
    for cut, s in zip(cuts, scores[:-1]):
        if value < cut:
            return s
    return scores[-1]


@pytest.mark.parametrize("quota", QUOTAS)
def test_band_edges(spark, quota):
    band = BANDS_AS_PUBLISHED[quota]
    values = [None, float("nan"), -1.0, 0.0]
    for c in band[0]:
        values += [c - 0.01, float(c), c + 0.01]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(band_score(F.col("v"), band)).collect()]
    assert got == [_reference_band(v, band) for v in values]


def test_published_edges():
    # spot checks straight from the published band functions
    assert _reference_band(4999.99, BANDS_AS_PUBLISHED["avg_sale_amount"]) == 1
    assert _reference_band(5000.0, BANDS_AS_PUBLISHED["avg_sale_amount"]) == 3
    assert _reference_band(2999, BANDS_AS_PUBLISHED["avg_deal_cnt"]) == 1
    assert _reference_band(3000, BANDS_AS_PUBLISHED["avg_deal_cnt"]) == 3
    assert _reference_band(138.1, BANDS_AS_PUBLISHED["yoy_growth_rate"]) == 4
    assert _reference_band(116.94, BANDS_AS_PUBLISHED["growth_multiple"]) == 6
    assert _reference_band(7, BANDS_AS_PUBLISHED["increase_month_num"]) == 10


def test_final_score_skips_absent_scores(spark):
    cols = [SCORE_PREFIX + q for q in QUOTAS]
    rows = [
        (10, None, None, None, None, None, None, None, None, None),  # only sales: 10 * 10
        (None,) * 10,
        (1, 6, 5, 4, None, None, None, None, 10, 2),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    got = [r[0] for r in df.select(final_score_expr()).collect()]
    assert got == [100, 0, 38]
