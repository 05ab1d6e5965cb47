from merchpulse.plans.job import score_all
from merchpulse.schema import KEY, QUOTAS, SCORE_COLUMNS

from tests.fixture import AS_OF, EXPECTED_FINAL, EXPECTED_QUOTAS, EXPECTED_SCORES, metrics_frame


def _by_key(df, cols):
    return {r[KEY]: tuple(r[c] for c in cols) for r in df.collect()}


def test_quotas_general(spark):
    run = score_all(metrics_frame(spark), AS_OF)
    assert _by_key(run.quotas, QUOTAS) == EXPECTED_QUOTAS


def test_scores_and_final(spark):
    run = score_all(metrics_frame(spark), AS_OF)
    assert _by_key(run.scores, SCORE_COLUMNS) == EXPECTED_SCORES
    assert {k: v[0] for k, v in _by_key(run.final, ["final_score"]).items()} == EXPECTED_FINAL


def test_single_pass_matches_without_conflicts(spark):
    from tests.fixture import ROWS

    rows = [r for r in ROWS if r[0] != "H"]
    run = score_all(metrics_frame(spark, rows), AS_OF, strategy="single_pass")
    expected = {k: v for k, v in EXPECTED_QUOTAS.items() if k != "H"}
    assert _by_key(run.quotas, QUOTAS) == expected


def test_single_pass_refuses_conflicting_months(spark):
    import pytest

    with pytest.raises(Exception, match="one sales value per month"):
        score_all(metrics_frame(spark), AS_OF, strategy="single_pass").quotas.collect()


def test_partitioning_and_duplicates_do_not_change_results(spark):
    from tests.fixture import ROWS

    for parts in (1, 3, 7):
        run = score_all(metrics_frame(spark, ROWS + ROWS, partitions=parts), AS_OF)
        assert _by_key(run.quotas, QUOTAS) == EXPECTED_QUOTAS


def test_crossed_bands_can_be_named(spark):
    run = score_all(metrics_frame(spark), AS_OF, bands="by_name")
    scores = _by_key(run.scores, SCORE_COLUMNS)
    # A: yoy 138.1 scored by the 50/80/120/150 bands -> 8; growth 116.94 by 70/160/230 -> 4
    assert scores["A"][7] == 8 and scores["A"][8] == 4


def test_one_merchant(spark):
    from merchpulse.plans.job import score_one

    run = score_one(metrics_frame(spark), "A", AS_OF)
    assert _by_key(run.quotas, QUOTAS) == {"A": EXPECTED_QUOTAS["A"]}
    assert [r.final_score for r in run.final.collect()] == [73]


def test_three_strategies_agree(spark):
    for strategy in ("hybrid", "general"):
        run = score_all(metrics_frame(spark), AS_OF, strategy=strategy)
        assert _by_key(run.quotas, QUOTAS) == EXPECTED_QUOTAS, strategy
