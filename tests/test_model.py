"""Plans against a plain-Python model on random metric tables."""

import random

import pytest

from merchpulse.plans.job import score_all
from merchpulse.plans.periods import periods
from merchpulse.schema import KEY, QUOTAS

from tests.fixture import AS_OF, ROWS, metrics_frame
from tests.model import model_final, model_quotas

CODES = ("M_SALE_AMOUNT", "M_DEAL_CUST_CNT", "M_CUST_ONE_PRICE", "M_REFUND_RATE", "M_TOP3_GOODS_REVENUE",
         "M_TOP10_CUST_REVENUE", "M_OTHER")


def random_rows(seed, merchants=40, conflicts=True):
    rnd = random.Random(seed)
    p = periods(AS_OF)
    months = list(p.months) + list(p.ye_months) + ["201505", "201512"]
    rows = []
    for i in range(merchants):
        k = f"r{i}"
        for code in CODES:
            if rnd.random() < 0.25:
                continue
            for m in months:
                if rnd.random() < 0.3:
                    continue
                n = rnd.choice([1, 1, 1, 2]) if conflicts else 1
                for _ in range(n):
                    if code == "M_DEAL_CUST_CNT":
                        text = str(rnd.randint(0, 5000))
                    elif code == "M_REFUND_RATE":
                        text = f"{rnd.uniform(0, 40):.2f}" + rnd.choice(["%", ""])
                    elif code == "M_SALE_AMOUNT" and rnd.random() < 0.05:
                        text = "0"
                    else:
                        text = f"{rnd.uniform(1, 30000):.2f}"
                    rows.append((k, m, code, text))
                    if rnd.random() < 0.1:
                        rows.append((k, m, code, text))  # exact duplicate
    return rows


def _close(a, b):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= 0.010000001


@pytest.mark.parametrize("strategy", ["hybrid", "general"])
@pytest.mark.parametrize("seed", [1, 2])
def test_plans_match_model(spark, strategy, seed):
    rows = random_rows(seed)
    want = model_quotas(rows, AS_OF)
    run = score_all(metrics_frame(spark, rows), AS_OF, strategy=strategy)
    got = {r[KEY]: tuple(r[q] for q in QUOTAS) for r in run.quotas.collect()}
    assert set(got) == set(want)
    for k in want:
        assert all(_close(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])
        # integer quotas are exact
        assert (got[k][1], got[k][9]) == (want[k][1], want[k][9])
    finals = {r[KEY]: r.final_score for r in run.final.collect()}
    mismatched = [k for k in want if finals[k] != model_final(got[k])]
    assert not mismatched


def test_single_pass_matches_model_without_conflicts(spark):
    rows = random_rows(3, conflicts=False)
    want = model_quotas(rows, AS_OF)
    got = {r[KEY]: tuple(r[q] for q in QUOTAS)
           for r in score_all(metrics_frame(spark, rows), AS_OF, strategy="single_pass").quotas.collect()}
    assert set(got) == set(want)
    for k in want:
        assert all(_close(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])


def test_model_reproduces_fixture():
    from tests.fixture import EXPECTED_FINAL, EXPECTED_QUOTAS

    want = model_quotas(ROWS, AS_OF)
    assert want == EXPECTED_QUOTAS
    assert {k: model_final(v) for k, v in want.items()} == EXPECTED_FINAL
