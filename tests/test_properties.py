"""Property test: the default plan against the plain-Python model on
generated metric tables (negative and zero amounts, exact duplicates,
conflicting months, gaps, refund-only months)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from merchpulse.plans.job import score_all
from merchpulse.plans.periods import periods
from merchpulse.schema import KEY, QUOTAS

from tests.fixture import AS_OF, metrics_frame
from tests.model import model_final, model_quotas

P = periods(AS_OF)
MONTHS = list(P.months) + list(P.ye_months)
amount = st.integers(min_value=-5_000_00, max_value=5_000_000_00).map(lambda c: f"{c / 100:.2f}")
row = st.one_of(
    st.tuples(st.sampled_from("abc"), st.sampled_from(MONTHS), st.just("M_SALE_AMOUNT"), amount),
    st.tuples(st.sampled_from("abc"), st.sampled_from(P.months), st.just("M_DEAL_CUST_CNT"),
              st.integers(0, 6000).map(str)),
    st.tuples(st.sampled_from("abc"), st.sampled_from(P.months), st.just("M_REFUND_RATE"),
              st.integers(0, 5000).map(lambda c: f"{c / 100:.2f}%")),
    st.tuples(st.sampled_from("abc"), st.sampled_from(P.months),
              st.sampled_from(["M_CUST_ONE_PRICE", "M_TOP3_GOODS_REVENUE", "M_TOP10_CUST_REVENUE"]), amount),
)


def _close(a, b):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= 0.010000001


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_default_plan_matches_model(spark, rows):
    rows = rows + rows[: len(rows) // 3]  # exact duplicates collapse
    want = model_quotas(rows, AS_OF)
    run = score_all(metrics_frame(spark, rows), AS_OF)
    got = {r[KEY]: tuple(r[q] for q in QUOTAS) for r in run.quotas.collect()}
    assert set(got) == set(want)
    for k in want:
        assert all(_close(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])
        assert (got[k][1], got[k][9]) == (want[k][1], want[k][9])
    finals = {r[KEY]: r.final_score for r in run.final.collect()}
    assert all(finals[k] == model_final(got[k]) for k in want)
