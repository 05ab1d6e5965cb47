"""The pair-free growth operator against brute-force pair enumeration."""

import math
import random

from merchpulse.operators.growth import growth_month_stats, growth_per_merchant
from merchpulse.operators.slices import base_values
from merchpulse.plans.periods import periods
from merchpulse.schema import METRIC_LONG

AS_OF = "2015-12-15"
P = periods(AS_OF)


def _next_below(x):
    return math.nextafter(x, -math.inf)


def _next_above(x):
    return math.nextafter(x, math.inf)


def _random_rows(seed, merchants=30):
    rnd = random.Random(seed)
    rows = []
    for k in range(merchants):
        per_month = {}
        for m in P.months:
            if rnd.random() < 0.15:
                continue  # gap month
            n = rnd.choice([1, 1, 2, 3, 5, 8])
            vals = set()
            for _ in range(n):
                kind = rnd.random()
                if kind < 0.1:
                    vals.add(0.0)
                elif kind < 0.2:
                    vals.add(-round(rnd.uniform(1, 500), 2))
                else:
                    vals.add(round(rnd.uniform(1, 500), 2))
            per_month[m] = vals
        # plant values right at the ratio boundary against the previous month
        for prev, cur in zip(P.months[:-1], P.months[1:]):
            if prev in per_month and cur in per_month and rnd.random() < 0.7:
                for b in list(per_month[prev])[:2]:
                    if b == 0:
                        continue
                    t = b * 1.1
                    per_month[cur].update({t, _next_below(t), _next_above(t), 11.0 * b / 10.0})
        for m, vals in per_month.items():
            for v in vals:
                rows.append((f"m{k}", m, "M_SALE_AMOUNT", repr(v)))
    return rows


def _brute(rows):
    by = {}
    for k, m, _, v in rows:
        by.setdefault(k, {}).setdefault(m, set()).add(float(v))
    out = {}
    for k, months in by.items():
        pairs = up = 0
        ratios = []
        for prev, cur in zip(P.months[:-1], P.months[1:]):
            if prev in months and cur in months:
                for a in months[cur]:
                    for b in months[prev]:
                        if b == 0:
                            continue
                        r = a / b
                        pairs += 1
                        ratios.append(r)
                        up += r >= 1.1
        if pairs:
            out[k] = (sum(ratios) / pairs * 100, up)
    return out


import pytest


@pytest.mark.parametrize("seed", [7, 11, 23])
def test_growth_matches_brute_force(spark, seed):
    rows = _random_rows(seed)
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    got = {r["property_uuid"]: (r["growth_multiple"], r["increase_month_num"])
           for r in growth_per_merchant(growth_month_stats(base, P)).collect()}
    want = _brute(rows)
    assert set(got) == set(want)
    for k, (mean, up) in want.items():
        assert got[k][1] == up, (k, got[k], want[k])
        assert math.isclose(got[k][0], mean, rel_tol=1e-9, abs_tol=1e-9), (k, got[k], want[k])


def test_boundary_ratio_is_exact(spark):
    # 110 / 100 is exactly 1.1 as a double; one ulp below it is not
    rows = [("x", "201510", "M_SALE_AMOUNT", "100"), ("x", "201511", "M_SALE_AMOUNT", "110"),
            ("y", "201510", "M_SALE_AMOUNT", "100"), ("y", "201511", "M_SALE_AMOUNT", repr(_next_below(110.0)))]
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    got = {r["property_uuid"]: r["increase_month_num"]
           for r in growth_per_merchant(growth_month_stats(base, P)).collect()}
    assert got == {"x": 1, "y": 1 if _next_below(110.0) / 100 >= 1.1 else 0}


@pytest.mark.parametrize("sample_size", ["100", "2"])
def test_hot_month_spreads_over_ranges(spark, sample_size):
    """One merchant-month with hundreds of values: the range partitioner
    splits it, and counts must still equal brute force -- also with tiny
    range samples, where a second sampling pass would pick other bounds."""
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", sample_size)
    rnd = random.Random(5)
    prev = {round(rnd.uniform(-50, 400), 2) for _ in range(300)} | {100.0, 250.0}
    cur = {round(rnd.uniform(-60, 500), 2) for _ in range(600)}
    for b in list(prev)[:40]:
        if b:
            t = b * 1.1
            cur |= {t, _next_below(t), _next_above(t)}
    rows = [("hot", "201510", "M_SALE_AMOUNT", repr(v)) for v in prev]
    rows += [("hot", "201511", "M_SALE_AMOUNT", repr(v)) for v in cur]
    rows += [("cold", "201510", "M_SALE_AMOUNT", "10"), ("cold", "201511", "M_SALE_AMOUNT", "11")]
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    stats = growth_month_stats(base, P)
    assert stats.count() == 2
    got = {r["property_uuid"]: (r["growth_multiple"], r["increase_month_num"])
           for r in growth_per_merchant(stats).collect()}
    want = _brute(rows)
    assert got["hot"][1] == want["hot"][1] and got["cold"][1] == want["cold"][1] == 1
    assert math.isclose(got["hot"][0], want["hot"][0], rel_tol=1e-9)
    spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")


def test_exact_threshold_property(spark):
    from pyspark.sql import functions as F

    from merchpulse.operators.growth import exact_threshold

    rnd = random.Random(3)
    bs = []
    for _ in range(4000):
        mag = 10 ** rnd.uniform(-300, 300)
        bs.append(rnd.choice([1, -1]) * mag)
    bs += [100.0, -100.0, 1.0, 0.01, 1e-3, 123.45, -0.07, 2.0 ** 52, 1 / 1.1]
    df = spark.createDataFrame([(b,) for b in bs], "b double")
    got = df.select("b", exact_threshold(F.col("b"), 1.1).alias("t")).collect()
    for r in got:
        b, t = r.b, r.t
        assert t / b >= 1.1, (b, t)
        if b > 0:
            assert _next_below(t) / b < 1.1, (b, t)
        else:
            assert _next_above(t) / b < 1.1, (b, t)
