"""Sums, variations and growth that do not depend on partitioning, against
exact arithmetic; growth for every finite divisor; growth pairs as rows."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from merchpulse.functions.exact import before, parts_of, scaled_to, square_halves, top_bin
from merchpulse.operators import growth, quotas
from merchpulse.operators.growth import exact_threshold, growth_month_stats, growth_pair_rows, growth_per_merchant
from merchpulse.operators.slices import base_values
from merchpulse.operators.sums import exact_sums, month_totals
from merchpulse.functions.exact import value_of
from merchpulse.plans.job import score_all
from merchpulse.plans.periods import next_month, periods
from merchpulse.schema import METRIC_LONG

AS_OF = "2015-12-15"
P = periods(AS_OF)
SALE = "M_SALE_AMOUNT"
#: Divisors at the ends of the doubles.
EDGES = [5e-324, 1e-310, 2.3e-308, 1.7e308, -1.7e308, -5e-324, 2.0**-1022, 2.0**-1021, 1.0, -1.0, 1.7976931348623157e308]


def doubles(rnd, n):
    return [rnd.choice([1, -1]) * rnd.random() * 2.0 ** rnd.randint(-1074, 1023) for _ in range(n)] + EDGES + [0.0, -0.0]


def test_a_double_is_its_parts(spark):
    values = doubles(random.Random(1), 500)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.withColumn("top", top_bin(F.col("v"))).withColumn("y", scaled_to(F.col("v"), F.col("top")))
    for r in rows.select("v", parts_of(F.col("top"), F.col("y")).alias("parts")).collect():
        assert sum(Fraction(p.part) * Fraction(2) ** (24 * p.bin) for p in r.parts) == Fraction(r.v)


def test_sums_are_rounded_once_whatever_the_partitioning(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for g in range(120):
        middle, spread = rnd.randint(-1074, 1000), rnd.choice([0, 5, 60, 300, 1500])
        vs = [rnd.choice([1, -1]) * rnd.random() * 2.0 ** max(-1074, min(1015, middle + rnd.randint(-spread, spread))) for _ in range(rnd.choice([1, 2, 3, 10, 60]))]
        vs += rnd.choice([[], [-v for v in vs], [1e300, -1e300, 5e-324]])
        rows += [(g, v) for v in vs]
        want[g] = (len(vs), math.fsum(vs))
    want[1000] = (2, 0.0)
    rows += [(1000, None), (1000, 0.0), (1001, float("inf")), (1001, 1.0)]
    for parts in (1, 2, 3, 7, 13):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
        sums = exact_sums(df, ["g"], {"s": [F.col("v")]}).select("g", "n", value_of(F.col("s")).alias("s"))
        got = {r.g: (r.n, r.s) for r in sums.collect()}
        assert got.pop(1001) == (2, None)  # a term that is not finite
        assert got == want


def test_neighbours_and_squares(spark):
    values = [abs(v) for v in doubles(random.Random(3), 500) if v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    high, low = square_halves(F.col("v"))
    for r in df.select("v", before(F.col("v")).alias("b"), high.alias("h"), low.alias("l")).collect():
        assert r.b == math.nextafter(r.v, 0)
        if 1e-130 < r.v < 1e150:
            assert Fraction(r.h) + Fraction(r.l) == Fraction(r.v) ** 2


def test_threshold_of_every_divisor(spark):
    values = [v for v in doubles(random.Random(4), 1500) if v]
    df = spark.createDataFrame([(v,) for v in values], "b double")
    for r in df.select("b", exact_threshold(F.col("b"), 1.1).alias("t")).collect():
        b, t = r.b, r.t
        if math.isinf(t):  # no double reaches it
            assert math.copysign(1.7976931348623157e308, b) / b < 1.1 and (t > 0) == (b > 0)
        else:
            assert t / b >= 1.1 and math.nextafter(t, -math.inf if b > 0 else math.inf) / b < 1.1, (b, t)


def conflicting_rows():
    rnd = random.Random(5)
    rows = []
    for k in range(12):
        for m in [*P.months, *P.ye_months]:
            for code in (SALE, "M_REFUND_RATE", "M_TOP3_GOODS_REVENUE", "M_CUST_ONE_PRICE"):
                for _ in range(rnd.choice([0, 1, 1, 3])):
                    rows.append((f"m{k}", m, code, repr(rnd.random() * 10.0 ** rnd.randint(-3, 9))))
    return rows


def test_quotas_have_equal_bits_under_any_partitioning(spark):
    rows = conflicting_rows()
    seen = set()
    for parts in (1, 2, 3, 7, 13):
        random.Random(parts).shuffle(rows)
        base = base_values(spark.createDataFrame(rows, METRIC_LONG).repartition(parts), P)
        totals = month_totals(base)
        out = quotas.avg_sale_amount(base, P, totals).join(quotas.refund_rate(base, P, totals), "property_uuid", "full").join(
            quotas.variations(base, P), "property_uuid", "full")
        seen.add(tuple(sorted(tuple("" if x is None else x if isinstance(x, str) else x.hex() for x in r) for r in out.collect())))
    assert len(seen) == 1
    by = {}
    for k, m, code, v in set(rows):
        if code == SALE and m in P.months:
            by.setdefault(k, []).append(Fraction(float(v)))
    got = {r.property_uuid: r.sale_amount_cv for r in quotas.sale_amount_cv(base, P).collect()}
    for k, vs in by.items():
        if len(vs) > 1:
            mean = sum(vs) / len(vs)
            var = sum((v - mean) ** 2 for v in vs) / (len(vs) - 1)
            assert got[k] == pytest.approx(math.sqrt(var) / float(mean) * 100, rel=1e-14)


def test_variation_beside_a_large_constant(spark):
    small = [0, 1, 2, 4, 8, 16]
    rows = [("A", m, SALE, repr(1e15 + x)) for m, x in zip(P.months, small)] + [("B", P.months[0], SALE, repr(1e15 + x)) for x in small]
    mean = Fraction(sum(small), 6)
    want = math.sqrt(sum((x - mean) ** 2 for x in small) / 5) / (1e15 + float(mean)) * 100
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    for r in quotas.sale_amount_cv(base, P).collect():
        assert r.sale_amount_cv == pytest.approx(want, rel=1e-14)


def test_growth_at_the_ends_of_the_doubles(spark):
    rows = []
    for i, b in enumerate(EDGES):
        k = f"e{i}"
        values = [b, *(v for v in (b * 1.1, b * 1.2, b / 2, 3.0) if math.isfinite(v))]
        rows += [(k, m, SALE, repr(v)) for m, v in zip(P.months, values)]
        rows += [(f"c{i}", m, SALE, repr(v)) for m, v in zip(P.months, values)] + [(f"c{i}", P.months[1], SALE, repr(b * 0.75))]
    want = {}
    for k in {r[0] for r in rows}:
        at = {}
        for _, m, _, v in (r for r in rows if r[0] == k):
            at.setdefault(m, set()).add(float(v))
        ratios = [a / b for m in at for b in at[m] if b for a in at.get(next_month(m), ())]
        mean = math.fsum(ratios) / len(ratios) * 100 if all(map(math.isfinite, ratios)) else None
        want[k] = (mean if mean is None or math.isfinite(mean) else None, sum(r >= 1.1 for r in ratios))
    metrics = spark.createDataFrame(rows, METRIC_LONG)
    stats = growth_per_merchant(growth_month_stats(base_values(metrics, P), P))
    hybrid = score_all(metrics, AS_OF, strategy="hybrid").quotas
    for frame, digits in ((stats, 15), (hybrid, 2)):
        got = {r.property_uuid: (r.growth_multiple, r.increase_month_num) for r in frame.collect()}
        assert set(got) == set(want)
        for k, (mean, up) in want.items():
            assert got[k][1] == up, (k, got[k], want[k])
            assert (got[k][0] is None) == (mean is None) and (mean is None or got[k][0] == pytest.approx(mean, rel=1e-12, abs=0.006 if digits == 2 else 0)), (k, got[k], mean)


def test_growth_pairs_as_rows(spark):
    rnd = random.Random(6)
    rows = [("hot", P.months[i], SALE, repr(round(rnd.uniform(-5, 90), 3))) for i in (0, 1, 1, 2) for _ in range(120)]
    rows += [(f"k{k}", m, SALE, repr(float(rnd.randint(0, 3)))) for k in range(20) for m in rnd.sample(P.months, 4) for _ in range(rnd.choice([1, 2]))]
    rows += [("hot", P.months[1], SALE, "0"), ("one", P.months[0], SALE, "7"), ("x", P.ye_months[0], SALE, "1"), ("x", P.ye_months[1], SALE, "2")]
    at = {}
    for k, m, _, v in rows:
        at.setdefault((k, m), set()).add(float(v))
    want = Counter((k, m, a, b, a / b) for (k, m), vs in at.items() if m in P.months for a in vs
                   for pm in P.months if next_month(pm) == m for b in at.get((k, pm), ()) if b)
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    for block in (16, 1024):
        assert Counter(tuple(r) for r in growth_pair_rows(base, P, block=block).collect()) == want
    assert growth_pair_rows(base.limit(0), P).count() == 0


def test_a_hot_month_is_joined_by_blocks(spark):
    """No group of the pair join holds much more than a block of either side."""
    rows = [("hot", m, SALE, repr(float(i))) for m in P.months[:2] for i in range(1, 400)]
    base = base_values(spark.createDataFrame(rows, METRIC_LONG), P)
    later = base.where(F.col("target_time") == P.months[1]).select("property_uuid", F.col("target_time").alias("m"), F.col("value").alias("v"))
    sizes = spark.createDataFrame([("hot", P.months[1], 8, 8, s) for s in range(4)], "property_uuid string, m string, a_blocks int, b_blocks int, salt int")
    side = growth._blocked(later, "a", "b", sizes, 4)
    groups = side.groupBy("property_uuid", "m", "a_block", "b_block").count().collect()
    assert len(groups) == 64 and max(r["count"] for r in groups) < 100 and sum(r["count"] for r in groups) == 8 * 399
    plan = growth_pair_rows(base, P)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
