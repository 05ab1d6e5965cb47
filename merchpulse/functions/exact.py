"""Sums of doubles that do not depend on the order of their terms.

A double is cut, without rounding, into at most four whole numbers of 24 bits
with fixed places (``bin``: a multiple of 24 binary digits).  Whole numbers of
one bin are added exactly, in any order and by any partial aggregation, so what
comes out of a group depends on its values alone.  At the end the bins are
carried into digits and rounded once, half to even.  Everything is arithmetic
of columns; powers of two are applied in two steps, so that no intermediate
value leaves the range of doubles.

Neighbours of a double are found by the published predecessor formula of
rounding to nearest: subtracting slightly more than half a unit in the last
place, scaled up where that unit would be subnormal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
_DIGIT = 1 << BITS
#: Bins that sums of up to 2^37 terms can carry into.
_CARRY = 4
SMALLEST = 5e-324
LARGEST = 1.7976931348623157e308


def times_power(x: Column, exponent: Column) -> Column:
    """``x * 2 ** exponent`` for an even exponent."""
    half = F.pow(F.lit(2.0), exponent / 2)
    return x * half * half


def top_bin(value: Column) -> Column:
    """The bin of a finite double's first whole number."""
    # log2 may be off by one either way, for which the numbers have room
    return F.when(value == 0, F.lit(0)).otherwise(F.floor((F.floor(F.log2(F.abs(value))) + 2) / BITS)).cast("int")


def scaled_to(value: Column, top: Column) -> Column:
    """The value in units of its first bin, exactly."""
    return times_power(value, top * F.lit(-BITS))


def parts_of(top: Column, scaled: Column, *more: Column) -> Column:
    """``array<struct<bin: int, part: bigint, ...more>>``: the whole part, then
    24 bits at a time of what stands after the point.  The remainder and the
    products by powers of two are exact, and the cast cuts off.  Give columns,
    not long expressions: each stands here several times."""
    parts = [scaled.cast("bigint")]
    for k in range(3):
        after = (scaled * F.lit(float(1 << k * BITS))) % F.lit(1.0)
        parts.append((after * F.lit(float(_DIGIT))).cast("bigint"))
    return F.array(*[F.struct((top - F.lit(k)).alias("bin"), p.alias("part"), *more) for k, p in enumerate(parts)])


def bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def _digits(bins: Column, sign: int) -> Column:
    """Carry the bins' sums upward: the last carry, and of the highest digit
    other than 0 its bin, itself with the digit below (``high``), the two below
    these (``low``), and whether anything follows (``more``)."""
    long = lambda n: F.lit(n).cast("bigint")
    state = F.struct(
        long(0).alias("carry"), long(0).alias("d3"), long(0).alias("d2"), long(0).alias("d1"), F.lit(False).alias("rest"),
        F.lit(0).alias("bin"), long(0).alias("high"), long(0).alias("low"), F.lit(False).alias("more"),
    )
    first, last = F.array_min(F.map_keys(bins)), F.array_max(F.map_keys(bins))

    def step(s, b):
        t = F.coalesce(F.element_at(bins, b), long(0)) * F.lit(sign) + s["carry"]
        digit = F.pmod(t, long(_DIGIT))
        some = digit != 0
        rest = s["rest"] | (s["d1"] != 0)
        return F.struct(
            F.shiftright(t - digit, BITS).alias("carry"), digit.alias("d3"), s["d3"].alias("d2"), s["d2"].alias("d1"), rest.alias("rest"),
            F.when(some, b).otherwise(s["bin"]).alias("bin"),
            F.when(some, digit * long(_DIGIT) + s["d3"]).otherwise(s["high"]).alias("high"),
            F.when(some, s["d2"] * long(_DIGIT) + s["d1"]).otherwise(s["low"]).alias("low"),
            F.when(some, s["rest"]).otherwise(s["more"]).alias("more"),
        )

    return F.aggregate(F.sequence(first, last + F.lit(_CARRY)), state, step)


def _mantissa(d: Column) -> Column:
    # high holds 25 bits at least, so a last bit for "anything below" only breaks ties
    low = F.when(d["more"], F.greatest(d["low"], d["low"].bitwiseOR(F.lit(1).cast("bigint")))).otherwise(d["low"])
    return d["high"].cast("double") * F.lit(float(1 << 2 * BITS)) + low.cast("double")


def rounded(bins: Column) -> Column:
    """``struct<mantissa: double, exponent: int>``: the exact sum of a
    ``map<bin, sum of parts>``, rounded once.  The value is
    ``value_of(...)``; kept apart, it can be divided before it overflows."""
    def of(d, sign):
        return F.struct((_mantissa(d) * F.lit(float(sign))).alias("mantissa"), (d["bin"] * BITS - F.lit(3 * BITS)).alias("exponent"))

    # a last carry below 0 stands for a negative sum
    return bound(_digits(bins, 1), lambda up: F.when(up["carry"] >= 0, of(up, 1)).otherwise(bound(_digits(bins, -1), lambda down: of(down, -1))))


def value_of(sum_: Column, divisor: Column | None = None) -> Column:
    """The rounded sum as a double, divided by ``divisor`` first."""
    m = sum_["mantissa"] if divisor is None else sum_["mantissa"] / divisor
    return times_power(m, sum_["exponent"])


def square_halves(x: Column) -> tuple[Column, Column]:
    """``x * x`` without rounding, as the rounded square and what it lacks
    (Veltkamp's split and Dekker's product); the second is 0 where the square
    leaves the range of doubles."""
    c = x * F.lit(134217729.0)  # 2^27 + 1
    high = c - (c - x)
    low = x - high
    square = x * x
    lack = ((high * high - square) + F.lit(2.0) * high * low) + low * low
    return square, F.when(F.abs(lack) < F.lit(float("inf")), lack).otherwise(F.lit(0.0))


def before(x: Column) -> Column:
    """The largest double below ``x > 0``."""
    u = 2.0**-53
    phi = F.lit(u * (1 + 2 * u))
    scale = F.lit(2.0**53)
    return (
        F.when(x < F.lit(2.0**-1021), x - F.lit(SMALLEST))
        .when(x < F.lit(2.0**-960), (x * scale - phi * (x * scale)) / scale)
        .otherwise(x - phi * x)
    )
