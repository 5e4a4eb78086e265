"""Rounding with one arithmetic recipe.

``F.round`` on a double rounds the shortest decimal text of the value
(``round(1.005, 2) = 1.01``), whereas an engine that rounds the binary value
gives 1.0.  The reports of this library are compared across engines, so every
rounded measure is built from the same IEEE operations:

* ``half_away(x, d)``: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``; NaN and
  values too large to have decimals pass unchanged.
* ``ratio(num, den, d, scale)``: the rounded value of ``num * scale / den``
  with one division, from integer sums (rates and shares).
* ``money_avg`` / ``money_sum``: amounts are summed as exact decimals of six
  places and rounded once, at the end, so the result neither depends on the
  order in which partitions are added nor loses fractions of a cent.

All are plain column expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Doubles from here on are whole numbers.
_WHOLE = float(2 ** 52)


def half_away(x, digits: int) -> Column:
    """Round half away from zero at ``digits`` decimals; -0.0 becomes 0.0."""
    x = _col(x).cast("double")
    p = float(10 ** digits)
    scaled = F.abs(x) * F.lit(p)
    rounded = F.signum(x) * (F.floor(scaled + F.lit(0.5)) / F.lit(p))
    return F.when(F.isnan(x) | (scaled >= F.lit(_WHOLE)), x).otherwise(rounded) + F.lit(0.0)


def ratio(num, den, digits: int = 2, scale: float = 100.0) -> Column:
    """``round(num * scale / den, digits)``; NULL when ``den`` is 0 or NULL."""
    num, den = _col(num), _col(den)
    q = num.cast("double") * F.lit(float(scale) * 10 ** digits) / F.nullif(den.cast("double"), F.lit(0.0))
    return half_away(q, 0) / F.lit(float(10 ** digits)) + F.lit(0.0)


#: Amounts this large (and infinite ones) are summed as doubles.
_LARGE = 1e21


def _micros(amount) -> Column:
    """Sum of the amounts in millionths, exact (aggregate)."""
    x = _col(amount).cast("double")
    return F.sum(F.when(~F.isnan(x) & (F.abs(x) < F.lit(_LARGE)), x).cast("decimal(28,6)")) * F.lit(1_000_000)


def _plain(amount) -> Column:
    """True when a NaN or very large amount forbids the exact sum (aggregate)."""
    x = _col(amount).cast("double")
    return F.coalesce(F.bool_or(F.isnan(x) | (F.abs(x) >= F.lit(_LARGE))), F.lit(False))


def _cents(micros: Column, unit: Column) -> Column:
    """``micros / unit`` in whole cents, half away from zero, as money."""
    micros = micros.cast("decimal(38,0)")
    half = (unit * F.lit(5_000)).cast("decimal(38,0)")
    step = (unit * F.lit(10_000)).cast("decimal(38,0)")
    top = F.abs(micros) + half
    whole = (top - top % step) / step  # divides evenly, so the quotient is exact
    return F.signum(micros.cast("double")) * whole.cast("double") / F.lit(100.0) + F.lit(0.0)


def money_sum(amount) -> Column:
    """``round(sum(amount), 2)``, exact to the sixth decimal (aggregate); NaN
    if an amount is NaN."""
    return F.when(_plain(amount), half_away(F.sum(_col(amount).cast("double")), 2)).otherwise(
        _cents(_micros(amount), F.lit(1)))


def money_avg(amount) -> Column:
    """``round(avg(amount), 2)``, exact to the sixth decimal (aggregate)."""
    n = F.count(_col(amount))
    return F.when(_plain(amount), half_away(F.avg(_col(amount).cast("double")), 2)).when(
        n > 0, _cents(_micros(amount), n))


#: Amounts below this have exact squares in two limbs of nine digits.
_SQUARED = 1e11
_LIMB, _HALF = 10 ** 9, 1 << 30


def _whole_sum(x: Column) -> Column:
    """Exact sum of longs below 2^60 as a decimal (aggregate): high and low
    halves are added as longs, good for 8 billion rows a group."""
    high, low = F.sum(F.shiftright(x, 30)), F.sum(x.bitwiseAND(F.lit(_HALF - 1)))
    return high.cast("decimal(38,0)") * F.lit(_HALF).cast("decimal(11,0)") + low.cast("decimal(38,0)")


def money_std(amount) -> Column:
    """``round(stddev_samp(amount), 2)``, the same for every order and
    partitioning of the rows (aggregate); null for fewer than two amounts.

    Amounts are taken in millionths, cut into limbs ``h * 10^9 + l``; the sums
    of h, l, hh, hl and ll are exact, and so is ``n * sum(m^2) - sum(m)^2``,
    whose limbs are carried before the one division and root.  NaN, infinite
    and very large amounts fall back on the engine's deviation."""
    x = _col(amount).cast("double")
    plain = F.coalesce(F.bool_or(F.isnan(x) | (F.abs(x) >= F.lit(_SQUARED))), F.lit(False))
    small = F.when(~F.isnan(x) & (F.abs(x) < F.lit(_SQUARED)), x).cast("decimal(18,6)")
    m = (small * F.lit(1_000_000)).cast("long")
    low = F.pmod(m, F.lit(_LIMB))
    high = ((m - low) / F.lit(_LIMB)).cast("long")
    big = "decimal(38,0)"
    n = F.count(x).cast(big)
    h, l_ = F.sum(high).cast(big), F.sum(low).cast(big)
    # n * S2 - S1^2 = t2 * 10^18 + t1 * 10^9 + t0
    t2 = (n * _whole_sum(high * high) - h * h).cast(big)
    t1 = ((n * _whole_sum(high * low) - h * l_) * F.lit(2)).cast(big)
    t0 = (n * _whole_sum(low * low) - l_ * l_).cast(big)
    limb = F.lit(_LIMB).cast("decimal(10,0)")
    r0 = F.pmod(t0, limb)
    t1 = (t1 + ((t0 - r0) / limb).cast(big)).cast(big)
    r1 = F.pmod(t1, limb)
    t2 = (t2 + ((t1 - r1) / limb).cast(big)).cast(big)
    rest = (r1 * limb + r0).cast(big)
    exact = F.when(F.abs(t2) < F.lit(10 ** 18).cast(big),
                   (t2 * F.lit(10 ** 18).cast("decimal(19,0)") + rest).cast(big).cast("double")) \
        .otherwise(t2.cast("double") * F.lit(1e18) + rest.cast("double"))
    count = F.count(x).cast("double")
    std = F.sqrt(exact / F.nullif(count * (count - F.lit(1.0)), F.lit(0.0))) / F.lit(1e6)
    return half_away(F.when(plain, F.stddev_samp(x)).otherwise(std), 2)
