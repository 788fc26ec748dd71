"""Tails of test statistics as column expressions.

The regularised incomplete beta and gamma functions are evaluated by their
continued fractions (or, below the mean, the gamma's power series) from the
last term back, with ``aggregate`` over a sequence of term numbers. The
sequence has as many terms as the parameters need, a few square roots of them,
so nothing is iterated to convergence and no row leaves its executor.

What stands before the fractions is put together so that large parameters keep
their digits: logarithms of ratios near 1 by ``log1p``, and the remainders of
Stirling's formula instead of differences of log-gammas.

The normal tail is for whole columns: its series and fraction have a fixed
number of terms. Written out they make a method of generated code that is too
long for the JVM to compile, so they are aggregates over constants, and both
tails of a value share them.

Beyond ``MANY`` degrees of freedom the limits are used (normal for t,
chi-square for F); they differ by less than one over the degrees of freedom.
Undefined tails (null or non-finite statistics, no degrees of freedom) are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MANY = 1e7
#: Recurrence steps before Stirling's series, which has full precision from here on.
STEPS = 16


def _num(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def stirling_rest(z: Column) -> Column:
    """ln(gamma(z)) - ((z - 1/2) ln z - z + ln(2 pi) / 2) for z > 0."""
    step = lambda acc, i: acc + (z + i + 0.5) * F.log1p(1.0 / (z + i)) - 1.0
    w = z + STEPS
    # fixed values: B(2k) / (2k (2k - 1)) of Stirling's series
    series = 1 / (12 * w) - 1 / (360 * w**3) + 1 / (1260 * w**5) - 1 / (1680 * w**7) + 1 / (1188 * w**9)
    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS - 1)), F.lit(0.0), step) + series


def _backwards(terms: Column, start: Column, step) -> Column:
    """step(value, i) for i = terms, ..., 2, 1 (as doubles)."""
    return F.aggregate(F.sequence(terms.cast("long"), F.lit(1).cast("long"), F.lit(-1).cast("long")), start,
                       lambda v, i: step(v, i.cast("double")))


def _beta_fraction(x: Column, y: Column, a: Column, b: Column) -> Column:
    """I_x(a, b) by its continued fraction, which converges fast for x < (a + 1) / (a + b + 2); y = 1 - x."""
    d = x * b - y * a
    # x^a y^b / (a B(a, b)) without powers of large numbers
    front = F.exp(a * F.log1p(d / a) + b * F.log1p(-d / b) + 0.5 * F.log(a * b / (a + b) / (2 * math.pi))
                  + stirling_rest(a + b) - stirling_rest(a) - stirling_rest(b)) / a

    def step(f: Column, i: Column) -> Column:
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return 1.0 + F.when(i % 2 == 0, even).otherwise(odd) / f
    terms = F.ceil(200 + 12 * F.sqrt(F.greatest(a, b)))
    return F.when(x <= 0, 0.0).otherwise(front / _backwards(terms, F.lit(1.0), step))


def beta_regularised(x, y, a, b) -> Column:
    """I_x(a, b) for x + y = 1; give the smaller of x and y without rounding of 1 minus the other."""
    x, y, a, b = map(_num, (x, y, a, b))
    return F.when(x <= 0, 0.0).when(y <= 0, 1.0).when(x < (a + 1) / (a + b + 2), _beta_fraction(x, y, a, b)) \
        .otherwise(1.0 - _beta_fraction(y, x, b, a))


def gamma_upper(a, x) -> Column:
    """Q(a, x), the regularised upper incomplete gamma function."""
    a, x = _num(a), _num(x)
    d = x - a
    # x^a e^-x / gamma(a)
    front = F.exp(a * F.log1p(d / a) - d + 0.5 * F.log(a / (2 * math.pi)) - stirling_rest(a))
    terms = F.ceil(200 + 12 * F.sqrt(F.greatest(a, F.lit(1.0))))
    lower = front / a * _backwards(terms, F.lit(1.0), lambda s, i: 1.0 + s * x / (a + i))
    fraction = _backwards(terms, F.lit(1e300), lambda f, i: x + 2 * i - 1 - a + i * (a - i) / f)
    # the first term of the fraction stands for i = 0: x + 1 - a + (a - 1) / (x + 3 - a + ...)
    return F.when(x <= 0, 1.0).when(x < a + 1, 1.0 - lower).otherwise(front / fraction)


def chi2_sf(x, k) -> Column:
    """P(X > x) for chi-square with k degrees of freedom."""
    x, k = _num(x), _num(k)
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (k > 0)
    return F.when(ok, F.when(x <= 0, 1.0).otherwise(gamma_upper(k / 2, x / 2)))


def f_sf(f, d1, d2) -> Column:
    """P(F > f) for F(d1, d2)."""
    f, d1, d2 = map(_num, (f, d1, d2))
    ok = f.isNotNull() & ~F.isnan(f) & (F.abs(f) < float("inf")) & (d1 > 0) & (d2 > 0)
    total = d2 + d1 * f
    return F.when(ok, F.when(f <= 0, 1.0).when(d2 > MANY, chi2_sf(d1 * f, d1))
                  .otherwise(beta_regularised(d2 / total, d1 * f / total, d2 / 2, d1 / 2)))


def t_two_sided(t, df) -> Column:
    """P(|T| > |t|) for Student's t with df degrees of freedom."""
    t, df = _num(t), _num(df)
    ok = t.isNotNull() & ~F.isnan(t) & (df > 0)
    total = df + t * t
    return F.when(ok, F.when(t == 0, 1.0).when(F.abs(t) == float("inf"), 0.0)
                  .when(df > MANY, gamma_upper(0.5, t * t / 2))
                  .otherwise(beta_regularised(df / total, t * t / total, df / 2, 0.5)))


def pearson_p(r, n) -> Column:
    """Two-sided p of Pearson's r with n pairs (t test, n - 2 degrees of freedom)."""
    r, n = _num(r), _num(n)
    ok = r.isNotNull() & ~F.isnan(r) & (n >= 3)
    t = r * F.sqrt((n - 2) / (1 - r * r))
    return F.when(ok, F.when(F.abs(r) >= 1.0, 0.0).otherwise(t_two_sided(t, n - 2)))


def normal_parts(z: Column) -> tuple[Column, Column]:
    """What ``ln_normal_sf`` of z and of -z have in common: the series near 0 and the far tail, each null where the other holds."""
    u = F.abs(z)
    constants = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    series = F.aggregate(constants(2 * k + 1 for k in range(32, 0, -1)), F.lit(1.0), lambda s, c: 1.0 + z * z / c * s)
    fraction = F.aggregate(constants(range(50, 0, -1)), u, lambda f, k: u + k / f)
    far = -u * u / 2 - 0.5 * math.log(2 * math.pi) - F.log(fraction)
    return F.when(u <= 2.5, series), F.when(u > 2.5, far)


def ln_normal_sf(z: Column, parts: tuple[Column, Column] | None = None) -> Column:
    """ln P(Z > z) of the standard normal, with full relative precision in both tails.

    Within 2.5 deviations by the series z + z^3/3 + z^5/15 + ..., beyond by the
    continued fraction of Mills' ratio; both from the last term back. ``parts``
    are the columns of ``normal_parts`` if they are at hand.
    """
    s, far = parts or normal_parts(z)
    middle = F.log(0.5 - z * s * F.exp(-z * z / 2) / math.sqrt(2 * math.pi))
    return F.when(z > 2.5, far).when(z < -2.5, F.log1p(-F.exp(far))).otherwise(middle)


def anderson_darling_p(a2, n) -> Column:
    """p of the Anderson-Darling statistic for a normal with estimated mean and variance."""
    a2, n = _num(a2), _num(n)
    a = a2 * (1 + 0.75 / n + 2.25 / (n * n))
    # fixed values: D'Agostino and Stephens (1986), table 4.9
    return (F.when(a < 0.2, 1 - F.exp(-13.436 + 101.14 * a - 223.73 * a * a))
             .when(a < 0.34, 1 - F.exp(-8.318 + 42.796 * a - 59.938 * a * a))
             .when(a < 0.6, F.exp(0.9177 - 4.279 * a - 1.38 * a * a))
             .when(a < 10, F.exp(1.2937 - 5.709 * a + 0.0186 * a * a)).otherwise(3.7e-24))


def lilliefors_p(d, n) -> Column:
    """p of the Kolmogorov-Smirnov distance to a normal with estimated mean and variance."""
    d, n = _num(d), _num(n)
    kd = F.when(n > 100, d * F.pow(n / 100, F.lit(0.49))).otherwise(d)
    nd = F.least(n, F.lit(100.0))
    # fixed values: Dallal and Wilkinson (1986); for p above 0.1 the fits to Stephens' (1974) modified statistic
    p = F.exp(-7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * F.sqrt(nd + 2.78019) - 0.122119
              + 0.974598 / F.sqrt(nd) + 1.67997 / nd)
    k = (F.sqrt(n) - 0.01 + 0.85 / F.sqrt(n)) * d
    large = (F.when(k <= 0.302, 1.0)
              .when(k <= 0.5, 2.76773 - 19.828315 * k + 80.709644 * k**2 - 138.55152 * k**3 + 81.218052 * k**4)
              .when(k <= 0.9, -4.901232 + 40.662806 * k - 97.490286 * k**2 + 94.029866 * k**3 - 32.355711 * k**4)
              .when(k <= 1.31, 6.198765 - 19.558097 * k + 23.186922 * k**2 - 12.234627 * k**3 + 2.423045 * k**4)
              .otherwise(0.0))
    return F.when(p > 0.1, large).otherwise(p)
