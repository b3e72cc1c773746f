"""p-values for result rows.

Spark SQL has no normal, beta or gamma tail function. Each helper turns one
test statistic into one p-value and only ever sees aggregated rows. The
functions are nested so that they travel to the executors by value and need
no installed package there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_two_sided(z: Column) -> Column:
    def tail(value):
        return None if value is None else math.erfc(abs(value) / math.sqrt(2.0))

    return F.udf(tail, T.DoubleType())(z)


def normal_upper(z: Column) -> Column:
    def tail(value):
        return None if value is None else 0.5 * math.erfc(value / math.sqrt(2.0))

    return F.udf(tail, T.DoubleType())(z)


def inversions_two_sided(discordant: Column, size: Column) -> Column:
    """Two-sided probability of at most (or at least) so many discordant pairs among all orders of ``size`` values.

    The number of orders by their inversions grows from value to value: the k-th value adds 0 to k - 1 of them. Beyond
    171 values the probability of any count that is asked for here (0 or 1) is below the least double.
    """

    def tail(count, n):
        if count is None or n is None or n < 2:
            return None
        fewer = int(min(count, n * (n - 1) // 2 - count))
        if fewer <= 1:
            return 2.0 / math.factorial(n - fewer) if n <= 171 else 0.0
        orders = [1] + [0] * fewer
        for k in range(2, n + 1):
            total, grown = 0, []
            for i in range(fewer + 1):
                total += orders[i] - (orders[i - k] if i >= k else 0)
                grown.append(total)
            orders = grown
        return min(1.0, 2 * sum(orders) / math.factorial(n))

    return F.udf(tail, T.DoubleType())(discordant, size)


def student_two_sided(t: Column, degrees: Column) -> Column:
    """Two-sided tail of Student's t: the regularised incomplete beta function by its continued fraction.

    Null if the fraction does not settle.
    """

    def gamma_ratio(a, b):
        """Log of gamma(a + b) / gamma(a); for a large a from Stirling's series, whose large terms cancel here by themselves."""
        if a < 1e4:
            return math.lgamma(a + b) - math.lgamma(a)
        return (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + (1 / (a + b) - 1 / a) / 12

    def beta(a, b, x):
        if x <= 0.0 or x >= 1.0:
            return min(max(x, 0.0), 1.0)
        if x > (a + 1.0) / (a + b + 2.0):
            rest = beta(b, a, 1.0 - x)
            return None if rest is None else 1.0 - rest
        tiny = 1e-300
        value, c, d = 1.0, 1.0, 0.0
        for step in range(1, 1_000_000):
            k = step // 2
            if step % 2 == 0:
                term = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
            else:
                term = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
            d = 1.0 / ((1.0 + term * d) or tiny)
            c = (1.0 + term / c) or tiny
            value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        else:
            return None
        log_front = a * math.log(x) + b * math.log1p(-x) - math.lgamma(min(a, b)) + gamma_ratio(max(a, b), min(a, b))
        return math.exp(log_front) / (a * value)

    def tail(value, freedom):
        if value is None or freedom is None or freedom < 1:
            return None
        return beta(freedom / 2.0, 0.5, freedom / (freedom + value * value))

    return F.udf(tail, T.DoubleType())(t, degrees)


def chi_square_upper(statistic: Column, degrees: Column) -> Column:
    """Upper tail of chi-square: the regularised incomplete gamma function by series or continued fraction.

    Null if the fraction does not settle.
    """

    def gamma(a, x):
        if x <= 0.0:
            return 1.0
        front = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1.0:
            term = total = 1.0 / a
            k = a
            while term > total * 1e-17:
                k += 1.0
                term *= x / k
                total += term
            return 1.0 - front * total
        tiny = 1e-300
        value, c, d = 1.0, 1.0, 0.0
        for step in range(1, 1_000_000):
            k = (step + 1) // 2
            term = ((k - a) if step % 2 == 1 else k) / x
            d = 1.0 / ((1.0 + term * d) or tiny)
            c = (1.0 + term / c) or tiny
            value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        else:
            return None
        return front / (x * value)

    def tail(value, freedom):
        if value is None or freedom is None:
            return None
        return 1.0 if freedom == 0 else gamma(freedom / 2.0, value / 2.0)

    return F.udf(tail, T.DoubleType())(statistic, degrees)
