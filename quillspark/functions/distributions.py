"""The six bounded distributions of parameters, as expressions.

A range whose ends are equal gives that value; a range the wrong way round is taken the right way round; an unknown or null
distribution gives null (``checked`` raises instead).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.draws import normal, sql_normal, sql_uniform, tagged, uniform

NAMES = ("uniform", "normal", "exponential", "beta", "lognormal", "truncated_normal")
# Acklam's rational approximation of the inverse normal distribution.
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
EDGE = 0.02425
TAIL = 0.0013498980316301  # the normal distribution at -3


def _poly(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def inverse_normal(p: Column) -> Column:
    low = F.sqrt(F.lit(-2.0) * F.ln(p))
    high = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    q = p - 0.5
    r = q * q
    tail = lambda x: _poly(x, C) / (_poly(x, D) * x + 1.0)
    return F.when(p < EDGE, tail(low)).when(p > 1 - EDGE, -tail(high)).otherwise(_poly(r, A) * q / (_poly(r, B) * r + 1.0))


def sample(distribution: Column, lo: Column, hi: Column, key: Column, tag: str | Column) -> Column:
    """A value of the named distribution between lo and hi."""
    a, b = F.least(lo, hi), F.greatest(lo, hi)
    span, mid = b - a, (a + b) / 2.0
    u = uniform(key, tag)
    bounded = lambda x: F.least(b, F.greatest(a, x))
    second = F.element_at(F.array_sort(F.array(*(uniform(key, tagged(tag, f"@{k}")) for k in range(6)))), 2)
    z = normal(key, tag)
    return (
        F.when(~distribution.isin(*NAMES) | distribution.isNull(), F.lit(None).cast("double"))
        .when(a == b, a)
        .when(distribution == "uniform", a + u * span)
        .when(distribution == "normal", bounded(mid + z * span / 6.0))
        .when(distribution == "exponential", F.least(b, a - F.ln(F.lit(1.0) - u) * span / 30.0))
        .when(distribution == "beta", a + second * span)  # beta(2, 5): the second smallest of six
        .when(distribution == "lognormal", F.least(b, a + F.exp(F.lit(0.8) * z) * span / 10.0))
        .otherwise(bounded(mid + span / 6.0 * inverse_normal(F.lit(TAIL) + u * (1.0 - 2.0 * TAIL))))
    )


def checked(distribution: Column, value: Column) -> Column:
    """value, or an error for an unknown distribution."""
    return F.when(distribution.isin(*NAMES), value).otherwise(F.raise_error(F.concat(F.lit("unknown distribution: "), F.coalesce(distribution, F.lit("null")))))


def sql_inverse_normal(p: str) -> str:
    def poly(x: str, cs: tuple[float, ...]) -> str:
        out = f"({cs[0]!r}::DOUBLE)"
        for c in cs[1:]:
            out = f"({out} * {x} + ({c!r}::DOUBLE))"
        return out

    tail = lambda x: f"({poly(x, C)} / ({poly(x, D)} * {x} + 1.0))"
    low, high, q = f"sqrt(-2.0 * ln({p}))", f"sqrt(-2.0 * ln(1.0 - {p}))", f"({p} - 0.5)"
    r = f"({q} * {q})"
    return f"CASE WHEN {p} < {EDGE} THEN {tail(low)} WHEN {p} > {1 - EDGE!r} THEN -{tail(high)} ELSE {poly(r, A)} * {q} / ({poly(r, B)} * {r} + 1.0) END"


def sql_sample(distribution: str, lo: str, hi: str, key: str, tag: str) -> str:
    a, b = f"least({lo}, {hi})", f"greatest({lo}, {hi})"
    span, mid, u, z = f"({b} - {a})", f"(({a} + {b}) / 2.0)", sql_uniform(key, tag), sql_normal(key, tag)
    six = ", ".join(sql_uniform(key, tag, f"@{k}") for k in range(6))
    p = f"({TAIL}::DOUBLE + {u} * (1.0 - 2.0 * {TAIL}::DOUBLE))"
    return f"""CASE WHEN {distribution} IS NULL OR {distribution} NOT IN {NAMES} THEN NULL WHEN {a} = {b} THEN {a}
        WHEN {distribution} = 'uniform' THEN {a} + {u} * {span}
        WHEN {distribution} = 'normal' THEN least({b}, greatest({a}, {mid} + {z} * {span} / 6.0))
        WHEN {distribution} = 'exponential' THEN least({b}, {a} - ln(1.0 - {u}) * {span} / 30.0)
        WHEN {distribution} = 'beta' THEN {a} + list_sort([{six}])[2] * {span}
        WHEN {distribution} = 'lognormal' THEN least({b}, {a} + exp(0.8::DOUBLE * {z}) * {span} / 10.0)
        ELSE least({b}, greatest({a}, {mid} + {span} / 6.0 * ({sql_inverse_normal(p)}))) END"""
