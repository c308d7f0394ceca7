"""Tails of distributions as SQL of the oracle engine, by series and continued fraction: nothing here is shared with ``genoframe.functions``."""

from __future__ import annotations


def erfc(x: str) -> str:
    """For x of 0 or more: below 2 from the series of erf with positive terms, beyond from the continued fraction."""
    series = f"2 / sqrt(pi()) * exp(-{x} * {x}) * {x} * list_sum([exp(n * ln(2 * {x} * {x}) - lgamma(2e0 * n + 2) + n * ln(2e0) + lgamma(n + 1e0)) for n in range(0, 60)])"
    fraction = f"exp(-{x} * {x}) / sqrt(pi()) / list_reduce([cast(n as double) for n in range(120, 0, -1)], lambda k, n: {x} + n / 2 / k, {x} + 0e0)"
    return f"(case when {x} is null then null when {x} <= 0 then 1e0 when {x} < 2 then 1 - {series} else {fraction} end)"


def chi2(x: str, df: int) -> str:
    """Upper tail of chi-square with 1, 2, 4 or 5 degrees of freedom; ``x`` is a column."""
    half = f"({x} / 2e0)"
    if df == 2:
        return f"exp(-{half})"
    if df == 4:
        return f"(exp(-{half}) * (1 + {half}))"
    root = erfc(f"sqrt({half})")
    if df == 1:
        return root
    assert df == 5
    return f"({root} + exp(-{half}) * (sqrt({half}) * 2 / sqrt(pi()) + power({half}, 1.5e0) * 4 / 3 / sqrt(pi())))"


def chi2_quantile_of(p: str) -> str:
    """Chi-square (one degree) of which the upper tail is ``p`` (a scalar subquery or literal), by 60 bisections, as a scalar subquery."""
    return f"(with recursive b(k, lo, hi) as (select 0, 0e0, 80e0 union all select k + 1, case when {chi2('((lo + hi) / 2)', 1)} > {p} then (lo + hi) / 2 else lo end, case when {chi2('((lo + hi) / 2)', 1)} > {p} then hi else (lo + hi) / 2 end from b where k < 60) select (lo + hi) / 2 from b where k = 60)"
