"""Scalar functions as SQL text, so that Spark columns (``expr``) and oracle queries share one formula."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cody's rational approximations of erfc for 0.46875 to 4 (used from 0 on, where the relative error stays below 5e-12) and beyond.
_ERF_C = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e00, 6.61191906371416295e01, 2.98635138197400131e02, 8.81952221241769090e02, 1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03)
_ERF_D = (1.0, 1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02, 1.62138957456669019e03, 3.29079923573345963e03, 4.36261909014324716e03, 3.43936767414372164e03, 1.23033935480374942e03)
_ERF_P = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
_ERF_Q = (1.0, 2.56852019228982242e00, 1.87295284992346725e00, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)
# The rational approximation of the normal quantile (relative error 1.15e-9).
_QA = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_QB = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
_QC = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277671838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_QD = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
_TAIL = 0.02425


def _num(x: float) -> str:
    return f"({x!r}e0)" if "e" not in repr(x) else f"({x!r})"


def _horner(parts: tuple[float, ...], x: str) -> str:
    out = _num(parts[0])
    for p in parts[1:]:
        out = f"({out} * {x} + {_num(p)})"
    return out


def erfc(x: str) -> str:
    """Null of null. Relative error below 5e-12, below 1e-14 beyond 0.5; 0 from about 26.5 on, where the value leaves the range of doubles (P near 1e-308)."""
    y = f"abs({x})"
    square = f"({y} * {y})"
    inverse = f"(1e0 / greatest({square}, 1e0))"
    middle = f"(exp(-{square}) * {_horner(_ERF_C, y)} / {_horner(_ERF_D, y)})"
    large = f"(exp(-{square}) / greatest({y}, 1e0) * (0.5641895835477563e0 - {inverse} * {_horner(_ERF_P, inverse)} / {_horner(_ERF_Q, inverse)}))"
    tail = f"(case when {y} <= 4e0 then {middle} when {y} < 27e0 then {large} else 0e0 end)"
    return f"(case when ({x}) >= 0 then {tail} when ({x}) < 0 then 2e0 - {tail} end)"


def norm_sf(z: str) -> str:
    return f"(0.5e0 * {erfc(f'(({z}) / sqrt(2e0))')})"


def norm_quantile(p: str) -> str:
    low = f"sqrt(-2e0 * ln({p}))"
    high = f"sqrt(-2e0 * ln(1e0 - ({p})))"
    mid = f"(({p}) - 0.5e0)"
    square = f"({mid} * {mid})"
    one = "1e0"
    lower = f"({_horner(_QC, low)} / ({_horner(_QD, low)} * {low} + {one}))"
    upper = f"(-{_horner(_QC, high)} / ({_horner(_QD, high)} * {high} + {one}))"
    middle = f"({_horner(_QA, square)} * {mid} / ({_horner(_QB, square)} * {square} + {one}))"
    return f"(case when ({p}) < {_TAIL} then {lower} when ({p}) > {1 - _TAIL} then {upper} else {middle} end)"


def chi2_sf(x: str, df: int) -> str:
    """Upper tail of chi-square with whole degrees of freedom."""
    half = f"(({x}) / 2e0)"
    if df % 2 == 0:
        terms, factor = ["1e0"], 1.0
        for k in range(1, df // 2):
            factor *= k
            terms.append(f"power({half}, {k}) / {_num(factor)}")
        return f"(exp(-{half}) * ({' + '.join(terms)}))"
    out, gamma = erfc(f"sqrt({half})"), 0.5 * 3.141592653589793**0.5
    for k in range(1, (df + 1) // 2):
        out = f"({out} + exp(-{half}) * power({half}, {k - 0.5}) / {_num(gamma)})"
        gamma *= k + 0.5
    return f"({out})"


def chi2_isf_1(p: str) -> str:
    """Chi-square (one degree) whose upper tail is p."""
    z = norm_quantile(f"(({p}) / 2e0)")
    return f"power({z}, 2)"


def expit(x: str) -> str:
    return f"(case when ({x}) >= 0 then 1e0 / (1e0 + exp(-({x}))) else exp({x}) / (1e0 + exp({x})) end)"


def logit(p: str) -> str:
    return f"ln(({p}) / (1e0 - ({p})))"


def log_expit(x: str) -> str:
    """log(1 / (1 + exp(-x))) without overflow."""
    return f"(case when ({x}) >= 0 then -ln(1e0 + exp(-({x}))) else ({x}) - ln(1e0 + exp({x})) end)"


def mlog10(p: str) -> str:
    return f"(-log10({p}))"


def two_sided(z: str) -> str:
    """Two-sided P of a standard normal value."""
    return erfc(f"(abs({z}) / sqrt(2e0))")


def ci_to_sd(lo: str, up: str, level: float = 0.95) -> str:
    return f"((({up}) - ({lo})) / (2e0 * {norm_quantile(_num(1 - (1 - level) / 2))}))"


def sd_to_ci(beta: str, sd: str, level: float = 0.95) -> tuple[str, str]:
    q = norm_quantile(_num(1 - (1 - level) / 2))
    return f"(({beta}) - {q} * ({sd}))", f"(({beta}) + {q} * ({sd}))"


def ci_to_z(lo: str, up: str, level: float = 0.95) -> str:
    return f"((({lo}) + ({up})) / 2e0 / {ci_to_sd(lo, up, level)})"


def ci_to_p(lo: str, up: str, level: float = 0.95) -> str:
    """The arguments are written out some hundred times: for whole tables use ``with_ci_p``."""
    return two_sided(ci_to_z(lo, up, level))


def with_ci_p(df: DataFrame, lo: str, up: str, out: str = "p", level: float = 0.95) -> DataFrame:
    """``ci_to_p`` in a column: the statistic is a column of its own first, so that the expression stays short enough to be compiled."""
    own = "__z"
    while own in df.columns:
        own += "_"
    return df.withColumn(own, F.expr(ci_to_z(lo, up, level))).withColumn(out, F.expr(two_sided(own))).drop(own)


def beta_p_to_sd(beta: str, p: str) -> str:
    return f"(abs(({beta}) / {norm_quantile(f'(({p}) / 2e0)')}))"


def err_prod(x: str, y: str, sdx: str, sdy: str, cov: str = "0e0") -> str:
    """Deviation of a product; the mixed term is 2 * sdx * sdy * cov, as its users expect."""
    return f"(abs(({x}) * ({y})) * sqrt(power(({sdx}) / ({x}), 2) + power(({sdy}) / ({y}), 2) + 2e0 * ({sdx}) * ({sdy}) * ({cov})))"


def err_frac(x: str, y: str, sdx: str, sdy: str, cov: str = "0e0") -> str:
    return f"(abs(({x}) / ({y})) * sqrt(power(({sdx}) / ({x}), 2) + power(({sdy}) / ({y}), 2) - 2e0 * ({cov}) / (({x}) * ({y}))))"


def err_sum(sdx: str, sdy: str, cov: str = "0e0") -> str:
    return f"sqrt(power({sdx}, 2) + power({sdy}, 2) + 2e0 * ({cov}))"


def ceil_n(x: str, n: int) -> str:
    return f"(ceil(({x}) * 1e{n}) / 1e{n})"


def floor_n(x: str, n: int) -> str:
    return f"(floor(({x}) * 1e{n}) / 1e{n})"


def mod_floor(x: str, m: str) -> str:
    return f"(floor(({x}) / ({m})) * ({m}))"


def mod_round(x: str, m: str) -> str:
    return f"(floor(({x}) / ({m}) + 0.5e0) * ({m}))"


def complement(allele: str) -> str:
    return f"translate({allele}, 'ACGTacgt', 'TGCAtgca')"


def does_flip(a: str, b: str, c: str, d: str) -> str:
    """Whether alleles (a, b) are (c, d) the other way round."""
    return f"(({a}) = ({d}) and ({b}) = ({c}))"


def pair_enc(x: str, y: str) -> str:
    """Index of an unordered pair of allele numbers from 0."""
    hi, lo = f"greatest({x}, {y})", f"least({x}, {y})"
    return f"({hi} * ({hi} + 1) / 2 + {lo})"


# --- column forms where SQL text would be clumsy ---------------------------------------------------------------


def col(sql: str) -> Column:
    return F.expr(sql)


def pair_dec(code: Column) -> Column:
    """struct(x, y), x >= y, of a pair index."""
    hi = F.floor((F.sqrt(8 * code.cast("double") + 1) - 1) / 2)
    return F.struct(hi.cast("long").alias("x"), (code - hi * (hi + 1) / 2).cast("long").alias("y"))


def regex_extract(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


def regex_extract_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def interpolate(text: Column, values: dict[str, str], regex: bool = False) -> Column:
    """Keys replaced by values, the longest key first."""
    for key in sorted(values, key=len, reverse=True):
        text = F.regexp_replace(text, key, values[key]) if regex else F.replace(text, F.lit(key), F.lit(values[key]))
    return text


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def abbreviated(text: Column, n: int, mark: str = "...") -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - len(mark)), F.lit(mark))).otherwise(text)


def hex_to_int(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def digits(number: Column, base: int, width: int) -> Column:
    """Array of digits, the highest first."""
    return F.transform(F.sequence(F.lit(width - 1), F.lit(0)), lambda k: F.floor(number / F.pow(F.lit(float(base)), k)).cast("long") % base)


def from_digits(values: Column, base: int) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, d: acc * base + d)


def parse_counts(text: Column) -> Column:
    """Genotype counts ``a/b/c`` as an array of ints."""
    return F.transform(F.split(text, "/"), lambda x: x.cast("int"))


def parse_date(text: Column, fmt: str, zone: str = "UTC") -> Column:
    return F.to_utc_timestamp(F.to_timestamp(text, fmt), zone)


def chromosome_of(path: Column) -> Column:
    return F.regexp_extract(path, r"chr(\d+)", 1)


def typed_list(spec: str) -> dict[str, str]:
    """``name:TYPE`` items, comma or semicolon between them."""
    import re

    return dict(item.split(":", 1) for item in re.split("[,;]", spec) if item)


def int_ranges(spec: str) -> list[int]:
    """``1-22,23`` as a list."""
    out: list[int] = []
    for item in spec.split(","):
        first, _, last = item.partition("-")
        out.extend(range(int(first), int(last or first) + 1))
    return out


def corr(a: str, b: str) -> Column:
    """Correlation; null where a side does not vary (the built-in one divides by zero there)."""
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b))), F.lit(0.0))


def log_sum_exp(df: DataFrame, keys: list[str], col: str, out: str = "lse") -> DataFrame:
    """Log of the sum of exponentials by key, pivoted at each key's maximum so that nothing overflows; nulls are left out."""
    top = df.groupBy(*keys).agg(F.max(col).alias("__top"))
    joined = df.join(top.select(*(F.col(k).alias(f"__{k}") for k in keys), "__top"), functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys)))
    return joined.groupBy(*keys, "__top").agg(F.sum(F.exp(F.col(col) - F.col("__top"))).alias("__x")).select(*keys, (F.col("__top") + F.log("__x")).alias(out))


def factor_guess(df: DataFrame, col: str, most: float = 0.05) -> DataFrame:
    """Share of distinct values among the known ones, whether the column looks like a factor (share at most ``most``), and whether it has two values."""
    kinds = df.agg(F.count_distinct(col).alias("k"), F.count(col).alias("n"))
    share = F.col("k") / F.nullif(F.col("n"), F.lit(0))
    return kinds.select(share.alias("share"), (share <= most).alias("is_factor"), (F.col("k") == 2).alias("is_binary"))


def log_multinomial(counts: Column) -> Column:
    """Log of the multinomial coefficient of an array of counts; log factorials are sums of logs."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda acc, x: acc + x)
    log_factorial = lambda n: F.aggregate(F.when(n >= 2, F.sequence(F.lit(2).cast("long"), n.cast("long"))).otherwise(F.array().cast("array<bigint>")), F.lit(0.0), lambda acc, k: acc + F.log(k.cast("double")))
    return log_factorial(total) - F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + log_factorial(x))


def multinomial_pseudo(counts: Column, pseudo: Column) -> Column:
    """Log probability of counts where the category probabilities are the counts plus pseudo counts, normalised."""
    padded = F.zip_with(counts, pseudo, lambda c, p: c + p)
    total = F.aggregate(padded, F.lit(0.0), lambda acc, x: acc + x)
    logs = F.zip_with(counts, padded, lambda c, q: c * F.log(q / total))
    return log_multinomial(counts) + F.aggregate(logs, F.lit(0.0), lambda acc, x: acc + x)
