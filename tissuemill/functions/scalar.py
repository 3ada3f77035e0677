"""Column expressions that the operators share: names, rounding, clamping, pixel cleaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a column name may not be in the language of the cell tables' readers.
RESERVED = [
    "if", "else", "repeat", "while", "function", "for", "next", "break", "TRUE", "FALSE", "NULL", "Inf", "NaN", "NA",
    "NA_integer_", "NA_real_", "NA_character_", "NA_complex_", "in",
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once a row even if body has it inside a lambda.

    A plain column isn't enough: the optimizer may put its expression into the lambda, to be evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def make_names(name: Column) -> Column:
    """A valid column name: other characters than letters, digits, ``.`` and ``_`` become ``.``; X goes before a bad start.

    The start is judged as given: a letter, or a dot that no digit follows, is good.
    """
    clean = F.regexp_replace(name, r"[^\p{L}\p{N}._]", ".")
    good = name.rlike(r"^(\p{L}|\.(?!\p{N}))")
    led = F.when(good, clean).otherwise(F.concat(F.lit("X"), clean))
    return F.trim(F.when(led.isin(RESERVED), F.concat(led, F.lit("."))).otherwise(led))


def contains_ci(text: Column, part: Column) -> Column:
    """Whether ``text`` contains ``part``, in upper case."""
    return F.upper(text).contains(F.upper(part))


def clean_file_name(name: Column) -> Column:
    """Spaces, square brackets and commas become ``_``."""
    return F.translate(name, " [],", "____")


def is_tiff_path(path: Column) -> Column:
    return path.endswith(".tif") | path.endswith(".tiff")


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def round_half_even(x: Column) -> Column:
    return F.rint(x)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    x = x if low is None else F.greatest(x, F.lit(float(low)))
    return x if high is None else F.least(x, F.lit(float(high)))


def finite_or_zero(x: Column) -> Column:
    """NaN, infinities and null become 0."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def normal_quantile(p: Column) -> Column:
    """The standard normal quantile of 0 < p < 1 by rational polynomials (relative error below 1.2e-9)."""
    # Coefficients of the published approximation, and where its pieces meet.
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0]
    edge = 0.02425

    def horner(coefficients: list[float], x: Column) -> Column:
        out = F.lit(coefficients[0])
        for k in coefficients[1:]:
            out = out * x + F.lit(k)
        return out

    def tail(q: Column) -> Column:
        return horner(c, q) / horner(d, q)

    q = p - 0.5
    middle = horner(a, q * q) * q / horner(b, q * q)
    return F.when(p < edge, tail(F.sqrt(-2 * F.log(p)))).when(p > 1 - edge, -tail(F.sqrt(-2 * F.log(1 - p)))).otherwise(middle)
