"""Tail probabilities as SQL expressions, so that tests stay lazy one-row frames.

Arguments are SQL text (a column name or an expression in brackets) of type double.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Steps of the series and fractions below. Each reaches double precision with these for its range of arguments.
_SERIES_STEPS = 60
_FRACTION_STEPS = 60
_BETA_SERIES_STEPS = 200
#: Where the complementary error function changes from its power series to its continued fraction.
_ERFC_SPLIT = 2.0
#: Above so many degrees of freedom, and below so large a t squared, the beta series converges fast and loses nothing.
_LARGE_DOF, _LARGE_SQUARE = 100.0, 25.0


def erfc(x: str) -> str:
    """Complementary error function of x >= 0, to about 13 digits.

    Below 2 one less the power series of positive terms; above, the continued fraction from its innermost step.
    """
    step = f"acc.term * 2 * {x} * {x} / (2 * n + 1)"
    series = (
        f"aggregate(sequence(1, {_SERIES_STEPS}), named_struct('term', {x}, 'total', {x}), (acc, n) -> "
        f"named_struct('term', {step}, 'total', acc.total + {step})).total"
    )
    fraction = f"aggregate(sequence({_FRACTION_STEPS}, 1, -1), {x}, (f, n) -> {x} + n / 2D / f)"
    return (
        f"(CASE WHEN {x} < {_ERFC_SPLIT}D THEN 1D - {2 / math.sqrt(math.pi)}D * exp(-{x} * {x}) * {series} "
        f"ELSE exp(-{x} * {x}) / ({math.sqrt(math.pi)}D * {fraction}) END)"
    )


def normal_two_sided(z: str) -> str:
    return erfc(f"(abs({z}) / sqrt(2D))")


def chi_square_upper(x: str, dof: str) -> str:
    """P(X > x) for a chi-square variable with a whole number of degrees of freedom.

    Even: a finite exponential sum. Odd: the normal tail plus a finite sum over half-integers.
    """
    half = f"({x} / 2D)"
    terms = f"int({dof} div 2)"
    index = f"CASE WHEN {terms} > 1 THEN sequence(1, {terms} - 1) ELSE array() END"

    def summed(first: str, shift: str) -> str:
        return (
            f"aggregate({index}, named_struct('term', {first}, 'total', {first}), (acc, i) -> named_struct("
            f"'term', acc.term * {half} / (i + {shift}), 'total', acc.total + acc.term * {half} / (i + {shift}))).total"
        )

    even = f"exp(-{half}) * {summed('1D', '0D')}"
    first_odd = f"(sqrt({half}) / {math.gamma(1.5)}D)"
    odd = f"{erfc(f'sqrt({half})')} + CASE WHEN {terms} > 0 THEN exp(-{half}) * {summed(first_odd, '0.5D')} ELSE 0D END"
    return f"CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {odd} END"


def _gamma_ratio(a: str) -> str:
    """Gamma(a + 1/2) / Gamma(a) for a > 0: its expansion in 1/a, the argument shifted up by 16.

    Taken as one expression, because the difference of two large logarithms would lose digits.
    """
    y = f"({a} + 16D)"
    expansion = f"-1D / (8 * {y}) + 1D / (192 * pow({y}, 3)) - 1D / (640 * pow({y}, 5)) + 17D / (14336 * pow({y}, 7))"
    shifted = " * ".join(f"(({a} + {k}D) / ({a} + {k}.5D))" for k in range(16))
    return f"(sqrt({y}) * exp({expansion}) * {shifted})"


def with_student_t_tail(df: DataFrame, t: str, dof: str, out: str, terms: int = 150) -> DataFrame:
    """Add P(|T| > |t|), for any number of degrees of freedom: the regularised incomplete beta function.

    For small t, and for moderate t with many degrees of freedom, one less the series of positive terms for the
    centre; else the continued fraction for the tail itself, so that small probabilities keep their digits.
    """
    df = df.selectExpr("*", f"try_divide({t} * {t}, {dof}) AS _q", f"{dof} / 2 AS _a")
    df = df.selectExpr(
        "*",
        # x = dof / (dof + t^2) is near 1 with many degrees of freedom: its logarithm and 1 - x are taken from q.
        "1D / (1D + _q) AS _x",
        "_q / (1D + _q) AS _y",
        f"{_gamma_ratio('_a')} * exp(-_a * log1p(_q)) / {math.sqrt(math.pi)}D AS _f",
        f"1D / (1D + _q) > (_a + 1) / (_a + 2.5D) OR ({dof} > {_LARGE_DOF}D AND {t} * {t} < {_LARGE_SQUARE}D) AS _central",
    )
    grow = "acc.term * (_a + 0.5D + n) / (1.5D + n) * _y"
    centre = (
        f"2D * _f * sqrt(_y) * aggregate(sequence(0, {_BETA_SERIES_STEPS}), named_struct('term', 1D, 'total', 1D), "
        f"(acc, n) -> named_struct('term', {grow}, 'total', acc.total + {grow})).total"
    )
    # Coefficients of the fraction alternate: even and odd steps.
    m = "double(j div 2)"
    even = f"{m} * (0.5D - {m}) * _x / ((_a + 2 * {m} - 1) * (_a + 2 * {m}))"
    odd = f"-(_a + {m}) * (_a + 0.5D + {m}) * _x / ((_a + 2 * {m}) * (_a + 2 * {m} + 1))"
    k = f"(CASE WHEN j % 2 = 0 THEN {even} ELSE {odd} END)"
    first = "1D / (1D - (_a + 0.5D) * _x / (_a + 1))"
    tail = f"""_f * sqrt(_y) / _a * aggregate(sequence(2, {2 * terms + 1}), named_struct('c', 1D, 'd', {first}, 'h', {first}),
        (acc, j) -> named_struct('c', 1D + {k} / acc.c, 'd', 1D / (1D + {k} * acc.d),
                                 'h', acc.h * (1D + {k} / acc.c) / (1D + {k} * acc.d))).h"""
    # A difference of exactly 0: every value is as extreme.
    chosen = f"CASE WHEN {t} = 0 THEN 1D WHEN _central THEN greatest(0D, 1D - {centre}) ELSE {tail} END"
    return df.selectExpr("*", f"{chosen} AS {out}").drop("_q", "_a", "_x", "_y", "_f", "_central")
