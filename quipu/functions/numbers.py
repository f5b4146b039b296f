"""Arithmetic, casts and conditions with Python's and NumPy's rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that a refused calculation reports.
DIVISION_BY_ZERO = "Error: división por cero"
UNKNOWN_OPERATION = "Operación no válida"


def floor_div(a: Column, b: Column) -> Column:
    """Quotient of whole numbers rounded down, exact at any size; null on a zero divisor."""
    divisor = F.nullif(b, F.lit(0))
    rest = F.try_mod(a, b)
    down = (rest != 0) & ((rest < 0) != (b < 0))
    return F.call_function("div", a, divisor) - F.when(down, 1).otherwise(0)


def floor_div_real(a: Column, b: Column) -> Column:
    """Quotient of doubles rounded down, as a double; null on a zero divisor."""
    quotient = F.try_divide(a, b)
    return quotient - floor_mod(quotient, F.lit(1.0))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; null on a zero divisor."""
    rest = F.try_mod(a, b)
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def maximum(a: Column, b: Column) -> Column:
    """Larger value; NaN if either is NaN."""
    return F.greatest(a, b)


def minimum(a: Column, b: Column) -> Column:
    """Smaller value; NaN if either is NaN (Spark orders NaN last)."""
    return F.when(F.isnan(a) | F.isnan(b), F.lit(float("nan"))).otherwise(F.least(a, b))


def fmax(a: Column, b: Column) -> Column:
    """Larger value, ignoring NaN."""
    return F.greatest(F.nanvl(a, F.lit(None)), F.nanvl(b, F.lit(None)))


def fmin(a: Column, b: Column) -> Column:
    """Smaller value, ignoring NaN."""
    return F.least(F.nanvl(a, F.lit(None)), F.nanvl(b, F.lit(None)))


def _ieee(x: Column, edge: int, logarithm) -> Column:
    """A logarithm with -inf at the edge of its range and NaN below."""
    return (
        F.when(x > edge, logarithm(x))
        .when(x == edge, F.lit(float("-inf")))
        .when(x < edge, F.lit(float("nan")))
        .otherwise(x.cast("double"))
    )


def log_ieee(x: Column) -> Column:
    return _ieee(x, 0, F.log)


def log10_ieee(x: Column) -> Column:
    return _ieee(x, 0, F.log10)


def log2_ieee(x: Column) -> Column:
    return _ieee(x, 0, F.log2)


def log1p_ieee(x: Column) -> Column:
    return _ieee(x, -1, F.log1p)


_LIMB = 9  # decimal digits that are multiplied at once


def factorial_text(n: Column) -> Column:
    """All digits of a factorial as text; null below zero.

    The digits are kept in groups of nine, lowest first, so no number is too long.
    """
    limb = F.lit(10**_LIMB).cast("bigint")

    def times(limbs: Column, k: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            value = x * k + state["carry"]
            return F.struct(F.call_function("div", value, limb).alias("carry"), F.concat(state["out"], F.array(value % limb)).alias("out"))

        def end(state: Column) -> Column:
            return F.when(state["carry"] > 0, F.concat(state["out"], F.array(state["carry"]))).otherwise(state["out"])

        return F.aggregate(limbs, start, step, end)

    limbs = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.array(F.lit(1).cast("bigint")), lambda a, k: times(a, k.cast("bigint")))
    digits = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), _LIMB, "0")), "")
    return F.when(n >= 0, F.ltrim(digits, F.lit("0")))


def calculate(a: Column, b: Column, op: Column) -> tuple[Column, Column]:
    """Result and error text of a calculation chosen by its sign."""
    result = (
        F.when(op == "+", a + b).when(op == "-", a - b).when(op == "*", a * b).when(op == "/", F.try_divide(a, b))
    )
    error = F.when((op == "/") & (b == 0), DIVISION_BY_ZERO).when(
        ~op.isin("+", "-", "*", "/") | op.isNull(), UNKNOWN_OPERATION
    )
    return result, error


def to_int(x: Column) -> Column:
    """Whole number from a number (cut towards zero) or from text; null if not one."""
    return x.try_cast("bigint")


def text_to_int(s: Column) -> Column:
    """Whole number from text; null for text such as '3.9' that is not one."""
    return F.when(s.rlike(r"\A\s*[+-]?\d+\s*\z"), F.trim(s).try_cast("bigint"))


def to_text(x: Column) -> Column:
    """A double as Python prints it: an exponent only below 1e-4 and from 1e16, and nan, inf, -inf.

    Every row is printed once and changed by plain replacements: no patterns, and no digits taken apart.
    """
    size, engine = F.abs(x), x.cast("string")
    # The engine writes 1.0E-5 and 1.25E16; Python 1e-05 and 1.25e+16.
    short = F.replace(engine, F.lit(".0E"), F.lit("E"))
    # From 1e7 to 1e16 and from 1e-4 to 1e-3 the decimal holds all digits; a whole number has no other digits than its own.
    digits = F.rtrim(x.cast("decimal(38,20)").cast("string"), F.lit("0"))
    whole = x.cast("bigint")
    return (
        F.when((size >= 1e-3) & (size < 1e7), engine)  # here both print alike, without any further work
        .when(F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(x == 0, engine)
        .when((size >= 1e7) & (size < 1e16), F.when(x == whole, F.concat(whole.cast("string"), F.lit(".0"))).otherwise(digits))
        .when((size >= 1e-4) & (size < 1e7), digits)
        .when(size >= 1e16, F.replace(short, F.lit("E"), F.lit("e+")))
        .when(size >= 1e-9, F.replace(short, F.lit("E-"), F.lit("e-0")))  # exponents of one digit: 5 to 9
        .when(x.isNotNull(), F.replace(short, F.lit("E-"), F.lit("e-")))
    )


def truthy_number(x: Column) -> Column:
    """True unless zero or missing; NaN counts as true."""
    return F.coalesce(x != 0, F.lit(False))


def truthy_text(s: Column) -> Column:
    """True unless empty or missing, so the text '0' is true."""
    return F.coalesce(F.length(s) > 0, F.lit(False))


def circle_area(radius: Column) -> Column:
    return F.pi() * F.pow(radius, F.lit(2))


def where(condition: Column, yes, no) -> Column:
    """One of two values; a null condition counts as false."""
    return F.when(condition, yes).otherwise(no)


def bands(*steps: tuple[Column, str], otherwise: str) -> Column:
    """Label of the first step whose condition holds; a null condition does not."""
    label = F.when(steps[0][0], steps[0][1])
    for condition, text in steps[1:]:
        label = label.when(condition, text)
    return label.otherwise(otherwise)


def python_type(x: Column) -> Column:
    """The name Python gives the value's type."""
    kind = F.typeof(x)
    return (
        F.when(x.isNull(), "NoneType")
        .when(kind.isin("tinyint", "smallint", "int", "bigint"), "int")
        .when(kind.isin("float", "double"), "float")
        .when(kind == "string", "str")
        .when(kind == "boolean", "bool")
        .when(kind.startswith("array"), "list")
        .when(kind.startswith("map"), "dict")
        .when(kind.startswith("struct"), "tuple")
        .otherwise(kind)
    )
