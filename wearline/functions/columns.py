"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: keeps ratio features finite when the denominator is zero.
EPSILON = 1e-6


def clean(name: str) -> Column:
    """The column with NaN read as missing, so that averages and differences skip it."""
    c = F.col(name)
    return F.when(~F.isnan(c), c)


def ieee_div(num: Column, den: Column, zero_as_null: bool = False) -> Column:
    """Floating-point division: x/0 is signed infinity and 0/0 is NaN.

    Spark's own operator raises under ANSI and gives NULL otherwise. A negative zero
    denominator counts as zero.
    """
    if zero_as_null:
        return F.try_divide(num, den)
    inf = F.lit(float("inf"))
    at_zero = (F.when(F.isnan(num) | (num == 0.0), F.lit(float("nan")))
               .when(num > 0.0, inf).when(num < 0.0, -inf))
    return F.when(den == 0.0, at_zero).otherwise(F.try_divide(num, den))


def absolute_error(actual: str, predicted: str) -> Column:
    return F.abs(F.col(predicted) - F.col(actual))


def rmse(actual: str, predicted: str) -> Column:
    """Root of the mean squared error, as an aggregate."""
    err = F.col(actual) - F.col(predicted)
    return F.sqrt(F.avg(err * err))


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text to a timestamp; `Z` is offset zero, no offset means UTC, anything else NULL.

    The session time zone must be UTC. The pattern keeps out loose forms such as a bare year.
    """
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    text = F.trim(c)
    return F.when(text.rlike(shape), text.try_cast("timestamp"))
