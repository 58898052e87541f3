"""Null-aware arithmetic shared by the summaries.

Missing values are NULL everywhere: NaN is turned into NULL on the way in
(in Spark ``NaN > 30`` is true) and an undefined ratio is NULL on the way out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimals that are the same whatever order a distributed sum was taken in.
STEADY_DIGITS = 9


def no_nan(df: DataFrame, name: str) -> Column:
    """The named column with NaN replaced by NULL."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / F.lit(60.0)


def total(value: Column) -> Column:
    """Sum without missing values; a group with none at all gives 0."""
    return F.coalesce(F.sum(value), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


# A wide decimal: whole numbers are exact, fractions rounded at the sixth decimal.
EXACT = "decimal(38,6)"


def exact_product(value: Column, weight: Column, copies: Column | None = None) -> Column:
    """Sum of ``value * weight * copies`` over the rows with a weight other than 0, the
    same to the last bit in whatever order a distributed sum is taken."""
    times = F.lit(1) if copies is None else copies
    product = value * weight.cast("double") * times
    return F.sum(F.when(weight != 0, product).cast(EXACT))


def exact_weight(value: Column, weight: Column, copies: Column | None = None) -> Column:
    """Sum of ``weight * copies`` over the rows with a value, just as exact."""
    times = F.lit(1) if copies is None else copies
    return F.sum(F.when(value.isNotNull(), weight.cast("double") * times).cast(EXACT))


def unknown_weight(value: Column, weight: Column) -> Column:
    """Whether a row has a value, but no weight."""
    return F.max(value.isNotNull() & weight.isNull())


def mean_of_sums(weighted: Column, weights: Column, unknown: Column) -> Column:
    ratio = F.try_divide(weighted.cast("double"), weights.cast("double"))
    return F.when(~unknown, ratio)


def weighted_mean(value: Column, weight: Column, copies: Column | None = None) -> Column:
    """Mean of ``value`` weighted by ``weight``, each row counted ``copies`` times.

    Rows without a value are left out. A row with a value but no weight makes
    the mean of its group unknown; a zero weight has no influence. Sums are exact,
    so that the result does not depend on how the rows are partitioned.
    """
    return mean_of_sums(
        exact_product(value, weight, copies),
        exact_weight(value, weight, copies),
        unknown_weight(value, weight),
    )


def count_values(value: Column) -> Column:
    """Exact number of distinct values, where a missing one counts as a value."""
    return F.count_distinct(value) + F.coalesce(
        F.max(value.isNull().cast("long")), F.lit(0)
    )
