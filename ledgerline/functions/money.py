"""Exact money: products and sums of decimals without lost digits.

Spark narrows the scale of a decimal result that would need more than 38
digits. A sum of amounts of 8 decimals times a rate of 8 decimals is such a
result: it would keep 6 decimals. Rouble amounts are therefore computed in one
stated type, ``RUB``: 16 decimals, all that such a product can have, and 21
digits before the point. What does not fit it is an error, never rounded. A
sum or difference of two ``RUB`` values is exact in Spark's own type for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The type of rouble amounts while they are computed.
RUB = T.DecimalType(37, 16)


def as_rub(c: Column | str) -> Column:
    """The value in the rouble type; one with more than 21 digits before the point is an error."""
    return (F.col(c) if isinstance(c, str) else c).cast(RUB)


def exact_product(a: Column, a_type: T.DecimalType, b: Column, b_type: T.DecimalType) -> Column:
    """a * b without rounding, as ``RUB`` where plain arithmetic would round; NULL if either is.

    Where the plain product may round, ``a`` is cut into a low part, whose
    product fits, and a high part of whole units of a power of ten.
    """
    scale = a_type.scale + b_type.scale
    if a_type.precision + b_type.precision + 1 <= 38 or scale <= 6:
        return a * b  # Spark keeps the scale
    if scale > RUB.scale:
        raise ValueError(f"{a_type.simpleString()} x {b_type.simpleString()} has more than {RUB.scale} decimals")
    low_digits = 36 - a_type.scale - b_type.precision
    if low_digits < 1:
        raise ValueError(f"{b_type.simpleString()} is too wide for a rate")
    unit = F.lit(10 ** low_digits).cast(T.DecimalType(low_digits + 1, 0))
    low = (a % unit).cast(T.DecimalType(low_digits + a_type.scale, a_type.scale))
    # no more than its product with the rate has room for; a larger one would not fit RUB either
    high_digits = max(1, min(a_type.precision - a_type.scale - low_digits, 37 - b_type.precision))
    high = ((a - low) / unit).cast(T.DecimalType(high_digits, 0))
    room = max(1, RUB.precision - RUB.scale - low_digits)  # digits the high product has before the point
    of_high = (high * b).cast(T.DecimalType(room + b_type.scale, b_type.scale)) * unit
    return as_rub(as_rub(of_high) + as_rub(low * b))


def in_roubles(df: DataFrame, amount: str, rate: str) -> Column:
    """The amount times the rate, exactly; times 1 where the rate is NULL."""
    types = df.schema[amount].dataType, df.schema[rate].dataType
    if not all(isinstance(t, T.DecimalType) for t in types):
        return F.col(amount) * F.coalesce(F.col(rate), F.lit(1))
    return exact_product(F.col(amount), types[0], F.coalesce(F.col(rate), F.lit(1).cast(types[1])), types[1])
