"""Casts from CSV text to typed columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JVM reads '12d', '0x1p3' or 'NaN' as numbers; plain decimal text holds no letter but e.
_NOT_A_NUMBER = "[a-df-zA-DF-Z]"

# 9999-12-31; earlier times are bounded alike.
_LAST_MICROS = 253_402_214_400_000_000


def lenient_double(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    return F.when(~text.rlike(_NOT_A_NUMBER), text.try_cast("double"))


def lenient_int(text: Column) -> Column:
    """Text to int, rounding fractions half away from zero; bad or too large text becomes NULL.

    Almost every id is plain digits, so the direct cast comes first and the rounding
    (which goes through BigDecimal) only runs for the rest.
    """
    number = lenient_double(text)
    fits = (number > -2147483648.5) & (number < 2147483647.5)
    return F.coalesce(text.try_cast("int"), F.when(fits, F.round(number).cast("int")))


def strict_number(text: Column, to: str) -> Column:
    """Text to number; empty text becomes NULL and bad text fails the job, in any ANSI mode.

    So does text with more digits behind the point than a decimal type keeps.
    """
    given = F.nullif(text, F.lit(""))
    number = F.when(~given.rlike(_NOT_A_NUMBER), given.try_cast(to))
    bad = given.isNotNull() & number.isNull()
    if to.startswith("decimal"):
        bad |= given.try_cast("decimal(38,19)") != number
    return F.when(bad, F.raise_error(F.concat(F.lit("not a price: "), given))).otherwise(number)


def epoch_millis(text: Column) -> Column:
    """Text epoch milliseconds to an instant; bad text, and times beyond year 9999, become NULL."""
    micros = F.coalesce(
        F.try_multiply(text.try_cast("bigint"), F.lit(1000).cast("bigint")),
        F.round(lenient_double(text) * 1000).try_cast("bigint"),
    )
    return F.timestamp_micros(F.when(F.abs(micros.cast("double")) <= _LAST_MICROS, micros))
