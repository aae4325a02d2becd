"""Numeric and text helper expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text that counts as a number: optional sign, digits, optional exponent.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dround(c: Column | str, digits: int) -> Column:
    """Round in binary: ``round(x * 10^n) / 10^n``.

    ``F.round(x, n)`` rounds the decimal text of a double, SQL engines that
    compute in binary give another last digit for some values.
    """
    scale = float(10**digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def to_number(c: Column | str) -> Column:
    """Text to double; text that is not a plain number becomes NULL.

    The pattern keeps out forms that a bare cast accepts: ``1d``, ``1.5f``,
    ``nan`` and ``inf``.  A number too large for a double is NULL as well.
    """
    text = F.trim(_col(c))
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER_PATTERN) & (F.abs(number) < float("inf")), number)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit a value to ``low..high``; NULL stays NULL."""
    value = _col(c)
    return F.when(
        value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
    )


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage ``100 * part / whole`` as a double; NULL when ``whole`` is 0."""
    return dround(
        F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits
    )


def count_if(condition: Column) -> Column:
    """Number of rows for which the condition holds (0 for no rows)."""
    return F.count(F.when(condition, F.lit(1)))


def fixed_text(c: Column | str, digits: int) -> Column:
    """A double as fixed-point text, never in scientific notation."""
    return F.format_string(f"%.{digits}f", _col(c))


def _lossless(name: str, data_type: str) -> Column:
    """A value as text that tells all values of its type apart, the same under any session time zone."""
    c = F.col(name)
    if data_type == "timestamp":
        c = F.unix_micros(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def hash_key(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """Hex digest of some columns of ``df`` and a seed: a reproducible random order.

    The digest depends on the row's values alone, so a retried task or another
    partitioning gives the same order, which ``rand()`` would not.  Every column enters
    whole, so rows that differ anywhere are ordered independently.
    """
    types = dict(df.dtypes)
    parts = [_lossless(c, types[c]) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


#: Bits of the key.
MIX_KEY_BITS = 46


def mix_key(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """The first 46 bits of the digest as a number."""
    digits = F.substring(hash_key(df, columns, seed), 1, 12)
    return F.shiftright(F.conv(digits, 16, 10).cast("bigint"), 48 - MIX_KEY_BITS)
