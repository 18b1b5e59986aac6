"""Numeric column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import vocab
from larder.functions.text import strip

# Decimal literals only: keeps out "1d" and "0x1p3", which a JVM cast would accept.
_DECIMAL = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def to_double(text: Column) -> Column:
    """Number written as text, else null."""
    t = strip(text.cast("string"))
    return F.when(t.rlike(_DECIMAL), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def safe_int(text: Column) -> Column:
    """Whole part of a number written as text ("750.0000" -> 750), else null."""
    return to_double(text).try_cast("bigint")


def persons(portions: Column) -> Column:
    """Guests served by one unit; unknown, zero and negative stay null."""
    n = safe_int(portions)
    return F.when(n > 0, n)


def volume_ml(weight: Column, step: Column) -> Column:
    """Bottle volume of a drink. Smaller numbers in this field are grams, hence null."""
    ml = safe_int(weight)
    return F.when((step == vocab.DRINK_STEP) & (ml >= vocab.MIN_VOLUME_ML), ml)


def round_cents(value: Column) -> Column:
    """Nearest cent of the double's exact binary value, ties to the even cent.

    ``round`` works on the shortest decimal form and so calls 2.675 a tie, although the
    stored double lies below it. Here the fraction is scaled by 2^52, which is exact, and
    the cent is found in whole numbers. Bits below that (of a value under 1) are added apart.
    """
    one = F.lit(1 << 52)
    size = F.abs(value)
    whole = F.floor(size).cast("bigint")
    scaled = (size - whole) * F.lit(float(1 << 52))
    fraction = F.floor(scaled).cast("bigint")
    low = (scaled - fraction) * F.lit(100.0)
    hundredfold = fraction * 100 + F.floor(low).cast("bigint")
    beyond = low > F.floor(low)
    cents = F.call_function("div", hundredfold, one)
    rest = hundredfold % one
    half = F.lit(1 << 51)
    odd = ((whole * 100 + cents) % 2) == 1
    up = (rest > half) | ((rest == half) & (beyond | odd))
    rounded = (whole * 100 + cents + F.when(up, 1).otherwise(0)) / F.lit(100.0)
    # From 2^46 on doubles are more than a cent apart: the value is its own rounding.
    exact = F.when(size >= float(1 << 46), size).otherwise(rounded)
    return F.when(value < 0, -exact).otherwise(exact)
