"""Number columns: parsing, rounding, exact means. All expressions stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loticote.functions.fixed_values import NOT_A_PRICE, ROOM_PREFIX
from loticote.functions.text import normalize_text, strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ROOM_COUNT = r"^(\d+\.?\d*|\.\d+)$"
SEVERAL_DOTS = r"^[0-9.]*[0-9][0-9.]*$"

# 2**27 + 1 cuts a double into two halves whose products are exact.
HALF_SPLIT = 134217729.0


# Text is matched before it is cast: a failing cast raises and swallows an exception per row. The
# match also names its column only once, which keeps pushed-down filters cheap.


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL, never NaN."""
    return F.regexp_substr(strip(col.cast("string")), F.lit(NUMBER)).try_cast("double")


def clean_price(col: Column, numeric: bool = False) -> Column:
    """Price text to double, keeping digits and dots only.

    A column that is already numeric must not go through its text form: 12000000.0 prints as
    ``1.2E7`` and would be read back as 1.27. Dropping the minus sign is all the text rule does
    to such a value.
    """
    if numeric:
        value = F.abs(col.cast("double"))
        return F.when(~F.isnan(value), value)
    kept = F.regexp_replace(col, NOT_A_PRICE, "")
    return F.nullif(kept, F.lit("")).try_cast("double")


def _leading_count(col: Column, pattern: str, least: int = 0) -> Column:
    found = F.nullif(F.regexp_extract(normalize_text(col), pattern, 1), F.lit("")).try_cast("int")
    return F.when(found >= least, found)


def rooms_from_type(col: Column) -> Column:
    """Room count written in front of the type (``3 chambres salon`` gives 3)."""
    return _leading_count(col, ROOM_PREFIX)


def parse_rooms(col: Column) -> Column:
    """Room count given as digits and at most one dot, cut to a whole number; NULL otherwise."""
    text = strip(col.cast("string"))
    return F.regexp_substr(text, F.lit(ROOM_COUNT)).try_cast("double").try_cast("int")


def malformed_rooms(col: Column) -> Column:
    """Digits with several dots: the loader refuses the whole listing, not just the count.

    Cleaning turns such a text into a missing count, so this meets listings that were not cleaned here.
    """
    text = strip(col.cast("string"))
    refused = text.rlike(SEVERAL_DOTS) & ~text.rlike(ROOM_COUNT)
    return F.coalesce(refused, F.lit(False))


def fill_rooms(rooms: Column, type_text: Column) -> Column:
    """The stated number, negative ones as well, or else a positive one found in the type text."""
    stated = to_number(rooms).try_cast("int")
    return F.coalesce(stated, _leading_count(type_text, ROOM_PREFIX, least=1))


def round_exact(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double, ties to even, as decimal formatting does.

    ``value * scale`` may land on .5 only because the product was rounded; the error term of the
    product (Dekker) tells on which side of the tie the true value lies.
    """
    scale = F.lit(float(10**digits))
    product = value * scale
    nearest = F.rint(product)
    carry = value * F.lit(HALF_SPLIT)
    high = carry - (carry - value)
    error = (high * scale - product) + (value - high) * scale
    off_tie = (F.abs(product - nearest) == 0.5) & (error != 0)
    return F.when(off_tie, product + F.signum(error) / 2).otherwise(nearest) / scale


def round_scaled(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of numeric arrays."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def price_per_m2(price: Column, surface: Column) -> Column:
    """Price per square metre at two decimals; NULL without a price or a positive surface."""
    return F.when((price != 0) & (surface > 0), round_exact(price / surface, 2))


def ratio_per_m2(price: Column, surface: Column) -> Column:
    """Unrounded price per square metre; NULL unless the surface is positive."""
    return F.when(surface > 0, price / surface)


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Decimal sum, so the result does not depend on the order in which partitions arrive."""
    return F.sum(value.cast(f"decimal({scale + 16},{scale})"))


def mean_of(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def exact_mean(value: Column, scale: int = 2) -> Column:
    return mean_of(exact_sum(value, scale), F.count(value))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share in percent; NULL when the whole is zero."""
    return round_exact(F.try_divide(part, whole) * 100, digits)


def gap_percent(value: Column, base: Column) -> Column:
    """Signed gap to a base value in percent, two decimals."""
    return round_scaled(F.try_divide(value - base, base) * 100, 2)


def index_value(value: Column, base: Column, digits: int = 4) -> Column:
    """Index with the base at 100."""
    return round_scaled(F.try_divide(value, base) * 100, digits)
