"""Column expressions: cleaning, lenient casts, falsy chains, padding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    return F.trim(as_col(c).cast("string"))


def lenient(c, dtype: str) -> Column:
    """Cast where bad text becomes NULL; integers are truncated from decimals."""
    c = as_col(c)
    if dtype in ("int", "bigint", "integer", "long"):
        return c.cast("string").try_cast("double").try_cast(dtype)
    return c.try_cast(dtype)


def rounded_small(c, places: int) -> Column:
    """``F.round`` of doubles, in plain arithmetic where that cannot differ: small numbers that are not near a half."""
    c, unit = as_col(c), 10.0 ** places
    off_half = F.abs(c * unit - F.floor(c * unit) - 0.5) > 1e-4  # the product is off by 1e-6 at most
    return F.when((F.abs(c) * unit <= 1e10) & off_half, F.floor(c * unit + 0.5) / F.lit(unit)).otherwise(F.round(c, places))


def reformat_date(c, pattern_in: str = "dd-MM-yyyy", pattern_out: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.try_to_date(as_col(c), pattern_in), pattern_out)


def joined_text(cols: Sequence, sep: str = " ") -> Column:
    """Fields joined by one separator; a missing field is '' and keeps its place."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def first_truthy_number(cols: Sequence, default: float | None = 0.0) -> Column:
    """First value that is neither NULL nor 0."""
    chain = [F.nullif(as_col(c).cast("double"), F.lit(0.0)) for c in cols]
    return F.coalesce(*chain, F.lit(default)) if default is not None else F.coalesce(*chain)


def first_truthy_text(cols: Sequence, default: str | None = None) -> Column:
    """First value that is neither NULL nor ''."""
    chain = [F.nullif(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.coalesce(*chain, F.lit(default)) if default is not None else F.coalesce(*chain)


def first_truthy_array(cols: Sequence) -> Column:
    """First array that is neither NULL nor empty."""
    return F.coalesce(*[F.when(F.size(as_col(c)) > 0, as_col(c)) for c in cols])


def to_decimal(c) -> Column:
    """Float to exact decimal through its text form."""
    return as_col(c).cast("string").try_cast("decimal(38,18)")


def to_double(c) -> Column:
    return as_col(c).cast("double")


def asset_url(id_col, prefix: str, suffix: str = ".jpg") -> Column:
    return F.concat(F.lit(prefix), as_col(id_col).cast("string"), F.lit(suffix))


def price_text(c) -> Column:
    return F.format_string("Rs. %.2f", as_col(c).cast("double"))


def first_name(c) -> Column:
    return F.split_part(F.ltrim(as_col(c)), F.lit(" "), F.lit(1))


def pad_list(c, n: int) -> Column:
    """Array padded with NULLs to ``n`` entries."""
    c = as_col(c)
    return F.concat(c, F.array_repeat(F.lit(None), F.greatest(F.lit(n) - F.size(c), F.lit(0))))


def pad_vector(c, n: int) -> Column:
    """Vector padded with zeros to ``n`` entries; NULL becomes all zeros."""
    c = F.coalesce(as_col(c), F.array().cast("array<double>"))
    return F.concat(c, F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - F.size(c), F.lit(0))))


def free_slots(used, n: int = 24) -> Column:
    return F.array_except(F.sequence(F.lit(0), F.lit(n - 1)), as_col(used))


def has_duplicates(c) -> Column:
    known = F.filter(as_col(c), lambda x: x.isNotNull())
    return F.size(F.array_distinct(known)) < F.size(known)


def hash_number(*cols) -> Column:
    """32-bit number from the md5 of '-'-joined values; any engine can repeat it."""
    text = F.concat_ws("-", *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


# Price band (low, exclusive high) per master category, and for the rest.
PRICE_BANDS = {"Footwear": (1200, 3500), "Apparel": (800, 2500), "Accessories": (300, 2000)}
OTHER_BAND = (500, 2000)


def price_band(category) -> tuple[Column, Column]:
    low = high = None
    for name, (a, b) in PRICE_BANDS.items():
        hit = as_col(category) == name
        low = F.when(hit, a) if low is None else low.when(hit, a)
        high = F.when(hit, b) if high is None else high.when(hit, b)
    return low.otherwise(OTHER_BAND[0]), high.otherwise(OTHER_BAND[1])


def imputed_price(id_col, category) -> Column:
    """Repeatable price inside the band of the category."""
    low, high = price_band(category)
    return (low + F.pmod(as_col(id_col).cast("bigint") * 7919, high - low)).cast("bigint")
