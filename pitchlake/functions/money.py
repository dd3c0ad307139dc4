"""Money texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Accepted currency signs, and the suffixes of market values with their factors.
CURRENCIES = "£|€"
MARKET_VALUE_FACTORS = {"Th": 1e3, "k": 1e3, "m": 1e6, "M": 1e6}

# Texts standing for an unknown amount, the free-move text, the fee currency,
# and the suffixes of fees with their factors.
UNKNOWN_AMOUNTS = ("-", "?", "")
FREE_TRANSFER = "free transfer"
FEE_CURRENCY = "€"
FEE_FACTORS = {"m": 1_000_000, "k": 1_000}
FEE_TYPE = "decimal(18,3)"


def market_value(text: Column, factors: Mapping[str, float] = MARKET_VALUE_FACTORS) -> Column:
    """Amount in whole units, NULL where number or suffix is missing.

    The number passes through single precision and the product is rounded half to even,
    so amounts agree digit for digit with published tables.
    """
    pattern = f"({CURRENCIES})([0-9\\.]+)({'|'.join(factors)})"
    number = F.regexp_extract(text, pattern, 2).try_cast("float").cast("double")
    suffix = F.regexp_extract(text, pattern, 3)
    factor = F.lit(None).cast("double")
    for name, value in factors.items():
        factor = F.when(suffix == name, F.lit(float(value))).otherwise(factor)
    return F.rint(number * factor).try_cast("int")


def transfer_amount(text: Column, free: str | None = None) -> Column:
    """Fee or value of a transfer: unknown is NULL, other wording counts as nothing paid."""
    scaled = F.substring(text, F.lit(2), F.length(text)).try_cast(FEE_TYPE)
    for suffix, factor in FEE_FACTORS.items():
        body = F.substring(text, F.lit(2), F.length(text) - 2).try_cast(FEE_TYPE)
        scaled = F.when(F.right(text, F.lit(1)) == suffix,
                        (body * F.lit(factor)).try_cast(FEE_TYPE)).otherwise(scaled)
    nothing = F.lit(0).cast(FEE_TYPE)
    amount = F.when(text.isNull() | text.isin(*UNKNOWN_AMOUNTS), F.lit(None).cast(FEE_TYPE))
    if free is not None:
        amount = amount.when(text == free, nothing)
    return amount.when(F.left(text, F.lit(1)) == FEE_CURRENCY, scaled).otherwise(nothing)


def transfer_fee(text: Column) -> Column:
    return transfer_amount(text, free=FREE_TRANSFER)
