"""Scalar rules: finiteness, returns, exact shares, quantiles of sorted arrays."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARE_TYPE = "decimal(38,9)"


def finite(x: Column) -> Column:
    """Neither null, NaN nor infinite; never null itself."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def positive(x: Column) -> Column:
    return finite(x) & F.coalesce(x > 0, F.lit(False))


def midpoint(bid: Column, ask: Column) -> Column:
    """Halves first, so that large prices do not overflow."""
    return bid / 2 + ask / 2


def return_bps(start: Column, end: Column) -> Column:
    """Logarithmic return in basis points; log1p near 1, a difference of logs elsewhere."""
    ratio = end / start
    return 10_000 * F.when((ratio >= 0.5) & (ratio <= 2), F.log1p((end - start) / start)).otherwise(F.ln(end) - F.ln(start))


def sorted_quantile(values: Column, q: float) -> Column:
    """Linear quantile of an ascending array without nulls; null where it is empty."""
    place = F.lit(q) * (F.size(values) - 1)
    low = F.floor(place).cast("int")
    a = F.try_element_at(values, low + 1)
    b = F.try_element_at(values, F.ceil(place).cast("int") + 1)
    return F.when(F.size(values) > 0, a + (place - low) * (b - a))


_PLAIN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


@F.pandas_udf(T.StringType())
def _expanded(text: pd.Series) -> pd.Series:
    """Exponent notation as plain digits; null where the text is no number."""

    def one(x):
        try:
            d = Decimal(x)
            return format(d, "f") if d.is_finite() else None
        except (InvalidOperation, TypeError, ValueError):
            return None

    return text.map(one)


def exact_shares(text: Column, exponents: bool = False) -> Column:
    """Decimal text to decimal(38,9); null unless it has at most 9 places and 29 whole digits, exactly.

    A cast rounds further places silently, so the places are counted in the
    text.  Plain text stays in the JVM; with ``exponents`` the rest goes
    through a vectorised Python function.
    """
    plain = F.when(F.rlike(text, F.lit(_PLAIN)), F.trim(text))
    if exponents:
        plain = F.coalesce(plain, _expanded(F.when(~F.rlike(text, F.lit(_PLAIN)), text)))
    places = F.length(F.regexp_replace(F.regexp_extract(plain, r"\.(\d*)$", 1), "0+$", ""))
    whole = F.length(F.regexp_replace(F.regexp_extract(plain, r"^[+-]?(\d*)", 1), "^0+", ""))
    return F.when((places <= 9) & (whole <= 29), plain.try_cast(SHARE_TYPE))
