"""Reason masks: a value is null exactly where its mask is not 0; a valid zero is not null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reason bits.
SOURCE_UNAVAILABLE = 1
SOURCE_UNVERIFIED = 2
HALT = 4
STARTUP = 8
LOW_COVERAGE = 16
NO_SUPPORTED_DATA = 32
INVALID_CURRENT_VALUE = 64
NO_OBSERVED_EVENT = 128
MIDPOINT_AGE_LOWER_BOUND_ONLY = 256
CONTINUITY_BREAK = 512
ZERO_RETURN_VARIATION = 1024
ZERO_SPREAD = 2048
NAMES = {
    1: "SOURCE_UNAVAILABLE", 2: "SOURCE_UNVERIFIED", 4: "HALT", 8: "STARTUP", 16: "LOW_COVERAGE", 32: "NO_SUPPORTED_DATA",
    64: "INVALID_CURRENT_VALUE", 128: "NO_OBSERVED_EVENT", 256: "MIDPOINT_AGE_LOWER_BOUND_ONLY", 512: "CONTINUITY_BREAK",
    1024: "ZERO_RETURN_VARIATION", 2048: "ZERO_SPREAD",
}
ALL = 4095
HISTORY = 63
# Source and midpoint age status.
UNVERIFIED, ACCEPTED, UNAVAILABLE = 0, 1, 2
UNOBSERVABLE, NO_CHANGE_OBSERVED, KNOWN = 0, 1, 2


def bit(condition: Column, value: int) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0))


def any_of(*bits: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def has(mask: Column, value: int) -> Column:
    return mask.bitwiseAND(value) != 0


def names_of(mask: Column) -> Column:
    """Names of the set bits in ascending order."""
    return F.array_compact(F.array(*[F.when(has(mask, b), F.lit(n)) for b, n in NAMES.items()]))


def source_bit(status: Column) -> Column:
    return F.when(status == UNVERIFIED, SOURCE_UNVERIFIED).when(status == UNAVAILABLE, SOURCE_UNAVAILABLE).otherwise(0)


def supported_mask(duration: Column, halt: Column, status: Column, invalid: Column, broken: Column) -> Column:
    """Mask of a time integral: 0 wherever it has support."""
    return F.when(duration > 0, 0).otherwise(
        any_of(F.lit(NO_SUPPORTED_DATA), bit(halt, HALT), source_bit(status), bit(~halt & invalid, INVALID_CURRENT_VALUE), bit(~halt & broken, CONTINUITY_BREAK))
    )


def current_mask(valid: Column, halt: Column, status: Column, broken: Column, *, missing_event: bool = False, bound: Column | None = None) -> Column:
    """Mask of a value at a step's end: halt first, then the source, then the value itself."""
    out = F.when(halt, any_of(F.lit(HALT), source_bit(status))).when(status != ACCEPTED, source_bit(status)).when(valid, 0)
    if bound is not None:
        out = out.when(bound, MIDPOINT_AGE_LOWER_BOUND_ONLY)
    return out.otherwise(any_of(F.lit(NO_OBSERVED_EVENT if missing_event else INVALID_CURRENT_VALUE), bit(broken, CONTINUITY_BREAK)))


def history_mask(status: Column, halt: Column, elapsed: Column, startup: int, supported: Column, usable: Column, possible: Column, least: float) -> Column:
    """Mask of an exponentially weighted value.  ``supported``: some usable weight since the last halt."""
    return any_of(
        source_bit(status), bit(halt, HALT), bit(elapsed < startup, STARTUP), bit(~supported, NO_SUPPORTED_DATA),
        bit(supported & (elapsed >= startup) & (usable < F.lit(least) * possible), LOW_COVERAGE),
    )
