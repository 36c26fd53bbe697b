"""Typed predicates: compiled to intervals, intersected per field, evaluated in three states.

Catalyst keeps contradictory comparisons as plain filters, so contradictions
are found here, when a conjunction is compiled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import digest

MATCHING, NONMATCHING, UNAVAILABLE = "matching", "nonmatching", "unavailable"
_SIDES = {">": ("lower", False), ">=": ("lower", True), "<": ("upper", False), "<=": ("upper", True)}
_RANGE = {"lower", "lower_inclusive", "upper", "upper_inclusive"}


def _number(x: Any, what: str) -> float:
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        raise ValueError(f"{what}: a finite number is needed")
    try:
        x = float(x)
    except OverflowError as e:
        raise ValueError(f"{what}: a finite number is needed") from e
    if not math.isfinite(x):
        raise ValueError(f"{what}: a finite number is needed")
    return x + 0.0  # -0.0 becomes 0.0


@dataclass(frozen=True)
class Interval:
    """A field's allowed values; None is no bound."""

    lower: float | None = None
    lower_inclusive: bool = True
    upper: float | None = None
    upper_inclusive: bool = True

    def meet(self, other: Interval) -> Interval:
        """The intersection.  A bound that excludes its end is tighter than one that includes it."""

        def tightest(a, b, sign):
            if a[0] is None or b[0] is None:
                return b if a[0] is None else a
            return max(a, b, key=lambda x: (sign * x[0], not x[1]))

        low = tightest((self.lower, self.lower_inclusive), (other.lower, other.lower_inclusive), 1)
        high = tightest((self.upper, self.upper_inclusive), (other.upper, other.upper_inclusive), -1)
        return Interval(*low, *high)

    @property
    def empty(self) -> bool:
        if self.lower is None or self.upper is None:
            return False
        return self.lower > self.upper or (self.lower == self.upper and not (self.lower_inclusive and self.upper_inclusive))

    def holds(self, x: Column) -> Column:
        out = F.lit(True)
        if self.lower is not None:
            out = out & ((x >= self.lower) if self.lower_inclusive else (x > self.lower))
        if self.upper is not None:
            out = out & ((x <= self.upper) if self.upper_inclusive else (x < self.upper))
        return out


@dataclass(frozen=True)
class Field:
    """A queryable field: its mask column (None: the value's own null tells) and the sources it depends on."""

    name: str
    mask: str | None = None
    sources: tuple[str, ...] = ()


@dataclass(frozen=True)
class Predicates:
    """A canonical conjunction, in the order of the field list."""

    terms: tuple[tuple[Field, Interval], ...]

    @property
    def fields(self) -> list[str]:
        return [f.name for f, _ in self.terms]

    @property
    def sources(self) -> list[str]:
        return sorted({s for f, _ in self.terms for s in f.sources})

    @property
    def dependencies(self) -> list[str]:
        return [c for f, _ in self.terms for c in (f.name, f.mask) if c]

    def to_dict(self) -> dict:
        return {"version": 1, "conjunction": [{"field": f.name, "mask": f.mask, **vars(i)} for f, i in self.terms]}

    @property
    def identity(self) -> str:
        return digest(self.to_dict())

    def _missing(self, f: Field) -> Column:
        null = F.col(f.name).isNull()
        return null | (F.col(f.mask) != 0) if f.mask else null

    @property
    def status(self) -> Column:
        """unavailable if any field is; else matching if all hold; else nonmatching."""
        missing, passing = F.lit(False), F.lit(True)
        for f, i in self.terms:
            missing, passing = missing | self._missing(f), passing & i.holds(F.col(f.name))
        return F.when(missing, UNAVAILABLE).when(passing, MATCHING).otherwise(NONMATCHING)

    @property
    def failing(self) -> Column:
        """Names of available fields that do not hold."""
        return F.array_compact(F.array(*[F.when(~self._missing(f) & ~i.holds(F.col(f.name)), F.lit(f.name)) for f, i in self.terms]))

    @property
    def unavailable(self) -> Column:
        return F.array_compact(F.array(*[F.when(self._missing(f), F.lit(f.name)) for f, _ in self.terms]))

    def evaluate(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"status": self.status, "failing_fields": self.failing, "unavailable_fields": self.unavailable})


def _interval(raw: Mapping[str, Any]) -> Interval:
    name = raw["field"]
    if set(raw) == {"field", "operator", "value"}:
        x = _number(raw["value"], name)
        if raw["operator"] == "==":
            return Interval(x, True, x, True)
        if raw["operator"] not in _SIDES:
            raise ValueError(f"unsupported operator {raw['operator']!r}")
        side, inclusive = _SIDES[raw["operator"]]
        return Interval(**{side: x, f"{side}_inclusive": inclusive})
    if set(raw) == {"field", "range"} and isinstance(raw["range"], Mapping) and set(raw["range"]) == _RANGE:
        r = raw["range"]
        if not all(isinstance(r[k], bool) for k in ("lower_inclusive", "upper_inclusive")):
            raise ValueError(f"{name}: inclusivity must be boolean")
        if r["lower"] is None and r["upper"] is None:
            raise ValueError(f"{name}: a range needs an end")
        ends = {k: None if r[k] is None else _number(r[k], name) for k in ("lower", "upper")}
        return Interval(ends["lower"], r["lower_inclusive"], ends["upper"], r["upper_inclusive"])
    raise ValueError("a predicate has a field and either an operator with a value, or a range")


def compile_predicates(predicates: Sequence[Mapping[str, Any]], fields: Sequence[Field]) -> Predicates:
    """Validate and intersect; a field that no value can satisfy is an error."""
    if not predicates:
        raise ValueError("at least one predicate is needed")
    known = {f.name: f for f in fields}
    found: dict[str, Interval] = {}
    for raw in predicates:
        if not isinstance(raw, Mapping) or raw.get("field") not in known:
            raise ValueError(f"unknown field in {raw!r}")
        name = raw["field"]
        found[name] = found.get(name, Interval()).meet(_interval(raw))
        if found[name].empty:
            raise ValueError(f"contradictory predicates for {name}")
    return Predicates(tuple((f, found[f.name]) for f in fields if f.name in found))
