"""Feature configuration, canonical JSON and identities."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, field
from typing import Any

NS = 1_000_000_000


class ContractError(ValueError):
    """Input or configuration that breaks a stated contract."""


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, no NaN: equal values have equal text."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False, ensure_ascii=False)


def digest(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def _whole(value: Any, name: str, low: int, high: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ContractError(f"{name} must be a whole number in [{low}, {high}]")
    return value


@dataclass(frozen=True, order=True)
class View:
    """An exponentially weighted view: half-life and startup, in grid steps."""

    half_life: int
    startup: int

    def __post_init__(self):
        _whole(self.half_life, "half-life", 1, 86_400)
        _whole(self.startup, "startup", 6, 57_600)


@dataclass(frozen=True)
class FeatureConfig:
    """Views, age windows and coverage floors of the feature calculation."""

    views: tuple[View, ...] = (View(30, 60), View(120, 300))
    age_windows: tuple[int, ...] = (60, 300)
    spread_coverage: float = 0.9
    other_coverage: float = 0.8
    age_coverage: float = 0.8
    trade_reporting_age_ns: int = NS
    version: int = field(default=1)

    def __post_init__(self):
        if not 1 <= len(self.views) <= 8 or list(self.views) != sorted(set(self.views)) or len({v.half_life for v in self.views}) != len(self.views):
            raise ContractError("views must be 1 to 8, ascending, with distinct half-lives")
        if not self.age_windows or list(self.age_windows) != sorted(set(self.age_windows)):
            raise ContractError("age windows must be ascending and distinct")
        for w in self.age_windows:
            _whole(w, "age window", 1, 300)
        for name in ("spread_coverage", "other_coverage", "age_coverage"):
            v = getattr(self, name)
            if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) or not 0 < v <= 1:
                raise ContractError(f"{name} must be in (0, 1]")
        _whole(self.trade_reporting_age_ns, "trade reporting age", 0, 60 * NS)

    def to_dict(self) -> dict:
        return asdict(self) | {"views": [[v.half_life, v.startup] for v in self.views], "age_windows": list(self.age_windows)}

    @classmethod
    def from_dict(cls, value: dict) -> FeatureConfig:
        if set(value) != {f for f in cls.__dataclass_fields__} or value["version"] != 1:
            raise ContractError("unknown or missing configuration fields")
        return cls(**(value | {"views": tuple(View(*v) for v in value["views"]), "age_windows": tuple(value["age_windows"])}))

    @property
    def identity(self) -> str:
        return digest(self.to_dict())
