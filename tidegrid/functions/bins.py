"""Bin axes of histograms and empirical distributions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FixedAxis:
    """Bins of a non-negative value: 0 for zero, 1 for (0, e0), then [e_i, e_i+1) with the last edge inclusive, then overflow."""

    edges: tuple[float, ...]

    def __post_init__(self):
        if len(self.edges) < 2 or list(self.edges) != sorted(set(self.edges)) or self.edges[0] <= 0:
            raise ValueError("edges must be positive and ascending")

    @property
    def overflow(self) -> int:
        return len(self.edges) + 1

    def bin(self, x: Column) -> Column:
        # Edges as literals: recomputing a bin by a logarithm would move values that lie on an edge.
        below = F.size(F.filter(F.array(*[F.lit(float(e)) for e in self.edges]), lambda e: e <= x))
        return F.when(x.isNull(), None).when(x == 0, 0).when(x == self.edges[-1], len(self.edges)).otherwise(below + 1)


@dataclass(frozen=True)
class Axis:
    """Fifty (or more) finite bins with named outer classes; logarithmic axes keep zero and underflow apart."""

    edges: tuple[float, ...]
    log: bool

    @classmethod
    def spaced(cls, low: float, high: float, bins: int = 50, *, log: bool) -> Axis:
        space = np.geomspace if log else np.linspace
        return cls(tuple(float(x) for x in space(low, high, bins + 1)), log)

    def status(self, x: Column) -> Column:
        low, high = self.edges[0], self.edges[-1]
        out = F.when(x.isNull(), None)
        if self.log:
            out = out.when(x == 0, "zero").when(x < low, "positive_underflow")
        else:
            out = out.when(x < low, "underflow")
        return out.when(x > high, "overflow").otherwise("finite")

    def bin(self, x: Column) -> Column:
        """The finite bin from 0, the last one closed; null elsewhere."""
        below = F.size(F.filter(F.array(*[F.lit(e) for e in self.edges]), lambda e: e <= x))
        return F.when(self.status(x) == "finite", F.least(below - 1, F.lit(len(self.edges) - 2)))


#: The joint displays' axes.
JOINT_AXES = {
    "rms": Axis.spaced(0.01, 1000, log=True),
    "spread": Axis.spaced(0.03, 3000, log=True),
    "rate": Axis.spaced(0.01, 1000, log=True),
    "participation": Axis.spaced(0, 1, log=False),
}


def log1p_bin(x: Column, width: float = 0.0025) -> Column:
    """0 for zero, else 1 + floor(ln(1 + x) / width)."""
    return F.when(x == 0, 0).otherwise(F.floor(F.ln(1 + x) / F.lit(width)) + 1).cast("long")


def linear_bin(x: Column, width: float = 0.001) -> Column:
    return F.when(x == 0, 0).otherwise(F.floor(x / F.lit(width)) + 1).cast("long")


def bands(x: Column, edges: Sequence[float] = (1, 10, 30, 100)) -> Column:
    """-1 unavailable, 0 zero, 1 below the first edge, then one band per edge."""
    out = F.when(x.isNull(), -1).when(x == 0, 0)
    for k, e in enumerate(edges):
        out = out.when(x < e, k + 1)
    return out.otherwise(len(edges) + 1)
