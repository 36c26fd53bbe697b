"""Selections: dates, members, sessions, bounds and discovery timing as ranges of step ends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import NS, ContractError
from tidegrid.grid import Grid, session_bounds

# Reporting sessions as inclusive seconds after 04:00.
SESSIONS = {"premarket": (1, 19_800), "rth": (19_801, 43_200), "after_hours": (43_201, 57_600)}
TIMINGS = ("historical_membership", "nominal_post_discovery", "receipt_post_discovery")


@dataclass(frozen=True)
class Selection:
    """Which step ends of which members a query may see.  ``bounds`` is ``[start, stop)``."""

    sessions: tuple[str, ...] = tuple(SESSIONS)
    members: tuple[tuple[str, str], ...] | None = None
    dates: tuple[str, str] | None = None
    bounds: tuple[int, int] | None = None
    timing: str = "historical_membership"

    def __post_init__(self):
        if not self.sessions or set(self.sessions) - set(SESSIONS) or len(set(self.sessions)) != len(self.sessions):
            raise ContractError("sessions must be distinct and known")
        if self.timing not in TIMINGS:
            raise ContractError("unknown population timing")
        if self.members is not None and len(set(self.members)) != len(self.members):
            raise ContractError("members must be unique")
        if self.dates is not None and not date.fromisoformat(self.dates[0]) <= date.fromisoformat(self.dates[1]):
            raise ContractError("dates must be ascending")
        if self.bounds is not None and self.bounds[0] >= self.bounds[1]:
            raise ContractError("bounds must be ascending")

    def scope(self, members: Sequence[dict]) -> list[dict]:
        """Catalog members in scope; an absent member or an empty scope is an error."""
        known = {(m["session_date"], m["symbol"]) for m in members}
        if self.members is not None and set(self.members) - known:
            raise ContractError(f"members not in the catalog: {sorted(set(self.members) - known)}")
        out = [
            m for m in members
            if (self.members is None or (m["session_date"], m["symbol"]) in set(self.members)) and (self.dates is None or self.dates[0] <= m["session_date"] <= self.dates[1])
        ]
        if not out:
            raise ContractError("the scope holds no member")
        return out

    def ranges(self, members: Sequence[dict]) -> list[dict]:
        """Inclusive ranges of whole-second ends, at most one per session and member, numbered per member."""
        out = []
        for m in self.scope(members):
            start, _ = session_bounds(m["session_date"])
            after = None
            if self.timing != "historical_membership":
                clocks = [m.get("discovery_ns")] + ([m.get("receipt_ns")] if self.timing == "receipt_post_discovery" else [])
                if any(c is None for c in clocks):
                    raise ContractError("a member has no discovery time")
                after = max(clocks)
            for k, name in enumerate(s for s in SESSIONS if s in self.sessions):
                first, last = (start + x * NS for x in SESSIONS[name])
                if self.bounds is not None:
                    first, last = max(first, -(-self.bounds[0] // NS) * NS), min(last, -(-self.bounds[1] // NS) * NS - NS)
                if after is not None:
                    first = max(first, (after // NS + 1) * NS)
                if first <= last:
                    out.append({"session_date": m["session_date"], "symbol": m["symbol"], "segment_index": k, "session": name, "first_ns": first, "last_ns": last})
        return out


def annotate(rows: DataFrame, ranges: Sequence[dict], grid: Grid = Grid()) -> DataFrame:
    """Selected rows with ``selection_segment_id`` and the flags of their segment's ends.

    Ranges are at most three per member of the scope, which the driver holds already.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame([tuple(r[k] for k in ("session_date", "symbol", "segment_index", "first_ns", "last_ns")) for r in ranges], "session_date string, symbol string, segment_index int, first_ns bigint, last_ns bigint")
    joined = rows.join(table, ["session_date", "symbol"]).where((F.col(grid.time) >= F.col("first_ns")) & (F.col(grid.time) <= F.col("last_ns")))
    return joined.withColumns({
        "selected": F.lit(True), "selection_segment_id": F.concat(F.col("session_date"), F.lit("/"), F.col("symbol"), F.lit(":"), F.col("segment_index").cast("string")),
        "selection_segment_start": F.col(grid.time) == F.col("first_ns"), "selection_segment_end": F.col(grid.time) == F.col("last_ns"),
    }).drop("first_ns", "last_ns", "segment_index")
