"""The dense grid: one row per member and step, labelled by the step's end."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid.config import NS, ContractError


@dataclass(frozen=True)
class Grid:
    """Keys of a member, the column of a step's end, and the step in that column's unit."""

    keys: tuple[str, ...] = ("session_date", "symbol")
    time: str = "interval_end_ns"
    step: int = NS

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.time]

    def window(self, *more: str | Column) -> WindowSpec:
        """Rows of a member (and of ``more``) in time order."""
        return Window.partitionBy(*self.keys, *more).orderBy(self.time)

    def end_of(self, at: Column) -> Column:
        """The end of the step that holds an event; an event on a step's end belongs to the next one."""
        return at - F.pmod(at, F.lit(self.step)) + F.lit(self.step)

    def dense(self, members: DataFrame, start: str = "start", stop: str = "stop") -> DataFrame:
        """Every step end in ``(start, stop]`` of each member; other member columns stay."""
        ends = F.sequence(F.col(start) + F.lit(self.step), F.col(stop), F.lit(self.step))
        return members.where(F.col(stop) > F.col(start)).withColumn(self.time, F.explode(ends))

    def filled(self, members: DataFrame, measured: DataFrame) -> DataFrame:
        """The dense grid with measurements joined where there are any."""
        return self.dense(members).drop("start", "stop").join(measured, self.columns, "left")


NEW_YORK = "America/New_York"


def session_bounds(day: str, opens: int = 4, closes: int = 20, zone: str = NEW_YORK) -> tuple[int, int]:
    """Nanoseconds of a session's start and end; the zone's daylight saving applies."""
    try:
        d = date.fromisoformat(day)
    except (TypeError, ValueError) as e:
        raise ContractError("session date must be YYYY-MM-DD") from e
    if d.isoformat() != day:
        raise ContractError("session date must be YYYY-MM-DD")
    return tuple(int(datetime.combine(d, time(h), ZoneInfo(zone)).timestamp()) * NS for h in (opens, closes))


def session_start(day: Column, hour: int = 4, zone: str = NEW_YORK) -> Column:
    """The same start in nanoseconds as a Column of a date string (session time zone UTC)."""
    local = F.to_timestamp(F.concat(day, F.lit(f" {hour:02d}:00:00")))
    return F.unix_seconds(F.to_utc_timestamp(local, zone)) * F.lit(NS)


def session_name(since_midnight: Column) -> Column:
    """Reporting session of a step end by its local seconds since midnight: inclusive at 09:30 and 16:00."""
    return F.when(since_midnight <= 34_200, "premarket").when(since_midnight <= 57_600, "rth").otherwise("after_hours")


def local_seconds(end_ns: Column, zone: str = NEW_YORK) -> Column:
    local = F.from_utc_timestamp(F.timestamp_seconds(whole_div(end_ns, NS)), zone)
    return F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)


def endpoint_time(end_ns: Column) -> Column:
    """A nanosecond column as a timestamp; whole seconds lose nothing."""
    return F.timestamp_micros(whole_div(end_ns, 1000))


def whole_div(a: Column, b: int) -> Column:
    """Integer division rounding down, exact for all longs."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))
