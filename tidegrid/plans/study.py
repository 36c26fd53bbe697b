"""The half-life selection study: two views' conditions, 17 period variants, overlaps and disagreements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.numbers import finite
from tidegrid.grid import Grid
from tidegrid.operators import accounting as A
from tidegrid.operators import intervals as I
from tidegrid.operators.periods import gap_periods, omit_one, period_variants
from tidegrid.operators.runs import stretches


@dataclass(frozen=True)
class Condition:
    """A named threshold; ``{h}`` in the column stands for the view's half-life."""

    key: str
    column: str
    operator: str
    threshold: float

    def test(self, half_life: int) -> Column:
        x = F.col(self.column.format(h=half_life))
        return {">": x > self.threshold, ">=": x >= self.threshold, "<": x < self.threshold, "<=": x <= self.threshold}[self.operator]


# The study's conditions and dollar floor.
CONDITIONS = (
    Condition("movement", "midpoint_rms_5s_bps_hl{h}s", ">", 10), Condition("spread", "quoted_spread_bps_hl{h}s", "<", 100), Condition("movement_to_spread", "midpoint_rms_5s_to_spread_hl{h}s", ">", 2),
    Condition("participation", "movement_participation_hl{h}s", ">=", 0.4), Condition("trade_rate", "trade_rate_per_second_hl{h}s", ">=", 10),
    Condition("quote_freshness", "quote_age_p90_seconds_window60s", "<=", 2), Condition("trade_freshness", "trade_age_p90_seconds_window60s", "<=", 2),
)
DOLLAR_FLOOR = 10_000.0
DOLLAR_COLUMN = "dollar_rate_usd_per_second_hl{h}s"


@dataclass(frozen=True)
class Study:
    """Two views of the same grid under the same conditions."""

    views: tuple[tuple[str, int], ...] = (("fast", 30), ("slow", 120))
    conditions: tuple[Condition, ...] = CONDITIONS
    grid: Grid = Grid()
    more: tuple[str, ...] = ("session",)
    off_delay: int = 30
    least_elapsed: int = 300
    occupancy: float = 0.8

    @property
    def periods(self) -> dict:
        return {"off_delay": self.off_delay, "least_elapsed": self.least_elapsed, "occupancy": self.occupancy}

    def passes(self, view: str) -> dict[str, Column]:
        return {c.key: F.col(f"{view}_pass_{c.key}") for c in self.conditions}

    def evaluate(self, rows: DataFrame) -> DataFrame:
        """Availability and a flag per condition of each view, computed once; a null never passes."""
        flags: dict[str, Column] = {}
        for view, h in self.views:
            available = F.lit(True)
            for c in self.conditions:
                available = available & F.col(c.column.format(h=h)).isNotNull()
                flags[f"{view}_pass_{c.key}"] = F.coalesce(c.test(h), F.lit(False))
            flags[f"{view}_available"] = available
        out = rows.withColumns(flags)
        common = F.lit(True)
        for view, _ in self.views:
            common = common & F.col(f"{view}_available")
        out = out.withColumn("common_eligible", common)
        matches = {}
        for view, _ in self.views:
            everything = omit_one(self.passes(view))
            matches |= {f"{view}_match": F.col("common_eligible") & everything, f"{view}_own_match": F.col(f"{view}_available") & everything}
        return out.withColumns(matches)

    def variants(self) -> dict[str, tuple[Column, Column]]:
        """The first view on its own availability, then per view the baseline and each condition left out."""
        first = self.views[0][0]
        out = {f"{first}_own_baseline": (F.col(f"{first}_available"), F.col(f"{first}_own_match"))}
        common = F.col("common_eligible")
        for view, _ in self.views:
            out[view] = (common, F.col(f"{view}_match"))
            out |= {f"{view}_without_{c.key}": (common, common & omit_one(self.passes(view), c.key)) for c in self.conditions}
        return out

    def all_periods(self, evaluated: DataFrame) -> DataFrame:
        return period_variants(evaluated, self.grid, self.variants(), more=self.more, **self.periods)

    def scopes(self) -> dict[str, Sequence[str]]:
        k = self.grid.keys
        return {"member": k, **({"date": k[:1]} if len(k) > 1 else {}), "overall": ()}

    def availability(self, evaluated: DataFrame) -> DataFrame:
        (a, _), (b, _) = self.views
        return A.scoped(evaluated, self.scopes(), A.availability(F.col(f"{a}_available"), F.col(f"{b}_available"), (a, b)))

    def overlap(self, evaluated: DataFrame) -> DataFrame:
        (a, _), (b, _) = self.views
        return A.overlap_ratios(A.scoped(evaluated, self.scopes(), A.overlap_counts(F.col(f"{a}_match"), F.col(f"{b}_match"), (a, b))), (a, b))

    def membership(self, evaluated: DataFrame, periods: DataFrame | None = None) -> DataFrame:
        (a, _), (b, _) = self.views
        seconds = A.membership(evaluated, self.grid.keys, F.col(f"{a}_match"), F.col(f"{b}_match"), F.col("common_eligible"), (a, b)).withColumn("definition", F.lit("matching_second"))
        if periods is None:
            return seconds
        has = periods.groupBy(*self.grid.keys).agg(F.bool_or(F.col("variant") == a).alias("_a"), F.bool_or(F.col("variant") == b).alias("_b"))
        kept = seconds.select(*self.grid.keys, "common_eligible", "no_common_eligible").join(has, list(self.grid.keys), "left")
        named = A.classified(F.coalesce("_a", F.lit(False)), F.coalesce("_b", F.lit(False)), (a, b))
        return seconds.unionByName(kept.withColumns({"classification": named, "definition": F.lit("retained_period")}).drop("_a", "_b"))

    def stock_membership(self, membership: DataFrame) -> DataFrame:
        """Members united over dates: a view holds for a stock if it holds on any day."""
        (a, _), (b, _) = self.views
        c = F.col("classification")
        ever = membership.groupBy("definition", self.grid.keys[-1]).agg(F.bool_or(c.isin("both", f"{a}_only")).alias("_a"), F.bool_or(c.isin("both", f"{b}_only")).alias("_b"))
        return ever.select("definition", self.grid.keys[-1], A.classified(F.col("_a"), F.col("_b"), (a, b)).alias("classification"))

    def disagreements(self, evaluated: DataFrame, top: int | None = 20) -> DataFrame:
        out = None
        (a, _), (b, _) = self.views
        for x, y in ((a, b), (b, a)):
            part = A.disagreements(evaluated, F.col(f"{x}_match") & ~F.col(f"{y}_match"), {k: ~c for k, c in self.passes(y).items()}, top).withColumn("direction", F.lit(f"{x}_pass_{y}_fail"))
            out = part if out is None else out.unionByName(part)
        return out

    def stretches(self, evaluated: DataFrame, top: int = 3) -> DataFrame:
        out = None
        (a, _), (b, _) = self.views
        for x, y in ((a, b), (b, a)):
            sums = {f"failed_{k}_steps": ~c for k, c in self.passes(y).items()}
            part = stretches(evaluated, self.grid, F.col(f"{x}_match") & ~F.col(f"{y}_match"), sums, self.more, top).withColumn("direction", F.lit(f"{x}_only"))
            out = part if out is None else out.unionByName(part)
        return out

    def contribution(self, evaluated: DataFrame, periods: DataFrame) -> DataFrame:
        """Filter contributions with the symbol-days that leaving a condition out gains and loses."""
        out = None
        keys = list(self.grid.keys)
        have = periods.select("variant", *keys).distinct()
        for view, _ in self.views:
            part = A.filter_contribution(evaluated, F.col("common_eligible"), self.passes(view)).withColumn("view", F.lit(view))
            out = part if out is None else out.unionByName(part)
        base = have.where(F.col("variant").isin([v for v, _ in self.views])).withColumnRenamed("variant", "view")
        other = have.where(F.col("variant").contains("_without_")).select(F.substring_index("variant", "_without_", 1).alias("view"), F.substring_index("variant", "_without_", -1).alias("condition"), *keys)
        conditions = other.sparkSession.createDataFrame([(v, c.key) for v, _ in self.views for c in self.conditions], "view string, condition string")
        left = base.join(F.broadcast(conditions), "view").withColumn("_b", F.lit(1))
        both = left.join(other.withColumn("_v", F.lit(1)), ["view", "condition", *keys], "full")
        change = both.groupBy("view", "condition").agg(
            F.count_if(F.col("_v").isNotNull()).alias("retained_symbol_days"), F.count_if(F.col("_b").isNull()).alias("gained_symbol_days"), F.count_if(F.col("_v").isNull()).alias("lost_symbol_days")
        )
        return out.join(change, ["view", "condition"], "left").fillna(0, ["retained_symbol_days", "gained_symbol_days", "lost_symbol_days"])

    def period_overlap(self, periods: DataFrame, members: DataFrame, width: int) -> DataFrame:
        (a, _), (b, _) = self.views
        one = lambda v: periods.where(F.col("variant") == v).select(*self.grid.keys, F.col("episode_start").alias("start"), F.col("episode_end").alias("stop"))
        per = I.overlap_lengths(one(a), one(b), members, self.grid.keys, step=self.grid.step, width=width, names=(a, b))
        sums = [F.sum(c).alias(c) for c in per.columns if c.endswith("_steps")]
        return A.overlap_ratios(A.scoped(per, self.scopes(), sums), (a, b), "steps")

    def dollar_constrained(self, evaluated: DataFrame, floor: float = DOLLAR_FLOOR, column: str = DOLLAR_COLUMN) -> DataFrame:
        """Periods of each view under its dollar floor: an unavailable rate ends a stretch, one below the floor is an eligible nonmatch."""
        out = None
        valid = F.col("common_eligible")
        for _, h in self.views:
            valid = valid & finite(F.col(column.format(h=h)))
        for view, h in self.views:
            match = F.col(f"{view}_match") & valid & F.coalesce(F.col(column.format(h=h)) >= floor, F.lit(False))
            part = gap_periods(evaluated, self.grid, eligible=valid, matching=match, more=self.more, **self.periods).withColumn("view", F.lit(view))
            out = part if out is None else out.unionByName(part)
        return out
