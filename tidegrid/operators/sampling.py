"""Deterministic stratified samples of members: ranks by size within a month, hash order within a stratum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def strata(members: DataFrame, seed: str, strata_count: int = 4, *, month: str = "month", size: str = "event_count", keys: tuple[str, str] = ("session_date", "symbol")) -> DataFrame:
    """Adds ``monthly_rank``, ``monthly_members``, ``stratum`` and ``selection_hash``."""
    order = Window.partitionBy(month).orderBy(size, *keys)
    rank, count = (F.row_number().over(order) - 1).cast("long"), F.count("*").over(Window.partitionBy(month))
    text = F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys])
    out = members.withColumns({"monthly_rank": rank, "monthly_members": count, "selection_hash": F.sha2(text, 256)})
    stratum = F.least(F.lit(strata_count - 1), F.call_function("div", F.lit(strata_count) * F.col("monthly_rank"), F.col("monthly_members"))).cast("int")
    return out.withColumn("stratum", stratum)


def ranked_candidates(members: DataFrame, seed: str, per_cell: int, **options) -> DataFrame:
    """The first ``per_cell`` members of each (month, stratum) in hash order."""
    keys = options.get("keys", ("session_date", "symbol"))
    month = options.get("month", "month")
    cell = Window.partitionBy(month, "stratum").orderBy("selection_hash", *keys)
    return strata(members, seed, **options).withColumn("cell_rank", F.row_number().over(cell).cast("long")).where(F.col("cell_rank") <= per_cell)


def select_members(members: DataFrame, seed: str, per_cell: int = 1, *, strata_count: int = 4, months: list[str] | None = None, **options) -> list[dict]:
    """Per cell the first ``per_cell`` members in hash order, preferring symbols that no earlier cell has taken.

    That preference runs across cells in order, so the last step is on the
    driver.  A cell can lose at most one candidate for each symbol taken
    before, so its first (cells x per_cell) candidates suffice: what is
    collected is bounded by the number of cells, not by members.
    """
    month = options.get("month", "month")
    keys = options.get("keys", ("session_date", "symbol"))
    months = months or [r[0] for r in members.select(month).distinct().orderBy(month).collect()]
    most = len(months) * strata_count * per_cell
    rows = ranked_candidates(members, seed, most, strata_count=strata_count, **options).orderBy(month, "stratum", "cell_rank").collect()
    cells: dict[tuple, list[dict]] = {}
    for r in rows:
        cells.setdefault((r[month], r["stratum"]), []).append(r.asDict())
    chosen, taken = [], set()
    for m in months:
        for s in range(strata_count):
            left = cells.get((m, s), [])
            if len(left) < per_cell:
                raise ValueError(f"month {m}, stratum {s} has fewer than {per_cell} members")
            for k in range(per_cell):
                fresh = next((x for x in left if x[keys[1]] not in taken), None)
                one = fresh or left[0]
                left.remove(one)
                taken.add(one[keys[1]])
                chosen.append(one | {"cell_index": k, "symbol_repeat_fallback": fresh is None})
    return chosen
