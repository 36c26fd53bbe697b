"""Exponentially weighted sums over a dense grid, exact over long sessions.

``sum over u <= t of x_u * 2^((u - t) / h)`` cannot be one scaled prefix sum:
2^(57600 / 30) overflows.  Rows are cut into blocks of 30 half-lives, where
scale factors stay below 2^30, and blocks into superblocks of 30, where block
totals are scaled by at most 2^900.  A superblock starts from the last one's
end.  Anything older has decayed by 2^900 or more and is below the last bit of
a double unless all since is zero.  Three window layers share one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 30
SUPER = 30


def power2(x: Column) -> Column:
    return F.pow(F.lit(2.0), x)


def ew_sums(df: DataFrame, part: Sequence[str], order: str, position: str, inputs: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """``df`` with a column per input: its weighted sum with the given half-life in rows.

    ``part`` names the partition in which state is kept, ``position`` the row's
    number in it from 0; nulls add nothing.
    """
    by_life: dict[int, dict[str, Column]] = {}
    for name, (x, half_life) in inputs.items():
        by_life.setdefault(half_life, {})[name] = F.coalesce(x.cast("double"), F.lit(0.0))
    o = F.col(position)
    places: dict[str, Column] = {}
    for h in by_life:
        size = BLOCK * h
        places |= {f"_r{h}": F.pmod(o, F.lit(size)), f"_b{h}": F.call_function("div", o, F.lit(size))}
    df = df.withColumns(places | {f"_x_{n}": x for xs in by_life.values() for n, x in xs.items()})
    df = df.withColumns({k: v for h in by_life for k, v in {f"_q{h}": F.pmod(F.col(f"_b{h}"), F.lit(SUPER)), f"_s{h}": F.call_function("div", F.col(f"_b{h}"), F.lit(SUPER))}.items()})
    for h, xs in by_life.items():
        size, r, q, s = BLOCK * h, F.col(f"_r{h}"), F.col(f"_q{h}"), F.col(f"_s{h}")
        inside = Window.partitionBy(*part, f"_b{h}").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumns({f"_l_{n}": F.sum(F.col(f"_x_{n}") * power2(r / h)).over(inside) * power2(-r / h) for n in xs})
        ends = r == size - 1
        earlier = Window.partitionBy(*part, f"_s{h}").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        carry = {n: F.coalesce(F.sum(F.when(ends, F.col(f"_l_{n}") * power2(BLOCK * q))).over(earlier), F.lit(0.0)) for n in xs}
        df = df.withColumns({f"_c_{n}": F.col(f"_l_{n}") + c * power2(-BLOCK * (q - 1) - (r + 1) / h) for n, c in carry.items()})
        before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        since = (o - s * (size * SUPER) + 1) / h
        df = df.withColumns({
            n: F.col(f"_c_{n}") + F.when(s > 0, F.coalesce(F.last(F.when(ends & (q == SUPER - 1), F.col(f"_c_{n}")), ignorenulls=True).over(before), F.lit(0.0)) * power2(-since)).otherwise(0.0)
            for n in xs
        })
    return df.drop(*[c for c in df.columns if c.startswith(("_x_", "_l_", "_c_"))], *[f"_{k}{h}" for h in by_life for k in "rbqs"])
