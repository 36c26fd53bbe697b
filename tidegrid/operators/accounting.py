"""Reconciled accounting: member counts, contributions, scopes, gates, memberships and disagreements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def member_accounting(rows: DataFrame, keys: Sequence[str], planned: DataFrame | None = None) -> DataFrame:
    """Selected, eligible, matching, nonmatching and unavailable rows of each member.

    ``rows`` has a three-state ``status``.  Members of ``planned`` without rows
    are kept with zeros.
    """
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("selected"),
        count_if(F.col("status") != "unavailable").alias("eligible"),
        count_if(F.col("status") == "matching").alias("matching"),
        count_if(F.col("status") == "nonmatching").alias("nonmatching"),
        count_if(F.col("status") == "unavailable").alias("unavailable"),
    )
    counts = ["selected", "eligible", "matching", "nonmatching", "unavailable"]
    if planned is not None:
        out = planned.select(*keys).distinct().join(out, list(keys), "left").fillna(0, counts)
    return out.withColumns({
        "match_fraction": F.when(F.col("eligible") > 0, F.col("matching") / F.col("eligible")),
        "eligibility_class": F.when(F.col("eligible") == 0, "no_eligible_rows").when(F.col("matching") == 0, "valid_zero_match").otherwise("positive_match"),
    })


def unreconciled(accounting: DataFrame) -> DataFrame:
    """Rows whose counts do not add up; a correct accounting has none."""
    return accounting.where((F.col("selected") != F.col("eligible") + F.col("unavailable")) | (F.col("eligible") != F.col("matching") + F.col("nonmatching")))


def contributions(accounting: DataFrame, keys: Sequence[str], value: str = "matching") -> DataFrame:
    """Each member's share of all matching rows; null if there are none.

    The total is one row, so it is joined rather than windowed over all members.
    """
    total = accounting.agg(F.sum(value).alias("total"))
    return accounting.join(F.broadcast(total)).select(*keys, value, F.when(F.col("total") > 0, F.col(value) / F.col("total")).alias("share"))


def scoped(rows: DataFrame, scopes: Mapping[str, Sequence[str]], measures: Sequence[Column]) -> DataFrame:
    """Measures in several scopes; ``scope`` names each row's set of keys, absent keys are null.

    Measures are named counts and sums.  Rows are first aggregated by all keys;
    grouping sets then add up that small table, so rows are never multiplied by
    the number of scopes.
    """
    keys = list(dict.fromkeys(k for s in scopes.values() for k in s))
    fine = rows.groupBy(*keys).agg(*measures)
    names = [c for c in fine.columns if c not in keys]
    sets = [[F.col(k) for k in s] for s in scopes.values()]
    grouped = fine.groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("_id"), *[F.sum(n).alias(n) for n in names])
    label = F.lit(None)
    for name, own in scopes.items():
        number = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)
        label = F.when(F.col("_id") == number, name).otherwise(label)
    return grouped.withColumn("scope", label).drop("_id")


def overlap_counts(a: Column, b: Column, names: tuple[str, str] = ("fast", "slow")) -> list[Column]:
    """Counts of two flags' intersection, differences and union."""
    x, y = names
    return [
        count_if(a).alias(f"{x}_rows"), count_if(b).alias(f"{y}_rows"), count_if(a & b).alias("shared_rows"),
        count_if(a & ~b).alias(f"{x}_only_rows"), count_if(b & ~a).alias(f"{y}_only_rows"), count_if(a | b).alias("union_rows"),
    ]


def overlap_ratios(df: DataFrame, names: tuple[str, str] = ("fast", "slow"), unit: str = "rows") -> DataFrame:
    """Shared over union, over the first and over the second; null over zero."""
    ratio = lambda d: F.try_divide(F.col(f"shared_{unit}").cast("double"), F.col(d))
    return df.withColumns({"shared_over_union": ratio(f"union_{unit}"), **{f"shared_over_{n}": ratio(f"{n}_{unit}") for n in names}})


def availability(a: Column, b: Column, names: tuple[str, str] = ("fast", "slow")) -> list[Column]:
    x, y = names
    return [
        F.count("*").alias("represented"), count_if(a & b).alias("both_available"), count_if(a & ~b).alias(f"{x}_only_available"),
        count_if(b & ~a).alias(f"{y}_only_available"), count_if(~a & ~b).alias("neither_available"),
    ]


def classified(a: Column, b: Column, names: tuple[str, str] = ("fast", "slow")) -> Column:
    return F.when(a & b, "both").when(a, f"{names[0]}_only").when(b, f"{names[1]}_only").otherwise("neither")


def membership(rows: DataFrame, keys: Sequence[str], a: Column, b: Column, eligible: Column, names: tuple[str, str] = ("fast", "slow")) -> DataFrame:
    """Which of two views ever match in each member.  Grouping by fewer keys unites members."""
    ever = rows.groupBy(*keys).agg(count_if(eligible).alias("common_eligible"), F.bool_or(a).alias("_a"), F.bool_or(b).alias("_b"))
    return ever.select(*keys, "common_eligible", (F.col("common_eligible") == 0).alias("no_common_eligible"), classified(F.col("_a"), F.col("_b"), names).alias("classification"))


def gate_accounting(rows: DataFrame, valid: Column, passing: Column, scopes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Represented = valid + unavailable and valid = pass + fail, in every scope."""
    ok = F.coalesce(valid, F.lit(False))
    good = ok & F.coalesce(passing, F.lit(False))
    return scoped(rows, scopes, [
        F.count("*").alias("represented"), count_if(ok).alias("valid"), count_if(good).alias("pass"),
        count_if(ok & ~good).alias("fail"), count_if(~ok).alias("unavailable"),
    ])


def disagreements(rows: DataFrame, agree: Column, failures: Mapping[str, Column], top: int | None = 20) -> DataFrame:
    """For rows that one view passes and the other fails (``agree``): failures, sole failures, and failure combinations.

    ``top`` keeps the most frequent combinations, as the display asks for; None keeps all.
    """
    flags = {k: F.coalesce(v, F.lit(True)) for k, v in failures.items()}
    total = sum((f.cast("int") for f in flags.values()), F.lit(0))
    base = rows.where(agree)
    one = base.agg(
        F.count("*").alias("n"),
        *[count_if(f).alias(f"c_{k}") for k, f in flags.items()], *[count_if(f & (total == 1)).alias(f"s_{k}") for k, f in flags.items()],
    )
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("failure"), F.col(f"c_{k}").alias("rows"), F.col(f"s_{k}").alias("sole")) for k in flags]))
    single = one.select("n", stack.alias("r")).select(F.lit("condition").alias("record_type"), "r.failure", "r.rows", F.col("r.sole").alias("sole_rows"), F.col("n").alias("direction_rows"))
    name = F.concat_ws(",", *[F.when(f, F.lit(k)) for k, f in flags.items()])
    combos = base.groupBy(name.alias("failure")).agg(F.count("*").alias("rows"))
    if top is not None:
        combos = combos.orderBy(F.desc("rows"), "failure").limit(top)
    combos = combos.join(F.broadcast(one.select("n"))).select(
        F.lit("combination").alias("record_type"), "failure", "rows", F.lit(None).cast("long").alias("sole_rows"), F.col("n").alias("direction_rows")
    )
    return single.unionByName(combos).withColumn("share_of_direction", F.try_divide(F.col("rows").cast("double"), F.col("direction_rows")))


def filter_contribution(rows: DataFrame, common: Column, conditions: Mapping[str, Column]) -> DataFrame:
    """Each condition's standalone passes, and the matches its removal adds, inside the common mask; one wide aggregate."""
    everything = common
    for c in conditions.values():
        everything = everything & c
    measures = [count_if(common).alias("common"), count_if(everything).alias("baseline")]
    for k, c in conditions.items():
        rest = common
        for j, other in conditions.items():
            rest = rest & other if j != k else rest
        measures += [count_if(common & c).alias(f"a_{k}"), count_if(rest).alias(f"r_{k}")]
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("condition"), F.col(f"a_{k}").alias("standalone"), F.col(f"r_{k}").alias("removed")) for k in conditions]))
    return rows.agg(*measures).select("common", "baseline", stack.alias("x")).select(
        "x.condition", F.col("common").alias("common_eligible"), F.col("x.standalone").alias("standalone_pass"),
        F.try_divide(F.col("x.standalone").cast("double"), F.col("common")).alias("standalone_rate"), F.col("baseline").alias("baseline_matching"),
        F.col("x.removed").alias("removed_matching"), (F.col("x.removed") - F.col("baseline")).alias("added_matching"),
    )


def membership_change(baseline: DataFrame, variant: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: members retained by the variant, gained and lost against the baseline."""
    a, b = baseline.select(*keys).distinct(), variant.select(*keys).distinct()
    both = a.withColumn("in_a", F.lit(1)).join(b.withColumn("in_b", F.lit(1)), list(keys), "full")
    return both.agg(count_if(F.col("in_b").isNotNull()).alias("retained"), count_if(F.col("in_a").isNull()).alias("gained"), count_if(F.col("in_b").isNull()).alias("lost"))


def threshold_crossings(rows: DataFrame, keys: Sequence[str], order: str, flag: Column) -> DataFrame:
    """How often a flag turns on and off between neighbouring rows of a member."""
    before = F.lag(flag).over(Window.partitionBy(*keys).orderBy(order))
    marked = rows.select(*keys, flag.alias("now"), before.alias("before"))
    return marked.groupBy(*keys).agg(count_if(F.col("now") & ~F.col("before")).alias("turned_on"), count_if(~F.col("now") & F.col("before")).alias("turned_off"))


def view_crossings(rows: DataFrame, common: Column, a: Column, b: Column, floor: float, a_match: Column, b_match: Column, names: tuple[str, str] = ("fast", "slow")) -> DataFrame:
    """One row: how often one view's value reaches a floor that the other's does not, and how that bears on one-sided matches."""
    x, y = names
    ok = F.coalesce(common & a.isNotNull() & b.isNotNull(), F.lit(False))
    only_a, only_b = a_match & ~b_match, b_match & ~a_match
    return rows.agg(
        count_if(ok & (a >= floor) & (b < floor)).alias(f"{x}_above_{y}_below"), count_if(ok & (b >= floor) & (a < floor)).alias(f"{y}_above_{x}_below"),
        count_if(only_a).alias(f"{x}_only"), count_if(only_b).alias(f"{y}_only"), count_if(only_a & ok & (a < floor)).alias(f"{x}_only_low"), count_if(only_b & ok & (b < floor)).alias(f"{y}_only_low"),
    )


def reason_tallies(rows: DataFrame, mask: str, bits: Mapping[int, str]) -> DataFrame:
    """Rows that carry each reason; a row with several counts in each."""
    one = rows.agg(*[count_if(F.col(mask).bitwiseAND(b) != 0).alias(n) for b, n in bits.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("reason"), F.col(n).alias("rows")) for n in bits.values()])).alias("x")).select("x.*")


def concentration(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest member share and Herfindahl index of row counts, in two levels of aggregation."""
    n = F.col("n").cast("double")
    per = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("members"), F.sum("n").alias("rows"), (F.max(n) / F.sum(n)).alias("largest_share"), (F.sum(n * n) / (F.sum(n) * F.sum(n))).alias("herfindahl"))
