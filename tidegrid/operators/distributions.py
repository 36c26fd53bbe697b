"""Exact and binned distributions: marginals, joint histograms, empirical curves and quantile profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.bins import Axis, FixedAxis

#: Published quantile grids.
MARGINAL_QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)
PROFILE_QUANTILES = (0.01, 0.05, 0.1, 0.25, 0.5)


def exact_marginal(rows: DataFrame, keys: Sequence[str], value: str, mask: str | None = None) -> DataFrame:
    """The exact distribution of valid values, pooled and with members weighing the same.

    One row per distinct value: its count, pooled cumulative count and share,
    equal-member mass and its cumulative mass.  Values are first counted per
    member, so what is ordered is distinct values, and cumulative sums run over
    ranges of values in parallel (``running_total``).
    """
    valid = rows.where(F.col(value).isNotNull() & ((F.col(mask) == 0) if mask else F.lit(True)))
    per = valid.groupBy(*keys, value).agg(F.count("*").alias("n"))
    members = per.groupBy(*keys).agg(F.sum("n").alias("member_n"))
    total = members.agg(F.count("*").alias("members"), F.sum("member_n").alias("total"))
    weighted = per.join(members, list(keys)).groupBy(value).agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.col("member_n")).alias("mass"))
    out = running_total(weighted, value, ["n", "mass"]).join(F.broadcast(total))
    return out.select(
        F.col(value).alias("value"), "n", F.col("cum_n").alias("cumulative_n"), (F.col("cum_n") / F.col("total")).alias("pooled_share"),
        (F.col("mass") / F.col("members")).alias("equal_mass"), (F.col("cum_mass") / F.col("members")).alias("equal_share"),
    )


def running_total(df: DataFrame, order: str, sums: Sequence[str], buckets: int = 256, prefix: str = "cum_") -> DataFrame:
    """Cumulative sums over a whole table in the order of one column, without gathering it in one task.

    Rows are range-partitioned by approximate quantiles into ``buckets``; each
    bucket is summed and ordered on its own, and the buckets' totals, at most
    ``buckets`` rows, give the offsets.
    """
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(order, probs, 10_000).alias("_cuts"))
    with_bucket = df.join(F.broadcast(cuts)).withColumn("_bucket", F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c < F.col(order)))).drop("_cuts")
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = with_bucket.groupBy("_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums]).select(
        F.col("_bucket"), *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    out = with_bucket.withColumns({f"_i_{s}": F.sum(s).over(inside) for s in sums}).join(F.broadcast(totals), "_bucket")
    return out.withColumns({f"{prefix}{s}": F.col(f"_i_{s}") + F.col(f"_o_{s}") for s in sums}).drop("_bucket", *[f"_{k}_{s}" for s in sums for k in "io"])


def marginal_quantiles(marginal: DataFrame, probs: Sequence[float] = MARGINAL_QUANTILES) -> DataFrame:
    """For each q the first value whose pooled rank reaches ceil(q n), and the first whose equal-member mass reaches q."""
    n = F.max("cumulative_n")
    total = marginal.agg(n.alias("total"))
    long = marginal.join(F.broadcast(total)).withColumn("q", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    return long.groupBy("q").agg(
        F.min(F.when(F.col("cumulative_n") >= F.greatest(F.ceil(F.col("q") * F.col("total")), F.lit(1)), F.col("value"))).alias("pooled"),
        F.min(F.when(F.col("equal_share") + 1e-15 >= F.col("q"), F.col("value"))).alias("equal_member"),
    )


def joint_histogram(rows: DataFrame, keys: Sequence[str], x: str, y: str, x_axis: FixedAxis, y_axis: FixedAxis, by: Sequence[str] = ()) -> DataFrame:
    """Counts and equal-member probability of every occupied (x bin, y bin)."""
    valid = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({"x_bin": x_axis.bin(F.col(x)), "y_bin": y_axis.bin(F.col(y))})
    per = valid.groupBy(*by, *keys, "x_bin", "y_bin").agg(F.count("*").alias("n"))
    members = per.groupBy(*by, *keys).agg(F.sum("n").alias("member_n"))
    count = members.groupBy(*by).agg(F.count("*").alias("members"))
    joined = per.join(members, [*by, *keys]).groupBy(*by, "x_bin", "y_bin").agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.col("member_n")).alias("mass"))
    joined = joined.join(count, list(by)) if by else joined.join(F.broadcast(count))
    return joined.select(*by, "x_bin", "y_bin", "n", (F.col("mass") / F.col("members")).alias("equal_probability"))


def joint_coverage(rows: DataFrame, x: str, y: str, x_plotted: Column, y_plotted: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows plotted, off axis, and with x, y or both invalid."""
    xn, yn = F.col(x).isNull(), F.col(y).isNull()
    ok = ~xn & ~yn
    on = F.coalesce(x_plotted & y_plotted, F.lit(False))
    return rows.groupBy(*by).agg(
        F.count("*").alias("represented"), F.count_if(xn & ~yn).alias("x_invalid"), F.count_if(yn & ~xn).alias("y_invalid"), F.count_if(xn & yn).alias("both_invalid"),
        F.count_if(ok & on).alias("plotted"), F.count_if(ok & ~on).alias("off_axis"),
    )


def dense_bins(histogram: DataFrame, by: Sequence[str], x_bins: int, y_bins: int) -> DataFrame:
    """Zeros for the bins of each panel that hold nothing: a fixed number of bins per panel."""
    panels = histogram.select(*by).distinct() if by else histogram.sparkSession.range(1).select()
    every = panels.withColumn("x_bin", F.explode(F.sequence(F.lit(0), F.lit(x_bins - 1)))).withColumn("y_bin", F.explode(F.sequence(F.lit(0), F.lit(y_bins - 1))))
    return every.join(histogram, [*by, "x_bin", "y_bin"], "left").fillna(0, ["n"])


def memberships(rows: DataFrame, session: str, band: Column, gate: Column) -> DataFrame:
    """Rows unnested into the displays they belong to: pooled and own session, all and own band, ungated and gated.

    Gated displays hold rows of bands from 1 on; a row lands in at most 2 x 2 x 2 displays.
    """
    scopes = F.array(F.lit("pooled"), F.col(session))
    bands = F.array(F.lit("all"), F.concat(F.lit("band_"), band.cast("string")))
    gates = F.when(F.coalesce(gate, F.lit(False)) & (band >= 1), F.array(F.lit("unconditional"), F.lit("gated"))).otherwise(F.array(F.lit("unconditional")))
    return rows.withColumn("scope", F.explode(scopes)).withColumn("band", F.explode(bands)).withColumn("gate", F.explode(gates))


def binned_ecdf(rows: DataFrame, bins: Mapping[str, Column], by: Sequence[str], gate: Column | None = None) -> DataFrame:
    """Counts and cumulative shares by metric and bin, pooled over and within ``by``.

    ``bins`` maps a metric to its bin (null: invalid).  One pass: metrics are
    stacked and counted, and grouping sets of the counts give the pooled rows,
    whose ``by`` is null.
    """
    base = rows.where(F.coalesce(gate, F.lit(False))) if gate is not None else rows
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), b.cast("long").alias("bin")) for k, b in bins.items()]))
    long = base.select(*by, stack.alias("m")).select(*by, "m.metric", "m.bin").where(F.col("bin").isNotNull())
    fine = long.groupBy("metric", "bin", *by).agg(F.count("*").alias("n"))
    counts = fine.groupingSets([[F.col("metric"), F.col("bin"), *[F.col(b) for b in by]], [F.col("metric"), F.col("bin")]], "metric", "bin", *by).agg(
        F.grouping_id("metric", "bin", *by).alias("_g"), F.sum("n").alias("n")
    )
    counts = counts.withColumn("pooled", F.col("_g") != 0).drop("_g")
    part = Window.partitionBy("metric", "pooled", *by)
    run = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumns({"cumulative_n": F.sum("n").over(run), "share": F.sum("n").over(run) / F.sum("n").over(part)})


def activity_ecdf(rows: DataFrame, value: Column, bin_: Column, session: str, threshold: Column) -> DataFrame:
    """Binned counts with each bin's extremes and threshold passes, per session and pooled, with cumulative shares.

    The curve of a session runs through (largest value of the bin, share), so
    it touches observed values only.  Rows are aggregated by session and bin
    once; the pooled rows come from that table.
    """
    fine = rows.select(F.col(session).alias("session"), value.alias("x"), bin_.alias("bin"), F.coalesce(threshold, F.lit(False)).alias("t")).where("x is not null").groupBy("session", "bin").agg(
        F.count("*").alias("n"), F.count_if("t").alias("passes"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    pooled = fine.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("passes").alias("passes"), F.min("low").alias("low"), F.max("high").alias("high")).withColumn("session", F.lit("pooled"))
    part = Window.partitionBy("session")
    run = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return fine.unionByName(pooled).withColumns({"cumulative_n": F.sum("n").over(run), "share": F.sum("n").over(run) / F.sum("n").over(part)})


def panel_summary(rows: DataFrame, keys: Sequence[str], x: str, y: str, x_axis: Axis, y_axis: Axis) -> DataFrame:
    """One row: validity, zeros, what the axes show, and the member that contributes most."""
    xn, yn = F.col(x).isNull(), F.col(y).isNull()
    both = ~xn & ~yn
    shown = F.coalesce(both & x_axis.bin(F.col(x)).isNotNull() & y_axis.bin(F.col(y)).isNotNull(), F.lit(False))
    count = lambda c: F.count_if(c)
    per = rows.groupBy(*keys).agg(
        F.count("*").alias("selected"), count(both).alias("pair_valid"), count(xn & ~yn).alias("x_invalid_only"), count(yn & ~xn).alias("y_invalid_only"), count(xn & yn).alias("both_invalid"),
        count(shown).alias("plotted"), count(both & (F.col(x) == 0)).alias("x_zero"), count(both & (F.col(y) == 0)).alias("y_zero"),
    )
    sums = ["selected", "pair_valid", "x_invalid_only", "y_invalid_only", "both_invalid", "plotted", "x_zero", "y_zero"]
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    out = per.agg(
        *[F.sum(s).alias(s) for s in sums], F.count("*").alias("selected_members"), F.count_if(F.col("pair_valid") > 0).alias("contributing_members"),
        F.max_by(name, F.struct("pair_valid", name.alias("name"))).alias("largest_member"), F.max("pair_valid").alias("largest_pair_valid"),
    )
    return out.withColumns({"off_axis": F.col("pair_valid") - F.col("plotted"), "largest_share": F.try_divide(F.col("largest_pair_valid").cast("double"), F.col("pair_valid"))})


def curve(ecdf: DataFrame, width: float, maximum: Column, log: bool = True) -> DataFrame:
    """x of each bin's right edge, capped at the largest value."""
    edge = F.col("bin") * F.lit(width)
    return ecdf.withColumn("x", F.least(F.expm1(edge) if log else edge, maximum))


def discrete_quantiles(rows: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact ``percentile_disc`` per probability: (by, q, value)."""
    from pyspark.sql.functions import expr

    arr = ", ".join(repr(float(p)) for p in probs)
    found = rows.groupBy(*by).agg(expr(f"percentile_disc(array({arr})) WITHIN GROUP (ORDER BY `{value}`)").alias("_v"), F.count(value).alias("n"))
    qs = F.array(*[F.lit(float(p)) for p in probs])
    return found.select(*by, "n", F.explode(F.arrays_zip(qs.alias("q"), F.col("_v").alias("value"))).alias("z")).select(*by, "n", F.col("z.q").alias("q"), F.col("z.value").alias("value"))


def collapse_quantiles(points: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Of runs of equal values the first and last probability, so that both sides of an atom stay."""
    out: list[tuple[float, float]] = []
    for i, (q, v) in enumerate(points):
        inner = 0 < i < len(points) - 1 and points[i - 1][1] == v == points[i + 1][1]
        if not inner:
            out.append((q, v))
    return out


def profile(rows: DataFrame, values: Mapping[str, Column], populations: Mapping[str, Column], floor: float, probs: Sequence[float] = PROFILE_QUANTILES) -> DataFrame:
    """Exact quantiles, minimum and share below a floor of each value in each population."""
    stack = F.array(*[F.struct(F.lit(v).alias("view"), F.lit(p).alias("population"), F.when(F.coalesce(c, F.lit(False)), x.cast("double")).alias("x")) for v, x in values.items() for p, c in populations.items()])
    long = rows.select(F.explode(stack).alias("s")).select("s.*").where(F.col("x").isNotNull())
    arr = ", ".join(repr(float(p)) for p in probs)
    got = long.groupBy("view", "population").agg(
        F.count("*").alias("n"), F.min("x").alias("minimum"), F.expr(f"percentile_disc(array({arr})) WITHIN GROUP (ORDER BY x)").alias("_q"),
        (F.count_if(F.col("x") < floor) / F.count("*")).alias("share_below"),
    )
    names = {p: f"p{int(round(100 * p))}" for p in probs}
    return got.select("view", "population", "n", "minimum", *[F.element_at("_q", i + 1).alias(n) for i, n in enumerate(names.values())], "share_below")
