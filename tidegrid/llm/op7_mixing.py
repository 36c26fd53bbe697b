"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) take the given weights in
turn and share ``total_share`` of all words; a target stops at ``most`` times
its source's words and the excess is shared again by weight until none is
above (solved at once from cumulative sums in the order of caps per weight).

A document of a source with target T and S words should appear T / S times:
the whole part is allocated as certain copies, and the rest is an inclusion
probability pi.  Documents are ranked by their random odds u / (1 - u) divided
by their inclusion odds pi / (1 - pi), and each source takes its least ranks
up to its remaining words.  The draw depends on the document only, so reruns
agree whatever the partitions.  The cut is found by cumulative sums over 4,096
cells of the rank, refined by its next digits and then by those of a hash of
the document until every cut cell holds one document; no source is sorted or
held in one task.  The last document of each source is the one that fits the
remaining gap best.  Where that would miss the target by more than the
source's smallest document left, documents longer than the gap are passed over
first and the order goes on, until it does not.

The table of sources (one narrow row each) is ordered in one task; it grows
with the number of sources, not of documents.

Defined results: a null or empty text has size 0 and takes 0 words; a very
long text is one document like any other; a null source is a source of its
own, last in order; documents of one rank follow the hash of id and text;
repeated rows are interchangeable, and a digit of the row number tells them
apart last, so the number of them that is taken does not depend on it; an
empty table gives an empty result.  Other columns are ignored by ``mix`` and
travel in one struct in ``mixed_documents``, so their names clash with none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.runtime import staged

CELLS = 4096
#: Sources up to which the table of cuts is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(mix_source, source_size, target) from one row per source with its ``source_size``."""
    order = Window.orderBy(F.col("mix_source").asc_nulls_last())
    cycle = F.array([F.lit(float(w)) for w in weights])
    weighted = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ratio = most * F.col("source_size") / F.col("w")
    ranked = Window.orderBy(ratio, F.col("mix_source").asc_nulls_last())
    prior = ranked.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighted.select(
        "mix_source", "source_size", "w", ratio.alias("ratio"),
        # the level at which this and all later sources would share what the earlier, capped ones leave
        ((total_share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(prior), F.lit(0)))
         / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(prior), F.lit(0.0)))).alias("level"),
    )
    # The first source whose cap is above its level sets the level of all that follow.
    free = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(everything)["level"]
    return levels.select("mix_source", "source_size", F.when(free.isNull(), most * F.col("source_size")).otherwise(F.least(most * F.col("source_size"), free * F.col("w"))).cast("double").alias("target"))


def _joined(rows: DataFrame, sources: DataFrame, small: bool) -> DataFrame:
    other = sources.withColumnRenamed("mix_source", "s_source")
    return rows.join(F.broadcast(other) if small else other, F.col("mix_source").eqNullSafe(F.col("s_source")), "left").drop("s_source")


def mix(docs: DataFrame, *, source: str = "source", weights: Sequence[float] = (3, 1, 2), total_share: float = 1.5, seed: int = 7, slim: bool = True) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``; with ``slim`` only ``doc_id`` is carried along, else the struct ``document``."""
    # A document's own columns travel in one struct, so their names clash with none of the plan's.
    carried = [F.col("doc_id").cast("long")] if slim else [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document")]
    rows = staged(
        docs.select(
            *carried,
            F.col(source).cast("string").alias("mix_source"),
            word_count(F.col("text").cast("string")).alias("size"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"),
            F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text")).alias("tie"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "op7-rows",
    )
    narrow = rows.select("mix_source", "size", "draw", "tie", "row")
    plan = staged(targets(narrow.groupBy("mix_source").agg(F.sum("size").alias("source_size")), weights, total_share), "op7-targets")
    small = plan.count() <= BROADCAST_SOURCES
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(times)).withColumn("pi", times - F.col("whole"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    u = (F.shiftrightunsigned("draw", 11).cast("double") + 0.5) / float(1 << 53)
    rank = (u / (1 - u)) / (F.col("pi") / (1 - F.col("pi")))
    place = F.when((F.col("pi") > 0) & (F.col("pi") < 1), rank / (1 + rank)).otherwise(F.lit(0.0))
    digit, bits = F.lit(CELLS), CELLS.bit_length() - 1
    by_hash = lambda h, k: F.shiftrightunsigned(h, 64 - bits * (k + 1)).bitwiseAND(CELLS - 1)
    # The digits of a document's place: of its rank, of a hash of the document, and of its row for equal documents.
    digits = [F.least(F.floor(F.pmod(place * float(CELLS) ** (k + 1), digit)), digit - 1) for k in range(3)]
    digits += [by_hash(F.col("tie"), k) for k in range(60 // bits)] + [by_hash(F.xxhash64("row"), k) for k in range(60 // bits)]
    cells = {f"c{k}": d.cast("long") for k, d in enumerate(digits)}
    used = 3

    def with_cells(df: DataFrame, levels: int = 3) -> DataFrame:
        return _joined(df, plan.select("mix_source", "pi"), small).withColumns(dict(list(cells.items())[:levels])).drop("pi")

    def search(left: DataFrame, cut: DataFrame) -> DataFrame:
        """(mix_source, t, rest): the digits of the cut of ``left`` at each source's ``rest``, and what stays of it; null where all fits."""
        nonlocal used
        whole = left.groupBy("mix_source").agg(F.sum("size").alias("all"))
        cut = cut.withColumns({"t": F.array().cast("array<bigint>"), "members": F.lit(2).cast("long")})
        for k, (level, column) in enumerate(cells.items()):
            if level not in left.columns:
                left = _joined(left, plan.select("mix_source", "pi"), small).withColumn(level, column).drop("pi")
            sums = left.groupBy("mix_source", F.col(level).alias("cell")).agg(F.sum("size").alias("w"), F.count_if(F.col("size") > 0).alias("in_cell"))
            before = F.coalesce(F.sum("w").over(Window.partitionBy("mix_source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            crossing = (
                _joined(sums.withColumn("before", before), cut.select("mix_source", "rest"), small)
                .where((F.col("w") > 0) & (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("w")))
                .select("mix_source", "cell", "in_cell", (F.col("rest") - F.col("before")).alias("rest_in"))
            )
            found = F.col("cell").isNotNull()
            cut = staged(
                _joined(cut, crossing, small).select(
                    "mix_source", F.coalesce("rest_in", "rest").alias("rest"), F.when(found, F.concat("t", F.array("cell"))).otherwise(F.col("t")).alias("t"),
                    F.when(found, F.col("in_cell")).otherwise(F.lit(0)).alias("members"),
                ),
                "op7-cut",
            )
            used = max(used, k + 1)
            if k >= 2 and cut.where("members > 1").isEmpty():
                break
            left = _joined(left, cut.where("members > 1").select("mix_source", F.element_at("t", -1).alias("edge")), small).where(F.col(level) == F.col("edge")).drop("edge")
        fits = F.size("t") == 0
        return _joined(cut, whole, small).select(
            "mix_source", F.when(~fits, F.col("t")).alias("t"), F.when(fits, F.col("rest") - F.coalesce("all", F.lit(0))).otherwise(F.col("rest")).alias("rest")
        )

    # A source's passes, each the largest size it takes and its cut: a document is sampled if it is under the cut of a pass that takes its size.
    # A cut shorter than a place is less than all places that begin with it.
    def sampled() -> Column:
        place_of = F.array(*[F.col(c) for c in list(cells)[:used]])
        return F.coalesce(F.exists("passes", lambda p: (F.col("size") <= p["limit"]) & (place_of < p["t"])), F.lit(False))

    first = search(with_cells(narrow), plan.select("mix_source", "rest"))
    cut = first.select("mix_source", "rest", F.array(F.struct(F.lit((1 << 63) - 1).alias("limit"), "t")).alias("passes"))
    while True:
        open_rows = _joined(with_cells(narrow, used), cut.withColumnRenamed("rest", "gap"), small).where(~sampled() & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")))
        # Each source's last document: of those left, the one whose size is nearest its gap, if that is an improvement.
        fit = open_rows.groupBy("mix_source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "c0", "c1", "c2", "tie", "row")).alias("best"), F.min("size").alias("smallest"))
        cut = staged(_joined(cut, fit.select("mix_source", F.col("best.row").alias("best_row"), F.col("best.off").alias("off"), "smallest"), small), "op7-fit")
        short = cut.where(F.col("off") > F.col("smallest")).select("mix_source", "rest", F.floor("rest").alias("limit"))
        if short.isEmpty():
            break
        rows_left = _joined(open_rows.drop("passes", "gap"), short.select("mix_source", "limit"), small).where(F.col("size") <= F.col("limit")).drop("limit")
        found = search(rows_left, short.select("mix_source", "rest"))
        more = _joined(short.select("mix_source", "limit"), found.withColumnRenamed("rest", "rest_in"), small)
        end = F.array(F.lit(CELLS).cast("long"))
        passes = F.when(F.col("limit").isNull(), F.col("passes")).otherwise(F.concat("passes", F.array(F.struct("limit", F.coalesce("t", end).alias("t")))))
        cut = staged(
            _joined(cut.select("mix_source", "rest", "passes"), more, small).select("mix_source", F.coalesce("rest_in", "rest").alias("rest"), passes.alias("passes")), "op7-cut"
        )

    cut = staged(_joined(cut, plan.select("mix_source", "source_size", "target", "whole", "pi"), small), "op7-plan")
    final = _joined(rows, cut.drop("rest", "off", "smallest"), small).withColumns(dict(list(cells.items())[:used]))
    chosen = (sampled() | F.coalesce(F.col("row") == F.col("best_row"), F.lit(False))) & (F.col("pi") > 0)
    final = final.withColumn("copies", (F.col("whole") + chosen.cast("int")).cast("int")).withColumn("taken", F.col("size") * F.col("copies"))
    return final.select("doc_id" if slim else "document", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken, with its own columns."""
    taken = mix(docs, slim=False, **options).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("document.*")
