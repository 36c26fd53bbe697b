"""Sharding by rendezvous hashing over weighted shards, in DataFrame functions only.

Each shard j draws a uniform number from the MD5 of (j, record key); a record
goes to the shard with the largest ``-weight / ln(u)``.  Its draws for the old
shards do not depend on new ones, so one more shard takes rows only into
itself, and a shard's weight sets its share of the rows.

Slots number the rows of a shard gaplessly.  No task orders a whole shard:
equal rows are counted first, the groups are dealt by hash to sub-buckets of
bounded expected size, sub-bucket counts give offsets, and groups are numbered
inside their sub-bucket.  A group of many rows is spread again to be numbered.

Defined results: a null key is a key like any other; a null or empty text has
size 1; a very long text is one row like any other; rows with one key share a
shard; equal rows are interchangeable and take successive slots, so slots do
not depend on the partitions; an empty table gives an empty result; other
columns are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.runtime import staged

#: Expected rows of a sub-bucket, and equal rows numbered by one array.
SUB_ROWS = 20_000
RUN = 10_000
#: Hexadecimal digits of a hash that are used.
DIGITS = 13


def hashed(*parts: Column) -> Column:
    """A number below 16 ** DIGITS from the MD5 of the parts' texts; a null is a text of its own."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a record key among ``len(weights)`` weighted shards."""

    def draw(j: int) -> Column:
        u = (hashed(F.lit(j), key).cast("double") + 0.5) / float(16**DIGITS)
        return F.struct((F.lit(-float(weights[j])) / F.ln(u)).alias("score"), F.lit(-j).alias("neg"))

    return (-F.greatest(*[draw(j) for j in range(len(weights))])["neg"]).cast("int") if len(weights) > 1 else F.lit(0)


def shard_rows(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shards: int = 16, weights: Sequence[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    weights = list(weights or [1.0] * shards)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    seen = docs.select(F.col(key).cast("long").alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    groups = staged(seen.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "op10-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    subs = max(1, -(-total // (len(weights) * SUB_ROWS)))
    groups = groups.withColumns({
        "shard": rendezvous(F.col("doc_id"), weights), "grown_shard": rendezvous(F.col("doc_id"), [*weights, sum(weights) / len(weights)]),
        "sub": F.pmod(hashed(F.col("doc_id"), F.col("text_crc32")), F.lit(subs)),
    })
    counts = groups.groupBy("shard", "sub").agg(F.sum("n").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "sub", F.coalesce(before, F.lit(0)).alias("offset"))
    inside = F.sum("n").over(Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1))
    placed = groups.withColumn("inside", F.coalesce(inside, F.lit(0))).join(offsets, ["shard", "sub"]).withColumn("slot", F.col("offset") + F.col("inside"))
    cols = ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"]
    runs = placed.where("n > 1").select(*cols, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))).alias("a")).repartition(F.col("slot"), F.col("a"))
    runs = runs.withColumn("i", F.explode(F.sequence(F.col("a"), F.least(F.col("a") + RUN, F.col("n")) - 1))).withColumn("slot", F.col("slot") + F.col("i"))
    every = placed.where("n = 1").select(*cols).unionByName(runs.select(*cols))
    return every.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
