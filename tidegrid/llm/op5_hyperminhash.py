"""Near-duplicate detection by HyperMinHash.

Each text's set of distinct word shingles gives ``ROWS`` registers a band.  A
register is the least of a bucket's hash values, stored as its leading-zero
count (6 bits) and the next 10 mantissa bits.  Equal sets form one class.
Class representatives are banded by their compressed registers; in each
bucket every member is paired with the bucket's least member.  Pairs are kept
if their collision-corrected Jaccard estimate is within five standard errors
of the threshold, and links are confirmed on full sets.  Components follow.
A bucket that still holds several components has pairs left to compare, those
of its members outside its largest component with all of other components:
while they are very many, stars around other members close more components,
then the rest is compared in blocks and on full sets, each pair in the first
band that it shares, so links that miss the least member are not lost.

The number of bands follows the threshold, so that a pair at it shares no band
with probability of at most 4e-7: 20 bands at 0.85, 28 at 0.8.  It falls below
the estimate filter with about 3e-7.

Defined results: a null text, or one without words, has the empty set, is
linked with nothing and is kept; a text of one to four words has its whole
sequence as one shingle, and a very long text all of its shingles; repeated
rows fall in one class and each row with the least doc_id is kept; where a
component has no doc_id at all its first row is kept; a pair exactly at the
threshold is linked; an empty table gives an empty result.  Other columns are
ignored, or travel in one struct, so clashing names do no harm.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import bloom
from tidegrid.llm import kernels as K
from tidegrid.llm.components import components
from tidegrid.llm.runtime import release, session, skewed_join, staged

BANDS, ROWS = 20, 4
#: Bound of the probability that a pair at the threshold shares no band.
MISS = 4e-7
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Members of a block of a large bucket, and blocks of its minority beyond which stars close more components first.
BLOCK = 1024
LARGE = 16


def bands_for(percent: int) -> int:
    """The least number of bands that misses a pair at the threshold with at most ``MISS``."""
    return max(1, math.ceil(math.log(MISS) / math.log1p(-min(percent / 100, 0.999) ** ROWS)))


@lru_cache(8)
def _seeds(count: int) -> np.ndarray:
    return np.random.default_rng(55).integers(0, 1 << 63, (2, count), dtype=np.uint64) * K.U64(2) + K.U64(1)


def leading_zeros(x: np.ndarray) -> np.ndarray:
    out, left = np.zeros(x.shape, np.uint64), x.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = left >> K.U64(64 - step) == 0
        out += np.where(high, K.U64(step), K.U64(0))
        left = np.where(high, left << K.U64(step), left)
    return np.where(x == 0, K.U64(63), out)


def compress(minimum: np.ndarray) -> np.ndarray:
    """Least hash values to 16-bit registers: leading zeros, then mantissa bits after the first one."""
    zeros = leading_zeros(minimum)
    mantissa = (minimum << zeros << K.U64(1)) >> K.U64(64 - MANTISSA)
    return ((zeros << K.U64(MANTISSA)) | mantissa).astype(np.uint16)


def registers(keys: np.ndarray, bounds: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """Registers of each row's set; rows with an empty set get zeros."""
    seeds = _seeds(count)
    out = np.zeros((len(bounds) - 1, count), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        least = np.empty((len(full), count), np.uint64)
        for k in range(count):
            x = (keys ^ seeds[0, k]) * seeds[1, k]
            x ^= x >> K.U64(32)
            x *= seeds[1, (k + 1) % count]
            least[:, k] = np.minimum.reduceat(x, bounds[:-1][full])
        out[full] = compress(least)
    return out


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of equal registers of unrelated sets of n and m shingles."""
    total = np.zeros(len(n))
    for level in range(48):
        high, low = 2.0 ** -level, 2.0 ** -(level + 1)
        total += (np.exp(-n * low) - np.exp(-n * high)) * (np.exp(-m * low) - np.exp(-m * high))
    return total / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate from two register matrices."""
    chance = collision_rate(n, m)
    return np.clip(((a == b).mean(1) - chance) / (1 - chance), 0, 1)


def _signer(count: int):
    def run(batches):
        for batch in batches:
            n_all, hi, lo, regs = [], [], [], []
            for _, _, raw, offs in K.chunks(batch.column(2)):
                keys, bounds = K.shingle_sets(raw, offs)
                total = np.zeros((2, len(keys) + 1), np.uint64)
                np.cumsum(K.mix(keys), out=total[0, 1:])
                np.cumsum(K.mix(keys ^ K.U64(0x5851F42D4C957F2D)), out=total[1, 1:])
                hi.append((total[0, bounds[1:]] - total[0, bounds[:-1]]).view(np.int64))
                lo.append((total[1, bounds[1:]] - total[1, bounds[:-1]]).view(np.int64))
                n_all.append(np.diff(bounds))
                regs.append(registers(keys, bounds, count))
            cat = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
            body = np.concatenate(regs).tobytes() if regs else b""
            offsets = (np.arange(batch.num_rows + 1) * (2 * count)).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), cat(n_all), cat(hi), cat(lo), packed, batch.column(2)],
                names=["doc_id", "row", "n", "hi", "lo", "regs", "text"],
            )

    return run


def _matrix(column: pa.Array, count: int) -> np.ndarray:
    raw, _ = K.buffers(column)
    return np.ascontiguousarray(raw).view(np.uint16).reshape(-1, count)


def _estimator(threshold: float, count: int):
    def run(batches):
        for batch in batches:
            a, b = _matrix(batch.column(2), count), _matrix(batch.column(4), count)
            n, m = np.array(batch.column(3)).astype(float), np.array(batch.column(5)).astype(float)
            keep = pa.array(estimate(a, b, n, m) >= threshold) if batch.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


def _verifier(percent: int):
    def run(batches):
        for batch in batches:
            u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at: dict[int, tuple[int, int]] = {}
            for k in range(batch.num_rows):
                at.setdefault(u[k], (2, k))
                at.setdefault(v[k], (3, k))
            sets: dict[int, np.ndarray] = {}
            names = list(at)
            texts = pa.array([batch.column(c)[k].as_py() for c, k in at.values()], pa.large_string())
            for i, _, raw, offs in K.chunks(texts):
                keys, bounds = K.shingle_sets(raw, offs)
                for r in range(len(offs) - 1):
                    sets[names[i + r]] = keys[bounds[r] : bounds[r + 1]]
            ok = []
            for x, y in zip(u, v, strict=True):
                a, b = sets[x], sets[y]
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common) and common > 0)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


def _shingle_sets(batches):
    """(node, text) to (node, set): sorted shingle hashes as bytes."""
    for batch in batches:
        sets = []
        for _, _, raw, offs in K.chunks(batch.column(1)):
            keys, bounds = K.shingle_sets(raw, offs)
            sets += [keys[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "set"])


class Postings:
    """Which of some sorted sets hold each element: intersection sizes of one set with all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(every, kind="stable")
        self.keys, self.owner, self.n = every[order], owner[order], len(sets)

    def common(self, one: np.ndarray) -> np.ndarray:
        first, last = np.searchsorted(self.keys, one, "left"), np.searchsorted(self.keys, one, "right")
        count = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        return np.bincount(self.owner[at], minlength=self.n)


def _blocks(threshold: float, percent: int, count: int):
    """Links between different components, of one block of a bucket's minority with one block of all its members.

    Pairs whose estimate passes are confirmed on the full sets right here, one
    member against all by postings, and only links leave the task.  A link
    joins its two components, so pairs inside what is joined by then are
    skipped: components are what the result needs.
    """

    def run(key, table):
        table = table.combine_chunks()
        node, root, n = (np.array(table.column(c)).copy() for c in ("node", "root", "n"))
        minor, regs = np.array(table.column("minor")), _matrix(table.column("regs"), count)
        band = table.column("band")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        at_left = np.array(table.column("is_left"))
        left, right = np.flatnonzero(at_left), np.flatnonzero(~at_left)
        us, vs = [], []
        held = Postings([sets[y] for y in right]) if len(right) else None
        for x in left:
            # Two members of the minority meet twice, and are compared once.
            near = (root[right] != root[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x])) & (~minor[right] | (node[right] > node[x]))
            y = right[near]
            if not len(y):
                continue
            same = regs[y] == regs[x]
            first = same.reshape(len(y), -1, ROWS).all(2).argmax(1) == band
            chance = collision_rate(np.full(int(first.sum()), float(n[x])), n[y[first]].astype(float))
            y = y[first][(same[first].mean(1) - chance) / (1 - chance) >= threshold]
            if not len(y):
                continue
            common = held.common(sets[x])[np.searchsorted(right, y)]
            for z in y[100 * common >= percent * (n[x] + n[y] - common)]:
                if root[z] != root[x]:
                    us.append(node[x])
                    vs.append(node[z])
                    root[root == root[z]] = root[x]
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _merged(roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``roots`` (node, root) with the components that ``links`` (u, v) join, as a written table."""
    at = lambda end: roots.withColumnsRenamed({"node": end, "root": f"r{end}"})
    joined = links.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    top = components(joined, f"{name}-cc").select(F.col("root").alias("top"), F.col("node").alias("root"))
    ends = links.select(F.col("u").alias("node")).union(links.select("v")).distinct().join(roots, "node", "left_anti")
    every = roots.unionByName(ends.withColumn("root", F.col("node")))
    return staged(every.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), name)


def classes_and_links(docs: DataFrame, percent: int = 85, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The signed documents (doc_id, row, n, hi, lo, regs, text) and (hi, lo, node, class_doc, least, root) of each class of equal sets.

    ``least`` is the row with the class's least doc_id.  With ``row``, ``docs``
    is a written table that has its row numbers in that column, and the signed
    documents have no text of their own.
    """
    spark = session(docs.sparkSession)
    bands = bands_for(percent)
    count = bands * ROWS
    threshold = percent / 100 - 5 * float(np.sqrt(percent / 100 * (1 - percent / 100) / count))
    number = F.col(row) if row else F.monotonically_increasing_id()
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), F.col("text").cast("string").alias("text"))
    signed = cols.mapInArrow(_signer(count), "doc_id long, row long, n long, hi long, lo long, regs binary, text string")
    signed = staged(signed.drop("text") if row else signed, "op5-signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    classes = staged(signed.where("n > 0").groupBy("hi", "lo").agg(F.min("row").alias("node"), F.min("doc_id").alias("class_doc"), first), "op5-classes")
    reps = staged(signed.select(F.col("row").alias("node"), "n", "regs").join(classes.select("node"), "node"), "op5-reps")
    texts = cols.select("row", "text") if row else signed.select("row", "text")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) confirmed on the full sets of their texts; only texts that a pair may ask for are shuffled."""
        asked = bloom.build(pairs.select("u").union(pairs.select("v"))).column(F.col("row"))
        few = texts.where(asked)
        with_text = (
            pairs.join(few.withColumnsRenamed({"row": "u", "text": "u_text"}), "u")
            .join(few.withColumnsRenamed({"row": "v", "text": "v_text"}), "v")
        )
        return with_text.select("u", "v", "u_text", "v_text").mapInArrow(_verifier(percent), "u long, v long")

    keys = F.array([F.xxhash64(F.lit(b), F.substring("regs", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(bands)])
    banded = reps.select("node", F.posexplode(keys).alias("band", "key"))
    buckets = staged(banded.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("members")).where("members > 1"), "op5-buckets")
    members = staged(skewed_join(banded, buckets, ["key"], "members").where("node != center").select("key", "band", "node", "center"), "op5-members")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among the pairs (u, v): estimated on registers, then confirmed."""
        sized = (
            pairs.join(reps.withColumnsRenamed({"node": "u", "n": "un", "regs": "ur"}), "u")
            .join(reps.withColumnsRenamed({"node": "v", "n": "vn", "regs": "vr"}), "v")
            .where(100 * F.least("un", "vn") >= percent * F.greatest("un", "vn"))
        )
        near = staged(sized.select("u", "v", "ur", "un", "vr", "vn").mapInArrow(_estimator(threshold, count), "u long, v long"), "op5-near")
        release(spark)
        return staged(verified(near), "op5-links")

    links = confirmed(members.select(F.col("node").alias("u"), F.col("center").alias("v")).distinct())
    roots = staged(components(links, "op5-cc"), "op5-roots")

    # Buckets whose members, the center apart, are still of several components.
    star, last = 0, math.inf
    while True:
        rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        kinds = rooted.groupBy("key", "root").agg(F.count("*").alias("c"))
        mixed = kinds.groupBy("key").agg(F.sum("c").alias("members"), F.max(F.struct("c", "root")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
        mixed = staged(mixed.select("key", "members", F.col("top.root").alias("main"), (F.col("members") - F.col("top.c")).alias("minority")), "op5-mixed")
        left = mixed.agg(F.max("minority")).first()[0] or 0
        if left <= LARGE * BLOCK or left > 0.9 * last:
            break
        # Very many pairs are left: stars around other members first, while that helps.
        star, last = star + 1, left
        open_members = staged(skewed_join(rooted, mixed, ["key"], "members").select("key", "node", "root"), "op5-open")
        centers = open_members.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(star), "node").alias("h"), F.col("node").alias("v"), F.col("root").alias("vr"))).alias("c"))
        centers = centers.join(mixed.select("key", "members"), "key").select("key", "members", "c.v", "c.vr")
        spokes = skewed_join(open_members, staged(centers, "op5-centers"), ["key"], "members").where("root != vr").select(F.col("node").alias("u"), "v").distinct()
        roots = _merged(roots, confirmed(spokes), "op5-roots")

    # The other pairs of such buckets, in blocks: a block of the members outside the main component with a block of all.
    opened = skewed_join(rooted, mixed, ["key"], "members").withColumn("minor", F.col("root") != F.col("main"))
    of = lambda size: F.ceil(F.col(size) / BLOCK).cast("int")
    block = lambda size: F.pmod(F.xxhash64("node"), of(size)).cast("int")
    every = lambda size: F.explode(F.sequence(F.lit(0), of(size) - 1))
    cols = ["key", "band", "node", "root", "minor"]
    as_right = opened.select(*cols, F.lit(False).alias("is_left"), every("minority").alias("i"), block("members").alias("j"))
    as_left = opened.where("minor").select(*cols, F.lit(True).alias("is_left"), block("minority").alias("i"), every("members").alias("j"))
    open_rows = as_right.unionByName(as_left).join(reps, "node")
    open_nodes = staged(opened.select("node").distinct(), "op5-open")
    open_texts = texts.where(bloom.build(open_nodes).column(F.col("row"))).withColumnRenamed("row", "node").join(open_nodes, "node")
    open_sets = open_texts.select("node", "text").mapInArrow(_shingle_sets, "node long, set binary")
    second = open_rows.join(open_sets, "node").groupBy("key", "i", "j").applyInArrow(_blocks(threshold, percent, count), "u long, v long")
    second = staged(second.distinct(), "op5-links2")
    release(spark)
    roots = _merged(roots, second, "op5-roots")
    label = classes.join(roots, "node", "left").select("hi", "lo", "node", "class_doc", "least", F.coalesce("root", "node").alias("root"))
    return signed, staged(label, "op5-labels")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row) of every document."""
    signed, label = classes_and_links(docs, percent)
    names = label.groupBy("root").agg(F.min("class_doc").alias("component_id"))
    label = label.join(names, "root")
    kept = F.when(F.col("n") == 0, True).when(F.col("component_id").isNull(), F.col("row") == F.col("root")).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return signed.select("doc_id", "row", "n", "hi", "lo").join(label, ["hi", "lo"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), kept.alias("kept"), "row"
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each component, the first with its least doc_id, with its own columns; rows without words stay.

    Rows are told apart by number, so repeated rows, an id on several texts and
    rows without an id leave one row of their component like all others.
    """
    # Written once, so that a row's number is the same whenever it is read.
    numbered = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"), F.monotonically_increasing_id().alias("row"))
    held = staged(numbered, "op5-documents")
    signed, label = classes_and_links(held.select("document.doc_id", "document.text", "row"), percent, row="row")
    stays = label.groupBy("root").agg(F.min("least").alias("least")).select("least.row")
    gone = staged(signed.where("n > 0").select("row").join(stays, "row", "left_anti").withColumnRenamed("row", "_gone"), "op5-gone")
    # Documents that cannot be among the removed ones pass unshuffled.
    marked = held.withColumn("_maybe", bloom.build(gone).column(F.col("row")))
    doubtful = marked.where("_maybe").join(gone, F.col("row") == F.col("_gone"), "left_anti")
    return marked.where("not _maybe").unionByName(doubtful).select("document.*")
