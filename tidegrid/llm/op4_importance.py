"""Quality classifier by importance resampling.

Two hashed n-gram generative models are counted, one over target texts (rows
labelled good) and one over all raw texts.  A document's log importance is the
sum over its n-grams of ``log p_target - log p_raw``.  Adding a Gumbel draw
that depends only on the document and taking the top k samples k documents
without replacement in proportion to their importance.

N-grams are byte 4-grams and word bigrams.  Of the latter only those of one
word twice have a bucket, and all share it: 4-grams of bytes cannot tell a
repeated word from two words alike, and stuttering text is what this tells.
k is ``keep_share`` of all documents; by default the share of good rows among
the labelled ones.

Defined results: a null or empty text carries no evidence and is not kept; a
very long text is counted whole, piece by piece; documents tied at the k-th
score are all kept; with no labelled good row the two models agree and the
draw alone decides; repeated rows share one draw; an empty table gives an
empty result.  Columns of the input travel in one struct, so names like those
of the scores do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm import kernels as K
from tidegrid.llm.runtime import session, staged

BUCKETS = 1 << 16
ORDER = 4
#: The last bucket is the class of immediate word repeats.
REPEAT = BUCKETS
#: Pseudo-counts a bucket, on average, of the target model's prior.
PRIOR = 4.0


def ngrams(raw: np.ndarray, offs: np.ndarray, repeats: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each n-gram of each text."""
    n = len(raw) - ORDER + 1
    if n > 0:
        x = np.zeros(n, np.uint32)
        for k in range(ORDER):
            x = (x << np.uint32(8)) | raw[k : k + n]
        bucket = ((x * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
        at, rows, _ = K.windows_in_rows(offs, ORDER)
        bucket = bucket[at]
    else:
        bucket, rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not repeats:
        return bucket, rows
    w = K.Words(raw, offs)
    h = w.hashes(K.LOWER)
    same = np.flatnonzero((h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])) + 1
    return np.concatenate([bucket, np.full(len(same), REPEAT)]), np.concatenate([rows, w.row[same]])


def ngram_pieces(raw: np.ndarray, offs: np.ndarray, piece: int = K.CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``ngrams`` of a chunk; a text longer than a piece comes in pieces that overlap by what an n-gram spans."""
    if len(offs) != 2 or len(raw) <= piece:
        yield ngrams(raw, offs)
        return
    for at in range(0, len(raw) - ORDER + 1, piece):
        part = raw[at : at + piece + ORDER - 1]
        yield ngrams(part, np.array([0, len(part)]), repeats=False)
    h = K.Words(raw, offs).hashes(K.LOWER)
    again = int((h[1:] == h[:-1]).sum())
    yield np.full(again, REPEAT), np.zeros(again, np.int64)


def _counter(good: frozenset):
    def run(batches):
        total, target = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            flags = np.array([x in good for x in batch.column(0).to_pylist()], bool)
            for i, j, raw, offs in K.chunks(batch.column(1)):
                for bucket, rows in ngram_pieces(raw, offs):
                    total += np.bincount(bucket, minlength=BUCKETS + 1)
                    target += np.bincount(bucket[flags[i:j][rows]], minlength=BUCKETS + 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    return run


def log_ratio(docs: DataFrame, good: DataFrame, target_rows: int = 20_000) -> np.ndarray:
    """``log p_target - log p_raw`` of each bucket.

    The raw model counts every document.  The target model is fitted on a
    bounded sample, at most ``target_rows`` labelled ids (least hash first);
    that bound is also the bound of what the tasks receive.  At most
    ``BUCKETS + 1`` sums reach the driver.
    """
    ids = good.select(F.col("doc_id").cast("long").alias("id")).distinct().orderBy(F.xxhash64(F.lit("target"), "id"), "id").limit(target_rows).collect()
    run = _counter(frozenset(r["id"] for r in ids))
    sums = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "bucket int, raw long, target long")
    raw, target = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for r in sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    p = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    # The raw model is the prior of the target's, so an n-gram rare in both is no evidence.
    q = target + PRIOR * len(p) * p
    return np.log(q / q.sum()) - np.log(p)


def _sortable(x: np.ndarray) -> np.ndarray:
    """Doubles to signed integers of the same order."""
    b = x.astype(np.float64).view(np.int64)
    return np.where(b < 0, b ^ np.int64((1 << 63) - 1), b)


def scored(docs: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    """(document, ngrams, weight, key): ``docs`` as a struct, log importance, and its order with the Gumbel draw."""

    def run(batches):
        for batch in batches:
            weight, count = [], []
            for i, j, raw, offs in K.chunks(batch.column(0).field("text")):
                w, c = np.zeros(j - i), np.zeros(j - i, np.int64)
                for bucket, rows in ngram_pieces(raw, offs):
                    w += np.bincount(rows, weights=ratio[bucket], minlength=j - i)
                    c += np.bincount(rows, minlength=j - i)
                weight.append(w)
                count.append(c)
            weight = np.concatenate(weight) if weight else np.zeros(0)
            count = np.concatenate(count) if count else np.zeros(0, np.int64)
            draw = np.array(batch.column(1)).astype(np.int64).view(np.uint64)
            u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
            score = np.where(count > 0, weight - np.log(-np.log(u)), -np.inf)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count.astype(np.int64)), pa.array(weight.astype(np.float64)), pa.array(_sortable(score))], names=["document", "ngrams", "weight", "key"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw"))
    schema = T.StructType([T.StructField("document", docs.schema), T.StructField("ngrams", T.LongType()), T.StructField("weight", T.DoubleType()), T.StructField("key", T.LongType())])
    return rows.mapInArrow(run, schema)


def kth_largest(df: DataFrame, key: str, k: int) -> int:
    """The k-th largest value of a long column by four rounds of 65,536-bucket counts (no sort, no collected rows)."""
    if k <= 0:
        return (1 << 63) - 1
    shifted = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order in the bits
    prefix, left = 0, k
    for level in range(4):
        shift = 48 - 16 * level
        rows = df if level == 0 else df.where(F.shiftrightunsigned(shifted, shift + 16) == F.lit(prefix))
        counts = dict(rows.groupBy(F.shiftrightunsigned(shifted, shift).bitwiseAND(0xFFFF).alias("b")).count().collect())
        for b in sorted(counts, reverse=True):
            if counts[b] >= left:
                break
            left -= counts[b]
        else:
            return -(1 << 63)
        prefix = (prefix << 16) | b
    return prefix - (1 << 63)


def fit(docs: DataFrame, labels: DataFrame, keep_share: float | None, seed: int) -> tuple[np.ndarray, DataFrame, int]:
    """The model, the scores of all documents as a written table, and the least kept score."""
    session(docs.sparkSession)
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id")
    if keep_share is None:
        known = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        keep_share = 1.0 if known is None else float(known)
    ratio = log_ratio(docs, good)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    table = staged(scored(slim, ratio, seed).select("document.doc_id", "ngrams", "weight", "key"), "op4-scores")
    return ratio, table, kth_largest(table, "key", int(np.ceil(keep_share * table.count())))


def importance_scores(docs: DataFrame, labels: DataFrame, *, keep_share: float | None = None, seed: int = 4) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, kept) of every document."""
    _, table, least = fit(docs, labels, keep_share, seed)
    return table.select("doc_id", F.col("ngrams").alias("n_ngrams"), F.col("weight").alias("log_weight"), ((F.col("key") >= least) & (F.col("ngrams") > 0)).alias("kept"))


def importance_select(docs: DataFrame, labels: DataFrame, *, keep_share: float | None = None, seed: int = 4) -> DataFrame:
    """The kept documents, with their own columns; scores are computed again rather than joined, so no text is shuffled."""
    ratio, _, least = fit(docs, labels, keep_share, seed)
    typed = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    return scored(typed, ratio, seed).where((F.col("key") >= least) & (F.col("ngrams") > 0)).select("document.*")
