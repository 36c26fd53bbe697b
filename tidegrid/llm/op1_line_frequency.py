"""Quality rules by cross-document line frequency.

Lines are normalised (A-Z lower-cased, digits folded to 0, runs of separators
collapsed, ends trimmed) and hashed.  For each host the distinct documents of
each line hash are counted; lines found in more than ``limit`` documents of
their host are removed, and a document whose words remain to less than
``least_kept`` is depleted and rejected.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; a null host is a host of its own; repeated rows are documents of
their own; a line found in exactly ``limit`` documents stays; an empty table
gives an empty result.  A very long text is counted whole: its bytes are
hashed in blocks, so a task holds about 16 bytes a byte of it.  Columns of the
input other than the three named ones are ignored, so clashing names do no
harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import kernels as K
from tidegrid.llm.runtime import session, staged

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: A line in more than one of this many of all lines is hot; there are fewer hot lines than that, so their table may be broadcast.
HOT_LINES = 10_000

STATS = (
    "row long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " line_hash array<long>, line_words array<int>"
)


def base_statistics(column: pa.Array) -> list[pa.Array]:
    """The five base counts and the distinct normalised lines (hash, words) of each text."""
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    hashes, words_of, lengths = [], [], []
    for _, _, raw, offs in K.chunks(column):
        w = K.Words(raw, offs)
        n = len(offs) - 1
        parts[0].append(w.count)
        parts[1].append(K.row_sums(w.inside & ((raw & 0xC0) != 0x80), offs))
        parts[2].append(K.row_sums(symbol[raw], offs))

        # Lines that hold a word: the line of a word is the number of \n before it, texts apart.
        newline = np.flatnonzero(raw == 10)
        line = np.searchsorted(newline, w.start) + w.row
        head = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
        row = w.row[head]
        at = line[head] - row  # line breaks before the line
        start = np.maximum(np.where(at > 0, newline[np.maximum(at - 1, 0)] + 1 if len(newline) else 0, 0), offs[row])
        stop = np.where(at < len(newline), newline[np.minimum(at, len(newline) - 1)] if len(newline) else len(raw), len(raw))
        stop = np.minimum(stop, offs[row + 1])
        exact = K.span_hashes(raw, start, stop)
        parts[3].append(np.bincount(row[~K.first_in_rows(row, exact)], minlength=n))

        h = w.hashes()
        at3, rows3, _ = K.windows_in_rows(w.before, 3)
        grams = K.sequence_hashes(h, 3)
        often = at3[K.counts_in_rows(rows3, grams[at3] if len(at3) else at3.astype(np.uint64)) >= 2]
        marked = np.zeros(len(h), bool)
        for k in range(3):
            marked[often + k] = True
        parts[4].append(K.row_sums(marked, w.before))

        # Normalised lines: a position-weighted sum of word hashes in each line.
        folded = w.hashes(K.FOLDED)
        size = np.diff(np.concatenate([head, [len(line)]]))
        place = np.arange(len(line)) - np.repeat(head, size)
        sums = K.mix(folded + place.astype(np.uint64) * K.U64(0xA0761D6478BD642F))
        normal = K.mix(np.add.reduceat(sums, head)) if len(head) else np.zeros(0, np.uint64)
        first = K.first_in_rows(row, normal)
        # Words of all occurrences of a line count with its first one.
        own = K.mix(normal + row.astype(np.uint64) * K.U64(0x9FB21C651E98DF25))
        _, back = np.unique(own, return_inverse=True)
        total = np.bincount(back, weights=size).astype(np.int64) if len(back) else np.zeros(0, np.int64)
        hashes.append(normal[first].view(np.int64))
        words_of.append(total[back][first] if len(back) else total)
        lengths.append(np.bincount(row[first], minlength=n))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    bounds = pa.array(np.concatenate([[0], np.cumsum(cat(lengths))]).astype(np.int32))
    out = [pa.array(cat(p).astype(np.int64)) for p in parts]
    return out + [
        pa.ListArray.from_arrays(bounds, pa.array(cat(hashes).astype(np.int64))),
        pa.ListArray.from_arrays(bounds, pa.array(cat(words_of).astype(np.int32))),
    ]


def _stats(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *base_statistics(batch.column(3))],
            names=["row", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_hash", "line_words"],
        )


def line_quality(
    docs: DataFrame, *, host: str = "source", limit: int = 20, least_kept: float = 1 / 3, min_words: int = 50
) -> DataFrame:
    """One row per document: base counts, removed words, ``base_failed`` and ``kept``."""
    spark = session(docs.sparkSession)
    # Rows are numbered before they are written, so a row has one number however often the table is read.
    cols = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text")
    )
    stats = staged(cols.mapInArrow(_stats, STATS), "op1-stats")
    lines = stats.select(
        "row", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("line")
    ).select("row", "host", F.col("line.line_hash").alias("hash"), F.col("line.line_words").alias("words"))
    frequent = staged(
        lines.groupBy("host", "hash").agg(F.count("*").alias("documents")).where(F.col("documents") > limit).select(F.col("host").alias("f_host"), F.col("hash").alias("f_hash"), "documents"),
        "op1-frequent",
    )
    # Hot lines meet their documents by broadcast; all others have few rows a key and meet them by shuffle.
    hot = F.col("documents") * HOT_LINES > F.lit(frequent.agg(F.sum("documents")).first()[0] or 0)
    same = F.col("host").eqNullSafe(F.col("f_host")) & (F.col("hash") == F.col("f_hash"))
    rest = lines.join(F.broadcast(frequent.where(hot).withColumnsRenamed({"f_host": "h_host", "f_hash": "h_hash", "documents": "often"})), F.col("host").eqNullSafe(F.col("h_host")) & (F.col("hash") == F.col("h_hash")), "left")
    removed = (
        rest.where("often is not null").select("row", "words").union(rest.where("often is null").join(frequent.where(~hot), same).select("row", "words"))
        .groupBy("row").agg(F.sum("words").alias("removed"), F.count("*").alias("removed_lines"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    removed_words = F.coalesce("removed", F.lit(0))
    return stats.drop("line_hash", "line_words").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("n_words") - removed_words >= least_kept * F.col("n_words"))).alias("kept"),
        removed_words.alias("removed_words"),
        F.coalesce("removed_lines", F.lit(0)).alias("removed_lines"),
    )
