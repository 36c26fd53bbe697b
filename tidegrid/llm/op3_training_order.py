"""Training-order materialisation of token sequences.

Texts become BPE token ids, cut into sequences of ``length`` ids.  The N
sequences are numbered gaplessly; a keyed Feistel network over the least
even-bit domain that holds N, with cycle-walking, permutes the numbers to
global slots.  Slots are range-partitioned: each task takes a run of shards
and writes them as fixed-stride records, so slot s is record ``s % per_shard``
of shard ``s // per_shard``, and a reader can seek to any slot and resume.

The ids are written once with each row's place among the sequences of its
part, so the numbers stay the same whatever is read again.  The ranges are a
written table too, one file a range; the ids and the shuffle go before the
shards are written from them, so at most three copies of the ids stand at a
time.  The shards are
written when ``training_order`` is called, not when its result is read.  A
shard is written under a temporary name by one task and renamed; an attempt
that finds the shard there leaves it, since all attempts write the same bytes.
The manifest comes last: a folder without one is incomplete.

A record is the id count (two bytes) and the ids (two bytes each, four where
the vocabulary is larger than 65,536), little-endian, padded with zeros.

Defined results: null and empty texts give no sequence; a very long text gives
all of its sequences; repeated rows give sequences of their own; no two
sequences tie for a slot; an empty table gives a manifest and no shard.
Columns other than doc_id and text are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.llm import kernels as K
from tidegrid.llm import op6_bpe
from tidegrid.llm.runtime import BATCH_ROWS, passing, session, staged

LENGTH = 512
PER_SHARD = 16_384
ROUNDS = 6
#: Sequences of one batch of records.
BATCH = 2048
MANIFEST = "manifest.json"


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of range(n) at the given indices, by cycle-walking."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
            left, right = right, left ^ (K.mix(right + salt) & mask)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    walk = np.flatnonzero(out >= np.uint64(n))
    while len(walk):
        out[walk] = once(out[walk])
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def numbered(docs: DataFrame, rank_file: str, pattern: str, length: int, kind: str) -> DataFrame:
    """The ids of ``docs`` as a written table (part, at, sequences, doc_id, ids): ``at`` is the row's first sequence in its part."""

    def emit(groups):
        part, at = TaskContext.get().partitionId(), 0
        for docs, ids in groups:
            sizes = np.array([len(x) for x in ids], np.int64)
            own = -(-sizes // length)
            first = at + np.cumsum(own) - own
            at += int(own.sum())
            body = pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), part, np.int32)), pa.array(first), pa.array(own), pa.array(docs, pa.int64()), body], names=["part", "at", "sequences", "doc_id", "ids"])

    table = op6_bpe.encoded(docs, rank_file, pattern, emit, "part int, at long, sequences long, doc_id long, ids binary", checked=False)
    return staged(table.where("sequences > 0"), "op3-ids")


def ranged(docs: DataFrame, rank_file: str, pattern: str, key: int, length: int, per_shard: int, kind: str) -> tuple[DataFrame, int]:
    """The sequences by slot as a written table of one file a range of whole shards, and their number."""
    spark = docs.sparkSession
    with passing(spark):
        rows = numbered(docs, rank_file, pattern, length, kind)
    # One narrow row a part; parts are the input's partitions, in the order of their numbers.
    totals = rows.groupBy("part").agg(F.sum("sequences").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = staged(totals.select("part", before.alias("offset"), "total"), "op3-parts")
    n = parts.agg(F.sum("total")).first()[0] or 0
    width = np.dtype(kind).itemsize

    def cut(batches):
        for batch in batches:
            raw, offs = K.buffers(batch.column(3))
            first, own = np.array(batch.column(0)), np.array(batch.column(1))
            row = np.repeat(np.arange(batch.num_rows), own)
            seq = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(own)[:-1]]), own) if len(row) else np.zeros(0, np.int64)
            start = offs[:-1][row] + seq * (length * width)
            stop = np.minimum(start + length * width, offs[1:][row])
            slot = feistel(first[row] + seq, n, key) if len(row) else np.zeros(0, np.int64)
            for i in range(0, len(row), BATCH):
                one = slice(i, i + BATCH)
                body = pa.array([raw[a:b].tobytes() for a, b in zip(start[one].tolist(), stop[one].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(slot[one]), batch.column(2).take(pa.array(row[one])), pa.array(seq[one].astype(np.int32)), body], names=["slot", "doc_id", "seq", "tokens"])

    shards = -(-n // per_shard)
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = rows.join(F.broadcast(parts), "part") if parts.count() <= 1_000_000 else rows.join(parts, "part")
    placed = placed.select((F.col("offset") + F.col("at")).alias("first"), "sequences", "doc_id", "ids")
    sequences = placed.mapInArrow(cut, "slot long, doc_id long, seq int, tokens binary")
    # Ranges of whole shards: task t takes the shards from t * shards / tasks on.
    shard = F.call_function("div", F.col("slot"), F.lit(per_shard))
    ranges = sequences.repartitionById(tasks, F.call_function("div", shard * tasks, F.lit(max(shards, 1))).cast("int")).sortWithinPartitions("slot")
    return staged(ranges, "op3-ranges"), n


def training_order(
    docs: DataFrame, out: str, rank_file: str, pattern: str, *, key: int = 3, length: int = LENGTH, per_shard: int = PER_SHARD
) -> DataFrame:
    """Write the shards and the manifest under the URI ``out``; one row per sequence: where it is and what it holds."""
    spark = session(docs.sparkSession)
    kind = "<u2" if op6_bpe.encoder(rank_file, pattern).n_vocab <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize
    with passing(spark):
        ranges, n = ranged(docs, rank_file, pattern, key, length, per_shard, kind)

    files = sorted(_uri(name) for name in ranges.inputFiles())

    def write(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield from _write_shards(_rows_of(files[k]), out, length, per_shard, width)

    # One task a range, which reads its file from end to end: a scan would cut large files and put small ones together.
    tasks = spark.range(0, len(files), 1, max(1, len(files)))
    index = staged(tasks.mapInArrow(write, "slot long, shard int, byte_offset long, doc_id long, seq int, n_tokens int, record_crc32 long"), "op3-index")
    shards = -(-n // per_shard)
    # A shard that is not whole must not be named by a manifest.
    full = F.when(F.col("shard") == shards - 1, n - (shards - 1) * per_shard).otherwise(per_shard)
    sums = index.groupBy("shard").agg(F.count("*").alias("rows"), F.max("byte_offset").alias("last"))
    if sums.where((F.col("rows") != full) | (F.col("last") != (full - 1) * (2 + length * width))).limit(1).count() or index.count() != n:
        raise ValueError("shards are not whole")
    _write_text(spark, posixpath.join(out, MANIFEST), json.dumps({"sequences": n, "length": length, "per_shard": per_shard, "shards": shards, "key": key, "id_bytes": width}))
    return index


def _uri(name: str) -> str:
    return "file://" + name.removeprefix("file:") if name.startswith("file:/") and not name.startswith("file://") else name


def _rows_of(uri: str) -> Iterator[pa.RecordBatch]:
    """A Parquet file's rows in order."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        yield from pq.ParquetFile(f).iter_batches(BATCH_ROWS)


def _write_text(spark: SparkSession, uri: str, text: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _place(fs: pafs.FileSystem, temporary: str, name: str) -> None:
    """Rename a finished shard; where another attempt has placed it already, that one stays."""
    if fs.get_file_info(name).type == pafs.FileType.NotFound:
        try:
            fs.move(temporary, name)
            return
        except OSError:
            if fs.get_file_info(name).type == pafs.FileType.NotFound:
                raise
    fs.delete_file(temporary)


def _write_shards(batches: Iterator[pa.RecordBatch], out: str, length: int, per_shard: int, width: int) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(out)
    fs.create_dir(root, recursive=True)
    stride = 2 + length * width
    current, stream, temporary = None, None, ""

    def close():
        if stream is not None:
            stream.close()
            _place(fs, temporary, posixpath.join(root, f"shard-{current:08d}.bin"))

    try:
        for batch in batches:
            raw, offs = K.buffers(batch.column(3))
            slot, sizes = np.array(batch.column(0)), np.diff(offs)
            records = np.zeros((len(sizes), stride), np.uint8)
            records[:, :2] = (sizes // width).astype("<u2").view(np.uint8).reshape(-1, 2)
            records[:, 2:][np.arange(stride - 2) < sizes[:, None]] = raw
            shard = slot // per_shard
            for one in np.unique(shard):
                if one != current:
                    close()
                    current, temporary = int(one), posixpath.join(root, f".{uuid.uuid4().hex}.part")
                    stream = fs.open_output_stream(temporary)
                stream.write(records[shard == one].tobytes())
            crc = [zlib.crc32(r) for r in records]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shard.astype(np.int32)), pa.array(slot % per_shard * stride), batch.column(1), batch.column(2), pa.array((sizes // width).astype(np.int32)), pa.array(crc, pa.int64())],
                names=["slot", "shard", "byte_offset", "doc_id", "seq", "n_tokens", "record_crc32"],
            )
        close()
        stream = None
    finally:
        if stream is not None and not stream.closed:  # a stopped attempt leaves no part behind
            stream.close()
            fs.delete_file(temporary)


def manifest(out: str) -> dict:
    """What a complete folder holds; an incomplete one has no manifest and raises ``FileNotFoundError``."""
    fs, root = pafs.FileSystem.from_uri(out)
    with fs.open_input_file(posixpath.join(root, MANIFEST)) as f:
        return json.loads(f.read())


def read_slots(out: str, start: int, stop: int) -> Iterator[np.ndarray]:
    """Token ids of slots ``[start, stop)`` in order; begin anywhere to resume."""
    about = manifest(out)
    length, per_shard, width = about["length"], about["per_shard"], about["id_bytes"]
    fs, root = pafs.FileSystem.from_uri(out)
    stride, slot, stop = 2 + length * width, start, min(stop, about["sequences"])
    while slot < stop:
        with fs.open_input_file(posixpath.join(root, f"shard-{slot // per_shard:08d}.bin")) as f:
            f.seek(slot % per_shard * stride)
            for _ in range(min(stop, (slot // per_shard + 1) * per_shard) - slot):
                record = f.read(stride)
                count = int.from_bytes(record[:2], "little")
                yield np.frombuffer(record, f"<u{width}", count, 2)
                slot += 1
