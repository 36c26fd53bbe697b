"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of more than ``CHUNK`` bytes is cut at fixed places into chunks, each
with the first ``OVERLAP`` bytes of the next.  The chunks are rows: they are
dealt to tasks, and each is pre-tokenised there on its own.  Two neighbours
are stitched at the first boundary in the overlap that both scans have and
that holds in any scan: a letter or digit followed by a character that is none
and no mark or apostrophe, which no pre-token spans.  The pieces between
stitches are encoded in parallel again, their ids are put in order and
concatenated.  Chunks whose overlap has no such boundary go on in one piece.
Shorter texts are one chunk and are encoded where they are.

Decoding concatenates the raw bytes of ids.

The pattern must be one of the usual kind, whose matches do not reach over a
letter or digit followed by white space, punctuation or a symbol other than an
apostrophe; ``public_tokenizers.PATTERN`` is.

Defined results: a null text counts as empty and gives no ids; the decoded
bytes always equal the text's UTF-8 bytes; equal texts get equal ids, and
repeated rows are rows of their own; text that looks like a special token is
ordinary text; a very long text is the work of many tasks, but a pre-token
without end is one piece, and a row of ``token_ids`` holds all ids of its text;
an empty table gives an empty result.  Columns other than doc_id and text are
ignored, so clashing names do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm import kernels as K
from tidegrid.llm.runtime import session, staged

CHUNK = 32_768
OVERLAP = 512
#: Texts of one output batch of ids, and chunks of one batch of chunk rows.
OUTPUT_ROWS, CHUNK_ROWS = 100, 128
_APOSTROPHES = "'’"


@lru_cache(4)
def encoder(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def _pattern(pattern: str):
    return regex.compile(pattern)


def ids_of(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    return enc.encode_to_numpy(text, disallowed_special=())


def decode_bytes(ids: Iterable[int], enc: tiktoken.Encoding) -> bytes:
    """The raw bytes of ids, one after another; ids that are no token raise ``KeyError``."""
    return enc.decode_bytes(ids if isinstance(ids, list) else list(ids))


# --- chunks and stitches ----------------------------------------------------


def chunk_bytes(raw: np.ndarray, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, end with overlap) of each chunk of a text's bytes, at starts of characters."""

    def whole(at: int) -> int:
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(raw))

    starts = sorted({whole(at) for at in range(0, len(raw), chunk)} - {len(raw)}) or [0]
    ends = [*starts[1:], len(raw)]
    return [(a, b, whole(min(len(raw), b + overlap))) for a, b in zip(starts, ends, strict=True)]


def holds_anywhere(text: str, at: int) -> bool:
    """Whether every scan has a boundary before ``text[at]``."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at] not in _APOSTROPHES and unicodedata.category(text[at])[0] in "PSZC" and unicodedata.category(text[at]) != "Cn"


def boundaries(head: str, tail: str, pattern: str, overlap: int = OVERLAP) -> tuple[list[int], list[int]]:
    """The chunk ``head`` + ``tail`` pre-tokenised: its sure boundaries in the tail, and those in its own first ``overlap`` bytes."""
    text, n = head + tail, len(head)
    first, last = [], []
    for m in _pattern(pattern).finditer(text):
        p = m.end()
        if p <= overlap and holds_anywhere(text, p):
            first.append(p)
        if p > n and holds_anywhere(text, p):
            last.append(p - n)
    return last, first


def stitch(text: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Places where the text can be cut into pieces that encode on their own, first 0 and last the length."""
    raw = text.encode()
    spans = chunk_bytes(np.frombuffer(raw, np.uint8), chunk, overlap)
    parts = [(raw[a:b].decode(), raw[b:c].decode()) for a, b, c in spans]
    found = [boundaries(h, t, pattern, overlap) for h, t in parts]
    cuts, at = [0], 0
    for k in range(1, len(parts)):
        at += len(parts[k - 1][0])
        both = set(found[k - 1][0]) & set(found[k][1])
        if both:
            cuts.append(at + min(both))
    return [*cuts, len(text)]


def _chunk_rows(chunk: int, overlap: int):
    """(row, doc_id, text) to (row, doc_id, k, head, tail)."""

    def run(batches):
        for batch in batches:
            raw, offs = K.buffers(batch.column(2))
            for r in range(batch.num_rows):
                own = raw[offs[r] : offs[r + 1]]
                spans = chunk_bytes(own, chunk, overlap)
                for i in range(0, len(spans), CHUNK_ROWS):
                    part = spans[i : i + CHUNK_ROWS]
                    one = lambda c, n=len(part), r=r: batch.column(c).take(pa.array(np.full(n, r)))
                    text = lambda x, y, part=part, own=own: pa.array([own[s[x] : s[y]].tobytes().decode() for s in part], pa.string())
                    yield pa.RecordBatch.from_arrays([one(0), one(1), pa.array(np.arange(i, i + len(part), dtype=np.int32)), text(0, 1), text(1, 2)], names=["row", "doc_id", "k", "head", "tail"])

    return run


def _scan(pattern: str, overlap: int):
    def run(batches):
        for batch in batches:
            last, first = [], []
            for head, tail in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = boundaries(head, tail, pattern, overlap)
                last.append(a)
                first.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(last, pa.list_(pa.int32())), pa.array(first, pa.list_(pa.int32()))], names=["row", "k", "last", "first"])

    return run


PIECES = "row long, doc_id long, piece int, n long, ids binary"


def _encode_pieces(rank_file: str, pattern: str):
    """Segments (row, doc_id, piece, text), in order, to the ids of each piece as four-byte numbers."""

    def run(batches):
        enc = encoder(rank_file, pattern)
        key, held = None, []

        def piece():
            ids = ids_of("".join(held), enc)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([ids.astype("<u4").tobytes()], pa.binary())],
                names=["row", "doc_id", "piece", "n", "ids"],
            )

        for batch in batches:
            for row, doc, at, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if key is not None and (row, at) != (key[0], key[2]):
                    yield piece()
                    held = []
                key = (row, doc, at)
                held.append(text)
        if key is not None:
            yield piece()

    return run


def encoded_pieces(docs: DataFrame, rank_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, doc_id, piece, n, ids) of the pieces of every text of more than one chunk, ids as four-byte numbers."""
    numbered = docs.where(F.octet_length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = numbered.mapInArrow(_chunk_rows(chunk, overlap), "row long, doc_id long, k int, head string, tail string")
    # Chunks are dealt to tasks here, and their rows are fixed once written.
    chunks = staged(chunks.repartition("row", "k"), "op6-chunks")
    found = staged(chunks.select("row", "k", "head", "tail").mapInArrow(_scan(pattern, overlap), "row long, k int, last array<int>, first array<int>"), "op6-found")
    own = found.select("row", "k", "first")
    before = found.select("row", (F.col("k") + 1).alias("k"), F.col("last").alias("left"))
    cut = F.array_min(F.array_intersect("left", "first"))
    # One narrow row a chunk: a text's chunks are ordered in one task, not its bytes.
    order = Window.partitionBy("row").orderBy("k")
    cuts = own.join(before, ["row", "k"], "left").select("row", "k", cut.alias("cut")).withColumns({
        "next": F.lead("cut").over(order), "piece": F.last(F.when(F.col("cut").isNotNull() | (F.col("k") == 0), F.col("k")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    begin, size = F.coalesce("cut", F.lit(0)), F.length("head")
    text = F.concat("head", "tail").substr(begin + 1, size + F.coalesce("next", F.lit(0)) - begin)
    segments = chunks.join(cuts, ["row", "k"]).select("row", "doc_id", "piece", "k", text.alias("text"))
    return segments.repartition("row", "piece").sortWithinPartitions("row", "piece", "k").select("row", "doc_id", "piece", "text").mapInArrow(_encode_pieces(rank_file, pattern), PIECES)


def _typed(docs: DataFrame) -> DataFrame:
    session(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _short(docs: DataFrame, chunk: int) -> DataFrame:
    return docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= chunk)


def _in_order(pieces: DataFrame) -> DataFrame:
    """Each long text's pieces after one another, read as a stream."""
    return pieces.repartition("row").sortWithinPartitions("row", "piece").select("row", "doc_id", "ids")


def _streamed(batches) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
    """Per long text its doc_id and its pieces' ids; each text's pieces must be used up before the next."""
    rows = ((r, d, np.frombuffer(x, "<u4")) for b in batches for r, d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
    now = next(rows, None)
    while now is not None:
        row, doc = now[:2]

        def own():
            nonlocal now
            while now is not None and now[0] == row:  # noqa: B023
                yield now[2]
                now = next(rows, None)

        yield doc, own()


# --- operators ----------------------------------------------------------------


def decode_ids(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``tokens`` (doc_id, ids) to (doc_id, bytes); null ids give no bytes, and bytes need not be UTF-8."""

    def run(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(i, OUTPUT_ROWS)
                # One row's ids at a time become Python integers.
                raw = [decode_bytes(ids.as_py() or [], enc) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    session(tokens.sparkSession)
    return tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, bytes binary")


def _lists(docs: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    bounds = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
    flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(bounds, flat)], names=["doc_id", "ids"])


def encoded(docs: DataFrame, rank_file: str, pattern: str, emit, schema: str, *, checked: bool = True, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """What ``emit`` makes of each task's stream of (doc_ids, ids of each), as rows of ``schema``; where ``checked``, ids that do not decode to their text's bytes fail the job."""

    def short(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, OUTPUT_ROWS):
                part = batch.slice(i, OUTPUT_ROWS)
                ids = []
                for text in part.column(1).to_pylist():
                    ids.append(ids_of(text or "", enc))
                    if checked and decode_bytes(ids[-1].tolist(), enc) != (text or "").encode():
                        raise ValueError("ids do not decode to their text")
                yield part.column(0).to_pylist(), ids

    def long(batches):
        enc = encoder(rank_file, pattern)
        for doc, pieces in _streamed(batches):
            ids = list(pieces)
            if checked:
                for x in ids:
                    if not np.array_equal(ids_of(decode_bytes(x.tolist(), enc).decode(), enc), x):
                        raise ValueError("ids do not decode to their text")
            yield [doc], [np.concatenate(ids)]

    typed = _typed(docs)
    whole = _in_order(encoded_pieces(typed, rank_file, pattern, chunk, overlap)).mapInArrow(lambda batches: emit(long(batches)), schema)
    return _short(typed, chunk).mapInArrow(lambda batches: emit(short(batches)), schema).unionByName(whole)


def token_ids(docs: DataFrame, rank_file: str, pattern: str, *, checked: bool = True, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, ids array<int>); see ``encoded``."""

    def emit(groups):
        for rows, ids in groups:
            yield _lists(rows, ids)

    return encoded(docs, rank_file, pattern, emit, "doc_id long, ids array<int>", checked=checked, chunk=chunk, overlap=overlap)


def encode_digest(docs: DataFrame, rank_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); ids and bytes are hashed piece by piece, so a text's ids are never held whole."""

    def digest(pieces: Iterable[np.ndarray], enc: tiktoken.Encoding) -> tuple[int, str, str]:
        n, a, b = 0, hashlib.sha256(), hashlib.sha256()
        for ids in pieces:
            listed = ids.tolist()
            if listed:
                a.update(((" " if n else "") + " ".join(map(str, listed))).encode())
                b.update(decode_bytes(listed, enc))
                n += len(listed)
        return n, a.hexdigest(), b.hexdigest()

    def batch_of(docs: list, rows: list) -> pa.RecordBatch:
        n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def short(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            yield batch_of(batch.column(0).to_pylist(), [digest([ids_of(text or "", enc)], enc) for text in batch.column(1).to_pylist()])

    def long(batches):
        enc = encoder(rank_file, pattern)
        for doc, pieces in _streamed(batches):
            yield batch_of([doc], [digest(pieces, enc)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    typed = _typed(docs)
    whole = _in_order(encoded_pieces(typed, rank_file, pattern, chunk, overlap)).mapInArrow(long, schema)
    return _short(typed, chunk).mapInArrow(short, schema).unionByName(whole)
