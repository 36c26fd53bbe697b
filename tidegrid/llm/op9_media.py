"""Media columns: Netpbm and BMP to numpy arrays, area-resized tiles and difference hashes.

``decode`` reads Netpbm P1-P6 (8- and 16-bit) and uncompressed BMP of 1, 4, 8,
24 and 32 bits.  ``area_resize`` averages source areas exactly through an
integral image (summed-area table), with fractional borders.  ``dhash``
compares neighbours of a 9 x 8 resize.  Tiles are written as NPY.

For text columns, ``text_media`` stores the padded UTF-8 bytes losslessly as
an 8-bit PGM of 64 samples a row in a written table, reads that table back,
computes its features from what was read, and writes the tiles.

Defined results: a null text counts as empty; an empty text is stored as one
row of zeros; a very long text is one image, of which a task holds a few
copies and no table of sums; equal texts, and so repeated rows, give equal
values; neighbours that tie give bit 0; an empty table gives an empty result;
columns other than the named ones are ignored, so clashing names do no harm.
A damaged image raises ``ValueError`` in ``decode`` and gives null features in
``media_features``.
"""

from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.runtime import session, staged

WIDTH = 64


# --- containers -----------------------------------------------------------


def _netpbm_header(data: bytes, fields: int) -> tuple[list[int], int]:
    values, at, n = [], 2, len(data)
    while len(values) < fields:
        while at < n and data[at : at + 1].isspace():
            at += 1
        if at < n and data[at] == 35:  # a comment runs to the line's end
            while at < n and data[at] != 10:
                at += 1
            continue
        begin = at
        while at < n and 48 <= data[at] <= 57:
            at += 1
        if begin == at:
            raise ValueError("bad Netpbm header")
        values.append(int(data[begin:at]))
    return values, at


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 48
    values, at = _netpbm_header(data, 2 if kind in (1, 4) else 3)
    w, h = values[:2]
    if not w or not h:
        raise ValueError("empty Netpbm image")
    depth = 3 if kind in (3, 6) else 1
    peak = 1 if kind in (1, 4) else values[2]
    if not 0 < peak < 65536:
        raise ValueError("bad Netpbm maximum")
    if kind == 1:
        bits = [c - 48 for c in b"".join(line.split(b"#")[0] for line in data[at:].split(b"\n")) if c in b"01"]
        out = 1 - np.array(bits[: w * h], np.uint16)
    elif kind in (2, 3):
        out = np.array(b"\n".join(line.split(b"#")[0] for line in data[at:].split(b"\n")).split()[: w * h * depth], np.uint16)
    elif kind == 4:
        row = -(-w // 8)
        packed = np.frombuffer(data, np.uint8, row * h, at + 1).reshape(h, row)
        out = 1 - np.unpackbits(packed, axis=1)[:, :w].reshape(-1).astype(np.uint16)
    else:
        out = np.frombuffer(data, ">u2" if peak > 255 else np.uint8, w * h * depth, at + 1)
    if len(out) != w * h * depth:
        raise ValueError("short Netpbm image")
    if peak not in (255, 65535):
        out = (out.astype(np.uint32) * 255 + peak // 2) // peak
    out = out.astype(np.uint16 if peak == 65535 else np.uint8).reshape(h, w, depth)
    return out[:, :, 0] if depth == 1 else out


def _decode_bmp(data: bytes) -> np.ndarray:
    u4 = lambda at: int.from_bytes(data[at : at + 4], "little")
    offset, header = u4(10), u4(14)
    w, h = int.from_bytes(data[18:22], "little", signed=True), int.from_bytes(data[22:26], "little", signed=True)
    bits, packing, used = int.from_bytes(data[28:30], "little"), u4(30), u4(46)
    if header < 40 or packing not in (0, 3) or w <= 0 or h == 0 or bits not in (1, 4, 8, 24, 32):
        raise ValueError("unsupported BMP")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)
    if h > 0:
        rows = rows[::-1]
    if bits >= 24:
        return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1].copy()
    size = used or 1 << bits
    palette = np.frombuffer(data, np.uint8, size * 4, 14 + header).reshape(size, 4)[:, 2::-1]
    if bits == 8:
        index = rows[:, :w]
    elif bits == 4:
        index = np.stack([rows >> 4, rows & 15], 2).reshape(abs(h), -1)[:, :w]
    else:
        index = np.unpackbits(rows, axis=1)[:, :w]
    out = palette[np.minimum(index, size - 1)]
    return out[:, :, 0].copy() if (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all() else out


def decode(data: bytes) -> np.ndarray:
    """A Netpbm or BMP file as an array, height x width or height x width x 3."""
    try:
        if len(data) > 2 and data[:1] == b"P" and 49 <= data[1] <= 54:
            return _decode_netpbm(data)
        if data[:2] == b"BM":
            return _decode_bmp(data)
    except (IndexError, OverflowError) as e:
        raise ValueError("damaged image") from e
    raise ValueError("neither Netpbm nor BMP")


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """An 8-bit grey BMP, rows bottom-up and padded to four bytes."""
    h, w = samples.shape
    stride = -(-w // 4) * 4
    body = np.zeros((h, stride), np.uint8)
    body[:, :w] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, 1)
    palette[:, 3] = 0
    le = lambda n, x: int(x).to_bytes(n, "little")
    head = b"BM" + le(4, 1078 + body.size) + le(4, 0) + le(4, 1078) + le(4, 40) + le(4, w) + le(4, h) + le(2, 1) + le(2, 8) + le(4, 0) + le(4, body.size) + le(8, 0) + le(4, 256) + le(4, 0)
    return head + palette.tobytes() + body.tobytes()


# --- features -------------------------------------------------------------


def _integral_rows(image: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The integral image's rows at fractional places, each the sum of all rows above: band by band, so no table of the whole image is held."""
    low = np.minimum(places.astype(np.int64), len(image))
    total, out, at = np.zeros(image.shape[1:], np.int64), np.empty((len(places), *image.shape[1:])), 0
    for k, (row, part) in enumerate(zip(low.tolist(), (places - low).tolist(), strict=True)):
        total += image[at:row].sum(0, dtype=np.int64)
        at = row
        out[k] = total + part * image[min(row, len(image) - 1)]
    return out


def _cumulative_at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The summed table along its first axis at fractional places."""
    low = np.minimum(places.astype(np.int64), len(table) - 1)
    high = np.minimum(low + 1, len(table) - 1)
    part = (places - low)[(slice(None),) + (None,) * (table.ndim - 1)]
    return table[low] * (1 - part) + table[high] * part


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each target cell's source area, through an integral image at the cells' corners."""
    h, w = image.shape[:2]
    rows = np.swapaxes(_integral_rows(image, np.linspace(0, h, height + 1)), 0, 1)
    table = np.concatenate([np.zeros((1, *rows.shape[1:])), rows.cumsum(0)])
    cells = _cumulative_at(table, np.linspace(0, w, width + 1))
    return np.diff(np.diff(np.swapaxes(cells, 0, 1), axis=0), axis=1) / (h * w / height / width)


def dhash(image: np.ndarray) -> str:
    """64-bit difference hash as 16 hex digits."""
    grey = image if image.ndim == 2 else image.mean(2)
    small = np.rint(area_resize(grey, 8, 9) * 1024)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy_tile(image: np.ndarray, height: int = 32, width: int = 32) -> bytes:
    """An area-resized tile as the bytes of an NPY file."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(image, height, width)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


# --- columns --------------------------------------------------------------


def media_features(media: DataFrame, *, key: str, content: str, tile: int = 32) -> DataFrame:
    """(key, height, width, dhash, tile NPY bytes) of a binary image column; nulls where an image is null or damaged."""

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column(1).to_pylist():
                try:
                    image = decode(data) if data is not None else None
                except ValueError:
                    image = None
                rows.append((None,) * 4 if image is None else (*image.shape[:2], dhash(image), npy_tile(image, tile, tile)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            types = (pa.int32(), pa.int32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["key", "height", "width", "dhash", "tile"])

    session(media.sparkSession)
    return media.select(F.col(key).cast("string").alias("key"), F.col(content).cast("binary").alias("content")).mapInArrow(
        run, "key string, height int, width int, dhash string, tile binary"
    )


def text_payload(text: bytes) -> bytes:
    """Bytes 0 appended up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 if text else 64)


def store_text(text: bytes) -> bytes:
    """The stored media form of a text."""
    payload = np.frombuffer(text_payload(text), np.uint8)
    return encode_pgm(payload.reshape(-1, WIDTH))


STORED = "doc_id long, n_bytes long, media binary"
MEASURED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile_sha256 string, tile binary"


def store_media(docs: DataFrame) -> DataFrame:
    """Every text's media, as a written table (doc_id, n_bytes, media)."""

    def run(batches):
        for batch in batches:
            raw = [(text or "").encode() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([store_text(x) for x in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    session(docs.sparkSession)
    return staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, STORED), "op9-media")


def measure_media(media: DataFrame, tile: int = 32) -> DataFrame:
    """Stored media (doc_id, n_bytes, media) decoded: digests of what was read, difference hash, and the tile as an NPY file; a written table."""

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column(2).to_pylist():
                image = decode(data)
                payload = image.tobytes()
                small = npy_tile(image, tile, tile)
                rows.append((
                    len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), dhash(image), hashlib.sha256(small).hexdigest(), small,
                ))
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=[x.split()[0] for x in MEASURED.split(", ")])

    return staged(media.mapInArrow(run, MEASURED), "op9-tiles")


def text_media(docs: DataFrame, *, tile: int = 32) -> DataFrame:
    """Store every text as an image in a written table, read that back, write the tiles, and return the digests of what was read."""
    return measure_media(store_media(docs), tile).drop("tile")
