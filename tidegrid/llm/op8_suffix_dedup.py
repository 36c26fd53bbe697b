"""Removal of repeated byte strings by anchored suffix arrays (deep-shallow sorting).

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else,
in the same document or another, is removed.

1. Anchors.  In each window of ``LENGTH`` bytes the ``GRAM``-byte gram of least
   hash (the leftmost of equals) is its anchor.  The choice depends on the
   window's bytes alone, so equal strings have equal anchors at equal places.
   An anchor's context is all bytes that such strings can reach.
2. Anchors whose gram occurs once cannot lie in a repeated string; counts by
   gram, summed in each chunk before the shuffle, find the others.  Where all
   contexts of a gram are equal, or a context occurs twice, every string of
   the context is repeated; counts by context, and from them by gram, decide
   both, so neither a passage in a third of all rows nor one with very many
   different surroundings is a hot group.
3. What is left are contexts at the edges of repeats.  For each gram, the
   suffixes right of its anchors and the reversed prefixes left of them are
   sorted by deep-shallow sorting.  A string that starts d bytes before the
   anchor is repeated if another context shares d bytes to the left and
   LENGTH - d to the right: the two orders' common prefixes cut both into
   classes, and an equal pair of classes tells.
   Where one gram has more than ``HOT`` open contexts, no task takes them all:
   each of their strings is hashed and counted with partial aggregation, which
   finds the same strings.
4. Removed runs are joined to the texts by content hash and cut out.

Defined results: a null text counts as empty; texts shorter than ``LENGTH``
bytes keep everything; repeated rows of ``LENGTH`` bytes or more lose
everything; equal contexts tie and are removed together; an empty table gives
an empty result.  The windows of a very long text are taken piece by piece,
all of them.  A document's columns travel in one struct, so clashing names do
no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm import bloom
from tidegrid.llm import kernels as K
from tidegrid.llm.deep_shallow import deep_shallow_sort
from tidegrid.llm.runtime import release, session, skewed_join, staged

LENGTH = 200
GRAM = 40
LEFT = LENGTH - GRAM  # an anchor lies at most so far right of its string's start
#: Bits of a place in a chunk or piece, and the window starts of a piece of a longer text.
PLACE = K.U64(21)
PIECE = 1 << 20
#: Contexts sorted at once.
BLOCK = 8192
#: Contexts of one gram up to which they are sorted in one task; beyond, their strings are counted by hash.
HOT = 50_000


def anchors(raw: np.ndarray, offs: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of all anchors of a chunk of texts, and the row of each; with ``first`` and ``last`` those of the windows that start there."""
    n = len(raw) - GRAM + 1
    wide = LEFT + 1
    if n < wide:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = K.prefix_hash(raw)
    _, down = K.Powers.get(len(raw) + 1)
    value = K.mix((prefix[GRAM:] - prefix[:-GRAM]) * down[:n])
    value = (value >> PLACE << PLACE) | np.arange(n, dtype=np.uint64)
    # Sliding minimum from prefix and suffix minima of blocks.
    size = -(-n // wide) * wide
    tail = np.full(size, ~K.U64(0))
    tail[:n] = value
    blocks = tail.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: n - wide + 1], ahead[wide - 1 : n])
    place = (least & ((K.U64(1) << PLACE) - K.U64(1))).astype(np.int64)
    starts, rows, _ = K.windows_in_rows(offs, LENGTH)
    if first or last is not None:
        keep = (starts >= first) & (starts < (len(raw) if last is None else last))
        starts, rows = starts[keep], rows[keep]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = place[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])])
    return at[new], rows[new]


def _contexts(raw: np.ndarray, offs: np.ndarray, first: int = 0, last: int | None = None):
    """Of each anchor of a chunk: its row, place, context bounds, and the hashes of its gram and context."""
    at, rows = anchors(raw, offs, first, last)
    prefix = K.prefix_hash(raw)
    lo, hi = np.maximum(at - LEFT, offs[:-1][rows]), np.minimum(at + LENGTH, offs[1:][rows])
    gram = K.span_hashes(raw, at, at + GRAM, prefix)
    context = K.mix(K.span_hashes(raw, lo, hi, prefix) + (at - lo).astype(np.uint64))
    return rows, at, lo, hi, gram.view(np.int64), context.view(np.int64)


def _context_pieces(raw: np.ndarray, offs: np.ndarray, piece: int = PIECE):
    """``_contexts`` of a chunk; a text longer than a piece comes piece by piece, each with the bytes its contexts reach."""
    if len(offs) != 2 or len(raw) <= piece + 2 * LENGTH + LEFT:
        yield _contexts(raw, offs)
        return
    seen = -1
    for a in range(0, len(raw) - LENGTH + 1, piece):
        low = max(0, a - LEFT)
        part = raw[low : a + piece + 2 * LENGTH]
        rows, at, lo, hi, gram, context = _contexts(part, np.array([0, len(part)]), a - low, a - low + piece)
        # Windows of two pieces may share an anchor; places never fall from one window to the next.
        new = at + low > seen
        if new.any():
            seen = int(at[-1] + low)
            yield rows[new], at[new] + low, lo[new] + low, hi[new] + low, gram[new], context[new]


def _gram_counts(batches):
    """(gram, n), summed over each chunk before anything is shuffled."""
    for batch in batches:
        for _, _, raw, offs in K.chunks(batch.column(0)):
            for *_, gram, _ in _context_pieces(raw, offs):
                gram, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n.astype(np.int64))], names=["gram", "n"])


def _anchor_rows(often: bloom.Bloom):
    """The anchors whose gram may occur again."""

    def run(batches):
        for batch in batches:
            k1, k2 = np.array(batch.column(0)), np.array(batch.column(1))
            for i, _, raw, offs in K.chunks(batch.column(2)):
                for rows, at, lo, hi, gram, context in _context_pieces(raw, offs):
                    keep = np.flatnonzero(often.may_hold(gram))
                    if not len(keep):
                        continue
                    rows, at, lo, hi, gram, context = (x[keep] for x in (rows, at, lo, hi, gram, context))
                    # Place and reach to both sides, at most LEFT and LENGTH, in one number.
                    place = ((at - offs[:-1][rows]) << 16) | ((at - lo) << 8) | (hi - at)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, context, k1[i + rows], k2[i + rows], place)], names=["gram", "context", "k1", "k2", "place"])

    return run


ANCHOR_SCHEMA = "gram long, context long, k1 long, k2 long, place long"


def _unpacked(anchor_rows: DataFrame) -> DataFrame:
    """``place`` as pos, lo and hi."""
    pos, place = F.shiftright("place", 16), F.col("place")
    bounds = {"pos": pos, "lo": pos - F.shiftright("place", 8).bitwiseAND(255), "hi": pos + place.bitwiseAND(255)}
    return anchor_rows.withColumns({k: v.cast("int") for k, v in bounds.items()}).drop("place")


def _extract(batches):
    """Texts with the places of their open contexts, to one row per context."""
    for batch in batches:
        text = batch.column(0)
        raw, offs = K.buffers(text)
        raw = raw.tobytes()
        out = {k: [] for k in ("gram", "context", "copies", "k1", "k2", "pos", "lo", "bytes", "hot")}
        for r, wanted in enumerate(batch.column(3).to_pylist()):
            for w in wanted:
                for k in ("gram", "context", "copies", "pos", "lo", "hot"):
                    out[k].append(w[k])
                out["k1"].append(batch.column(1)[r].as_py())
                out["k2"].append(batch.column(2)[r].as_py())
                out["bytes"].append(raw[offs[r] + w["lo"] : offs[r] + w["hi"]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["gram"], pa.int64()), pa.array(out["context"], pa.int64()), pa.array(out["copies"], pa.int64()), pa.array(out["k1"], pa.int64()), pa.array(out["k2"], pa.int64()), pa.array(out["pos"], pa.int32()), pa.array(out["lo"], pa.int32()), pa.array(out["bytes"], pa.binary()), pa.array(out["hot"], pa.bool_())],
            names=list(out),
        )


EXTRACT_SCHEMA = "gram long, context long, copies long, k1 long, k2 long, pos int, lo int, bytes binary, hot boolean"


def _strings(batches):
    """Every string of a context that holds its anchor: (gram, d, hash, context, copies, k1, k2, lo)."""
    for batch in batches:
        gram, context, copies, k1, k2, pos, lo = (np.array(batch.column(i)) for i in range(7))
        for i, _, raw, offs in K.chunks(batch.column(7)):
            starts, rows, _ = K.windows_in_rows(offs, LENGTH)
            if not len(starts):
                continue
            own = i + rows
            d = (pos[own] - lo[own]) - (starts - offs[:-1][rows])
            keep = (d >= 0) & (d <= LEFT)
            starts, own, d = starts[keep], own[keep], d[keep]
            h = K.span_hashes(raw, starts, starts + LENGTH)
            cols = (gram[own], d.astype(np.int32), h.view(np.int64), context[own], copies[own], k1[own], k2[own], (pos[own] - d).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["gram", "d", "h", "context", "copies", "k1", "k2", "lo"])


def _hot_spans(contexts: DataFrame) -> DataFrame:
    """The removed spans of contexts of hot grams, string by string."""
    strings = contexts.mapInArrow(_strings, "gram long, d int, h long, context long, copies long, k1 long, k2 long, lo int")
    again = strings.groupBy("gram", "d", "h").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a <> b").select("gram", "d", "h")
    return strings.where("copies = 1").join(again, ["gram", "d", "h"]).select("k1", "k2", "lo", (F.col("lo") + LENGTH).alias("hi"))


def repeated_starts(groups: np.ndarray, raw: np.ndarray, offs: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each context and d in [0, LEFT]: does the string that starts d bytes before its anchor recur in its group?"""
    n = len(groups)
    right_length, left_length = np.minimum(np.diff(offs) - left, LENGTH), left
    padded = np.concatenate([raw, np.zeros(LENGTH, np.uint8)])
    anchor = offs[:-1] + left
    reach = np.arange(LENGTH)
    right = np.where(reach < right_length[:, None], padded[np.minimum(anchor[:, None] + reach, len(padded) - 1)], 0).astype(np.uint8)
    reach = np.arange(LEFT)
    reverse = np.where(reach < left_length[:, None], padded[np.maximum(anchor[:, None] - 1 - reach, 0)], 0).astype(np.uint8)
    r_order, r_lcp = deep_shallow_sort(right, right_length, groups, GRAM + 32)
    l_order, l_lcp = deep_shallow_sort(reverse, left_length, groups, 32)
    r_new = np.concatenate([[True], groups[r_order][1:] != groups[r_order][:-1]])
    l_new = np.concatenate([[True], groups[l_order][1:] != groups[l_order][:-1]])
    out = np.zeros((n, LEFT + 1), bool)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(LEFT + 1):
        valid = np.flatnonzero((left_length >= d) & (right_length >= LENGTH - d))
        if len(valid) < 2:
            continue
        r_class[r_order] = np.cumsum(r_new | (r_lcp < LENGTH - d))
        l_class[l_order] = np.cumsum(l_new | (l_lcp < d))
        key = r_class[valid] * (n + 1) + l_class[valid]
        order = np.argsort(key)
        s = key[order]
        twin = np.zeros(len(s), bool)
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= twin[1:].copy()
        out[valid[order[twin]], d] = True
    return out


def _sort_block(parts: list[dict]) -> pa.RecordBatch:
    cat = lambda k: np.concatenate([p[k] for p in parts])
    gram, copies, pos, lo = cat("gram"), cat("copies"), cat("pos"), cat("lo")
    body = b"".join(x for p in parts for x in p["bytes"])
    offs = np.concatenate([[0], np.cumsum([len(x) for p in parts for x in p["bytes"]])]).astype(np.int64)
    _, groups = np.unique(gram, return_inverse=True)
    hit = repeated_starts(groups, np.frombuffer(body, np.uint8), offs, (pos - lo).astype(np.int64))
    hit[copies > 1] = False  # those are removed whole already
    # Runs of successive d make one removed span each: from the largest d to the end of the smallest d's string.
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (cat("k1")[row], cat("k2")[row], (pos[row] - (end - 1)).astype(np.int32), (pos[row] - begin + LENGTH).astype(np.int32))],
        names=["k1", "k2", "lo", "hi"],
    )


def _sort_rows(batches):
    """Rows ordered by gram and context: whole groups are gathered into blocks and sorted."""
    parts: list[dict] = []
    held, last = 0, None
    for batch in batches:
        col = {k: np.array(batch.column(i)) for i, k in enumerate(("gram", "context", "copies", "k1", "k2", "pos", "lo"))}
        new = np.ones(batch.num_rows, bool)  # copies of a text bring a context more than once
        new[1:] = (col["gram"][1:] != col["gram"][:-1]) | (col["context"][1:] != col["context"][:-1])
        if last is not None and batch.num_rows:
            new[0] = (col["gram"][0], col["context"][0]) != last
        if not batch.num_rows:
            continue
        last = (col["gram"][-1], col["context"][-1])
        keep = np.flatnonzero(new)
        if not len(keep):
            continue
        body = batch.column(7).take(pa.array(keep)).to_pylist()
        col = {k: v[keep] for k, v in col.items()}
        bounds = np.flatnonzero(np.concatenate([[True], col["gram"][1:] != col["gram"][:-1]]))
        if held >= BLOCK and parts and col["gram"][0] != parts[-1]["gram"][-1]:
            yield _sort_block(parts)
            parts, held = [], 0
        elif held >= BLOCK and len(bounds) > 1:
            head = bounds[1]
            parts.append({**{k: v[:head] for k, v in col.items()}, "bytes": body[:head]})
            yield _sort_block(parts)
            parts, held = [], 0
            col, body = {k: v[head:] for k, v in col.items()}, body[head:]
        parts.append({**col, "bytes": body})
        held += len(body)
    if parts:
        yield _sort_block(parts)


def _keys(docs: DataFrame):
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return body.alias("text"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(8), body).alias("k2")


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(k1, k2, los, his): the removed spans, overlaps included, of each text by its content hash."""
    spark = session(docs.sparkSession)
    text, k1, k2 = _keys(docs)
    # Counts come pre-summed by chunk, so a gram in a third of all rows is a row per chunk and then per task.
    grams = docs.select(text).mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    often = bloom.build(staged(grams, "op8-grams"))
    found = staged(docs.select(k1, k2, text).mapInArrow(_anchor_rows(often), ANCHOR_SCHEMA), "op8-found")
    release(spark)
    # What passed is counted exactly, by context and from that by gram; no gram or context is one task's work.
    by_context = staged(found.groupBy("gram", "context").agg(F.count("*").alias("copies")), "op8-counts")
    by_gram = staged(by_context.groupBy("gram").agg(F.sum("copies").alias("total"), F.count("*").alias("kinds")).where("total > 1").select("gram", "kinds"), "op8-kinds")
    again = skewed_join(by_context, by_gram, ["gram"], "kinds")
    kept = skewed_join(found, staged(again, "op8-again"), ["gram", "context"], "copies")
    repeated = _unpacked(staged(kept, "op8-anchors"))
    release(spark)
    open_ = repeated.where("kinds > 1")
    contexts = staged(
        open_.groupBy("gram", "context").agg(F.max("copies").alias("copies"), F.max("kinds").alias("kinds"), F.min(F.struct("k1", "k2", "pos", "lo", "hi")).alias("one")), "op8-contexts"
    )
    whole = repeated.where("kinds = 1 or copies > 1").select("k1", "k2", "lo", "hi")
    wanted = contexts.select("one.k1", "one.k2", F.struct("gram", "context", "copies", "one.pos", "one.lo", "one.hi", (F.col("kinds") > hot).alias("hot")).alias("w")).groupBy("k1", "k2").agg(F.collect_list("w").alias("wanted"))
    asked = bloom.build(contexts.select("one.k1")).first_column(F.col("k1"), F.col("k2"))
    # Of a text's copies each task sends on one, so a text of very many rows is no hot key of the join or the sort.
    bodies = docs.select(text, k1, k2).where(asked).join(wanted, ["k1", "k2"]).select("text", "k1", "k2", "wanted").mapInArrow(_extract, EXTRACT_SCHEMA)
    spans = whole
    if (contexts.agg(F.max("kinds")).first()[0] or 0) > hot:
        bodies = staged(bodies, "op8-bodies")
        spans = spans.union(_hot_spans(bodies.where("hot")))
    edges = bodies.where("not hot").repartition("gram").sortWithinPartitions("gram", "context").mapInArrow(_sort_rows, "k1 long, k2 long, lo int, hi int")
    spans = spans.union(edges).distinct()
    out = staged(
        spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("s"))
        .select("k1", "k2", F.transform("s", lambda x: x["lo"]).alias("los"), F.transform("s", lambda x: x["hi"]).alias("his")),
        "op8-spans",
    )
    release(spark)
    return out


def merged(los: list[int] | None, his: list[int] | None) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans, which come sorted."""
    out: list[list[int]] = []
    for lo, hi in zip(los or (), his or (), strict=True):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for lo, hi in runs:
        kept.append(text[at:lo])
        at = hi
    return b"".join([*kept, text[at:]])


def _with_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(document, los, his): ``docs`` as a struct with the removed spans of its text."""
    _, k1, k2 = _keys(docs)
    spans = repeated_spans(docs, hot).withColumnsRenamed({"k1": "s1", "k2": "s2"})
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"), k1.alias("d1"), k2.alias("d2"))
    keyed = keyed.withColumn("maybe", bloom.build(spans.select("s1")).column(F.col("d1")))
    # Texts without any removed span are not shuffled.
    none = F.lit(None).cast("array<int>")
    clean = keyed.where("not maybe").select("document", none.alias("los"), none.alias("his"))
    joined = keyed.where("maybe").join(spans, (F.col("d1") == F.col("s1")) & (F.col("d2") == F.col("s2")), "left")
    return clean.unionByName(joined.select("document", "los", "his"))


def removal_digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""

    def run(batches):
        for batch in batches:
            rows = []
            documents = batch.column(0)
            for text, los, his in zip(documents.field("text").to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, runs = (text or "").encode(), merged(los, his)
                rows.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut(raw, runs)).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([documents.field("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _with_spans(slim, hot).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, counted: str | None = None) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``.

    Fragments of a character at a cut are dropped; a null text stays null.
    ``counted`` names a column of text lengths, which is set anew where a text
    was cut.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            los, his = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            cols = [batch.column(0).field(k) for k in range(len(names))]
            texts = [
                None if t is None else t if not a else cut(t.encode(), merged(a, b)).decode("utf-8", "ignore")
                for t, a, b in zip(cols[at].to_pylist(), los, his, strict=True)
            ]
            cols[at] = pa.array(texts, pa.string())
            if counted in names:
                c = names.index(counted)
                cols[c] = pa.array([len(t) if a and t is not None else old for t, a, old in zip(texts, los, cols[c].to_pylist(), strict=True)], cols[c].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in docs.schema.fields])
    return _with_spans(docs.withColumn("text", F.col("text").cast("string"))).mapInArrow(run, schema)
