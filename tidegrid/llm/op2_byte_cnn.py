"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows,
each filter's maximum over a window is pooled, and a softmax layer gives class
probabilities.  A text's whole length is cut into windows; its class scores
are the mean log-probabilities of its windows, weighted by their bytes.

Training rows are a bounded sample of labelled rows (``sample_per_class``,
``sample_rows``, ``sample_chars``), which the caller chooses; every label is a
class.  The sample is the rows of least hash in a fixed order, so the model
does not depend on how the table is partitioned.  Prediction reads only text.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text where no row is labelled; a text whose best classes tie
gets the first by name; equal texts get equal predictions; repeated rows are
predicted alike and count once in the sample; an empty table gives an empty
result.  A very long text is windowed in pieces of ``PIECE`` bytes, all of
them scored.  Columns other than the named ones are ignored, so clashing names
do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import kernels as K
from tidegrid.llm.runtime import session

WINDOW = 256
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bytes whose windows are scored at once; a multiple of WINDOW.
PIECE = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteCNN:
    classes: list[str]
    embed: np.ndarray  # 256 x EMBED
    kernel: np.ndarray  # (widest * EMBED) x all filters; rows beyond a filter's width are zero
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Windows (n x WINDOW bytes) to rows of the widest filter's inputs."""
        e = self.embed[windows]
        wide = max(WIDTHS)
        view = np.lib.stride_tricks.sliding_window_view(e.reshape(len(windows), -1), wide * EMBED, axis=1)[:, :: EMBED]
        return np.ascontiguousarray(view)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = self.columns(windows)
        n, places, width = x.shape
        y = (x.reshape(-1, width) @ self.kernel).reshape(n, places, -1)
        best = y.argmax(1)
        return x, best, np.take_along_axis(y, best[:, None], 1)[:, 0] + self.bias

    def log_probabilities(self, windows: np.ndarray, block: int = 64) -> np.ndarray:
        out = np.empty((len(windows), len(self.classes)))
        for i in range(0, len(windows), block):
            # Every product has one shape, so a window's result does not depend on how many come with it.
            held = windows[i : i + block]
            full = held if len(held) == block else np.concatenate([held, np.zeros((block - len(held), held.shape[1]), np.uint8)])
            x = self.columns(full)
            n, places, width = x.shape
            y = (x.reshape(-1, width) @ self.kernel).reshape(n, places, -1).max(1) + self.bias
            z = (np.maximum(y, 0) @ self.dense + self.dense_bias)[: len(held)].astype(np.float64)
            z -= z.max(1, keepdims=True)
            out[i : i + block] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def windows_of(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (zero-padded at the end), their rows and their bytes."""
    sizes = np.diff(offs)
    count = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), count)
    total = np.concatenate([[0], np.cumsum(count)])
    start = (np.arange(total[-1]) - total[row]) * WINDOW + offs[:-1][row]
    length = np.minimum(WINDOW, offs[1:][row] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
    return np.where(inside, padded[np.minimum(at, len(padded) - 1)], 0).astype(np.uint8), row, length


def train(texts: list[str], labels: list[str], *, epochs: int = 6, batch: int = 64, rate: float = 4e-3, per_text: int = 4, seed: int = 11) -> ByteCNN:
    """Adam on cross-entropy over windows at random places of each text."""
    rng = np.random.default_rng(seed)
    classes = sorted(set(labels))
    wide = max(WIDTHS)
    crops, y = [], []
    for text, label in zip(texts, labels, strict=True):
        b = np.frombuffer(text.encode(), np.uint8)
        for _ in range(per_text):
            if len(b):
                size = WINDOW if rng.random() < 0.7 else int(rng.integers(24, WINDOW))
                at = int(rng.integers(0, max(1, len(b) - size + 1)))
                part = b[at : at + size]
                crops.append(np.concatenate([part, np.zeros(WINDOW - len(part), np.uint8)]))
                y.append(classes.index(label))
    mask = np.concatenate([np.repeat(np.arange(wide * EMBED)[:, None] < w * EMBED, FILTERS, 1) for w in WIDTHS], 1)
    total = FILTERS * len(WIDTHS)
    f4 = np.float32
    net = ByteCNN(
        classes, rng.normal(0, 0.5, (256, EMBED)).astype(f4), (rng.normal(0, 0.3, (wide * EMBED, total)) * mask).astype(f4),
        np.zeros(total, f4), rng.normal(0, 0.2, (total, len(classes))).astype(f4), np.zeros(len(classes), f4),
    )
    if not crops or len(classes) < 2:
        return net
    data, target = np.stack(crops), np.array(y)
    names = ("embed", "kernel", "bias", "dense", "dense_bias")
    m = {k: np.zeros_like(getattr(net, k)) for k in names}
    v = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            x, best, pre = net.pooled(data[pick])
            act = np.maximum(pre, 0)
            z = act @ net.dense + net.dense_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), target[pick]] -= 1
            p /= len(pick)
            dpre = (p @ net.dense.T) * (pre > 0)
            inputs = x[np.arange(len(pick))[:, None], best]  # rows x filters x inputs
            dx = dpre[:, :, None] * net.kernel.T[None]
            dembed = np.zeros_like(net.embed)
            held = data[pick][np.arange(len(pick))[:, None, None], best[:, :, None] + np.arange(wide)]
            np.add.at(dembed, held, dx.reshape(len(pick), total, wide, EMBED))
            grads = {"embed": dembed, "kernel": np.einsum("nf,nfi->if", dpre, inputs) * mask, "bias": dpre.sum(0), "dense": act.T @ p, "dense_bias": p.sum(0)}
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                setattr(net, k, (getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(f4))
    return net


def classify(net: ByteCNN, column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Predicted class and score of each whole text."""
    if not net.classes:
        return pa.array(["und"] * len(column), pa.string()), pa.array([0.0] * len(column), pa.float64())
    names, scores = [], []
    for i, j, raw, offs in K.chunks(column, PIECE):
        n = j - i
        sums = np.zeros((n, len(net.classes)))
        # Only a chunk of one text can be longer than a piece.
        for a in range(0, max(len(raw), 1), PIECE):
            part = np.clip(offs - a, 0, PIECE) if n == 1 else offs
            windows, row, length = windows_of(raw[a : a + PIECE] if n == 1 else raw, part)
            if len(windows):
                logp = net.log_probabilities(windows) * length[:, None]
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                sums[row[first]] += np.add.reduceat(logp, first)
            if n > 1:
                break
        sums /= np.maximum(np.diff(offs), 1)[:, None]
        best = sums.argmax(1)
        top = np.round(1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1), 6)
        for k, text in enumerate(column.slice(i, n).to_pylist()):
            known = text is not None and _LETTER.search(text) is not None
            names.append(net.classes[best[k]] if known else "und")
            scores.append(float(top[k]) if known else 0.0)
    return pa.array(names, pa.string()), pa.array(scores, pa.float64())


def labelled_sample(labelled: DataFrame, *, sample_per_class: int = 300, sample_rows: int = 20_000, sample_chars: int = 4096) -> tuple[list[str], list[str]]:
    """A bounded sample of ``(text, label)`` from (id, label, text): the rows of least hash of every class.

    Of each class at most ``sample_per_class`` rows are taken, fewer where
    there are so many classes that ``sample_rows`` would be exceeded, and at
    least one.  Of a longer text an excerpt of ``sample_chars`` characters at
    a hashed place is taken.  This bound is the only sampling, and only of
    training rows.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "id", "text"), 11)
    counts = labelled.groupBy("label").agg(F.count("*").alias("count"), F.min(draw).alias("least"))
    classes = counts.count()
    if not classes:
        return [], []
    most = max(1, min(sample_per_class, sample_rows // classes))
    # Most rows fall to a threshold by their class's size, so the ranking sees few; rows of one hash are one row.
    # The table of classes is as long as the network's last layer, which every task gets anyway.
    share = F.least(F.lit(1.0), F.lit(2.0 * most + 60) / F.col("count"))
    excerpt = F.col("text").substr((F.pmod(F.xxhash64(F.lit("place"), "text"), F.greatest(F.lit(1), F.length("text") - sample_chars + 1)) + 1).cast("int"), F.lit(sample_chars))
    thin = labelled.withColumn("draw", draw).join(F.broadcast(counts), "label").where((F.col("draw") < share * float(1 << 53)) | (F.col("draw") == F.col("least")))
    # Repeated rows are one here; the limit is far above what the thresholds let pass, and keeps the least draws.
    found = thin.select("label", "draw", excerpt.alias("text")).distinct().orderBy("draw").limit(classes * (4 * most + 500)).collect()
    taken: dict[str, list[tuple[int, str]]] = {}
    for r in found:
        taken.setdefault(r["label"], []).append((r["draw"], r["text"]))
    rows = [(label, text) for label in sorted(taken) for _, text in sorted(taken[label])[:most]]
    return [text for _, text in rows], [label for label, _ in rows]


def identify_language(docs: DataFrame, net: ByteCNN) -> DataFrame:
    """Columns of ``docs`` other than the text, with ``lang_pred`` and ``score``; ``docs`` has (doc_id, held_out, text)."""

    def run(batches):
        for batch in batches:
            pred, score = classify(net, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pred, score], names=["doc_id", "held_out", "lang_pred", "score"])

    session(docs.sparkSession)
    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_query(docs: DataFrame) -> DataFrame:
    """Train on labelled rows of three hash quarters, predict every row."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    labelled = docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("label"), "text"
    )
    net = train(*labelled_sample(labelled))
    return identify_language(docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string")), net)
