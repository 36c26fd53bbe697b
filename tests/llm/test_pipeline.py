"""The whole pipeline against a plain version of each stage, on the smallest tables."""

import math
import struct
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import xxhash

from tidegrid.llm import op4_importance as op4
from tidegrid.llm import op6_bpe as op6
from tidegrid.llm import op7_mixing as op7

SF = "/root/testdata/sf0.001"


def draw(seed, doc_id, text):
    """The keyed hash of a document, as a number in (0, 1)."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), h)
    h = xxhash.xxh64_intdigest(text.encode(), h)
    return ((h >> 11) + 0.5) / (1 << 53)


def grams(text):
    b = text.encode()
    out = Counter((int.from_bytes(b[i : i + 4], "big") * 0x9E3779B1 % (1 << 32)) >> 16 for i in range(len(b) - 3))
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in brute.words(text)]
    out[op4.REPEAT] = sum(x == y for x, y in zip(w, w[1:]))
    return +out


def quality(rows, labels):
    counts = {r["doc_id"]: grams(r["text"]) for r in rows}
    raw, target = np.zeros(op4.BUCKETS + 1), np.zeros(op4.BUCKETS + 1)
    good = {i for i, q in labels.items() if q == 1}
    for i, c in counts.items():
        for b, n in c.items():
            raw[b] += n
            target[b] += n * (i in good)
    p = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    q = target + op4.PRIOR * len(p) * p
    ratio = np.log(q / q.sum()) - np.log(p)
    score = {r["doc_id"]: sum(n * ratio[b] for b, n in counts[r["doc_id"]].items()) - math.log(-math.log(draw(4, r["doc_id"], r["text"]))) for r in rows if counts[r["doc_id"]]}
    k = math.ceil(len(rows) * sum(q == 1 for q in labels.values()) / len(labels))
    best = set(sorted(score, key=score.get, reverse=True)[:k])
    return [r for r in rows if r["doc_id"] in best]


def near(rows):
    """The stage links at a similarity of 0.8 or more."""
    return [r for r, (_, c) in zip(rows, brute.near_components([(r["doc_id"], r["text"]) for r in rows], 80), strict=True) if r["doc_id"] == c]


def repeats(rows):
    raws = [r["text"].encode() for r in rows]
    seen = Counter(x[i : i + 200] for x in raws for i in range(len(x) - 199))
    out = []
    for r, raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        text = bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")
        out.append(r | {"text": text, "n_chars": len(text) if any(gone) else r["n_chars"]})
    return out


def mixed(rows):
    size = {r["doc_id"]: len(brute.words(r["text"])) for r in rows}
    total, by = defaultdict(int), defaultdict(list)
    for r in rows:
        total[r["source"]] += size[r["doc_id"]]
        by[r["source"]].append(r)
    out = []
    for s, target in brute.targets(total).items():
        times = target / total[s] if total[s] else 0.0
        whole = math.floor(times)
        pi, rest = times - whole, target - whole * total[s]
        place = {}
        for r in by[s]:
            u = draw(7, r["doc_id"], r["text"])
            rank = (u / (1 - u)) / (pi / (1 - pi)) if 0 < pi < 1 else 0.0
            place[r["doc_id"]] = rank / (1 + rank)
        chosen, left = set(), rest
        order = sorted(by[s], key=lambda r: place[r["doc_id"]])
        passing = order
        while True:
            for r in passing:
                if size[r["doc_id"]] > left:
                    break
                chosen.add(r["doc_id"])
                left -= size[r["doc_id"]]
            others = [r["doc_id"] for r in order if r["doc_id"] not in chosen and 0 < size[r["doc_id"]] < 2 * left]
            if not others:
                break
            best = min(others, key=lambda i: (abs(size[i] - left), place[i]))
            if abs(size[best] - left) <= min(size[i] for i in others):
                chosen.add(best)
                break
            # Documents longer than the gap are passed over, and the order goes on.
            passing = [r for r in order if r["doc_id"] in others and size[r["doc_id"]] <= math.floor(left)]
        for r in by[s]:
            out += [r] * (whole + (r["doc_id"] in chosen and pi > 0))
    return out


def test_pipeline_against_plain(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    plain = (lambda x: quality(x, labels), near, repeats, mixed)
    for (name, stage), one in zip(p.STAGES, plain, strict=False):
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        rows = one(rows)
        key = lambda r: tuple(r[c] for c in docs.columns)
        assert Counter(key(r.asDict()) for r in docs.collect()) == Counter(key(r) for r in rows), name
    enc = op6.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = p.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((r["doc_id"], tuple(enc.encode_ordinary(r["text"]))) for r in rows)
    assert op7.CELLS ** 2 > 1000 * len(rows)  # no two documents of a source share a rank cell here
