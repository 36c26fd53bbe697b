"""Plain versions of the operators' contracts."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    marked = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] >= 2 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def normal_lines(text):
    """Words of each normalised line."""
    out = collections.Counter()
    for line in (text or "").split("\n"):
        w = words(line)
        if w:
            key = " ".join(re.sub(r"[0-9]", "0", x.translate({c: c + 32 for c in range(65, 91)})) for x in w)
            out[key] += len(w)
    return out


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(rows, percent=85):
    """Least doc_id reachable for each row of (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [(len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def removed(texts, length=200):
    """(bytes, removed, spans, sha of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by repeated resharing; ``sizes`` maps a source to its words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        out = {s: most * sizes[s] for s in capped} | {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        over = {s for s in free if out[s] > most * sizes[s]}
        if not over:
            return out
        capped |= over


def payload(text):
    raw = (text or "").encode()
    data = raw + bytes(-len(raw) % 64 if raw else 64)
    return len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:])


def media(text):
    """(media bytes, sha of the media, difference hash): cell means by overlap lengths."""
    raw = (text or "").encode()
    data = raw + bytes(-len(raw) % 64 if raw else 64)
    stored = b"P5\n64 %d\n255\n" % (len(data) // 64) + data
    image = np.frombuffer(data, np.uint8).reshape(-1, 64).astype(float)

    def overlap(n, cells):
        at = np.linspace(0, n, cells + 1)
        return np.array([[max(0.0, min(b, i + 1) - max(a, i)) for i in range(n)] for a, b in zip(at, at[1:])])

    means = overlap(len(image), 8) @ image @ overlap(64, 9).T / (len(image) * 64 / 72)
    small = np.rint(means * 1024)
    bits = "".join("1" if small[y][x + 1] > small[y][x] else "0" for y in range(8) for x in range(8))
    return len(stored), hashlib.sha256(stored).hexdigest(), f"{int(bits, 2):016x}"


def shards(rows, shards=16, sub_rows=20_000):
    """(doc_id, size, crc, shard, slot, grown shard) of rows of (doc_id, text)."""
    key = lambda *x: int(hashlib.md5(":".join("null" if y is None else str(y) for y in x).encode()).hexdigest()[:13], 16)
    score = lambda j, i: -1.0 / math.log((key(j, i) + 0.5) / 16.0**13)
    best = lambda i, n: max(range(n), key=lambda j: (score(j, i), -j))
    subs = max(1, -(-len(rows) // (shards * sub_rows)))
    seen = []
    for i, t in rows:
        raw = (t or "").encode()
        crc = zlib.crc32(raw)
        seen.append((best(i, shards), key(i, crc) % subs, i is not None, i or 0, crc, len(raw) + 1, i, best(i, shards + 1)))
    seen.sort(key=lambda x: x[:6])
    out, slots = [], collections.Counter()
    for shard, _, _, _, crc, size, i, grown in seen:
        out.append((i, size, crc, "key", shard, slots[shard], grown))
        slots[shard] += 1
    return out
