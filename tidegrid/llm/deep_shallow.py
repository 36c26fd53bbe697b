"""Deep-shallow sorting of byte strings, with the common prefixes of neighbours.

Shallow phase: multikey quicksort.  Each open segment is partitioned by a
pivot into smaller, equal and larger keys (eight bytes as one big-endian
number); the equal part goes on to the next key until ``shallow`` bytes are
used, the others stay at theirs.  One vectorised pass partitions all open
segments at once, whatever their depths.

Deep phase: each segment still tied is built into a blind trie, which stores
only branching depths and bytes.  A new string walks down blindly, is compared
with one leaf, and is hung where they part; reading the trie in order gives
the sorted strings and their common prefixes.
"""

from __future__ import annotations

import numpy as np


def common_prefix(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class BlindTrie:
    """A trie of equally long byte strings; equal strings share a leaf."""

    __slots__ = ("depth", "kids", "ids", "text")

    def __init__(self, depth: int, kids: dict | None = None, ids: list | None = None, text: bytes = b""):
        self.depth, self.kids, self.ids, self.text = depth, kids, ids, text

    def add(self, text: bytes, one: int) -> BlindTrie:
        """The trie's root after adding; the first string makes a leaf of its own."""
        node = self
        while node.kids is not None:  # blind descent: only branching bytes are looked at
            child = node.kids.get(text[node.depth])
            node = child if child is not None else next(iter(node.kids.values()))
        if node.text == text:
            node.ids.append(one)
            return self
        part = common_prefix(node.text, text)
        above, node = None, self
        while node.kids is not None and node.depth < part:
            above, node = node, node.kids[text[node.depth]]
        leaf = BlindTrie(len(text), None, [one], text)
        if node.kids is not None and node.depth == part:
            node.kids[text[part]] = leaf
            return self
        # any leaf below shows the byte at the branch
        probe = node
        while probe.kids is not None:
            probe = next(iter(probe.kids.values()))
        branch = BlindTrie(part, {probe.text[part]: node, text[part]: leaf})
        if above is None:
            return branch
        above.kids[text[above.depth]] = branch
        return self

    def ordered(self) -> tuple[list[int], list[int]]:
        """Ids in sorted order and each one's common prefix with its predecessor."""
        ids, lcps, stack = [], [], [(self, 0)]
        while stack:
            node, prefix = stack.pop()
            if node.kids is None:
                ids += node.ids
                lcps += [prefix] + [node.depth] * (len(node.ids) - 1)
                continue
            keys = sorted(node.kids)
            stack += [(node.kids[k], node.depth) for k in reversed(keys[1:])]
            stack.append((node.kids[keys[0]], prefix))
        return ids, lcps


def deep_shallow_sort(strings: np.ndarray, lengths: np.ndarray, groups: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of padded byte strings inside their groups, and the common prefix of each with its predecessor.

    ``strings`` is n x width (uint8, zero-padded past ``lengths``).  Prefixes
    never exceed either string's length and are 0 at a group's first string.
    Of strings that differ only by padding the shorter comes first.
    """
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    lcp = np.zeros(n, np.int64)
    if not n:
        return order, lcp
    depth_words = min(-(-shallow // 8), words.shape[1])
    new = np.concatenate([[True], np.diff(groups[order]) != 0])
    group_first = new.copy()
    depth = np.zeros(n, np.int64)  # words of its segment that are known to be equal, by place
    while True:
        segment = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        at = np.flatnonzero((size[segment] > 1) & (depth < depth_words))
        if not len(at):
            break
        own, d = segment[at], depth[at]
        key = words[order[at], d]
        # The pivot is the median of a segment's first, middle and last key.
        begin = first[own]
        ends = [words[order[begin + step], d] for step in (0, size[own] // 2, size[own] - 1)]
        pivot = np.maximum(np.minimum(ends[0], ends[1]), np.minimum(np.maximum(ends[0], ends[1]), ends[2]))
        side = (key > pivot).astype(np.int8) - (key < pivot).astype(np.int8)
        inner = np.lexsort((side, own))
        order[at], side = order[at][inner], side[inner]
        depth[at] = d + (side == 0)
        new[at[1:]] |= (side[1:] != side[:-1]) & (own[1:] == own[:-1])
    # Common prefixes of neighbours that the shallow phase told apart.
    apart = np.flatnonzero(new & ~group_first)
    if len(apart):
        a, b = words[order[apart - 1], :depth_words], words[order[apart], :depth_words]
        k = (a != b).argmax(1)
        differ = a[np.arange(len(apart)), k] ^ b[np.arange(len(apart)), k]
        equal_bytes = np.zeros(len(apart), np.int64)
        for byte in range(1, 8):
            equal_bytes += (differ >> np.uint64(64 - 8 * byte)) == 0
        lcp[apart] = 8 * k + equal_bytes
    segment = np.cumsum(new) - 1
    # Deep phase on what is still tied.
    edge = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1], [True]]))
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        if b - a == 1:
            continue
        ids = order[a:b]
        tails = [strings[i].tobytes() for i in ids]
        root = BlindTrie(width, None, [0], tails[0])
        for k in range(1, len(tails)):
            root = root.add(tails[k], k)
        found, prefixes = root.ordered()
        order[a:b] = ids[found]
        lcp[a + 1 : b] = prefixes[1:]
    # Equal padded strings: shorter first.
    full = lcp >= width
    if full.any():
        run = np.cumsum(~full)
        order = order[np.lexsort((lengths[order], run))]
    lcp[1:] = np.minimum(lcp[1:], np.minimum(lengths[order][1:], lengths[order][:-1]))
    lcp[np.concatenate([[True], groups[order][1:] != groups[order][:-1]])] = 0
    return order, lcp
