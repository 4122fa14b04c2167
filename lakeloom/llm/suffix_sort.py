"""Deep-shallow sorting of suffixes, and anchors at which equal long substrings agree (NumPy; no Spark here).

Shallow: multikey quicksort whose characters are 8-byte words, down to SHALLOW bytes. Deep: suffixes that agree so far
go into a blind trie, which branches on single bytes and compares a suffix with one leaf only; its leaves in order are
the rest of the sort.
"""

from __future__ import annotations

import numpy as np

#: Bytes that multikey quicksort compares before a group goes to a blind trie.
SHALLOW = 64
#: Parts of so few suffixes are sorted by comparison.
SMALL = 12
#: Bytes of an anchor's key and of the gram that makes it an anchor.
KEY, GRAM = 50, 16
#: Longest period of a run, and bytes of a text that are looked at together.
PERIODS, SEGMENT = 16, 1 << 20


def sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op (minimum or maximum) over each window of `width` consecutive values, by windows of twice the width so far."""
    reach = 1
    while 2 * reach <= width:
        x = op(x[:-reach], x[reach:])
        reach *= 2
    return op(x[: len(x) - width + reach], x[width - reach :]) if reach < width else x


def long_runs(data: bytes, length: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the stretches of at least 2 * length bytes in which every byte equals the one `period`
    before it, such as blanks or a repeated word. Any `length` bytes of one occur in it twice."""
    out: list[tuple[int, int, int]] = []
    own, least = np.frombuffer(data, np.uint8), 2 * length
    if len(own) < least:
        return out
    # Only for periods that have samples of a long run is every byte looked at.
    for p in (np.flatnonzero(samples(own, length)[1].any(axis=0)) + 1).tolist():
        edges = np.flatnonzero(np.diff(np.concatenate([[False], own[:-p] == own[p:], [False]])))
        for lo, hi in zip(edges[::2].tolist(), (edges[1::2] + p).tolist(), strict=True):
            if hi - lo >= least and not any(a <= lo and hi <= b for a, b, _ in out):
                out.append((lo, hi, p))
    return sorted(out)


def samples(own: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and, for each and each period, whether four samples in a row from there on equal the bytes a period
    later: a long run has such a place at least."""
    step, end = (2 * length - PERIODS) // 4 - 6, len(own) - PERIODS
    at = np.arange(0, end, step)
    some = np.stack([own[:end:step] == own[p : end + p : step] for p in range(1, PERIODS + 1)], axis=1)
    return at[:-3], some[:-3] & some[1:-2] & some[2:-1] & some[3:]


def long_runs_of(data: bytes, ends: np.ndarray, length: int) -> dict[int, list[tuple[int, int, int]]]:
    """long_runs of the texts that have any, by number. The texts lie one after the other in data and end at `ends`."""
    own = np.frombuffer(data, np.uint8)
    if len(own) < 2 * length:
        return {}
    at, some = samples(own, length)
    out = {}
    for i in np.unique(np.searchsorted(ends, at[some.any(axis=1)], side="right")).tolist():
        if runs := long_runs(own[ends[i - 1] if i else 0 : ends[i]], length):
            out[i] = runs
    return out


def anchors(data: bytes, length: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Positions such that every window of `length` bytes has one of them at most length-KEY bytes after its start,
    found from the window's bytes alone: equal windows have equal anchors. A position is an anchor if its gram's hash
    is the least of a window's. In a long run, where all hashes of a period tie at every place, only the first windows
    have anchors, two of each content; the others are known to be repeated. Where data is many texts, one after the
    other, `ends` says where they end: no window goes beyond a text, and each text's anchors are those it has alone."""
    ends = np.array([len(data)]) if ends is None else ends
    own = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], ends[:-1]])
    runs = [(lo + s, hi + s, p) for i, of in long_runs_of(own, ends, length).items() for s in [int(starts[i])] for lo, hi, p in of]
    out = [np.empty(0, np.int64)]
    for lo in range(0, len(own), SEGMENT):
        a, b = max(0, lo - length), min(len(own), lo + SEGMENT + length)
        inner = ends[np.searchsorted(ends, a, side="right") : np.searchsorted(ends, b)] - a
        at = a + segment_anchors(own[a:b], length, [(x - a, y - a, p) for x, y, p in runs if x < b and y > a], inner.tolist())
        out.append(at[(at >= lo) & (at < lo + SEGMENT)])
    return np.concatenate(out)


def segment_anchors(data: np.ndarray, length: int, runs: list[tuple[int, int, int]], inner: list[int]) -> np.ndarray:
    """`inner`: where one text ends and the next begins."""
    if len(data) < length:
        return np.empty(0, np.int64)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        h = (words[:-8] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[8:] * np.uint64(0xC2B2AE3D27D4EB4F))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    # The upper half is enough, and faster; none is 0, which stands for windows that don't count.
    width = length - KEY + 1
    h = (h[: len(data) - KEY + 1] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = np.zeros(len(data) - length + 1 + 2 * (width - 1), np.uint32)
    own = least[width - 1 : width - 1 + len(data) - length + 1]  # one for each window of `length` bytes
    own[:] = sliding(h, width, np.minimum)
    for lo, hi, p in runs:
        own[max(0, lo + 2 * p) : max(0, hi - length + 1)] = 0
    for end in inner:
        own[max(0, end - length + 1) : end] = 0
    return np.flatnonzero(sliding(least, width, np.maximum) == h)


def keys_of(data: bytes, at: np.ndarray, ends: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of the KEY bytes from each position; 0 where its text, which ends at `ends`, hasn't so many."""
    out = np.zeros(len(at), np.int64)
    fit = np.flatnonzero(at <= ends - KEY)
    if not len(fit):
        return out
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = np.full(len(fit), KEY, np.uint64)
    with np.errstate(over="ignore"):
        for i in [*range(0, KEY - 7, 8), KEY - 8]:
            h = (h ^ words[at[fit] + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    out[fit] = h.view(np.int64)
    return out


def agreement(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - 1 - (differ.bit_length() - 1) // 8


def blind_trie(rows: np.ndarray, lengths: np.ndarray, which: list[int], depth: int) -> list[int]:
    """`which`, sorted by the bytes from `depth` on; all agree before it. A row's end sorts before any byte."""
    of: dict[bytes, list[int]] = {}
    for i in which:
        of.setdefault(rows[i, depth : max(depth, lengths[i])].tobytes(), []).append(i)
    if len(of) <= SMALL:
        return [i for text in sorted(of) for i in of[text]]
    texts = iter(of)
    root: bytes | tuple = next(texts)  # a leaf is a text; an inner node is (depth, {byte: child})
    for own in texts:
        n, node = len(own), root
        while isinstance(node, tuple):
            d, children = node
            node = children.get(own[d] if d < n else -1) or next(iter(children.values()))
        d = agreement(node, own)
        other, mine = node[d] if d < len(node) else -1, own[d] if d < n else -1
        parent, node = None, root
        while isinstance(node, tuple) and node[0] < d:
            parent, node = node, node[1][own[node[0]]]
        if isinstance(node, tuple) and node[0] == d:
            node[1][mine] = own
            continue
        split = (d, {other: node, mine: own})
        if parent is None:
            root = split
        else:
            parent[1][own[parent[0]]] = split
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out += of[node]
    return out


def deep_shallow(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The order of rows (n, width uint8, zero beyond their lengths) by their bytes, shorter first."""
    shallow = min(SHALLOW, rows.shape[1] // 8 * 8)
    words = np.ascontiguousarray(rows[:, :shallow]).view(">u8").astype(np.uint64)
    out: list[int] = []
    todo = [(np.arange(len(rows)), 0)]
    while todo:
        which, w = todo.pop()
        if len(which) <= SMALL:
            out += sorted(which.tolist(), key=lambda i: rows[i, : lengths[i]].tobytes())
        elif w == words.shape[1] or lengths[which].min() < 8 * (w + 1):
            # Deep enough, or a row ends within this word.
            out += blind_trie(rows, lengths, which.tolist(), 8 * w)
        else:
            same = (words[which, w:] == words[which[0], w:]).all(axis=0)
            if same[0]:
                # All agree for some words: on to the first in which they don't, or to one in which a row ends.
                run = len(same) if same.all() else int(same.argmin())
                todo.append((which, min(w + run, int(lengths[which].min()) // 8)))
                continue
            c = words[which, w]
            pivot = np.partition(c, len(c) // 2)[len(c) // 2]
            for part, deeper in ((which[c > pivot], 0), (which[c == pivot], 1), (which[c < pivot], 0)):
                if len(part):
                    todo.append((part, w + deeper))
    return np.array(out, np.int64)


def common_prefixes(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The common prefix of each row in order with the next one."""
    a, b = order[:-1], order[1:]
    differ = rows[a] != rows[b]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(lengths[a], lengths[b]))
