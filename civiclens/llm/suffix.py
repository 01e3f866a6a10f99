"""Suffix arrays by induced sorting, in numpy.

A text is an array of whole numbers whose last is the unique smallest. Suffixes are classified as smaller
(S) or larger (L) than their successor; the leftmost S of each run start substrings that are
sorted by inducing, named in order and, where names repeat, sorted as a shorter text in turn. Two
scans then induce all suffixes from the sorted leftmost ones.

A scan visits one bucket (suffixes with the same first symbol) at a time and hands all its
predecessors on at once, as a stable sort by symbol; only runs of one symbol take further rounds. Texts
with more symbols than ``MOST_BUCKETS``, which only the recursion meets, are sorted by doubled prefixes: a scan of their
many small buckets would go entry by entry.
"""

from __future__ import annotations

import numpy as np

MOST_BUCKETS = 1 << 10
SHORT = 64
"""Leftmost substrings up to this long are compared column by column, longer ones whole."""


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    # An equal neighbour takes the type of the next change.
    change = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(change[::-1])[::-1] if n > 1 else change
    smaller = np.ones(n, dtype=bool)
    smaller[:-1] = np.append(step, 1)[following] > 0
    return smaller


def _scan_buckets(text, smaller, leftmost, heads, ends):
    """Both scans over buckets at once; ``leftmost`` holds the leftmost S in their order."""
    n, symbols = len(text), len(heads)
    suffixes = np.full(n, -1, dtype=np.int64)

    def hand_on(found: np.ndarray, at: np.ndarray, forward: bool) -> None:
        before = found[found > 0] - 1
        before = before[smaller[before] != forward]
        if not len(before):
            return
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        counts = np.bincount(symbol, minlength=symbols)
        nth = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        if forward:
            suffixes[at[symbol] + nth] = before
            at += counts
        else:
            suffixes[at[symbol] - nth] = before
            at -= counts

    starting = text[leftmost]
    lms_counts = np.bincount(starting, minlength=symbols)
    lms_ends = np.cumsum(lms_counts)
    grouped = leftmost[np.argsort(starting, kind="stable")]
    at = heads.copy()
    for c in range(symbols):
        done = heads[c]
        while done < at[c]:
            fresh = suffixes[done : at[c]].copy()
            done = at[c]
            hand_on(fresh, at, True)
        if lms_counts[c]:
            hand_on(grouped[lms_ends[c] - lms_counts[c] : lms_ends[c]], at, True)
    larger_ends = at
    at = ends.copy()
    for c in range(symbols - 1, -1, -1):
        done = ends[c]
        while done > at[c]:
            fresh = suffixes[at[c] + 1 : done + 1][::-1].copy()
            done = at[c]
            hand_on(fresh, at, False)
        if larger_ends[c] > heads[c]:
            hand_on(suffixes[heads[c] : larger_ends[c]][::-1].copy(), at, False)
    suffixes[0] = n - 1
    return suffixes


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """All suffixes by their first symbols, then by twice as many in every round; only those still equal to others are sorted again."""
    n = len(text)
    order = np.argsort(text)
    rank = np.empty(n, dtype=np.int64)
    pending, keys, size = np.arange(n), text[order], 0
    while len(pending):
        fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(fresh, len(pending)))
        # A suffix's rank is the place of the first one equal to it.
        rank[order[pending]] = np.repeat(pending[fresh], counts)
        pending = pending[np.repeat(counts > 1, counts)]
        size = 2 * size or 1
        # The last symbol occurs once, so suffixes that agree in so many symbols go on behind them.
        suffixes = order[pending]
        keys = rank[suffixes] * n + rank[suffixes + size]
        by = np.argsort(keys)
        order[pending], keys = suffixes[by], keys[by]
    return order


def _named(text: np.ndarray, sorted_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Names, from 0, of leftmost substrings in sorted order: equal ones share a name."""
    left, right = sorted_starts[:-1], sorted_starts[1:]
    size = sizes[right]
    equal = sizes[left] == size
    pending = np.flatnonzero(equal)
    for k in range(SHORT):
        pending = pending[size[pending] > k]
        if not len(pending):
            break
        differ = text[left[pending] + k] != text[right[pending] + k]
        equal[pending[differ]] = False
        pending = pending[~differ]
    for i in pending[size[pending] > SHORT].tolist():
        a, b, n = left[i], right[i], size[i]
        equal[i] = np.array_equal(text[a : a + n], text[b : b + n])
    return np.concatenate([[0], np.cumsum(~equal)])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in sorted order; the last symbol is the unique smallest, 0."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    symbols = int(text.max()) + 1
    if symbols > MOST_BUCKETS:
        return _by_doubling(text)
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts) - 1
    heads = ends - counts + 1
    smaller = _types(text)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    rough = _scan_buckets(text, smaller, starts, heads, ends)
    is_start = np.zeros(n, dtype=bool)
    is_start[starts] = True
    in_order = rough[is_start[rough]]
    sizes = np.zeros(n, dtype=np.int64)
    sizes[starts] = np.append(np.diff(starts) + 1, 1)
    names = _named(text, in_order, sizes)
    if names[-1] + 1 < len(starts):
        name_at = np.zeros(n, dtype=np.int64)
        name_at[in_order] = names
        in_order = starts[suffix_array(name_at[starts])]
    return _scan_buckets(text, smaller, in_order, heads, ends)


def permuted_prefixes(body: np.ndarray, suffixes: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """For each position the length, up to ``most``, that its suffix shares with the one sorted before it.

    ``body`` holds the text's bytes; ``room`` says how many of them, at most, count from each
    position. The array is in text order, as the positions are; eight bytes are compared at a time.
    """
    n = len(body)
    before = np.full(n, -1, dtype=np.int64)
    places, previous = suffixes[1:], suffixes[:-1]
    inside = (places < n) & (previous < n)
    before[places[inside]] = previous[inside]
    padded = np.append(body, np.zeros(most + 16, dtype=np.uint8)).astype(np.uint64)
    words = padded[: n + most + 8].copy()
    for k in range(1, 8):
        words |= padded[k : n + most + 8 + k] << np.uint64(8 * k)
    shared = np.zeros(n, dtype=np.int64)
    pending = np.flatnonzero(before >= 0)
    limit = np.minimum(np.minimum(room[pending], room[before[pending]]), most)
    shared[pending] = limit
    for k in range(0, most, 8):
        differ = words[pending + k] ^ words[before[pending] + k]
        ended = np.flatnonzero(differ)
        if len(ended):
            lowest = differ[ended] & (~differ[ended] + np.uint64(1))
            same = k + (np.bitwise_count(lowest - np.uint64(1)) >> 3)
            shared[pending[ended]] = np.minimum(limit[ended], same)
        going = (differ == 0) & (limit > k + 8)
        pending, limit = pending[going], limit[going]
        if not len(pending):
            break
    return shared
