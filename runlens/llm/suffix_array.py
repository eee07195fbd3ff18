"""Suffix arrays of short depth in numpy: refinement, common prefixes, merging.

Used on a buffer of segments laid end to end. Only suffixes that begin a window of DEPTH bytes within
their segment are compared, so no separator is needed; the others serve as helpers.
"""

from __future__ import annotations

import numpy as np

DEPTH = 50
#: Bytes of one suffix array: three of its indices fit into 64 bits.
BLOCK = 1 << 20
_BITS = np.uint64(20)
_LOW = np.uint64(BLOCK - 1)
_FIRST = 5


def refine(buffer: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Ranks of suffixes by their first DEPTH bytes, final for ``windows`` (positions of whole windows).

    Larsson-Sadakane refinement: suffixes are sorted by their first bytes; then every group that is still
    mixed is sorted by the rank of the suffix that many bytes on, which doubles the depth. Suffixes alone
    in their group are done.
    """
    n = len(buffer)
    padded = np.concatenate((buffer, np.zeros(DEPTH, dtype=np.uint8))).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(_FIRST):
        key = (key << np.uint64(8)) | padded[k : k + n]
    packed = np.sort((key << _BITS) | np.arange(n, dtype=np.uint64))
    order = (packed & _LOW).astype(np.int64)
    fresh = np.concatenate(([True], packed[1:] >> _BITS != packed[:-1] >> _BITS))
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, n))
    rank = np.zeros(n + DEPTH, dtype=np.uint64)
    rank[order] = np.repeat(starts, sizes)
    mixed = order[np.repeat(sizes > 1, sizes)]
    depth = _FIRST
    while depth < DEPTH and len(mixed):
        step = min(depth, DEPTH - depth)
        if depth + step == DEPTH:
            last = np.zeros(n, dtype=bool)
            last[windows] = True
            mixed = mixed[last[mixed]]
            if not len(mixed):
                break
        packed = np.sort((rank[mixed] << (_BITS + _BITS)) | (rank[mixed + step] << _BITS) | mixed.astype(np.uint64))
        mixed = (packed & _LOW).astype(np.int64)
        both, group = packed >> _BITS, packed >> (_BITS + _BITS)
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        fresh = np.concatenate(([True], both[1:] != both[:-1]))
        at = np.arange(len(mixed))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        own_start = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[mixed] = group + (own_start - group_start).astype(np.uint64)
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(mixed)))
        mixed = mixed[np.repeat(sizes > 1, sizes)]
        depth += step
    return rank[:n]


def common_prefixes(buffer: np.ndarray, order: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Common prefix, up to DEPTH, of each suffix in ``order`` with the one before it.

    Kasai's rule, in all segments at once: a window's prefix is at least one shorter than that of the
    window one byte before, if the neighbour of that one also has a window behind it in its segment, and
    that comes earlier in the order.
    ``first``, ``count``: first window and number of windows of each segment.
    """
    n = len(buffer)
    padded = np.concatenate((buffer, np.zeros(DEPTH + 1, dtype=np.uint8)))
    before = np.full(n + 1, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    goes_on = np.zeros(n + 1, dtype=bool)  # a window whose next byte begins a window of the same segment
    goes_on[order] = True
    goes_on[first + count - 1] = False
    place = np.zeros(n + 1, dtype=np.int64)
    place[order] = np.arange(len(order))
    found = np.zeros(n, dtype=np.int64)
    held = np.zeros(len(first), dtype=np.int64)
    sorted_by_count = np.argsort(-count, kind="stable")
    first, count = first[sorted_by_count], count[sorted_by_count]
    for step in range(int(count[0]) if len(count) else 0):
        live = int(np.searchsorted(-count, -step, side="left"))
        at = first[:live] + step
        other = before[at]
        held = np.where(other >= 0, held[:live], 0)  # segments with fewer windows have ended
        open_ones = np.flatnonzero((other >= 0) & (held < DEPTH))
        while len(open_ones):
            a, b, h = at[open_ones], other[open_ones], held[open_ones]
            same = padded[a + h] == padded[b + h]
            open_ones = open_ones[same]
            held[open_ones] += 1
            open_ones = open_ones[held[open_ones] < DEPTH]
        found[at] = held
        # goes_on[-1] is False; equal windows are in order of position, so that the next ones can be the other way round
        held = np.where(goes_on[other] & (place[other + 1] < place[at + 1]), np.maximum(held - 1, 0), 0)
    return found[order]


def keys(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The DEPTH bytes at each position as rows of big-endian words, so that rows compare as bytes do."""
    width = -(-DEPTH // 8) * 8
    padded = np.concatenate((buffer, np.zeros(width, dtype=np.uint8)))
    rows = padded[at[:, None] + np.arange(width)]
    rows[:, DEPTH:] = 0
    return rows.view(">u8").astype(np.uint64)


def search(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of rows: first place not below each wanted row, and whether it is there."""
    low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(sorted_keys), dtype=np.int64)
    while (going := np.flatnonzero(low < high)).size:
        mid = (low[going] + high[going]) // 2
        below = np.zeros(len(going), dtype=bool)
        equal = np.arange(len(going))
        for w in range(wanted.shape[1]):
            x, y = sorted_keys[mid[equal], w], wanted[going[equal], w]
            below[equal[x < y]] = True
            equal = equal[x == y]
            if not len(equal):
                break
        low[going[below]] = mid[below] + 1
        high[going[~below]] = mid[~below]
    there = low < len(sorted_keys)
    there[there] = (sorted_keys[low[there]] == wanted[there]).all(axis=1)
    return low, there


class Block:
    """Suffix array of some segments: classes of equal windows and the smallest owner of each."""

    def __init__(self, buffer: np.ndarray, first: np.ndarray, count: np.ndarray, owner: np.ndarray):
        """``first``, ``count``: windows of each segment in ``buffer``; ``owner``: document id of each segment."""
        self.segment = np.repeat(np.arange(len(first)), count)
        self.step = np.arange(len(self.segment)) - np.repeat(np.cumsum(count) - count, count)
        windows = first[self.segment] + self.step
        order = np.argsort(refine(buffer, windows)[windows], kind="stable")
        prefixes = common_prefixes(buffer, windows[order], first, count)
        starts = np.flatnonzero(np.concatenate(([True], prefixes[1:] < DEPTH))) if len(order) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.append(starts, len(order)))
        self.kind = np.zeros(len(order), dtype=np.int64)
        self.kind[order] = np.repeat(np.arange(len(starts)), sizes)
        self.owner = owner[self.segment]
        self.least = np.minimum.reduceat(self.owner[order], starts) if len(order) else np.zeros(0, dtype=np.int64)
        self._buffer, self._heads = buffer, windows[order][starts]

    def keys(self) -> np.ndarray:
        return keys(self._buffer, self._heads)

    def covered(self) -> np.ndarray:
        """Windows that a smaller owner has too."""
        return self.owner > self.least[self.kind]


def merge(blocks: list[Block]) -> None:
    """Give every class the smallest owner over all blocks, by binary search of each block's classes in the union."""
    if len(blocks) < 2:
        return
    union, least = blocks[0].keys(), blocks[0].least.copy()
    for block in blocks[1:]:
        own = block.keys()
        place, there = search(union, own)
        np.minimum.at(least, place[there], block.least[there])
        new = ~there
        union, least = np.insert(union, place[new], own[new], axis=0), np.insert(least, place[new], block.least[new])
    for block in blocks:
        block.least = least[search(union, block.keys())[0]]
