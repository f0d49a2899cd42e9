"""Suffix arrays by induced sorting, and permuted common prefixes, on whole arrays at a time.

Induction goes bucket by bucket of first bytes, as in the sequential algorithm, but each step moves
all suffixes that one bucket induces: those of the same byte in rounds, the rest in one stable
distribution. So the work stays linear, and the number of steps depends on the alphabet and on the
longest run of one byte, not on the length.
"""

from __future__ import annotations

import numpy as np


def smaller_suffixes(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end counts as smallest."""
    size = len(text)
    step = np.zeros(size, np.int8)
    step[:-1] = np.where(text[:-1] < text[1:], 1, np.where(text[:-1] > text[1:], -1, 0))
    step[-1] = -1
    # An equal pair is ordered as the next unequal one.
    places = np.where(step != 0, np.arange(size), size)
    following = np.minimum.accumulate(places[::-1])[::-1]
    return step[following] > 0


def _distribute(pending: list[list[np.ndarray]], places: np.ndarray, heads: np.ndarray) -> None:
    """Append places to the buckets of their heads, keeping their order."""
    if not len(places):
        return
    order = np.argsort(heads, kind="stable")
    heads, places = heads[order], places[order]
    cuts = np.flatnonzero(heads[1:] != heads[:-1]) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(heads)]):
        pending[heads[start]].append(places[start:end])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _rounds(text: np.ndarray, byte: int, found: np.ndarray) -> np.ndarray:
    """What a bucket induces in itself: predecessors of the same byte, and theirs, in order."""
    parts = [found]
    while len(found):
        before = found[found > 0] - 1
        found = before[text[before] == byte]
        parts.append(found)
    return _joined(parts)


def induce(text: np.ndarray, leftmost: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Larger and smaller suffixes per first byte, each in order, from an order of the leftmost smaller.

    Larger ones follow from the buckets in rising order, smaller ones from those in falling order.
    """
    rising: list[list[np.ndarray]] = [[] for _ in range(256)]
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(256)]
    _distribute(seeds, leftmost, text[leftmost])
    rising[text[-1]].append(np.array([len(text) - 1]))
    larger, smaller = [np.empty(0, np.int64)] * 256, [np.empty(0, np.int64)] * 256
    for byte in range(256):
        if rising[byte] or seeds[byte]:
            larger[byte] = _rounds(text, byte, _joined(rising[byte]))
            source = np.concatenate([larger[byte], _joined(seeds[byte])])
            before = source[source > 0] - 1
            heads = text[before]
            over = heads > byte
            _distribute(rising, before[over], heads[over])
    for byte in range(255, -1, -1):
        if falling[byte] or len(larger[byte]):
            # Collected from the end: the last suffix of the bucket first.
            last = _rounds(text, byte, _joined(falling[byte]))
            source = np.concatenate([last, larger[byte][::-1]])
            before = source[source > 0] - 1
            heads = text[before]
            under = heads < byte
            _distribute(falling, before[under], heads[under])
            smaller[byte] = last[::-1]
    return larger, smaller


def _name(text: np.ndarray, order: np.ndarray, size_of: np.ndarray) -> np.ndarray:
    """Numbers of the substrings in ``order``: equal neighbours share one."""
    one, two = order[:-1], order[1:]
    same = size_of[one] == size_of[two]
    left = np.flatnonzero(same)
    at = 0
    while len(left):
        inside = at < size_of[one[left]]
        left = left[inside]
        unequal = text[one[left] + at] != text[two[left] + at]
        same[left[unequal]] = False
        left = left[~unequal]
        at += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _rank(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of names: pairs are named until no two are the same.

    This is the recursion on the reduced string. Its buckets hold a name or two each, which would
    make induction a loop over single suffixes; naming pairs of names sorts them all at once.
    """
    size, width = len(names), 1
    while True:
        order = np.argsort(names)
        sorted_names = names[order]
        new = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
        rank = np.cumsum(new) - 1
        if rank[-1] == size - 1:
            return order
        names = np.empty(size, np.int64)
        names[order] = rank + 1
        second = np.zeros(size, np.int64)
        second[: max(0, size - width)] = names[width:]
        names = names * (size + 1) + second
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of an array of bytes, in order."""
    if not len(text):
        return np.empty(0, np.int64)
    small = smaller_suffixes(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(leftmost):
        _, smaller = induce(text, leftmost)
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        order = _joined(smaller)
        order = order[is_leftmost[order]]
        # A substring reaches to the next leftmost smaller suffix, the last to the end.
        size_of = np.zeros(len(text), np.int64)
        size_of[leftmost] = np.diff(np.append(leftmost, len(text) - 1)) + 1
        names = np.empty(len(text), np.int64)
        names[order] = _name(text, order, size_of)
        # The last substring ends with the text and is like no other.
        reduced = names[leftmost] * 2 + 1
        reduced[-1] -= 1
        leftmost = leftmost[_rank(reduced)]
    larger, smaller = induce(text, leftmost)
    return _joined([part for byte in range(256) for part in (larger[byte], smaller[byte])])


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each start in ``order``, the bytes it shares with the one before it, up to ``most``.

    They are worked out in the order of the text, where neighbours share all but one byte of their
    prefixes and so read the same memory, eight bytes at a time, and put back into sorted order.
    """
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.zeros(len(text), np.uint64)
    for byte in range(8):
        words |= padded[byte : byte + len(text)].astype(np.uint64) << np.uint64(8 * byte)
    place = np.zeros(len(text), np.int64)
    place[order[1:]] = np.arange(1, len(order))
    permuted = place[place > 0]
    here, before = order[permuted], order[permuted - 1]
    shared = np.zeros(len(here), np.int64)
    left = np.arange(len(here))
    for at in range(0, most, 8):
        room = np.maximum(here[left], before[left]) + at < len(text)
        left = left[room]
        differ = words[here[left] + at] ^ words[before[left] + at]
        equal = differ == 0
        low = differ[~equal] & (~differ[~equal] + np.uint64(1))
        shared[left[~equal]] += np.log2(low.astype(np.float64)).astype(np.int64) // 8
        shared[left[equal]] += 8
        left = left[equal]
    reach = len(text) - np.maximum(here, before)
    out = np.zeros(len(order), np.int64)
    out[permuted] = np.minimum(np.minimum(shared, reach), most)
    return out
