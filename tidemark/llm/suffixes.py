"""Suffix-array dedup: byte strings of a minimum length that an earlier document holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import segments
from tidemark.llm.text import mix

GRAM = 16  # bytes of an anchor
_K = np.uint64(0x9E3779B97F4A7C15)


def _anchored(length: int):
    """Pieces that hold every string of `length` bytes, keyed by the least hash of its 16-grams; checks are the anchor with the bytes on its left or right."""

    def pieces(buf, starts):
        none = np.zeros(0, np.int64)
        if len(buf) < length:
            return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)[:, None]
        pad = np.append(buf, np.zeros(16, np.uint8)).tobytes()
        lane = np.ndarray(len(buf) + 8, "<u8", pad, strides=(1,))
        gram = mix(mix(lane[: len(buf)]) * np.uint64(0x9E3779B97F4A7C15) + lane[8 : len(buf) + 8])
        # the place modulo 64 in the low bits: the least of a window tells the place of its anchor as well
        least = (gram & ~np.uint64(63)) | (np.arange(len(buf), dtype=np.uint64) & np.uint64(63))
        width, span = length - GRAM + 1, 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        n = len(buf) - length + 1
        least = least[:n]
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
        place = np.flatnonzero(np.arange(n) + length <= starts[text + 1] - 1)  # not over the end of a text
        if not len(place):
            return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)[:, None]
        anchor = least[place]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(place) != 1))
        first = place[new]
        last = place[np.append(np.flatnonzero(new)[1:], len(place)) - 1]
        least = least[first]
        at = first + ((least - first.astype(np.uint64)) & np.uint64(63)).astype(np.int64)
        key = least & ~np.uint64(63)
        # a string holds half of the bytes around its anchor at least on one side
        half = -(-(length - GRAM) // 2)
        steps = [*range(0, half - 8, 8), half - 8] if half >= 8 else []
        wide = np.concatenate([np.zeros(half, np.uint8), buf, np.zeros(half + 8, np.uint8)]).tobytes()
        lane = np.ndarray(len(wide) - 7, "<u8", wide, strides=(1,))
        checks = np.stack([mix(key + np.uint64(side)) for side in (1, 2)], axis=1)
        for step in steps:
            for side, base in enumerate((at, at + half + GRAM)):
                checks[:, side] = mix(checks[:, side] * _K + lane[base + step])
        return key, first, last + length, text[first], first - starts[text[first]], checks

    return pieces


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their keys, equal ones by place, and the keys in that order.

    The place stands in the low bits, as plain numbers sort several times faster than places by a key.
    """
    bits = np.uint64(len(keys).bit_length())
    packed = (keys.astype(np.uint64) << bits) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), packed >> bits


def _changes(ordered: np.ndarray) -> np.ndarray:
    return np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]


def _suffix_array(s: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of the suffixes by their first `length` symbols, by doubling the compared prefix.

    Also the rank of each suffix by a shorter prefix, and the length of that: the last one doubled.
    """
    n = len(s)
    # symbols of nine bits with 0 behind the end, as many as leave room for a place
    keys, done = np.zeros(n, np.uint64), min(length, max(1, (64 - n.bit_length()) // 9))
    for j in range(done):
        keys <<= np.uint64(9)
        keys[: max(0, n - j)] |= s[j:].astype(np.uint64) + np.uint64(1)
    order, ordered = _sorted(keys)
    new, known, at = _changes(ordered), s, 1
    while done < length:
        step = min(done, length - done)  # the second prefix may overlap the first
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        # in the order of the second prefix: those that end before it, then the present order, shifted
        short = max(0, n - step)
        by_second = np.concatenate([np.arange(short, n), order[order >= step] - step])
        place, ordered = _sorted(rank[by_second])
        order = by_second[place]
        known, at, done = rank, done, done + step
        if done < length:
            second = np.append(rank, np.zeros(step, np.int32))[order + step]
            new = _changes(ordered) | _changes(second)
    return order, known, at


def common_prefixes(s: np.ndarray, order: np.ndarray, length: int, known: np.ndarray | None = None, at: int = 1) -> np.ndarray:
    """For each place of the suffix order: is its prefix in common with the one before shorter than `length`?

    Breadth-first backward extension on the Burrows-Wheeler transform. A boundary of value v between
    two suffixes becomes one of value v+1 between the suffixes that one symbol in front of both
    makes, unless that boundary has a smaller value already. Boundaries are set by increasing value,
    and the work stops at `length`: what is unset then shares at least `length` symbols. `known` has
    ranks by the first `at` symbols: they set all boundaries below `at`, and the extension begins there.
    """
    n = len(s)
    before = s[order - 1]  # the symbol in front, cyclic
    by = np.argsort(before, kind="stable")  # places of the transform by symbol: the last-to-first map
    set_ = _changes((s if known is None else known)[order])
    frontier = set_
    # row r of the next column stands at by[r]; rows r-1 and r are split by a boundary b when
    # by[r-1] < b <= by[r] and both have the same symbol
    open_ = np.flatnonzero(~set_ & ~_changes(before[by]))
    low, high = by[open_ - 1] + 1, by[open_] + 1
    for _ in range(at, length):
        count = np.zeros(n + 1, np.int32)
        np.cumsum(frontier, out=count[1:])
        split = count.take(high) > count.take(low)
        if not split.any():
            break
        stays = ~split
        frontier = np.zeros(n, bool)
        frontier[open_[split]] = True
        open_, low, high = open_[stays], low[stays], high[stays]
        set_ |= frontier
    return set_


def _windows(length: int):
    def run(data, begin, end, doc, place, named):
        n = end - begin
        seg = np.repeat(np.arange(len(n)), n + 1)
        out = np.zeros(len(data) + len(n), np.uint16)  # sorted by digits
        shift = np.repeat(np.arange(len(n)), n)
        out[np.arange(len(data)) + shift] = data.astype(np.uint16) + 1
        order, known, at = _suffix_array(out, length)
        new = common_prefixes(out, order, length, known, at)
        base = begin + np.arange(len(n))
        offset = np.arange(len(out)) - base[seg]
        whole = (offset + length <= n[seg])[order]
        group, order = np.cumsum(new)[whole], order[whole]
        head = np.append(True, group[1:] != group[:-1])[: len(group)]
        group = np.cumsum(head) - 1
        seg, offset, at = seg[order], offset[order], order[head]
        name = np.zeros((len(at), 2), np.uint64)
        name[:, 1] = 1
        for j in range(length) if named else ():
            name = mix(name * _K + out[at + j].astype(np.uint64)[:, None])
        return group, doc[seg], place[seg] + offset, name.view(np.int64)

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, digest=None, schema: str = "text binary") -> DataFrame:
    """Per row the bytes left of its text when repeats of an earlier document go.

    A string belongs to the smallest id that holds it, wherever it stands. Anchors (the least hash
    of a string's 16-grams) bring equal strings to one bucket; only pieces whose anchor stands in
    several documents travel, and each bucket sorts the suffixes of its distinct pieces. Null and empty texts, and those shorter than
    `length`, stay as they are; rows that repeat an id are the same document, and both lose what an
    earlier document holds; rows without an id lose nothing.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return segments.dedup(named, _anchored(length), _windows(length), length, digest or (lambda text, ranges: (cut_bytes(text, ranges),)), schema)


def cut_bytes(text, ranges) -> bytes:
    data, out, at = (text or "").encode(), [], 0
    for lo, hi in ranges:
        out.append(data[at:lo])
        at = hi
    return b"".join([*out, data[at:]])


def digest(text, ranges):
    n = len((text or "").encode())
    left = cut_bytes(text, ranges)
    return n, n - len(left), len(ranges), segments.sha(left)
