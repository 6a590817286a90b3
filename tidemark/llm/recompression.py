"""Substring dedup by recompression: word windows that an earlier document holds."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import segments
from tidemark.llm.text import NONBLANK, exact_hashes, hashes, mix, windows, words

ROUNDS = 2
_K = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _least(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int):
    """Place of the least hash among symbols lo..hi (inclusive) of each window; -1 where none are."""
    best, at = np.full(len(lo), np.iinfo(np.uint64).max, np.uint64), np.full(len(lo), -1, np.int64)
    for j in range(width):
        i = lo + j
        inside = np.flatnonzero(i <= hi)
        if not len(inside):
            break
        value = h[i[inside]]
        less = value < best[inside]
        best[inside[less]], at[inside[less]] = value[less], i[inside][less]
    return best, at


def parse(h: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int):
    """(key, place) of a symbol for each window of words lo..hi, the same for equal windows.

    A round names runs of one symbol, then pairs of a left and a right symbol (a bit of the name
    tells which). Names are hashes of what they stand for, so every task gives one content one name
    and no table of names is exchanged. Of a window's symbols, those at its ends may depend on words
    outside; they are left out in each round, and what stays has the same names in each place the
    window stands. The symbol with the least name of the highest round that has any is taken; the
    least word, where no round has.
    """
    key, place = _least(mix(h), lo, hi, width)
    level = np.zeros(len(lo), np.int64)
    sym, own = h, text
    a, b = lo.copy(), hi.copy()
    for r in range(1, ROUNDS + 1):
        # runs
        new = np.append(True, (sym[1:] != sym[:-1]) | (own[1:] != own[:-1]))
        first = np.flatnonzero(new)
        index = np.cumsum(new) - 1
        count = np.diff(np.append(first, len(sym))).astype(np.uint64)
        alive = a <= b
        a, b = np.where(alive, index[np.minimum(a, len(index) - 1)] + 1, 1), np.where(alive, index[np.maximum(b, 0)] - 1, 0)
        sym, own = np.where(count > 1, mix(sym[first] * _K + count), sym[first]), own[first]
        # pairs
        right = (mix(sym + np.uint64(r)) & np.uint64(1)).astype(bool)
        starts = np.append(~right[:-1] & right[1:] & (own[1:] == own[:-1]), False)
        taken = np.append(False, starts[:-1])
        top = len(sym) - 1
        a = a + ((a <= b) & right[np.clip(a, 0, top)])
        b = b - ((a <= b) & ~right[np.clip(b, 0, top)])
        pair = np.where(starts, mix(mix(sym * _K + np.append(sym[1:], sym[-1:])) + np.uint64(r)), sym)
        stay = ~taken
        index = np.cumsum(stay) - 1
        alive = a <= b
        a, b = np.where(alive, index[np.clip(a, 0, top)], 1), np.where(alive, index[np.clip(b, 0, top)], 0)
        sym, own = pair[stay], own[stay]
        value, at = _least(mix(sym + np.uint64(77)), a, b, width)
        better = at >= 0
        key, place, level = np.where(better, value, key), np.where(better, at, place), np.where(better, r, level)
    return mix(key + level.astype(np.uint64)), place * (ROUNDS + 1) + level


def _pieces(width: int):
    """Windows keyed by their symbol; the check of each is a hash of its words."""

    def pieces(buf, starts):
        none = np.zeros(0, np.int64)
        begin, end, first = words(buf, starts, NONBLANK)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        lo = np.arange(max(0, len(begin) - width + 1))
        lo = lo[text[lo] == text[lo + width - 1]] if len(lo) else lo
        if not len(lo):
            return none.astype(np.uint64), none, none, none, none, none.astype(np.uint64)[:, None]
        h = hashes(buf, begin, end)
        key, _ = parse(h, text, lo, lo + width - 1, width)
        check = windows(h, width)[lo]
        return key, begin[lo], end[lo + width - 1], text[lo], lo - first[text[lo]], check[:, None]

    return pieces


def _windows(width: int):
    def run(data, begin, end, doc, place, named):
        # a white space byte between pieces
        n = end - begin
        buf = np.full(len(data) + len(n), 32, np.uint8)
        buf[np.arange(len(data)) + np.repeat(np.arange(len(n)), n)] = data
        starts = np.append(begin + np.arange(len(n)), len(buf))
        w0, w1, first = words(buf, starts, NONBLANK)
        piece = np.repeat(np.arange(len(n)), np.diff(first))
        lo = np.arange(max(0, len(w0) - width + 1))
        lo = lo[piece[lo] == piece[lo + width - 1]] if len(lo) else lo
        # a window is named by two hashes over its words; each word and each window is then compared with the first of its name
        _, number = segments.distinct(buf, w0, w1)
        pair = np.stack([exact_hashes(buf, w0, w1, 1), exact_hashes(buf, w0, w1, 2)], axis=1)
        one, two = np.zeros(len(lo), np.uint64), np.zeros(len(lo), np.uint64)
        for j in range(width):
            one, two = mix(one * _K + pair[lo + j, 0]), mix(two * _K + pair[lo + j, 1])
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        head = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)]
        seg, at = piece[lo[order]], lo[order]
        like = at[np.flatnonzero(head)][np.cumsum(head) - 1] if len(at) else at
        if any((number[at + j] != number[like + j]).any() for j in range(width)):
            # two windows of different words have one name: group by the words themselves
            _, first_of, group = np.unique(np.stack([number[at + j] for j in range(width)], axis=1), axis=0, return_index=True, return_inverse=True)
            return group.reshape(-1), doc[seg], place[seg] + at - first[seg], np.stack([one[first_of], two[first_of]], axis=1).view(np.int64)
        name = np.stack([one[head], two[head]], axis=1).view(np.int64)
        return np.cumsum(head) - 1, doc[seg], place[seg] + at - first[seg], name

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, digest=None, schema: str = "text string") -> DataFrame:
    """Per row the words left of its text when windows of an earlier document go.

    A window belongs to the smallest id that holds it. High-level symbols bring equal windows to one
    bucket; windows of a single document do not travel, by a hash of 32 bits, and those of one
    symbol are compared word for word. Null, empty and short texts stay; rows that repeat an id are one document
    and both lose what an earlier one holds; rows without an id lose nothing.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    left = lambda text, ranges: (" ".join(left_words(text, ranges)[1]),)
    return segments.dedup(named, _pieces(width), _windows(width), width, digest or left, schema)


def left_words(text, ranges):
    found, out, at = _WORD.findall(text or ""), [], 0
    for lo, hi in ranges:
        out += found[at:lo]
        at = hi
    return len(found), out + found[at:]


def digest(text, ranges):
    n, left = left_words(text, ranges)
    return n, n - len(left), segments.sha(" ".join(left).encode())
