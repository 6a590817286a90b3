"""Vectorised word splitting over batches of texts."""

from __future__ import annotations

import hashlib

import numpy as np

_RAW = np.arange(256, dtype=np.uint8)
LOWER = np.where((_RAW >= 65) & (_RAW <= 90), _RAW + 32, _RAW).astype(np.uint8)
#: Bytes of words: ASCII digits and letters, and all bytes above ASCII.
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])
#: Bytes of words: everything but the space and 0x09 to 0x0D.
NONBLANK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches, column: str = "text", limit: int = 2 << 20):
    """Batches cut into runs of rows with about `limit` characters, and one row at least.

    The work arrays of a run are many times its text, so this bounds the memory of a task.
    """
    for batch in batches:
        total, first = 0, 0
        for i, text in enumerate(batch[column]):
            size = len(text) if isinstance(text, str) else 0
            if total and total + size > limit:
                yield batch.iloc[first:i].reset_index(drop=True)
                total, first = 0, i
            total += size
        yield batch.iloc[first:].reset_index(drop=True)


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte buffer, each followed by a line feed, and where each begins (and the end).

    A null text is empty.
    """
    parts = [t.encode("utf-8") if isinstance(t, str) else b"" for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n" if parts else b"", np.uint8), starts


def words(buf: np.ndarray, starts: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word of the buffer, and the first word of each text (and the count)."""
    inside = alphabet[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return begin, end, np.searchsorted(begin, starts)


def hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each slice of the buffer, by one prefix sum over powers modulo 2**64."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    table = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULT + np.uint64(seed * 2654435761 % 2**32))
    base = int(mix(np.array([seed + 77], np.uint64))[0]) | 1
    inverse = pow(base, -1, 2**64)

    def powers(b: int) -> np.ndarray:
        out = np.full(len(buf) + 1, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(table[buf] * powers(base)[:-1], out=total[1:])
    return mix((total[end] - total[begin]) * powers(inverse)[begin] + (end - begin).astype(np.uint64))


def exact_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each slice by chained mixing of its 8-byte lanes; long slices by BLAKE2.

    Unlike the prefix sums of `hashes`, no two slices are equal by the form of the hash: two values
    with different seeds differ for different slices but for chance, about 2**-128 a pair.
    """
    size = (end - begin).astype(np.int64)
    out = mix(size.astype(np.uint64) * _MULT + np.uint64(seed * 2654435761 % 2**32))
    lanes = np.ndarray(len(buf) + 1, "<u8", np.append(buf, np.zeros(8, np.uint8)).tobytes(), strides=(1,))
    short = np.flatnonzero(size <= 64)
    for k in range(8):
        short = short[size[short] > 8 * k]
        if not len(short):
            break
        left = np.minimum(size[short] - 8 * k, 8).astype(np.uint64)
        lane = lanes[begin[short] + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (np.uint64(8) - left)))
        out[short] = mix((out[short] ^ lane) * _MULT + np.uint64(k + 1))
    salt = seed.to_bytes(8, "little")
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(buf[begin[i] : end[i]].tobytes(), digest_size=8, salt=salt).digest(), "little")
    return out


def windows(h: np.ndarray, n: int, seed: int = 3) -> np.ndarray:
    """A 64-bit hash of every n consecutive word hashes (none when there are fewer)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, seed, np.uint64)
    for i in range(n):
        out = mix(out * _MULT + h[i : len(h) - n + 1 + i])
    return out
