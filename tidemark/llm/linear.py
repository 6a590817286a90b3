"""Hashed byte n-grams and a logistic regression on them."""

from __future__ import annotations

import numpy as np

BITS = 18
BLOCK = 1 << 20


def grams(data: bytes, sizes: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """Feature numbers of all byte n-grams (n up to 8) of the data."""
    pad = np.frombuffer(data + b"\0" * 8, np.uint8)
    lanes = np.ndarray(len(data) + 1, "<u8", pad.tobytes(), strides=(1,))
    out = []
    for n in sizes:
        if len(data) >= n:
            x = lanes[: len(data) - n + 1] & np.uint64((1 << (8 * n)) - 1)
            x = (x ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append(((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def present(data: bytes, sizes: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """The distinct feature numbers of the data, in order."""
    x = grams(data, sizes, bits)
    if len(x) << 6 < 1 << bits:
        return np.unique(x)
    seen = np.zeros(1 << bits, bool)
    seen[x] = True
    return np.flatnonzero(seen).astype(np.int32)


def fit(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, rounds: int = 200, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps on the penalised log loss.

    A feature's value in a row that has it is `scale`; classes weigh alike. With one class only, the
    weights are zero and the intercept says that class.
    """
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(len(scale)), float(6 if len(labels) and labels[0] else -6)
    ends = np.cumsum([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int32)
    used = np.flatnonzero(np.bincount(flat, minlength=len(scale)))
    number = np.zeros(len(scale), np.int32)
    number[used] = np.arange(len(used))
    flat = number[flat]
    s = scale[used]
    # runs of rows with about BLOCK features each: the work arrays of one run bound the memory
    turn = (np.append(0, ends[:-1]) // BLOCK).astype(np.int64)
    heads = np.append(np.flatnonzero(np.diff(turn, prepend=-1)), len(rows))
    parts = [(a, b, int(ends[a - 1]) if a else 0, int(ends[b - 1])) for a, b in zip(heads[:-1].tolist(), heads[1:].tolist())]
    row = np.concatenate([np.repeat(np.arange(b - a, dtype=np.int32), np.diff(ends[a:b], prepend=lo)) for a, b, lo, _ in parts])

    def total(per_feature: np.ndarray) -> np.ndarray:
        """The sum over each row's features."""
        return np.concatenate([np.bincount(row[lo:hi], per_feature[flat[lo:hi]], b - a) for a, b, lo, hi in parts])

    def spread(per_row: np.ndarray) -> np.ndarray:
        """The sum over each feature's rows."""
        return sum(np.bincount(flat[lo:hi], per_row[a:b][row[lo:hi]], len(used)) for a, b, lo, hi in parts)

    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    w, b, vel, vb = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    step = 4 / float((weight * (total(s * s) + 1)).sum())
    for k in range(rounds):
        m = k / (k + 3)
        lw, lb = w + m * vel, b + m * vb
        z = total(s * lw) + lb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        gw = s * spread(g) + penalty * lw
        nw, nb = lw - step * gw, lb - step * g.sum()
        vel, vb, w, b = nw - w, nb - b, nw, nb
    out = np.zeros(len(scale))
    out[used] = w * s
    return out, b


def sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
