"""op12 against plain recomputation, and the block tables against all pairs."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import catalog, fingerprints
from tidemark.llm.text import hashes, mix, windows

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_fingerprint(text: str) -> str:
    """Votes term by term in dictionaries."""
    words = [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in WORDS.findall(text.encode())]
    h = []
    for w in words:
        buf = np.frombuffer(w + b"\n", np.uint8)
        h.append(hashes(buf, np.array([0]), np.array([len(w)]))[0])
    pairs = windows(np.array(h, np.uint64), 2)
    terms = Counter([(int(x) >> 12, 0) for x in h] + [(int(x) >> 12, 1) for x in pairs])
    votes = [0] * 128
    for (value, kind), n in terms.items():
        weight = (1 + kind) * (1 + int(math.log2(n)))
        for j in range(2):
            bits = int(mix(np.array([((value << 1 | kind) + 1) * 0x9E3779B97F4A7C15 + j & 2**64 - 1], np.uint64))[0])
            for i in range(64):
                votes[64 * j + i] += weight if bits >> i & 1 else -weight
    return f"{sum(1 << i for i, v in enumerate(votes) if v > 0):032x}"


def expected(rows):
    """By id, for rows with different ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    prints, out = {t: plain_fingerprint(t) for _, t in rows}, {}
    like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    ids = [r[0] for r in rows]
    for k, (i, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        new = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
        own, changed = prints[t], plain_fingerprint(new)
        near = sum((int(own, 16) ^ int(prints[u], 16)).bit_count() <= 3 for _, u in rows) - 1 if i % 20 == 0 else None
        out[i] = (len(t), hashlib.sha256(new.encode()).hexdigest(), own, changed, like(own, changed), like(own, prints[other]), near)
    assert len(out) == len(ids)
    return out


def test_against_plain_votes(spark, dirty):
    folder, docs = dirty
    rows = [(int(i), t if isinstance(t, str) else None) for i, t in zip(docs["doc_id"], docs["text"])]
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.n_near) for r in catalog.op12_fingerprints(spark, folder).collect()}
    assert got == expected(rows)


def test_ranges_of_many_tasks_and_repeated_rows(spark, tmp_path):
    """Nulls, repeated ids and rows, a third of all rows alike, a very long text, and a clashing column."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["la", "Le", "mi", "中文", "x1"], k=rng.randint(0, 40))), "p") for i in range(300)]
    rows += [(7, "seven", "p")] * 150 + [(None, "nobody", "p"), (None, None, "p"), (1000, "word " * 400_000, "p")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp0 string").repartition(9)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.op12_fingerprints(spark, str(tmp_path)).toPandas()
    assert len(out) == len(rows)
    ordered = sorted(((i, t or "") for i, t, _ in rows if i != 7 and i is not None), key=lambda r: -r[0])
    texts = dict(ordered)
    by_id = out[out["doc_id"].notna() & (out["doc_id"] != 7)].set_index("doc_id")
    for (i, t), (k, u) in zip(ordered, ordered[1:]):
        if {i, k} & {8, 6, 0}:
            continue  # beside repeated ids
        n = len(t) // 2
        assert by_id.loc[i, "edited_sha256"] == hashlib.sha256((t[: len(t) - n] + u[:n]).encode()).hexdigest()
    assert by_id.loc[1000, "fingerprint"] == plain_fingerprint(texts[1000])
    sevens = out[out["doc_id"] == 7]
    assert sevens["fingerprint"].nunique() == 2 and (sevens["edited_sha256"] == hashlib.sha256(b"sev" + b"se").hexdigest()).sum() >= 148


def test_one_document_and_none(spark, tmp_path):
    spark.createDataFrame([(20, "one two")], "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    (row,) = catalog.op12_fingerprints(spark, f"{tmp_path}/a").collect()
    assert row.edited_sha256 == hashlib.sha256(b"one one").hexdigest() and row.near_next == 1 and row.n_near == 0
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert catalog.op12_fingerprints(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("radius", [0, 2, 3, 6])
def test_block_tables_find_all(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(40)]
    rows = base + [b ^ sum(1 << k for k in rng.sample(range(128), rng.randint(1, 8))) for b in base for _ in range(12)]
    word = lambda x, j: (x >> 64 * j & 2**64 - 1) - (1 << 64 if x >> 64 * j + 63 & 1 else 0)
    pairs = [(word(x, 0), word(x, 1)) for x in rows]
    table = spark.createDataFrame(pairs * 2, "fp0 long, fp1 long")
    asked = spark.createDataFrame(pairs[::7], "q0 long, q1 long")
    found = [tuple(r) for r in fingerprints.within(asked, table, radius).collect()]
    want = {(*pairs[i], *pairs[j], (rows[i] ^ rows[j]).bit_count()) for i in range(0, len(rows), 7) for j in range(len(rows)) if (rows[i] ^ rows[j]).bit_count() <= radius}
    assert len(found) == len(set(found)) and set(found) == want


def test_fingerprints_of_the_operator(spark):
    rows = [(1, "A b"), (1, "A b"), (None, "a B"), (2, None), (3, "...")]
    out = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert out["fp0"].tolist()[:3] == [out["fp0"][0]] * 3 and out[["fp0", "fp1"]].iloc[3:].to_numpy().tolist() == [[0, 0]] * 2
    assert pd.isna(out["id"][2])


def test_edited_texts_are_more_alike_than_the_next(spark):
    out = catalog.op12_fingerprints(spark, "/root/testdata/sf0.01").toPandas()
    assert (out["near_edited"] > out["near_next"]).mean() > 0.98
