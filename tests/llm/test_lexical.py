"""op11 against its SQL and against plain sums."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from check import comparable, connect
from tidemark.llm import catalog, lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    counted = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked: dict = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, own, n in counted:
            m = 25 + 75 * n * n_docs // length
            scored.append((-sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 8 * m)) for t, k in wanted.items() if t in own), i is not None, i or 0))
        best = sorted(s for s in scored if s[0] < 0)[:top]
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(best)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "id", "score").collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_sql(spark, folder):
    df = catalog.op11_lexical_search(spark, folder)
    ours = comparable(df.columns, df.collect())
    cursor = connect(folder).execute(catalog.ORACLES["op11_lexical_search"])
    assert ours == comparable([d[0] for d in cursor.description], cursor.fetchall()) and len(ours) > 100


def test_dirty_tables(spark, dirty):
    folder, docs = dirty
    rows = [(int(i), t if isinstance(t, str) else None) for i, t in zip(docs["doc_id"], docs["text"])]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(catalog.op11_lexical_search(spark, folder).withColumnRenamed("doc_id", "id")) == expected(rows, items)


def random_tables(seed):
    """A third of the documents are one text, many ties, repeated rows, null ids, a very long text."""
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3000)] + ["Zeit", "中文", "É"]
    docs = [(rng.randint(0, 500), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(400)]
    docs += [(1000 + i % 150, "same old words w1 w2") for i in range(200)] + [(None, "w1 w1 w3"), (None, None), (7, ""), (8, "w5 " * 200_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(40)] + [(3, "w1 w1 w1"), (40, None), (41, "nothing-of it"), (None, "old"), (None, "old")]
    return docs, items


@pytest.mark.parametrize(("bucket", "focus", "block", "partitions"), [(4096, 8, 8 << 20, 3), (16, 2, 600, 7), (5, 1, 2_000, 1)])
def test_small_buckets_and_blocks(spark, monkeypatch, bucket, focus, block, partitions):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "FOCUS", focus)
    docs, items = random_tables(partitions)
    frame = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double").repartition(partitions)
    out = lexical.rank(frame, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    assert found(out) == expected(docs, items)


def test_buckets_are_pruned():
    """The search looks into few buckets and sums few scores once it knows a good score."""
    import pandas as pd

    rng = np.random.default_rng(0)
    rows = pd.DataFrame({"item": ["a"] * 4, "place": [0] * 4, "term": ["p", "q", "r", "s"], "n": [1] * 4})
    queries = lexical.Queries(lexical.Block(rows), np.array([9000, 50, 40, 30]))
    search = lexical.Search(queries, np.array([1]), 10, lambda name: name)
    impacts = [rng.integers(1, 500_000, 3).astype(np.int32) for _ in range(2000)]
    vectors = [(np.array([0, 1, 2], np.int32), i) for i in impacts[:40]] + [(np.array([1, 2, 3], np.int32), i // 2) for i in impacts[40:]]
    vectors.sort(key=lambda v: -float(np.sum(v[1].astype(float) ** 2)))
    norm = np.array([math.sqrt(float(np.sum(v.astype(float) ** 2))) for _, v in vectors])
    for lo in range(0, 2000, 100):
        part = vectors[lo : lo + 100]
        search.bucket([f"{lo + i:04}" for i in range(len(part))], norm[lo : lo + 100], [t.tobytes() for t, _ in part], [v.tobytes() for _, v in part])
    assert len(search.best[0]) == 10 and search.scored < 400


def test_terms_with_equal_hashes_are_told_apart():
    """Words of one polynomial hash: a Thue-Morse sequence and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    v = lexical.Vocabulary([one, "c"])
    buf = np.frombuffer(f"{two} {one} c ".encode(), np.uint8)
    assert v.find(buf, np.array([0, 2049, 4098]), np.array([2048, 4097, 4099])).tolist() == [-1, 0, 1]
    both = lexical.Vocabulary([one, two])
    assert both.find(buf, np.array([0, 2049]), np.array([2048, 4097])).tolist() == [1, 0]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(docs.limit(0), items).count() == 0
    assert lexical.rank(docs, items.limit(0)).count() == 0
    assert found(lexical.rank(docs, items)) == expected([(1, "a")], [(1, "a")])
