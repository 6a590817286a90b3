"""Every query against a plain recomputation."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import tiktoken
import xxhash

from tidemark.llm import catalog, neighbours

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda b: hashlib.sha256(b).hexdigest()


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def closure(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_license_scan(spark, dirty):
    folder, docs = dirty
    got = rows_of(catalog.op1_license_scan(spark, folder))
    assert len(got) == len(docs)
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for i, text in zip(docs["doc_id"], docs["text"]):
        words = WORD.findall((text or "").translate(UP))
        found = [(at, label) for p, label in phrases.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        row = got[i]
        assert (row.n_words, row.n_base) == (len(words), len(found)), i
        assert row.base_labels == ",".join(sorted({x for _, x in found}))
        assert (row.first_word, row.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert {x for _, x in found} <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_byte_bpe(spark, dirty):
    folder, docs = dirty
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(catalog.TOKENS, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(catalog.op2_byte_bpe(spark, folder))
    assert len(got) == len(docs)
    for i, text in zip(docs["doc_id"], docs["text"]):
        ids = coder.encode_ordinary(text or "")
        assert got[i][1:] == (len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())), (i, text[:50])


def test_one_pass_digests_what_decoding_gives(spark, dirty):
    folder, _ = dirty
    ids = catalog.bpe.encode(spark.read.parquet(f"{folder}/documents.parquet"), catalog.TOKENS, P.PATTERN)
    two = catalog.bpe.digest(catalog.bpe.decode(ids, catalog.TOKENS))
    assert sorted(map(tuple, catalog.bpe.decoded_digest(ids, catalog.TOKENS).collect())) == sorted(map(tuple, two.collect()))


def test_words_split_over_small_blocks_and_answers(spark, dirty):
    folder, docs = dirty
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(catalog.TOKENS, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        ids = catalog.bpe.encode(spark.read.parquet(f"{folder}/documents.parquet"), catalog.TOKENS, P.PATTERN, carry=["source", "text"], block_chars=3000, bucket_bytes=500)
        got = {row.id: row for row in ids.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(docs)
    for i, text, source in zip(docs["doc_id"], docs["text"], docs["source"]):
        assert (got[i].ids, got[i].text, got[i].source) == (coder.encode_ordinary(text or ""), text, source)


def _repeats(docs, units, n):
    least = {}
    for i, u in units.items():
        for at in range(len(u) - n + 1):
            key = u[at : at + n] if isinstance(u, bytes) else tuple(u[at : at + n])
            least[key] = min(least.get(key, i), i)
    out = {}
    for i, u in units.items():
        hit = np.zeros(len(u), bool)
        for at in range(len(u) - n + 1):
            key = u[at : at + n] if isinstance(u, bytes) else tuple(u[at : at + n])
            if least[key] < i:
                hit[at : at + n] = True
        out[i] = hit
    return out


def test_suffix_dedup(spark, dirty):
    folder, docs = dirty
    units = {i: (t or "").encode() for i, t in zip(docs["doc_id"], docs["text"])}
    got = rows_of(catalog.op4_suffix_dedup(spark, folder))
    removed = 0
    for i, hit in _repeats(docs, units, 50).items():
        left = np.frombuffer(units[i], np.uint8)[~hit].tobytes()
        spans = int((np.diff(hit.astype(int), prepend=0) == 1).sum())
        assert got[i][1:] == (len(hit), int(hit.sum()), spans, sha(left)), i
        removed += hit.sum()
    assert removed > 1000 and len(got) == len(docs)


def test_substring_dedup(spark, dirty):
    folder, docs = dirty
    units = {i: BLANK.findall(t or "") for i, t in zip(docs["doc_id"], docs["text"])}
    got = rows_of(catalog.op8_substring_dedup(spark, folder))
    removed = 0
    for i, hit in _repeats(docs, units, 13).items():
        left = " ".join(w for w, h in zip(units[i], hit) if not h)
        assert got[i][1:] == (len(hit), int(hit.sum()), sha(left.encode())), i
        removed += hit.sum()
    assert removed > 200 and len(got) == len(docs)


def test_decontaminate(spark, dirty):
    folder, docs = dirty
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    windows = {}
    for r in items:
        words = WORD.findall((r.text or "").translate(UP))
        n = min(10, len(words))
        for at in range(len(words) - n + 1) if n else ():
            windows.setdefault(tuple(words[at : at + n]), set()).add(r.item_id)
    got = rows_of(catalog.op9_decontaminate(spark, folder))
    for i, text in zip(docs["doc_id"], docs["text"]):
        words = WORD.findall((text or "").translate(UP))
        hit, names = np.zeros(len(words), bool), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if own := windows.get(tuple(words[at : at + n])):
                    hit[at : at + n] = True
                    names |= own
        want = (len(words), int(hit.sum()), len(names), sha(",".join(sorted(map(str, names))).encode()), bool(hit.any()))
        assert got[i][1:] == want, i


def test_simhash(spark, dirty):
    folder, docs = dirty
    prints = {}
    for i, text in zip(docs["doc_id"], docs["text"]):
        words = BLANK.findall((text or "").translate(UP))
        n = min(3, len(words))
        h = [xxhash.xxh64_intdigest(" ".join(words[a : a + n]).encode(), 42) for a in range(len(words) - n + 1)] if n else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = list(prints)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = closure(ids, linked)
    got = rows_of(catalog.op10_simhash(spark, folder))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


def test_embeddings(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    got = rows_of(catalog.op6_embedding_dedup(spark, folder), "vec_id")
    x = np.stack(table["embedding"].to_list()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & (table["label"].to_numpy()[:, None] == table["label"].to_numpy()[None, :])
    np.fill_diagonal(near, False)
    ids = table["vec_id"].tolist()
    want = closure(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (int(n), want[i]) for i, n in zip(ids, near.sum(axis=1))}


def planted_pairs(n, pairs, low, high):
    """n unit vectors; number i and pairs + i have a cosine between low and high, no others are near."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    cos = rng.uniform(low, high, (pairs, 1))
    off = rng.standard_normal((pairs, 64))
    off -= (off * x[:pairs]).sum(axis=1)[:, None] * x[:pairs]
    x[pairs : 2 * pairs] = cos * x[:pairs] + np.sqrt(1 - cos * cos) * off / np.linalg.norm(off, axis=1)[:, None]
    return x


def test_embedding_recall(spark):
    n, pairs = 20000, 2000
    x = planted_pairs(n, pairs, 0.9301, 0.95)
    near = {(b, a) for at in range(0, n, 2000) for a, b in zip(*(y + z for y, z in zip(np.nonzero(x[at : at + 2000] @ x.T >= 0.93), (at, 0)))) if a < b}
    assert len(near) == pairs
    table = spark.createDataFrame(list(zip(range(n), x.tolist())), "v long, embedding array<double>").selectExpr("v", "1 AS label", "embedding")
    # a narrow window stands for a label of many more vectors
    got = {(r.a, r.b) for r in neighbours.links(table, window=2).collect()}
    assert got <= near and len(got) >= 0.985 * pairs


def test_passes_follow_the_size():
    assert [neighbours.passes_for(n, 0.93, 24, 0.99) for n in (0, 24, 1000)] == [16, 16, 16]
    x = planted_pairs(200000, 10000, 0.9301, 0.9301)
    hit = np.zeros(10000, bool)
    for key in neighbours.keys_of(x, neighbours.passes_for(len(x), 0.93, 24, 0.99)):
        place = np.argsort(np.argsort(key, kind="stable"))
        hit |= abs(place[:10000] - place[10000:20000]) <= 24
    assert hit.mean() >= 0.985


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in catalog.op5_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    assert right >= 0.9 * len(rows)
