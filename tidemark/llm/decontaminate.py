"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ALNUM, LOWER, chunks, hashes, joined, mix, words
from tidemark.session import stage

STRIDE = 64  # start positions one search head covers


def _tables(items: pd.DataFrame, window: int) -> dict[int, dict]:
    """Search tables by pattern length in words."""
    buf, starts = joined(items["text"])
    buf = LOWER[buf]
    begin, end, first = words(buf, starts, ALNUM)
    h, data = hashes(buf, begin, end), buf.tobytes()
    by_length: dict[int, dict[tuple, set]] = {}
    for item, named, lo, hi in zip(items["item_id"].tolist(), items["named"].tolist(), first[:-1].tolist(), first[1:].tolist()):
        n = min(window, hi - lo)
        for at in range(lo, hi - n + 1) if n else ():
            key = tuple(data[begin[j] : end[j]] for j in range(at, at + n))
            by_length.setdefault(n, {}).setdefault((tuple(h[at : at + n].tolist()), key), set()).update([item] if named else [])
    out = {}
    for n, patterns in by_length.items():
        block = 2 if n > 1 else 1
        size = 1 << max(16, int(np.ceil(np.log2(len(patterns) * n * 16))))
        shift = np.full(size, n - block + 1, np.int8 if n < 127 else np.int64)
        grid = np.array([k[0] for k in patterns], np.uint64).reshape(len(patterns), n)
        for j in range(block - 1, n):
            np.minimum.at(shift, _block(grid, j, block, size), n - 1 - j)
        suffix = _code(grid)
        order = np.argsort(suffix, kind="stable")
        keys = list(patterns)
        out[n] = {"block": block, "shift": shift, "suffix": suffix[order], "words": [keys[i][1] for i in order], "items": [sorted(patterns[keys[i]], key=str) for i in order]}
    return out


def _block(h, j, block, size):
    x = h[..., j] if block == 1 else mix(h[..., j - 1] * np.uint64(0x9E3779B97F4A7C15) + h[..., j])
    return (x & np.uint64(size - 1)).astype(np.int64)


def _code(grid):
    out = np.zeros(len(grid), np.uint64)
    for j in range(grid.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + grid[:, j])
    return out


def _search(h: np.ndarray, table: dict, n: int, first: np.ndarray):
    """(place, index of the first pattern with its code) of places where a pattern may stand.

    Many search heads move at once, each over its own stretch of start positions; a head looks at
    the last words of its window and jumps as far as the shift table allows.
    """
    size, block = len(table["shift"]), table["block"]
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = _block(h, np.arange(len(h)), 1, size) if block == 1 else np.concatenate(([0], (mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) & np.uint64(size - 1)).astype(np.int64)))
    head = np.arange(0, len(h) - n + 1, STRIDE)
    limit = np.minimum(head + STRIDE, len(h) - n + 1)
    found = []
    while len(head):
        jump = table["shift"][code[head + n - 1]].astype(np.int64)
        found.append(head[jump == 0])
        head = head + np.maximum(jump, 1)
        alive = head < limit
        head, limit = head[alive], limit[alive]
    place = np.concatenate(found) if found else np.zeros(0, np.int64)
    text = np.searchsorted(first, place, side="right")
    place = place[place + n <= first[np.minimum(text, len(first) - 1)]]  # not across texts
    value = np.zeros(len(place), np.uint64)
    for j in range(n):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + h[place + j])
    at = np.searchsorted(table["suffix"], value)
    hit = (at < len(table["suffix"])) & (table["suffix"][np.minimum(at, len(table["suffix"]) - 1)] == value)
    return place[hit], at[hit]


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10, block_items: int = 5_000) -> DataFrame:
    """(id, n_words, spans, items) per row: hit word ranges [start, end) and the items found.

    `items` (item_id, text) is searched in blocks of `block_items` rows, each a bounded broadcast and
    one narrow pass over the documents, so any number of items is searched whole. Null and empty
    texts have no words and no hits; an item without words matches nothing; repeated rows stay. The
    windows of an item with a null id hit words, but it is not among the items found.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = f"id {kind}, text string, n_words long, starts array<long>, ends array<long>, items array<{item_kind}>"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("starts"), F.array().cast("array<long>").alias("ends"), F.array().cast(f"array<{item_kind}>").alias("items"))

    def searcher(held):
        def run(batches):
            tables = _tables(held.value, window)
            for batch in chunks(batches):
                buf, offsets = joined(batch["text"])
                buf = LOWER[buf]
                begin, end, first = words(buf, offsets, ALNUM)
                h, found = hashes(buf, begin, end), {}
                for n, table in tables.items():
                    for place, at in zip(*(x.tolist() for x in _search(h, table, n, first))):
                        own = tuple(buf[begin[j] : end[j]].tobytes() for j in range(place, place + n))
                        while at < len(table["suffix"]) and table["words"][at] != own and at + 1 < len(table["suffix"]) and table["suffix"][at + 1] == table["suffix"][at]:
                            at += 1
                        if table["words"][at] == own:
                            doc = int(np.searchsorted(first, place, side="right")) - 1
                            found.setdefault(doc, []).append((place - int(first[doc]), n, table["items"][at]))
                starts, ends, names = [list(x) for x in batch["starts"]], [list(x) for x in batch["ends"]], [list(x) for x in batch["items"]]
                for doc, hits in found.items():
                    spans = sorted([*zip(starts[doc], ends[doc]), *((a, a + n) for a, n, _ in hits)])
                    merged: list[list[int]] = []
                    for a, b in spans:
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    starts[doc], ends[doc] = [m[0] for m in merged], [m[1] for m in merged]
                    names[doc] = sorted({*names[doc], *(x for _, _, own in hits for x in own)}, key=str)
                yield pd.DataFrame({"id": batch["id"], "text": batch["text"], "n_words": np.diff(first), "starts": starts, "ends": ends, "items": names})

        return run

    # an item without an id is searched like any other, but has no name to report
    name = F.coalesce("item_id", F.lit("0").cast(item_kind)).alias("item_id")
    picked = items.select(name, F.col("item_id").isNotNull().alias("named"), "text").distinct()
    total = picked.count()
    blocks = max(1, -(-total // block_items))
    numbered = stage(picked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for k in range(blocks):
        out = out.mapInPandas(searcher(spark.sparkContext.broadcast(numbered.where(F.col("block") == k).drop("block").toPandas())), schema)
    return out.drop("text")


def verdicts(found: DataFrame) -> DataFrame:
    """The digest of `scan` per row: words, hit words, items, contaminated."""
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda t, x: t + x)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
