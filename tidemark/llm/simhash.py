"""SimHash near-duplicates by segment popcounts."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import LOWER, NONBLANK, chunks, joined, words
from tidemark.session import stage

BLOCKS = 8  # of 8 bits, each embedded as the popcounts of its two halves
CELL = 64  # distinct fingerprints that a cell compares pair by pair


def _fingerprint(values: np.ndarray) -> int:
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(bits * 2 > len(values), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) for every row, fp as a signed 64-bit number.

    Words are split at white space after A-Z are lower-cased; shingles keep their repeats. A text
    of fewer words is one shingle; null, empty and blank texts have fingerprint zero.
    """

    def run(batches):
        for batch in chunks(batches):
            buf, starts = joined(batch["text"])
            begin, end, first = words(buf, starts, NONBLANK)
            # words and single spaces between them, so that a shingle is one slice
            keep = NONBLANK[buf]
            keep[end] = True
            low = LOWER[buf].copy()
            low[end] = 32
            data = low[keep].tobytes()
            size = end - begin + 1
            stop = np.cumsum(size)
            origin = (stop - size).tolist()
            stop = (stop - 1).tolist()
            out, digest = np.zeros(len(batch), np.int64), xxhash.xxh64_intdigest
            for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                if lo < hi:
                    n = min(shingle, hi - lo)
                    values = [digest(data[a:b], 42) for a, b in zip(origin[lo : hi - n + 1], stop[lo + n - 1 : hi])]
                    out[i] = _fingerprint(np.array(values, np.uint64))
            yield pd.DataFrame({"id": batch["id"], "fp": out})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, fp long")


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) that connect all of the distinct `fp` within `distance` differing bits.

    A fingerprint becomes 16 popcounts, one for every 4 bits. Their Manhattan distance never
    exceeds the bit distance, so at most `distance` of the 8 blocks of two popcounts differ for a
    pair that links. There is one grid for each choice of blocks left out; its cells are the other
    blocks' popcounts. Pairs within a cell pass the bound, then the exact count of differing bits.
    A pair that several grids hold is compared in each; links are a set.

    A cell of more than CELL fingerprints (copies with small edits) is not compared pair by pair.
    Its members meet at shared neighbours: with distance d, every pair within d bits has a common
    point within ceil(d/2) flips of one and floor(d/2) of the other. The points are keys, and
    members of a key are linked to its smallest member after the exact count.
    """
    if not 1 <= distance <= 2:
        raise ValueError("distance must be 1 or 2")
    pops = [F.bit_count(F.col("fp").bitwiseAND(F.lit(int(np.int64(np.uint64(0xF << (4 * i) & (2**64 - 1))))))) for i in range(16)]
    code = lambda block: F.col(f"p{2 * block}") * 5 + F.col(f"p{2 * block + 1}")
    grids = []
    for n, left_out in enumerate(combinations(range(BLOCKS), distance)):
        cell = F.lit(n).cast("long")
        for block in range(BLOCKS):
            if block not in left_out:
                cell = cell * 25 + code(block)
        grids.append(cell)
    table = fps.select("fp", *[p.alias(f"p{i}") for i, p in enumerate(pops)])
    rows = table.select("fp", F.explode(F.array(*grids)).alias("cell"))
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("least")).where("n > 1")
    small = stage(rows.join(sizes.where(F.col("n") <= CELL), "cell").select("cell", "fp"), "cells")
    other = small.select("cell", F.col("fp").alias("b"))
    pops_of = lambda c: [F.bit_count(F.col(c).bitwiseAND(F.lit(int(np.int64(np.uint64(0xF << (4 * i) & (2**64 - 1))))))) for i in range(16)]
    bound = sum((F.abs(x - y) for x, y in zip(pops_of("a"), pops_of("b"))), F.lit(0))
    pairs = (
        small.withColumnRenamed("fp", "a").join(other, "cell").where("a < b").where(bound <= distance)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
    )
    dense = rows.join(sizes.where(F.col("n") > CELL), "cell").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(int(np.int64(np.uint64(1 << i)))) for i in range(64)])
    near = dense.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))
    heads = near.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    met = near.join(heads, "key").select("a", F.col("fp").alias("b"))
    stars = met.where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    if distance == 1:
        stars = near.select(F.col("key").alias("a"), F.col("fp").alias("b")).join(dense.select(F.col("fp").alias("a")), "a").where("a < b")
    return pairs.union(stars.select("a", "b")).distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(id, fingerprint, component_id) per row: the smallest id that links reach.

    Rows without text link like any other fingerprint zero. Repeated ids and rows stay; a null id
    is kept, and names a component only when no other member has an id. No rows give no rows.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fp")
    linked = components(links(least, distance)).withColumnRenamed("node", "fp")
    named = least.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(smallest, "component").select("fp", "component_id")
    return rows.join(names, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
