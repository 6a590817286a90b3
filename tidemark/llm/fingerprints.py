"""Document fingerprints: weighted SimHash of 128 bits, and a search within a Hamming radius by permuted block tables."""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ALNUM, LOWER, chunks, hashes, joined, mix, windows, words
from tidemark.session import stage

BITS = 128
#: Weight of a word and of two neighbouring words.
WORD, PAIR = 1, 2
_RUN = 1000  # terms whose votes fit into counters of 16 bits
_BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.uint16)
_COUNTERS = np.ascontiguousarray(_BITS_OF).view(np.uint64)  # a byte as eight counters of 16 bits, in two words


def simhash(texts: list) -> np.ndarray:
    """Fingerprints of at most 2,048 texts as rows of two 64-bit words.

    Terms are the words, A-Z lower-cased, and each two neighbouring words; a term that occurs n times
    weighs 1 + log2(n) times its kind's weight, whole part. Each term's hash votes for or against
    every bit. A null text is empty; a text without words has all bits 0.
    """
    buf, starts = joined(texts)
    begin, end, first = words(buf, starts, ALNUM)
    out = np.zeros((len(texts), BITS // 64), np.uint64)
    if not len(begin):
        return out
    word = hashes(LOWER[buf], begin, end)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    pair = windows(word, 2)
    same = text[1:] == text[:-1]
    # the text in the upper 11 bits, then the hash, the kind in the lowest bit
    code = lambda t, h, kind: (t << np.uint64(53)) | ((h >> np.uint64(12)) << np.uint64(1)) | np.uint64(kind)
    terms = np.sort(np.concatenate([code(text, word, 0), code(text[1:][same], pair[same], 1)]))
    at = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
    often = np.diff(np.append(at, len(terms)))
    terms = terms[at]
    owner = (terms >> np.uint64(53)).astype(np.int64)
    weight = np.where(terms & np.uint64(1), PAIR, WORD).astype(np.uint64) * (1 + np.log2(often).astype(np.uint64))
    opens = np.append(True, owner[1:] != owner[:-1])
    rank = np.arange(len(terms)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
    runs = np.flatnonzero(rank % _RUN == 0)
    texts_of_runs = np.flatnonzero(np.append(True, owner[runs][1:] != owner[runs][:-1]))
    total = np.add.reduceat(np.add.reduceat(weight.astype(np.int64), runs), texts_of_runs)
    bare = terms & np.uint64((1 << 53) - 1)
    for j in range(BITS // 64):
        hashed = mix((bare + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j))
        votes = _COUNTERS[hashed.view(np.uint8).reshape(-1, 8)].reshape(len(terms), 16) * weight[:, None]
        sums = np.add.reduceat(votes, runs, axis=0).view(np.uint16).astype(np.int64)
        ayes = np.add.reduceat(sums, texts_of_runs, axis=0)
        bits = np.packbits(2 * ayes > total[:, None], axis=1, bitorder="little")
        out[owner[runs][texts_of_runs], j] = bits.view(np.uint64).ravel()
    return out


def _hashed(texts: list) -> np.ndarray:
    parts = [simhash(texts[i : i + 2048]) for i in range(0, len(texts), 2048)]
    return np.concatenate(parts) if parts else np.zeros((0, BITS // 64), np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of rows of words."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def half_replaced(text: str, other: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of another text."""
    n = len(text) // 2
    return text[: len(text) - n] + other[:n]


def _columns(prefix: str, fps: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{prefix}{j}": fps[:, j].copy().view(np.int64) for j in range(fps.shape[1])}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp0, fp1) per row; see `simhash`. Null ids and repeated rows stay. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in chunks(batches, limit=1 << 20):
            yield pd.DataFrame({"id": batch["id"], **_columns("fp", _hashed(batch["text"].tolist()))})

    return named.mapInPandas(run, "id string, fp0 long, fp1 long").select(F.col("id").cast(kind).alias("id"), "fp0", "fp1")


_ROW = "id string, n_chars long, edited_sha256 string, fp0 long, fp1 long, edited0 long, edited1 long, near_edited double, near_next double"


def _compared(ids: list, texts: list, fps: np.ndarray, others: list, other_fps: np.ndarray) -> pd.DataFrame:
    """Each text beside its edited form and the text that follows it."""
    edited = [half_replaced(t, o) for t, o in zip(texts, others)]
    edited_fps = _hashed(edited)
    return pd.DataFrame({
        "id": ids, "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        **_columns("fp", fps), **_columns("edited", edited_fps), "near_edited": likeness(fps, edited_fps), "near_next": likeness(fps, other_fps),
    })


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, that of its text with half of the next row's, and their likeness.

    Rows are ordered by descending id, null ids last, rows of one id by a hash of the text; after the
    last row comes the first. They are dealt to tasks by ranges of that order, so each task meets the
    next text as the next row, and only the rows at the ends of tasks are matched afterwards. Rows
    of one id, or equal rows, may be in any number of tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("key"), F.asc("hash")]
    keyed = keyed.withColumn("hash", F.xxhash64("text"))
    dealt = keyed.repartitionByRange(*order, F.monotonically_increasing_id().asc()).sortWithinPartitions(*order)
    names = [c.split()[0] for c in _ROW.split(", ")]

    def run(batches):
        part, head, held = TaskContext.get().partitionId(), None, None
        for batch in chunks(batches, limit=1 << 20):
            ids, texts = batch["id"].tolist(), batch["text"].tolist()
            fps = _hashed(texts)
            if not texts:
                continue
            if head is None:
                head = (texts[0], fps[:1])
            if held is not None:
                ids, texts, fps = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], fps])
            held = (ids[-1], texts[-1], fps[-1:])
            if len(texts) > 1:
                yield _compared(ids[:-1], texts[:-1], fps[:-1], texts[1:], fps[1:]).assign(part=part, last=None, head=None)
        if held is not None:
            row = dict.fromkeys(names) | {"id": held[0], **{k: v[0] for k, v in _columns("fp", held[2]).items()}, **{k: v[0] for k, v in _columns("edited", head[1]).items()}}
            yield pd.DataFrame([row | {"part": part, "last": held[1], "head": head[0]}]).astype({c: "Int64" for c in ("n_chars",)})

    found = stage(dealt.select(F.col("key").cast("string").alias("id"), "text").mapInPandas(run, f"{_ROW}, part int, last string, head string"), "edited")
    ends = found.where("last IS NOT NULL")
    parts = sorted(r.part for r in ends.select("part").collect())  # one number for each task that had rows
    following = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, part_of int")
    # the first row of a task: its text in `head`, its fingerprint in the columns of the edited one
    heads = ends.select(F.col("part").alias("part_of"), F.col("head").alias("other"), F.col("edited0").alias("other0"), F.col("edited1").alias("other1"))
    met = ends.join(F.broadcast(following), "part").join(heads, "part_of").select("id", "last", "fp0", "fp1", "other", "other0", "other1")

    def finish(batches):
        for batch in batches:
            fps, others = (batch[[f"{c}0", f"{c}1"]].to_numpy(np.int64).view(np.uint64) for c in ("fp", "other"))
            yield _compared(batch["id"].tolist(), batch["last"].tolist(), fps, batch["other"].tolist(), others)

    rows = found.where("last IS NULL").select(*names).unionByName(met.mapInPandas(finish, _ROW))
    return rows.withColumn("id", F.col("id").cast(kind))


def _tables(radius: int) -> tuple[int, list[tuple[int, ...]]]:
    """Number of blocks, and the blocks that each table compares first."""
    if not 0 <= radius <= 14:
        raise ValueError("radius must be 0 to 14")
    blocks = next(b for b in (4, 8, 16) if b > radius)
    return blocks, list(combinations(range(blocks), blocks - radius))


def _block(word: str, k: int, blocks: int) -> Column:
    size = BITS // blocks
    column, at = F.col(f"{word}{k * size // 64}"), k * size % 64
    return F.shiftrightunsigned(column, at).bitwiseAND(F.lit((1 << size) - 1))


def within(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """(q0, q1, fp0, fp1, distance): all pairs of a query (q0, q1) and a table row (fp0, fp1) within `radius` differing bits.

    The 128 bits are 4, 8 or 16 blocks. A pair within the radius differs in that many blocks at
    most, so there is one table for each choice of the other blocks, permuted to the front as its
    key; a pair that meets in a table is compared exactly. It counts in the first table where it
    meets only, so no pair is seen twice. Both sides are made distinct, which bounds the partners of a query by the
    size of its Hamming ball however many copies there are. Empty inputs give no rows.
    """
    blocks, picks = _tables(radius)

    def keyed(df, a, b):
        distinct = df.select(F.col(a).alias("w0"), F.col(b).alias("w1")).distinct()
        keys = F.array(*[F.xxhash64(F.lit(n), *[_block("w", k, blocks) for k in pick]) for n, pick in enumerate(picks)])
        return distinct.select(F.col("w0").alias(a), F.col("w1").alias(b), F.posexplode(keys).alias("n", "key"))

    left = keyed(queries, "q0", "q1")
    right = keyed(table, "fp0", "fp1").withColumnRenamed("n", "n_of")
    met = left.join(right, "key").where("n = n_of").withColumns({"w0": F.col("q0").bitwiseXOR(F.col("fp0")), "w1": F.col("q1").bitwiseXOR(F.col("fp1"))})
    distance = F.bit_count("w0") + F.bit_count("w1")
    near = met.where(distance <= radius)
    # tables are in the order of their blocks: the first one that holds a pair has its least equal blocks
    equal = F.filter(F.array(*[F.when(_block("w", k, blocks) == 0, k) for k in range(blocks)]), lambda x: x.isNotNull())
    own = F.element_at(F.array(*[F.array(*map(F.lit, pick)) for pick in picks]), F.col("n") + 1)
    return near.where(F.slice(equal, 1, blocks - radius) == own).select("q0", "q1", "fp0", "fp1", distance.alias("distance"))


def hexed(prefix: str) -> Column:
    """A fingerprint as 32 lowercase hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.col(f"{prefix}{j}")), 16, "0") for j in reversed(range(BITS // 64))]))
