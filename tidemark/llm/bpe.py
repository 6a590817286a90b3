"""Byte-level BPE: every distinct word of the corpus is encoded once."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from itertools import chain, count
from zlib import crc32

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import chunks
from tidemark.session import stage

MAX_RANKS = 1_000_000  # tokens of a vocabulary that is broadcast; ranks are below it
SHORT = 40  # bytes of a word whose pairs are searched in a list
#: Bytes of text for each bucket of words, and the least number of buckets.
BUCKET_BYTES, BUCKETS = 64 << 20, 32


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file; refused beyond MAX_RANKS tokens."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    if len(ranks) > MAX_RANKS or max(ranks.values(), default=0) >= MAX_RANKS:
        raise ValueError(f"{len(ranks)} tokens; a vocabulary may have {MAX_RANKS}, with ranks below that")
    return ranks


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the lowest-ranked neighbouring pair is merged until none is left.

    Short words look for the pair in a list. Others use a heap of pairs over a linked list, so
    that a word of n bytes takes n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= SHORT:
        get, none = ranks.get, MAX_RANKS
        parts = [word[i : i + 1] for i in range(n)]
        pairs = [get(word[i : i + 2], none) for i in range(n - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return [ranks[part] for part in parts]
    stop, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (rank := ranks.get(word[i : stop[j]])) is not None:
            heapq.heappush(heap, (rank, i, stop[j]))

    for i in range(n - 1):
        offer(i)
    gone = bytearray(n)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = nxt[i]
        if gone[i] or j >= n or stop[j] != end:
            continue
        gone[j], stop[i], nxt[i] = 1, end, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : stop[i]]])
        i = nxt[i]
    return out


def slices(batches, rows: int = 500):
    """Batches cut into runs of rows."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows].reset_index(drop=True)


def _by_upper(upper: np.ndarray) -> np.ndarray:
    """A stable order by the upper parts of numbers; 16 bits, which mostly do, are sorted faster."""
    return np.argsort(upper.astype(np.uint16) if not len(upper) or upper.max() < 1 << 16 else upper, kind="stable")


def _pack(numbers) -> bytes:
    """Numbers from 0 to 2^31, compressed: their upper bytes plane by plane, then their low bytes in the order of the upper ones."""
    numbers = np.asarray(numbers, np.int32)
    upper = numbers >> 8
    planes = upper.view(np.uint8).reshape(-1, 4).T[:3]
    return zstandard.compress(planes.tobytes() + (numbers & 255).astype(np.uint8)[_by_upper(upper)].tobytes(), 3)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    upper = planes[2].astype(np.int32)
    for plane in planes[1::-1]:
        upper = upper << 8 | plane
    low = np.empty_like(upper)
    low[_by_upper(upper)] = planes[3]
    return upper << 8 | low


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(size, dtype=np.int64)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)


def _first_seen(at: np.ndarray) -> np.ndarray:
    """Numbers given in order of first occurrence, with 0 at those places and number + 1 elsewhere."""
    coded = at + 1
    coded[1:][at[1:] > np.maximum.accumulate(at)[:-1]] = 0
    coded[:1] = 0
    return coded


def _seen(coded: np.ndarray) -> np.ndarray:
    fresh, at = coded == 0, coded - 1
    at[fresh] = np.arange(fresh.sum())
    return at


class _Ids(dict):
    """Ids by word; a word that is asked for the first time is encoded."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: bytes) -> list[int]:
        ids = self[word] = encode_word(word, self.ranks)
        return ids


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, block_chars: int = 12 << 20, bucket_bytes: int = BUCKET_BYTES, digests: bool = False) -> DataFrame:
    """(id, carried columns, ids array<int>) per row; with `digests` the columns of `digest` in place of ids.

    Rows of about `block_chars` characters are a block. A block's texts become numbers of its
    distinct words by position, and those words go, packed, to the bucket of their hash (one written
    table holds both). All blocks' words meet in the buckets, where each distinct word is encoded
    once; each pack is answered by the ids of its words in the same order, and a block puts its ids
    together by position. So a frequent word travels once for each block, not for each occurrence.
    There is a bucket for every `bucket_bytes` of text, so a bucket's words fit in a task at any
    size of the table, and no pack is empty. Null and empty texts have no ids; repeated rows stay;
    carried columns are passed on unchanged, also one named like the id.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary(path))
    buckets = max(BUCKETS, -(-(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // bucket_bytes))
    carried = F.struct(*carry) if carry else F.lit(None).cast("string")
    named = docs.select(F.struct(F.col(id_col).alias("id"), carried.alias("carried")).alias("row"), F.col(text_col).alias("text"))
    kind = named.schema["row"].dataType.simpleString()
    # a row per block with bucket -1 for its texts, and one for each bucket of its words
    schema = f"block long, bucket int, rows array<{kind}>, counts binary, owners binary, places binary, sizes binary, words binary"

    def number(batches):
        find, first = regex.compile(pattern).findall, TaskContext.get().partitionId() << 32
        for block, batch in enumerate(chunks(batches, limit=block_chars), first):
            if not len(batch):
                continue
            known: dict[str, int] = defaultdict(count().__next__)
            found = [np.fromiter(map(known.__getitem__, find(text) if isinstance(text, str) else ()), np.int32) for text in batch["text"]]
            counts, found = [len(at) for at in found], np.concatenate(found)
            words = [word.encode() for word in known]
            del known
            bucket = np.fromiter((crc32(word) % buckets for word in words), np.int32, len(words))
            texts = (block, -1, list(batch["row"]), _pack(counts), _pack(bucket), _pack(_first_seen(found)), None, None)
            order, packs = np.argsort(bucket, kind="stable"), []
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
                own = [words[i] for i in part.tolist()]
                packs.append((block, int(bucket[part[0]]), None, None, None, None, _pack([len(word) for word in own]), zstandard.compress(b"".join(own), 3)))
            yield pd.DataFrame([texts, *packs], columns=["block", "bucket", "rows", "counts", "owners", "places", "sizes", "words"])

    blocks = stage(named.mapInPandas(number, schema), "bpe-blocks")

    def encode_all(batches):
        coded, last = None, None
        for batch in slices(batches, 64):
            out = []
            for block, bucket, sizes, words in zip(batch["block"], batch["bucket"], batch["sizes"], batch["words"]):
                if bucket != last:
                    coded, last = _Ids(held.value), bucket
                text, ends = zstandard.decompress(words), np.cumsum(_unpack(sizes)).tolist()
                ids = [coded[text[a:b]] for a, b in zip([0, *ends], ends)]
                out.append((block, bucket, _pack([len(x) for x in ids]), _pack(np.fromiter(chain.from_iterable(ids), np.int32))))
            yield pd.DataFrame(out, columns=["own_block", "own_bucket", "lengths", "ids"])

    packs = blocks.where("bucket >= 0").select("block", "bucket", "sizes", "words")
    back = packs.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(encode_all, "own_block long, own_bucket int, lengths binary, ids binary")

    def assemble(left, right):
        text = left.iloc[0]
        owners, at = _unpack(text["owners"]), _seen(_unpack(text["places"]))
        size, start, flat = np.zeros_like(owners), np.zeros_like(owners), np.zeros(0, np.int32)
        if len(owners):
            right = right.sort_values("own_bucket")
            n, flat = (np.concatenate([_unpack(x) for x in right[c]]) for c in ("lengths", "ids"))
            order = np.argsort(owners, kind="stable")
            size[order], start[order] = n, np.cumsum(n, dtype=np.int64) - n
        texts = np.split(at, np.cumsum(_unpack(text["counts"]))[:-1])
        ids = (flat[_runs(start[spots], size[spots])] for spots in texts)
        if digests:
            return _digests(ids, held.value).assign(row=list(text["rows"]))
        return pd.DataFrame({"row": list(text["rows"]), "ids": list(ids)})

    texts = blocks.where("bucket < 0").select("block", "rows", "counts", "owners", "places")
    made = DIGESTS if digests else "ids array<int>"
    out = texts.groupBy("block").cogroup(back.groupBy("own_block")).applyInPandas(assemble, f"row {kind}, {made}")
    return out.select("row.id", *([f"row.carried.{c}" for c in carry or []]), *out.columns[1:])


def decode(encoded: DataFrame, path: str, carry: list[str] | None = None) -> DataFrame:
    """(id, carried columns, bytes binary): ids joined with the token-byte table, in order."""
    carry = carry or []
    held = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema.fields}
    picked = encoded.select("id", F.struct(*carry).alias("carried") if carry else F.lit(None).cast("string").alias("carried"), "ids")
    kind = picked.schema["carried"].dataType.simpleString()

    def run(batches):
        token = {i: b for b, i in held.value.items()}
        for batch in slices(batches):
            yield pd.DataFrame({"id": batch["id"], "carried": batch["carried"], "ids": batch["ids"], "bytes": [b"".join(map(token.__getitem__, ids)) for ids in batch["ids"]]})

    out = picked.mapInPandas(run, f"id {kinds['id']}, carried {kind}, ids array<int>, bytes binary")
    return out.select("id", *([f"carried.{c}" for c in carry]), "ids", "bytes")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, number of ids, and hashes of the ids and of the decoded bytes."""
    kind = decoded.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            yield pd.DataFrame({
                "doc_id": batch["id"],
                "n_tokens": [len(x) for x in batch["ids"]],
                "ids_sha256": [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in batch["ids"]],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in batch["bytes"]],
            })

    return decoded.select("id", "ids", "bytes").mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digests(texts, ranks: dict[bytes, int]) -> pd.DataFrame:
    """Number and hash of the ids of each text, and the hash of the bytes they decode to, piece by piece."""
    token = {i: word for word, i in ranks.items()}
    name = {i: str(i) for i in token}
    rows = []
    for ids in texts:
        numbers, data = hashlib.sha256(), hashlib.sha256()
        for at in range(0, len(ids), 1 << 16):
            part = ids[at : at + (1 << 16)].tolist()
            numbers.update(("," * (at > 0) + ",".join(map(name.__getitem__, part))).encode())
            data.update(b"".join(map(token.__getitem__, part)))
        rows.append((len(ids), numbers.hexdigest(), data.hexdigest()))
    return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])


def decoded_digest(encoded: DataFrame, path: str) -> DataFrame:
    """`digest` of `decode` in one pass over the ids: neither ids nor bytes leave the task for a second one."""
    kind = encoded.schema["id"].dataType.simpleString()
    held = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        for batch in batches:
            yield _digests(batch["ids"], held.value).assign(doc_id=batch["id"])

    return encoded.select("id", "ids").mapInPandas(run, f"doc_id {kind}, {DIGESTS}")


def encoded_digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`digest` of the decoded ids of every row, worked out where a block puts its ids together, so ids never leave that task."""
    return encode(docs, path, pattern, id_col, text_col, digests=True).withColumnRenamed("id", "doc_id")
