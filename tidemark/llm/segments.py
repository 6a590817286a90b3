"""Long repeats: routing pieces of text by content, and removing what earlier documents hold."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import chunks, hashes, joined
from tidemark.session import stage

#: Characters of text in a chunk; bytes of text for a bucket; of pieces from which a bucket is sliced, and of pieces in a slice.
CHUNK, BUCKET, LARGE, SLICE = 2 << 20, 5 << 19, 48 << 20, 8 << 20
_SHIPPED = "bucket int, chunk long, bytes long, contents int, data binary, meta binary"
_MARKS = "chunk long, row binary, lo binary, hi binary"


def packed(docs: DataFrame) -> DataFrame:
    """`docs` (id, text) as a written table of chunks: some CHUNK characters of whole texts and one text at least, compressed."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in chunks(batches, limit=CHUNK):
            if len(batch):
                buf, starts = joined(batch["text"])
                ids, lost = batch["id"].to_numpy(np.int64), batch["lost"].to_numpy(bool)
                yield pd.DataFrame({"size": [int(starts[-1])], "ids": [ids.tobytes()], "lost": [lost.tobytes()], "starts": [starts.tobytes()], "text": [pack(buf.tobytes())]})

    rows = docs.select(F.coalesce("id", F.lit(0)).cast("long").alias("id"), F.col("id").isNull().alias("lost"), "text")
    made = rows.mapInPandas(run, "size long, ids binary, lost binary, starts binary, text binary")
    return stage(made.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def bucket_count(chunked: DataFrame) -> int:
    """One bucket for each BUCKET bytes of text, and 32 at least."""
    return max(32, (chunked.agg(F.sum("size")).first()[0] or 0) // BUCKET)


def _opened(row):
    """Buffer, starts, ids and null-id flags of a chunk."""
    buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.text), np.uint8)
    return buf, np.frombuffer(row.starts, np.int64), np.frombuffer(row.ids, np.int64), np.frombuffer(row.lost, bool)


def _units_of(row, pieces: Callable, buckets: int):
    """Units of the texts of a chunk that have an id, and their tokens: the bucket of the key and 32 bits of each check."""
    buf, starts, ids, lost = _opened(row)
    *unit, checks = pieces(buf, starts)
    key, begin, end, text, place = unit
    stay = ~lost[text]
    key, begin, end, text, place, checks = (x[stay] for x in (key, begin, end, text, place, checks))
    bucket = (key >> np.uint64(20)) % np.uint64(buckets)
    return buf, ids, bucket, (bucket << np.uint64(32))[:, None] | (checks >> np.uint64(32)), key, begin, end, text, place


def _heads(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])


def _gathered(buf, begin, size):
    """Slices of the buffer one after the other."""
    stop = np.cumsum(size)
    return buf[np.repeat(begin - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]


def distinct(buf: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """A representative for each distinct slice, and the number of its representative for each slice.

    Slices of one hash are compared with the first of them byte for byte; those that differ are told apart by their bytes.
    """
    size = (end - begin).astype(np.int64)
    h = hashes(buf, begin, end)
    order = np.argsort(h, kind="stable")
    head = _heads(h[order])
    number = np.zeros(len(h), np.int64)
    number[order] = np.cumsum(np.isin(np.arange(len(h)), head)) - 1
    rep = order[head]
    other = np.flatnonzero(rep[number] != np.arange(len(h)))
    wrong = size[other] != size[rep[number[other]]]
    alike = other[~wrong]
    if len(alike):
        differ = _gathered(buf, begin[alike], size[alike]) != _gathered(buf, begin[rep[number[alike]]], size[alike])
        wrong[~wrong] = np.add.reduceat(differ, np.append(0, np.cumsum(size[alike])[:-1])) > 0
    named: dict[bytes, int] = {}
    own = []
    for i in other[wrong].tolist():
        name = buf[begin[i] : end[i]].tobytes()
        if name not in named:
            named[name] = len(rep) + len(own)
            own.append(i)
        number[i] = named[name]
    return np.append(rep, np.array(own, np.int64)), number


def shared_keys(chunked: DataFrame, pieces: Callable, buckets: int) -> DataFrame:
    """(bucket, chunk, keys): 32 bits of the checks of a chunk that stand in another chunk, or in two texts of this one."""

    def keys(batches):
        for batch in batches:
            for row in batch.itertuples():
                _, _, _, token, _, _, _, text, _ = _units_of(row, pieces, buckets)
                if not len(token):
                    continue
                text, token = np.repeat(text, token.shape[1]), token.reshape(-1)
                order = np.argsort(token, kind="stable")
                text, token = text[order], token[order]
                head = _heads(token)
                many = np.maximum.reduceat(text, head) != np.minimum.reduceat(text, head)
                token = token[head]
                bucket = (token >> np.uint64(32)).astype(np.int32)
                edge = _heads(bucket)
                cut = lambda x: [part.tobytes() for part in np.split(x, edge[1:])]
                yield pd.DataFrame({"bucket": bucket[edge], "chunk": row.chunk, "keys": cut(token.astype(np.uint32)), "many": cut(many)})

    def meet(frame):
        key = np.frombuffer(b"".join(frame["keys"]), np.uint32)
        many = np.frombuffer(b"".join(frame["many"]), bool)
        row = np.repeat(np.arange(len(frame)), frame["many"].map(len))
        order = np.argsort(key, kind="stable")
        head = _heads(key[order])
        count = np.diff(np.append(head, len(key)))
        shared = np.zeros(len(key), bool)
        shared[order] = np.repeat((count > 1) | np.logical_or.reduceat(many[order], head), count)
        key, row = key[shared], row[shared]
        edge = _heads(row)
        parts = [part.tobytes() for part in np.split(key, edge[1:])][: len(edge)]
        return pd.DataFrame({"bucket": frame["bucket"].to_numpy()[row[edge]], "chunk": frame["chunk"].to_numpy()[row[edge]], "keys": pd.Series(parts, dtype=object)})

    cut = chunked.mapInPandas(keys, "bucket int, chunk long, keys binary, many binary")
    return cut.groupBy("bucket").applyInPandas(meet, "bucket int, chunk long, keys binary")


def shipped(chunked: DataFrame, pieces: Callable, buckets: int) -> DataFrame:
    """Pieces of units with a shared check, a row for each chunk and bucket: distinct contents once, and where they stand.

    `pieces(buf, starts)` gives (key, begin, end, text, place, checks) of units in the order of the text. Equal windows
    have one key and stand in units that have a check in common.
    """

    def ship(mine, wanted):
        none = pd.DataFrame({c.split()[0]: [] for c in _SHIPPED.split(", ")})
        if not len(mine) or not len(wanted):
            return none
        row = next(mine.itertuples())
        buf, ids, bucket, token, key, begin, end, text, place = _units_of(row, pieces, buckets)
        check = np.concatenate([np.frombuffer(k, np.uint32) for k in wanted["keys"]]).astype(np.uint64)
        asked = np.repeat(wanted["bucket"].to_numpy().astype(np.uint64), wanted["keys"].map(len) // 4) << np.uint64(32) | check
        take = np.flatnonzero(np.isin(token, asked).any(axis=1))
        if not len(take):
            return none
        bucket, key, begin, end, text, place = (x[take] for x in (bucket.astype(np.int64), key, begin, end, text, place))
        # units of one key that follow each other are one piece
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (np.diff(place) != 1)))
        end = end[np.append(first[1:], len(key)) - 1]
        bucket, begin, text, place = bucket[first], begin[first], text[first], place[first]
        rep, number = distinct(buf, begin, end)
        bucket = bucket[rep][number]  # equal contents have one key, so one bucket
        at = np.argsort(bucket[rep], kind="stable")
        rep, number = rep[at], np.argsort(at)[number]
        order = np.argsort(bucket[rep][number], kind="stable")
        number, who, row_of, place = number[order], ids[text[order]], text[order].astype(np.int32), place[order].astype(np.int32)
        size = (end - begin)[rep].astype(np.int64)
        data = _gathered(buf, begin[rep], size)
        stop = np.append(0, np.cumsum(size))
        names = np.unique(bucket[rep])
        c = np.searchsorted(bucket[rep], np.append(names, names[-1] + 1))
        o = np.searchsorted(bucket[rep][number], np.append(names, names[-1] + 1))
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for i, name in enumerate(names.tolist()):
            a, b, x, y = c[i], c[i + 1], o[i], o[i + 1]
            meta = size[a:b].astype(np.int32).tobytes() + who[x:y].tobytes() + (number[x:y] - a).astype(np.int32).tobytes() + row_of[x:y].tobytes() + place[x:y].tobytes()
            text_bytes = int(stop[b] - stop[a])
            rows.append((name, row.chunk, text_bytes + len(meta), int(b - a), pack(data[stop[a] : stop[b]].tobytes()), pack(meta)))
        return pd.DataFrame(rows, columns=none.columns)

    wanted = shared_keys(chunked, pieces, buckets)
    return chunked.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInPandas(ship, _SHIPPED)


def _contents(frame: pd.DataFrame):
    """Distinct contents of the rows of a bucket, and for each place its content, id, chunk, row and place."""
    unpack = zstandard.ZstdDecompressor().decompress
    size, who, number, row, place, many, base = [], [], [], [], [], [], 0
    for contents, meta in zip(frame["contents"].tolist(), frame["meta"]):
        meta = unpack(meta)
        n = (len(meta) - 4 * contents) // 20
        at = 4 * contents
        size.append(np.frombuffer(meta, np.int32, contents))
        who.append(np.frombuffer(meta, np.int64, n, at))
        number.append(np.frombuffer(meta, np.int32, n, at + 8 * n) + base)
        row.append(np.frombuffer(meta, np.int32, n, at + 12 * n))
        place.append(np.frombuffer(meta, np.int32, n, at + 16 * n))
        many.append(n)
        base += contents
    data = np.frombuffer(b"".join(unpack(d) for d in frame["data"]), np.uint8)
    end = np.cumsum(np.concatenate(size).astype(np.int64))
    begin = np.append(0, end[:-1])
    rep, same = distinct(data, begin, end)
    n = (end - begin)[rep]
    stop = np.cumsum(n)
    chunk = np.repeat(frame["chunk"].to_numpy(), many)
    return _gathered(data, begin[rep], n), stop - n, stop, same[np.concatenate(number)], np.concatenate(who), chunk, np.concatenate(row), np.concatenate(place).astype(np.int64)


def _compared(frame: pd.DataFrame, windows: Callable, named: bool):
    """The opened bucket, the windows of its distinct contents, and the least and greatest id of each content."""
    opened = _contents(frame)
    data, begin, end, content, who = opened[:5]
    group, piece, offset, name = windows(data, begin, end, np.arange(len(begin)), np.zeros(len(begin), np.int64), named)
    low, high = np.full(len(begin), np.iinfo(np.int64).max), np.full(len(begin), np.iinfo(np.int64).min)
    np.minimum.at(low, content, who)
    np.maximum.at(high, content, who)
    return opened, group, piece, offset, name, low, high


def _marked(opened, piece, offset, owner, high, width):
    """Ranges of the places whose id is above the owner of a window, as rows per chunk."""
    _, _, _, content, who, chunk, row, place = opened
    use = np.flatnonzero(owner < high[piece])
    use = use[np.lexsort((offset[use], piece[use]))]
    piece, offset, owner = piece[use], offset[use], owner[use]
    new = np.append(True, (np.diff(piece) != 0) | (np.diff(offset) != 1) | (owner[1:] != owner[:-1]))[: len(use)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(use))[: len(first)] - 1
    piece, lo, hi, owner = piece[first], offset[first], offset[last] + width, owner[first]
    # every place of a content meets the ranges of the content
    from_, to = np.searchsorted(piece, content, "left"), np.searchsorted(piece, content, "right")
    n = to - from_
    at = np.repeat(np.arange(len(content)), n)
    run = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(from_, n)
    hit = who[at] > owner[run]
    at, run = at[hit], run[hit]
    chunk, row, lo, hi = chunk[at], row[at], place[at] + lo[run], place[at] + hi[run]
    order = np.lexsort((lo, row, chunk))
    chunk, row, lo, hi = (x[order] for x in (chunk, row, lo, hi))
    edge = _heads(chunk)
    cut = lambda x: pd.Series([part.astype(np.int32).tobytes() for part in np.split(x, edge[1:])][: len(edge)], dtype=object)
    return pd.DataFrame({"chunk": chunk[edge], "row": cut(row), "lo": cut(lo), "hi": cut(hi)})


def chunk_marks(chunked: DataFrame, pieces: Callable, buckets: int, windows: Callable, width: int) -> DataFrame:
    """(chunk, row, lo, hi) of the windows that a smaller id holds as well.

    Checks go first: 32 bits of each, once for a chunk; only units with a check that another text has travel, equal
    pieces of a chunk once. A bucket compares the distinct contents of its pieces. `windows(data, begin, end, doc, place, named)`
    gives (group, doc, place) of each window, equal windows with one number from 0 on, and 128 bits of content for
    each number where `named`. A bucket above LARGE bytes is dealt into slices by chunk: each gives a row for each of
    its distinct windows, Spark finds the least id of a window, and that goes back to the slices. Between slices,
    windows are equal by 128 bits of hash (about 2**-128 a pair); within a bucket or slice they are compared whole.
    """
    dealt = stage(shipped(chunked, pieces, buckets), "pieces")
    size = dealt.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > LARGE)
    big = stage(size.select("bucket", F.ceil(F.col("bytes") / SLICE).cast("int").alias("slices")), "pieces-big")

    def whole(frame):
        opened, group, piece, offset, _, low, high = _compared(frame, windows, False)
        least = np.full(int(group.max()) + 1 if len(group) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, group, low[piece])
        return _marked(opened, piece, offset, least[group], high, width)

    if big.isEmpty():
        return dealt.groupBy("bucket").applyInPandas(whole, _MARKS)
    small = dealt.join(F.broadcast(big.select("bucket")), "bucket", "left_anti")  # at most bytes / LARGE numbers
    dealt = dealt.join(F.broadcast(big), "bucket").withColumn("slice", F.pmod(F.xxhash64("chunk"), F.col("slices")).cast("int"))

    def of_slice(frame):
        _, group, piece, _, name, low, high = _compared(frame, windows, True)
        least, most = np.full(len(name), np.iinfo(np.int64).max), np.full(len(name), np.iinfo(np.int64).min)
        np.minimum.at(least, group, low[piece])
        np.maximum.at(most, group, high[piece])
        return pd.DataFrame({"bucket": frame["bucket"].iloc[0], "slice": frame["slice"].iloc[0], "one": name[:, 0], "two": name[:, 1], "least": least, "most": most})

    def sliced(frame, owners):
        if not len(frame) or not len(owners):
            return pd.DataFrame({c.split()[0]: [] for c in _MARKS.split(", ")})
        opened, group, piece, offset, name, _, high = _compared(frame, windows, True)
        owner = pd.DataFrame({"one": name[:, 0], "two": name[:, 1]}).merge(owners[["one", "two", "owner"]], "left", ["one", "two"])
        known = owner["owner"].notna().to_numpy()
        least = np.full(len(name), np.iinfo(np.int64).max)
        least[known] = owner["owner"][known].astype(np.int64)
        return _marked(opened, piece, offset, least[group], high, width)

    found = stage(dealt.groupBy("bucket", "slice").applyInPandas(of_slice, "bucket int, slice int, one long, two long, least long, most long"), "windows")
    owned = found.groupBy("bucket", "one", "two").agg(F.min("least").alias("owner"), F.max("most").alias("last")).where("owner < last")
    owners = found.join(owned, ["bucket", "one", "two"]).where("most > owner").select("bucket", "slice", "one", "two", "owner")
    many = dealt.groupBy("bucket", "slice").cogroup(owners.groupBy("bucket", "slice")).applyInPandas(sliced, _MARKS)
    return small.groupBy("bucket").applyInPandas(whole, _MARKS).unionByName(many)


def _per_text(chunked: DataFrame, found: DataFrame, of: Callable, schema: str) -> DataFrame:
    """A row for each text: its id and the columns `of(text, ranges)` of `schema`, its ranges sorted and merged."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(mine, marks):
        if not len(mine):
            return pd.DataFrame({c: [] for c in ["id", *names]})
        buf, starts, ids, lost = _opened(next(mine.itertuples()))
        get = lambda c: np.frombuffer(b"".join(marks[c]), np.int32).astype(np.int64)
        who, lo, hi = merged(get("row"), get("lo"), get("hi"))
        first = np.searchsorted(who, np.arange(len(ids) + 1))
        rows = []
        for i in range(len(ids)):
            a, b = first[i], first[i + 1]
            rows.append(of(buf[starts[i] : starts[i + 1] - 1].tobytes().decode(), list(zip(lo[a:b].tolist(), hi[a:b].tolist()))))
        out = pd.DataFrame(rows, columns=names)
        out.insert(0, "id", pd.arrays.IntegerArray(ids.copy(), lost.copy()))
        return out

    return chunked.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(run, f"id long, {schema}")


def marks(docs: DataFrame, pieces: Callable, buckets: int, windows: Callable, width: int) -> DataFrame:
    """(id, starts, ends) of the rows of `docs` (id, text) that share windows with a smaller id."""
    chunked = packed(docs)
    ranges = lambda _, found: ([lo for lo, _ in found], [hi for _, hi in found])
    return _per_text(chunked, chunk_marks(chunked, pieces, buckets, windows, width), ranges, "starts array<long>, ends array<long>").where(F.size("starts") > 0)


def dedup(docs: DataFrame, pieces: Callable, windows: Callable, width: int, digest: Callable, schema: str) -> DataFrame:
    """Every row of `docs` (id, text): its id and `digest(text, ranges)`, a null text being empty."""
    chunked = packed(docs)
    return _per_text(chunked, chunk_marks(chunked, pieces, bucket_count(chunked), windows, width), digest, schema)


def merged(who: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Ranges of each owner, sorted, with those that touch made one."""
    if not len(who):
        return who, lo, hi
    order = np.lexsort((lo, who))
    who, lo, hi = who[order], lo[order], hi[order]
    owner = np.cumsum(np.append(True, who[1:] != who[:-1])) - 1
    span = int(hi.max()) + 2
    reach = np.maximum.accumulate(hi + owner * span)
    new = np.append(True, (lo + owner * span)[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return who[at], lo[at], (reach[np.append(at[1:], len(reach)) - 1] - owner[at] * span)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
