"""Ranked lexical search: the documents of highest integer score for each item, by norm buckets.

A document is a vector of term impacts, an item a vector of term weights, the score their product.
Vectors are ordered by length and cut into buckets. With a score that at least ten documents reach,
the Cauchy-Schwarz inequality passes over whole buckets for an item; inside a bucket bounds on its
coordinates, then the product over the item's heaviest terms and the length of what remains, leave
few documents, whose scores are summed in integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import ALNUM, LOWER, chunks, hashes, joined, words
from tidemark.session import stage

#: Documents of a bucket; terms of an item whose product is formed first.
BUCKET, FOCUS = 4096, 8
#: Bytes of item terms that are searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
#: One document in so many is searched first, for scores to prune by. Exact whatever the number.
SEED = 16
_SLACK = 1 + 1e-9  # bounds are in doubles, scores are integers


class Vocabulary:
    """Terms of a block of items, looked up by hash and then compared byte by byte."""

    def __init__(self, terms: list[str]):
        buf, starts = joined(terms)
        begin, end = starts[:-1], starts[1:] - 1
        h = hashes(buf, begin, end)
        order = np.argsort(h, kind="stable")
        self.buf, self.begin, self.end, self.hash = buf, begin, end, h[order]
        self.order, self.same = order, int(np.max(np.diff(np.append(np.flatnonzero(np.append(True, np.diff(h[order]) != 0)), len(h))), initial=1))

    def find(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of the term that each slice of the buffer is, or -1."""
        out = np.full(len(begin), -1, np.int64)
        if not len(self.hash):
            return out
        h = hashes(buf, begin, end)
        at = np.searchsorted(self.hash, h)
        for step in range(self.same):  # terms with one hash stand side by side
            here = np.minimum(at + step, len(self.hash) - 1)
            term = self.order[here]
            maybe = np.flatnonzero((out < 0) & (self.hash[here] == h) & (self.end[term] - self.begin[term] == end - begin))
            n = (end - begin)[maybe]
            stop = np.cumsum(n)
            inner = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - n, n)
            differ = buf[np.repeat(begin[maybe], n) + inner] != self.buf[np.repeat(self.begin[term[maybe]], n) + inner]
            equal = np.add.reduceat(differ, stop - n) == 0 if len(n) else np.zeros(0, bool)
            out[maybe[equal]] = term[maybe[equal]]
        return out


class Block:
    """The items of one block: names, terms and how often each occurs, by item."""

    def __init__(self, rows: pd.DataFrame):
        terms = sorted(rows["term"].unique())
        self.vocabulary = Vocabulary(terms)
        number = {t: i for i, t in enumerate(terms)}
        rows = rows.sort_values("place", kind="stable")
        self.items = rows["item"].drop_duplicates().tolist()
        self.first = np.flatnonzero(np.append(True, np.diff(rows["place"].to_numpy()) != 0)) if len(rows) else np.zeros(0, int)
        self.term = rows["term"].map(number).to_numpy(np.int64)
        self.times = rows["n"].to_numpy(np.int64)
        self.size = len(terms)


class Queries:
    """Weight vectors of the items of a block, heaviest terms first, with their lengths."""

    def __init__(self, block: Block, weight: np.ndarray):
        self.items, self.size, self.focus = block.items, block.size, FOCUS
        last = np.append(block.first[1:], len(block.term))
        self.term, self.value, self.rest = [], [], []
        for lo, hi in zip(block.first, last):
            value = weight[block.term[lo:hi]] * block.times[lo:hi]
            order = np.argsort(-value, kind="stable")
            order = order[value[order] > 0]
            self.term.append(block.term[lo:hi][order])
            self.value.append(value[order])
            self.rest.append(math.sqrt(float(np.sum(value[order][FOCUS:].astype(float) ** 2))))
        self.norm = np.array([math.sqrt(float(np.sum(v.astype(float) ** 2))) for v in self.value])


def _counted(docs: DataFrame, held, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf) of every document with a term: its length, and its terms of the vocabulary, packed."""
    named = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        vocabulary: Vocabulary = held.value
        for batch in chunks(batches):
            buf, starts = joined(batch["text"])
            buf = LOWER[buf]
            begin, end, first = words(buf, starts, ALNUM)
            n = np.diff(first)
            term = vocabulary.find(buf, begin, end)
            known = term >= 0
            code = np.sort(np.repeat(np.arange(len(n)), n)[known] << 32 | term[known])
            at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
            tf = np.diff(np.append(at, len(code))).astype(np.int32)
            code = code[at]
            edges = np.searchsorted(code >> 32, np.arange(len(n) + 1))
            own = (code & 0xFFFFFFFF).astype(np.int32)
            keep = np.flatnonzero(n > 0)
            if len(keep):
                yield pd.DataFrame({
                    "id": batch["id"].iloc[keep], "n": n[keep],
                    "terms": [own[edges[i] : edges[i + 1]].tobytes() for i in keep], "tf": [tf[edges[i] : edges[i + 1]].tobytes() for i in keep],
                })

    return named.mapInPandas(run, "id string, n long, terms binary, tf binary")


def _lists(packed) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of all rows, and how many each row has."""
    return np.frombuffer(b"".join(packed), np.int32).astype(np.int64), np.array([len(x) // 4 for x in packed], np.int64)


def _vectors(counted: DataFrame, documents: int, length: int) -> DataFrame:
    """(id, norm, terms, impacts) of the documents that hold a term of the vocabulary."""

    def run(batches):
        for batch in batches:
            tf, size = _lists(batch["tf"])
            n = batch["n"].to_numpy(np.int64)
            m = 100 - 75 + (75 * n * documents) // length
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size))
            stop = np.cumsum(size)
            total = np.append(0.0, np.cumsum(impact.astype(float) ** 2))
            # a sum of its own for each row, as differences of a long running sum lose digits
            norm = np.sqrt(np.add.reduceat(np.append(impact.astype(float) ** 2, 0.0), stop - size)) if len(size) else total[:0]
            packed = impact.astype(np.int32)
            yield pd.DataFrame({"id": batch["id"], "norm": norm, "terms": batch["terms"], "impacts": [packed[b - s : b].tobytes() for b, s in zip(stop.tolist(), size.tolist())]})

    return counted.where(F.octet_length("tf") > 0).mapInPandas(run, "id string, norm double, terms binary, impacts binary")


class Search:
    """The best documents of each item among those seen, bucket by bucket."""

    def __init__(self, queries: Queries, least: np.ndarray, top: int, key: Callable):
        self.q, self.least, self.top, self.key = queries, least.astype(np.int64), top, key
        self.best: list[list[tuple[int, object, str | None]]] = [[] for _ in queries.items]
        self.weight = np.zeros(queries.size, np.int64)
        self.looked = self.scored = 0

    def bucket(self, ids: list, norm: np.ndarray, terms, impacts) -> None:
        """Documents in descending order of length."""
        q = self.q
        term, size = _lists(terms)
        impact, _ = _lists(impacts)
        stop = np.cumsum(size)
        owner = np.repeat(np.arange(len(ids)), size)
        order = np.argsort(term, kind="stable")
        by_term, of_term = owner[order], impact[order].astype(float)
        edges = np.searchsorted(term[order], np.arange(q.size + 1))
        most = np.zeros(q.size)
        filled = np.flatnonzero(np.diff(edges))
        if len(filled):
            most[filled] = np.maximum.reduceat(of_term, edges[filled])
        for i in np.flatnonzero(q.norm * norm[0] * _SLACK >= self.least).tolist():  # Cauchy-Schwarz over the bucket
            own, value = q.term[i], q.value[i]
            if not len(own) or float(value @ most[own]) * _SLACK < self.least[i]:  # largest coordinates of the bucket
                continue
            self.looked += 1
            heavy = own[: q.focus]
            at = np.concatenate([np.arange(edges[t], edges[t + 1]) for t in heavy])
            held = by_term[at]
            x = of_term[at]
            weights = np.repeat(value[: q.focus], edges[heavy + 1] - edges[heavy])
            part = np.bincount(held, weights * x, len(ids))
            left = np.sqrt(np.maximum(norm**2 * _SLACK - np.bincount(held, x * x, len(ids)), 0))
            near = np.flatnonzero((part + q.rest[i] * left) * _SLACK >= self.least[i])
            if len(near):
                self._score(i, near, ids, term, impact, stop, size)

    def _score(self, i, near, ids, term, impact, stop, size) -> None:
        self.scored += len(near)
        self.weight[self.q.term[i]] = self.q.value[i]
        n = size[near]
        ends = np.cumsum(n)
        at = np.repeat(stop[near] - ends, n) + np.arange(ends[-1])
        score = np.add.reduceat(self.weight[term[at]] * impact[at], ends - n)
        self.weight[self.q.term[i]] = 0
        good = np.flatnonzero((score > 0) & (score >= self.least[i]))
        if len(good) > self.top:  # ties of the last place are decided by id below
            good = good[score[good] >= np.partition(score[good], -self.top)[-self.top]]
        found = [(-int(score[g]), self.key(ids[near[g]]), ids[near[g]]) for g in good.tolist()]
        best = sorted([*self.best[i], *found], key=lambda r: r[:2])[: self.top]
        self.best[i] = best
        if len(best) == self.top:
            self.least[i] = max(self.least[i], -best[-1][0])


def _found(vectors: DataFrame, held, least: dict[int, int], top: int, whole_ids: bool) -> DataFrame:
    """(place, id, score): what each task holds of the best documents of the items; `place` numbers the items."""

    def key(name):
        return (name is not None, int(name) if whole_ids and name is not None else name or "")

    def run(batches):
        queries = held.value
        search = Search(queries, np.array([least.get(i, 1) for i in range(len(queries.items))]), top, key)
        for batch in batches:
            for lo in range(0, len(batch), BUCKET):
                part = batch.iloc[lo : lo + BUCKET]
                part = part.iloc[np.argsort(-part["norm"].to_numpy(), kind="stable")]
                search.bucket(part["id"].tolist(), part["norm"].to_numpy(), part["terms"], part["impacts"])
        rows = [(i, name, -minus) for i, best in enumerate(search.best) for minus, _, name in best]
        yield pd.DataFrame(rows, columns=["place", "id", "score"]).astype({"place": "int64", "score": "int64", "id": object})

    return vectors.mapInPandas(run, "place long, id string, score long")


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, n) of items (item_id, text): a written table; repeated rows count once, rows of one id add up."""
    named = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct()

    def run(batches):
        for batch in chunks(batches):
            buf, starts = joined(batch["text"])
            buf = LOWER[buf]
            begin, end, first = words(buf, starts, ALNUM)
            data = buf.tobytes()
            names = np.repeat(batch["item"].to_numpy(object), np.diff(first))
            if len(begin):
                yield pd.DataFrame({"item": names, "term": [data[a:b].decode() for a, b in zip(begin.tolist(), end.tolist())]})

    return stage(named.mapInPandas(run, "item string, term string").groupBy("item", "term").agg(F.count("*").alias("n")), "item-terms")


def rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, id, score): the `top` documents of highest score above 0 of each item.

    Equal scores are ordered by ascending id, null ids first; equal rows keep their number. A null or
    empty text has no terms, an item without terms or matches has no rows. Repeated item rows count
    once, different texts of one item_id are one item. Items are searched in blocks whose terms
    fit `block_bytes` on average; a block is one pass over the documents, and its terms and
    weights are all that is broadcast.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    asked = item_terms(items)
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    schema = f"item_id {item_kind}, rank int, id {kind}, score long"
    out = [spark.createDataFrame([], schema)]
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).toPandas()
        if len(rows):
            rows["place"] = rows.groupby("item", dropna=False).ngroup()
            out.append(_ranked_block(docs, Block(rows), kind, item_kind, id_col, text_col, top))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _ranked_block(docs: DataFrame, block: Block, kind: str, item_kind: str, id_col: str, text_col: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    words_of = spark.sparkContext.broadcast(block.vocabulary)
    counted = stage(_counted(docs, words_of, id_col, text_col), "item-terms-of-documents")
    documents, length = counted.agg(F.count("*"), F.sum("n")).first()
    words_of.unpersist()
    if not documents:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, id {kind}, score long")

    def frequencies(batches):
        total = np.zeros(block.size, np.int64)
        for batch in batches:
            total += np.bincount(_lists(batch["terms"])[0], minlength=block.size)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"term": some, "df": total[some]})

    counts = counted.select("terms").mapInPandas(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = np.zeros(block.size, np.int64)
    for term, df in counts.collect():  # terms of the block at most
        weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    held = spark.sparkContext.broadcast(Queries(block, weight))
    whole_ids = kind in ("tinyint", "smallint", "int", "bigint")
    vectors = stage(_vectors(counted, documents, length), "vectors")
    place = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), F.col("id").cast(kind)))

    def ranked(found):
        return found.withColumn("rank", place).where(F.col("rank") <= top)

    seeds = vectors.where(F.pmod(F.xxhash64("id", "terms"), F.lit(SEED)) == 0)
    least = {r.place: r.score for r in ranked(_found(seeds, held, {}, top, whole_ids)).where(F.col("rank") == top).collect()}  # one score for each item of the block
    by_length = vectors.repartitionByRange(F.desc("norm"), F.monotonically_increasing_id().asc()).sortWithinPartitions(F.desc("norm"))
    found = stage(ranked(_found(by_length, held, least, top, whole_ids)), "ranked")
    held.unpersist()
    names = spark.createDataFrame(list(enumerate(block.items)), "place long, item string")
    return found.join(F.broadcast(names), "place").select(F.col("item").cast(item_kind).alias("item_id"), "rank", F.col("id").cast(kind).alias("id"), "score")
