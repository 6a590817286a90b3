"""Toxicity scores: a linear classifier on character n-grams scaled by log-count ratios."""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import fit, grams, present, sigmoid
from tidemark.llm.text import chunks
from tidemark.session import stage

SIZES = (6, 7, 8)
BITS = 22
SLOTS = 1 << 14  # features that are counted together


def _bytes(text) -> bytes:
    return (" " + " ".join(text.lower().split()) + " ").encode() if isinstance(text, str) else b""


def _ratios(rows: DataFrame, number: list[int], smooth: float, least: float):
    """Features whose rate differs between the classes by `least` standard errors, and their log-count ratios.

    A task counts the rows that have a feature in one array for each class and hands it on in packed
    runs of SLOTS features; runs are added up in two steps, so that no group holds every task's run.
    """
    run_schema = "run int, part int, counts binary"

    def pack(counts):
        return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(counts, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())

    def unpack(data):
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T
        return np.ascontiguousarray(flat).view(np.int64).reshape(2, SLOTS)

    def count(batches):
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                total[toxic, present(_bytes(text), SIZES, BITS)] += 1
        for run in range((1 << BITS) // SLOTS):
            part = total[:, run * SLOTS : (run + 1) * SLOTS]
            if part.any():
                yield pd.DataFrame({"run": [run], "part": TaskContext.get().partitionId() // 64, "counts": [pack(part)]})

    def added(frame):
        return sum(unpack(x) for x in frame["counts"])

    def add(frame):
        return pd.DataFrame({"run": frame["run"].iloc[:1], "part": frame["part"].iloc[:1], "counts": [pack(added(frame))]})

    def select(frame):
        seen = added(frame)
        n = np.array(number, float)[:, None]
        rate = seen / np.maximum(n, 1)
        mean = seen.sum(axis=0) / n.sum()
        error = np.sqrt(mean * (1 - mean) * (1 / np.maximum(n, 1)).sum())
        ratio = np.log((seen[1] + smooth) / (n[1] + 2 * smooth)) - np.log((seen[0] + smooth) / (n[0] + 2 * smooth))
        kept = np.flatnonzero((error > 0) & (np.abs(rate[1] - rate[0]) >= least * error))
        return pd.DataFrame({"feature": kept + int(frame["run"].iloc[0]) * SLOTS, "ratio": ratio[kept]})

    counted = rows.mapInPandas(count, run_schema).groupBy("run", "part").applyInPandas(add, run_schema)
    return counted.groupBy("run").applyInPandas(select, "feature int, ratio double").orderBy("feature").toArrow()


def _known(features: np.ndarray) -> np.ndarray:
    known = np.zeros(1 << BITS, bool)
    known[features] = True
    return known


def _held(text, known: np.ndarray) -> np.ndarray:
    """The distinct features of a text that are known."""
    x = grams(_bytes(text), SIZES, BITS)
    return np.unique(x[known[x]])


def labelled(documents: DataFrame, labels: DataFrame, per_class: int = 10_000) -> DataFrame:
    """(text, toxic) of the documents that train the classifier: about `per_class` of each class at most.

    That is the documented bound. `labels` has doc_id and toxic, one of several labels of an id being
    the highest. Ids are drawn by a threshold on their hash that follows from the size of their class, all of them
    in a small class; so at most about 2 * per_class ids are broadcast and no text is shuffled.
    A null id and a null label are left out; rows of one id are all taken.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = stage(known, "toxic-labels")
    number = dict(known.groupBy("toxic").count().collect())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    drawn = F.lit(False)
    for toxic, n in number.items():
        drawn = drawn | ((F.col("toxic") == toxic) & (place < int((1 << 31) * min(1.0, per_class / n))))
    return documents.select("doc_id", "text").join(F.broadcast(known.where(drawn)), "doc_id").select("text", "toxic")


def train(labelled: DataFrame, smooth: float = 1.0, least: float = 6.0):
    """(features, weights, intercept) from (text, toxic) rows; `labelled` above bounds them.

    Log-count ratios are counted over all these rows; features whose rate in the two classes
    differs by less than `least` standard errors say too little and are left out. The linear
    classifier is fitted by one task, since its rows are bounded; the driver gets the weights only.
    Null labels are left out and null texts are empty; repeated rows count again.
    Without rows of both classes the score is that of the one class, and not toxic without any.
    """
    rows = labelled.where("toxic IN (0, 1)").select(F.col("text").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    rows = stage(rows, "toxic-rows")
    found = dict(rows.groupBy("toxic").count().collect())
    number = [found.get(0, 0), found.get(1, 0)]
    if not all(number):
        return np.zeros(0, np.int32), np.zeros(0), 6.0 if number[1] else -6.0
    table = _ratios(rows, number, smooth, least)
    features, ratios = table["feature"].to_numpy().copy(), table["ratio"].to_numpy().copy()
    del table
    held = labelled.sparkSession.sparkContext.broadcast((features, ratios))

    def pick(batches):
        known = _known(held.value[0])
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "features": [_held(t, known).astype(np.int32).tobytes() for t in batch["text"]]})

    def learn(batches):
        features, ratios = held.value
        ratio = np.zeros(1 << BITS)
        ratio[features] = ratios
        held_rows, toxic = [], []
        for batch in batches:
            held_rows += [np.frombuffer(x, np.int32) for x in batch["features"]]
            toxic.append(batch["toxic"].to_numpy(np.int64))
        if held_rows:
            weights, intercept = fit(held_rows, np.concatenate(toxic), ratio)
            yield pd.DataFrame({"weights": [weights[features].tobytes()], "intercept": [float(intercept)]})

    drawn = stage(rows.mapInPandas(pick, "toxic int, features binary"), "toxic-features")
    fitted = drawn.repartition(1).sortWithinPartitions("toxic", "features").mapInPandas(learn, "weights binary, intercept double").first()
    held.unpersist()
    return features, np.frombuffer(fitted["weights"], float), fitted["intercept"]


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, score, kept columns) per row; null and empty texts get the score of no features."""
    features, weights, intercept = model
    held = docs.sparkSession.sparkContext.broadcast((features, weights))
    keep = keep or []
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    kinds = {f.name: f.dataType.simpleString() for f in named.schema.fields}
    schema = ", ".join([f"id {kinds['id']}", "score double", *([f"text {kinds['text']}"] if keep else []), *[f"keep_{c} {kinds['keep_' + c]}" for c in keep]])

    def run(batches):
        w = np.zeros(1 << BITS)
        w[held.value[0]] = held.value[1]
        known = _known(held.value[0])
        for batch in chunks(batches):
            out = pd.DataFrame({"id": batch["id"], "score": [sigmoid(w[_held(t, known)].sum() + intercept) for t in batch["text"]]})
            if keep:
                out["text"] = batch["text"]
                for c in keep:
                    out[f"keep_{c}"] = batch[f"keep_{c}"]
            yield out

    scored = named.mapInPandas(run, schema)
    return scored.select("id", "score", *([F.col("text").alias(text_col)] if keep else []), *[F.col(f"keep_{c}").alias(c) for c in keep])
