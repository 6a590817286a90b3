"""Near-duplicate embeddings by sorted projection passes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import stage

BLOCK = 512
#: Signs in a key, and the least number of passes.
BITS, PASSES = 62, 16


def _unit(frame: pd.Series) -> np.ndarray:
    x = np.stack(frame.to_list()).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def passes_for(n: int, floor: float, window: int, recall: float) -> int:
    """Passes after which a pair at `floor` among `n` vectors has met with probability `recall`.

    The signs of a pair agree with 1 - angle / pi each; about log2(n / window) leading signs that
    agree bring it into one window. A quarter of a sign is added, and PASSES are the least.
    """
    if n <= window:
        return PASSES
    met = (1 - np.arccos(floor) / np.pi) ** (np.log2(n / window) + 0.25)
    return max(PASSES, int(np.ceil(np.log1p(-recall) / np.log1p(-met))))


def keys_of(unit: np.ndarray, passes: int, seed: int = 7):
    """The key of every vector for each pass: the signs of BITS random projections as one number."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    for _ in range(passes):
        signs = unit @ rng.standard_normal((unit.shape[1], BITS)) > 0
        yield signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def links(vectors: DataFrame, floor: float = 0.93, recall: float = 0.99, window: int = 24, seed: int = 7) -> DataFrame:
    """Verified links (a, b) of `vectors` (v, label, embedding), from every pass.

    A pass orders the vectors of a label by the concatenated signs of BITS random projections and
    compares each with its next `window` neighbours. The number of passes follows from the vectors
    of the label, so that a pair at `floor` is met with probability `recall` at any size, as far as
    the directions of the label are spread evenly. The order is a range partitioning; neighbours
    that a partition boundary separates in one pass meet in the others.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    label = vectors.schema["label"].dataType.simpleString()
    # labels that need more than the least number of passes: few, as each has many vectors
    many = vectors.groupBy("label").count().where(F.col("count") > window)
    rounds = F.udf(lambda n: passes_for(n, floor, window, recall), "int")(F.col("count"))
    many = many.select(F.col("label").alias("big"), rounds.alias("passes")).where(F.col("passes") > PASSES)
    vectors = vectors.join(F.broadcast(many), F.col("label") == F.col("big"), "left").select("v", "label", "embedding", F.coalesce("passes", F.lit(PASSES)).alias("passes"))

    def keys(batches):
        for batch in batches:
            if not len(batch):
                continue
            unit, turns = _unit(batch["embedding"]), batch["passes"].to_numpy()
            batch = batch.drop(columns="passes")
            for p, key in enumerate(keys_of(unit, turns.max(), seed)):
                yield batch.assign(turn=p, key=key, n=unit.shape[1])[turns > p]

    def compare(batches):
        # the last `window` rows stay for the next batch, so a task holds no more than that and a batch
        tail = None
        for batch in batches:
            old = 0 if tail is None else len(tail)
            rows = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            for _, part in rows.groupby(["turn", "label", "n"], sort=False):
                unit, v, new = _unit(part["embedding"]), part["v"].to_numpy(), part.index.to_numpy() >= old
                for step in range(1, min(window, len(v) - 1) + 1):
                    hit = np.flatnonzero((np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= floor) & new[step:])
                    if len(hit):
                        yield pd.DataFrame({"a": v[hit], "b": v[hit + step]})
            tail = rows.tail(window)

    keyed = vectors.mapInPandas(keys, f"v long, label {label}, embedding {kind}, turn int, key long, n int")
    ordered = keyed.repartitionByRange("turn", "label", "n", "key", "v").sortWithinPartitions("turn", "label", "n", "key", "v")
    return ordered.mapInPandas(compare, "a long, b long").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", floor: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of the table.

    Equal vectors of a label are compared once and count as links of one another. The passes link
    vectors into components; members of a component are then compared in blocks of BLOCK by BLOCK,
    which counts the links of dense groups that are wider than a window, but only as far as the
    passes linked them: a pair without any chain of found links counts nothing. Vectors that are null,
    zero or not finite, and rows with a null label, link with nothing; vectors of different length
    neither. A repeated id counts each of its rows; a null id names no component.
    """
    kind = table.schema[vector_col].dataType.simpleString()
    base = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    norm = F.aggregate(F.transform("embedding", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda t, x: t + x)
    usable = F.coalesce(F.col("label").isNotNull() & (norm > 0) & (norm < float("inf")), F.lit(False))
    rows = base.withColumn("usable", usable)
    own = rows.where("usable").groupBy("label", "embedding").agg(F.min("id").alias("v"), F.count("*").alias("copies"))
    distinct = stage(own.where("v IS NOT NULL"), "vectors")
    found = links(distinct.select("v", "label", "embedding"), floor)
    member = stage(components(found), "vector-components")
    joined = distinct.join(member, F.col("v") == F.col("node")).select("v", "component", "copies", "embedding")
    sizes = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = joined.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    placed = stage(placed, "vector-blocks")
    left = placed.select("component", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), "v", "copies", "embedding")
    right = placed.select(F.col("component").alias("c2"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i2"), F.col("block").alias("j2"), F.col("v").alias("v2"), F.col("copies").alias("k2"), F.col("embedding").alias("e2"))

    def count(a, b):
        if not len(a) or not len(b):
            return pd.DataFrame({"v": [], "n": []})
        hit = _unit(a["embedding"]) @ _unit(b["e2"]).T >= floor
        hit[a["v"].to_numpy()[:, None] == b["v2"].to_numpy()[None, :]] = True
        return pd.DataFrame({"v": a["v"], "n": hit @ b["k2"].to_numpy()})

    counted = left.groupBy("component", "i", "j").cogroup(right.groupBy("c2", "i2", "j2")).applyInPandas(count, "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    named = distinct.join(counted, "v", "left").join(member, F.col("v") == F.col("node"), "left")
    named = named.select("label", "embedding", (F.coalesce("n", "copies") - 1).alias("n_links"), F.coalesce("component", "v").alias("component_id"))
    out = rows.where("usable").join(named, ["label", "embedding"], "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    alone = rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.union(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
