"""URL filters: domain and path rules, and a classifier for the rest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import BITS, fit, present, sigmoid

SIZES = (2, 3, 4, 5)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """`urls` with host and path: both empty for a null url or one without `://`."""
    at = F.expr(f"instr(`{url_col}`, '://')")
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return urls.withColumn("path", F.coalesce(path, F.lit(""))).withColumn("host", F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")))


def rule_columns(rules=RULES):
    """(rule, verdict) columns over host and path; the longest rule that fits wins."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _bytes(host: str, path: str) -> bytes:
    return f"^{host}${path}$".encode()


def train(labelled: DataFrame, sample: int = 4_000):
    """(weights, intercept) from (host, path, label) rows, label 1 to block.

    Fitted on at most `sample` distinct urls, half of each class, those with the least hash (the
    documented bound). Without labelled rows everything is allowed.
    """
    rows = labelled.select("host", "path", F.col("label").cast("int").alias("label")).where("label IN (0, 1)").distinct()
    picked = None
    for label in (0, 1):
        part = rows.where(F.col("label") == label).orderBy(F.xxhash64("host", "path"), "host", "path").limit(sample // 2)
        picked = part if picked is None else picked.union(part)
    table = picked.toPandas()
    features = [present(_bytes(h, p), SIZES) for h, p in zip(table["host"], table["path"])]
    return fit([f.astype(np.int64) for f in features], table["label"].to_numpy().astype(int), np.ones(1 << BITS), rounds=300)


def judge(pages: DataFrame, model, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) per row; a rule decides before the classifier."""
    weights, intercept = model
    held = pages.sparkSession.sparkContext.broadcast(weights)
    named = parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))).drop("url")
    kind = named.schema["id"].dataType.simpleString()

    def run(batches):
        w = held.value
        for batch in batches:
            yield batch[["id", "host", "path"]].assign(score=[sigmoid(w[present(_bytes(h, p), SIZES)].sum() + intercept) for h, p in zip(batch["host"], batch["path"])])

    rule, verdict = rule_columns(rules)
    scored = named.mapInPandas(run, f"id {kind}, host string, path string, score double")
    return scored.select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
