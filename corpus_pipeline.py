"""The corpus pipeline: stages over `documents`, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, pii, simhash, toxicity
from tidemark.llm.catalog import KEY, TOKENS, read, toxicity_model
from tidemark.session import stage

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.7. Null and empty texts get the score of no features; repeated rows are judged alike."""
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return toxicity.score(row, model, id_col="row").where("score < 0.7").select("id.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that with the smallest doc_id, a null id being the largest.

    Rows are told apart by 128 bits of hash of all their columns (maps and variants aside), so another text
    under one id and rows without an id are members like any other. Equal rows are one member, of which one row
    stays. Texts without words have one fingerprint.
    """
    mark = "_mark_of_the_row"
    hashed = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    marked = docs.withColumn(mark, F.concat(F.hex(F.xxhash64(*hashed)), F.lit("-"), F.hex(F.xxhash64(F.lit(7), *hashed))))
    groups = simhash.groups(marked.select(mark, "text"), id_col=mark)
    members = groups.groupBy(F.col("id").alias(mark), "component_id").agg(F.count("*").alias("n"))
    ids = marked.select(mark, "doc_id").distinct()
    first = members.join(ids, mark).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", mark, "n")).alias("first"))
    kept = stage(first.select(F.col(f"first.{mark}").alias(mark), "first.n"), "kept-rows")
    once = marked.join(kept.where("n = 1"), mark, "left_semi")
    often = marked.join(kept.where("n > 1"), mark, "left_semi").dropDuplicates([mark])
    return once.unionByName(often).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window. Null and empty texts have none and stay."""
    found = decontaminate.scan(docs.select(F.struct(*docs.columns).alias("row"), "text"), read(spark, sf_dir, "benchmark"), id_col="row")
    return found.where(F.size("starts") == 0).select("id.*")


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, `n_chars` counted anew. Null texts stay null and keep their count."""
    plain = docs.select(F.struct(*docs.columns).alias("row"), "text")
    replaced = pii.replace(plain, KEY)
    columns = [F.col("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns]
    if "n_chars" in docs.columns:
        kind, at = docs.schema["n_chars"].dataType, docs.columns.index("n_chars")
        columns[at] = F.coalesce(F.length("text"), F.col("row.n_chars")).cast(kind).alias("n_chars")
    return replaced.select(*columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and hashes of the ids and of the decoded bytes. Null and empty texts have no ids; repeated rows stay."""
    return bpe.encoded_digest(docs, TOKENS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("bpe", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again; an empty table gives no rows."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
