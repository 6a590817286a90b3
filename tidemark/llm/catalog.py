"""Queries of the operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, conversations, decontaminate, fingerprints, lexical, licenses, neighbours, pii, recompression, simhash, suffixes, toxicity, urls
from tidemark.session import stage

TOKENS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
KEY = "surrogates-v1"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_license_scan(spark, folder):
    return licenses.per_row(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id").drop("spans")


def op2_byte_bpe(spark, folder):
    return bpe.encoded_digest(read(spark, folder, "documents"), TOKENS, public_tokenizers.PATTERN)


def op3_url_filter(spark, folder):
    pages = read(spark, folder, "pages")
    rule, verdict = urls.rule_columns()
    ruled = urls.parts(pages.select("url")).select("host", "path", verdict.alias("verdict")).where("verdict IS NOT NULL")
    model = urls.train(ruled.select("host", "path", (F.col("verdict") == "block").cast("int").alias("label")))
    return urls.judge(pages, model).withColumnRenamed("id", "page_id")


def op4_suffix_dedup(spark, folder):
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return suffixes.dedup(read(spark, folder, "documents"), digest=suffixes.digest, schema=schema).withColumnRenamed("id", "doc_id")


def toxicity_model(documents: DataFrame, labels: DataFrame):
    """The classifier, fitted on labelled documents that are not held out."""
    return toxicity.train(toxicity.labelled(documents, labels.where("crc32(cast(doc_id AS string)) % 3 <> 1")))


def op5_toxicity(spark, folder):
    documents = read(spark, folder, "documents")
    scored = toxicity.score(documents, toxicity_model(documents, read(spark, folder, "labels")))
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_embedding_dedup(spark, folder):
    return neighbours.near(read(spark, folder, "embeddings"))


def op7_pii(spark, folder):
    return pii.replace(read(spark, folder, "documents").select("doc_id", "text"), KEY)


def op8_substring_dedup(spark, folder):
    schema = "n_words long, n_removed long, kept_sha256 string"
    return recompression.dedup(read(spark, folder, "documents"), digest=recompression.digest, schema=schema).withColumnRenamed("id", "doc_id")


def op9_decontaminate(spark, folder):
    found = decontaminate.scan(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return decontaminate.verdicts(found).withColumnRenamed("id", "doc_id")


def op10_simhash(spark, folder):
    return simhash.groups(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op11_lexical_search(spark, folder):
    """The ten documents of highest score for each benchmark item."""
    return lexical.rank(read(spark, folder, "documents"), read(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


def op12_fingerprints(spark, folder):
    """Fingerprints of all `documents` and of their edited texts, and how alike they are.

    `n_near`, for ids divisible by 20 (else null): other rows within 3 differing bits, found in the
    block tables.
    """
    rows = stage(fingerprints.edited(read(spark, folder, "documents")), "fingerprints")
    copies = stage(rows.groupBy("fp0", "fp1").agg(F.count("*").alias("n"), F.max(F.coalesce(F.col("id") % 20 == 0, F.lit(False))).alias("asked")), "distinct-fingerprints")
    asked = copies.where("asked").select(F.col("fp0").alias("q0"), F.col("fp1").alias("q1"))
    found = fingerprints.within(asked, copies.select("fp0", "fp1"), 3)
    near = found.join(copies, ["fp0", "fp1"]).groupBy("q0", "q1").agg(F.sum("n").alias("n"))
    near = stage(near.select(F.col("q0").alias("fp0"), F.col("q1").alias("fp1"), "n"), "near-fingerprints")
    counted = rows.where("id % 20 = 0").join(near, ["fp0", "fp1"]).select("*", (F.col("n") - 1).alias("n_near")).drop("n")
    others = rows.where("id % 20 <> 0 or id is null").withColumn("n_near", F.lit(None).cast("long"))
    return counted.unionByName(others).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprints.hexed("fp").alias("fingerprint"),
        fingerprints.hexed("edited").alias("edited_fingerprint"), "near_edited", "near_next", "n_near",
    )


def op13_conversation_repair(spark, folder):
    """Damaged `conversations`, their faults and cheapest repair; one row per original conv_id."""
    table = read(spark, folder, "conversations")
    cut, found = conversations.repair(conversations.damage(table))
    kind = table.schema["conv_id"].dataType.simpleString()
    out = conversations.digest(cut, found)
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *[c for c in out.columns if c != "conv"])


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_byte_bpe, op3_url_filter, op4_suffix_dedup, op5_toxicity, op6_embedding_dedup, op7_pii,
    op8_substring_dedup, op9_decontaminate, op10_simhash, op11_lexical_search, op12_fingerprints, op13_conversation_repair,
)}
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"unnest(regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'))"
ORACLES: dict[str, str] = {
    "op11_lexical_search": f"""
        WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
        found AS (SELECT rid, doc_id, {_TERMS} AS term FROM rows),
        tfs AS (SELECT rid, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        lengths AS (SELECT rid, count(*) AS n FROM found GROUP BY rid),
        corpus AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
        dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
        asked AS (SELECT item_id, {_TERMS} AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        weighed AS (
            SELECT item_id, term, sum(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1))))::BIGINT AS w
            FROM asked JOIN dfs USING (term), corpus GROUP BY item_id, term),
        scores AS (
            SELECT item_id, rid, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
            FROM weighed JOIN tfs USING (term) JOIN lengths USING (rid), corpus GROUP BY ALL),
        ranked AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
