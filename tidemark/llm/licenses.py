"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases whose every word must stand: (label, text).
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: Texts that may stand with words added, left out or changed: (label, text).
TEMPLATES = (
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-notice", "licensed under cc by nc 4 0"),
    ("cc-notice", "this work is licensed under a creative commons attribution license"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license"),
)


def _grams(spark, phrases, templates) -> DataFrame:
    rows = []
    for exact, group in ((True, phrases), (False, templates)):
        for label, text in group:
            words = text.split()
            rows += [(f"{label}:{text}", label, exact, len(words), i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return spark.createDataFrame(rows, "template string, label string, exact boolean, size int, place int, ta string, tb string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, share: float = 0.8, drift: int = 3) -> DataFrame:
    """Per distinct id and text: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans, copies.

    Every pair of neighbouring words is joined by its hash, then word for word, with the places of
    the same pair in the templates (a list of fixed size, broadcast). Each match votes for the
    diagonal place minus template place. Phrases need all votes of one diagonal. Diagonals of a
    template at most `drift` apart are merged, and a span is verified when its words hold at least
    `share` of the template's places within a stretch of at most the template's size plus `drift`
    for every merged diagonal. Only matches and one row per document are shuffled, keyed by id and
    text, so rows that repeat an id keep their own results; `copies` counts equal rows. The votes
    are written once, so that the texts are read and split in one pass. Null and empty texts have no
    words, no labels and score 0.
    """
    spark = docs.sparkSession
    grams = F.broadcast(_grams(spark, phrases, templates).withColumn("th", F.xxhash64("ta", "tb")))
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    named = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("own"), F.array_remove(F.split(low, BETWEEN, -1), "").alias("w"))
    named = named.withColumn("n_words", F.size("w").cast("long"))
    # the last word has no pair: its row (or the only one of a text without words) carries the document
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))
    rows = named.select("id", "own", "n_words", F.posexplode_outer(pairs).alias("at", "pair")).select("id", "own", "n_words", "at", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"))
    met = rows.join(grams, (F.xxhash64("a", "b") == F.col("th")) & (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left")
    met = met.where("template IS NOT NULL OR at IS NULL OR at = n_words - 1")
    key = ["id", "own"]
    votes = met.groupBy(*key, "n_words", "template", "label", "exact", "size", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.collect_set("place").alias("places"), F.count("*").alias("met"))
    votes = stage(votes, "license-votes")
    base = votes.where("template IS NULL OR exact").select(*key, "n_words", "label", F.when(F.size("places") == F.col("size") - 1, F.col("diagonal")).cast("long").alias("start"), F.col("size"), F.when(F.col("template").isNull(), F.col("met")).alias("met"))
    base = base.groupBy(*key, "n_words").agg(
        F.sum("met").alias("copies"), F.count("start").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base"),
        F.collect_list(F.when(F.col("start").isNotNull(), F.struct("label", "start", (F.col("start") + F.col("size")).alias("stop"), F.lit(1.0).alias("share")))).alias("base_spans"),
    )
    loose = votes.where("NOT exact").withColumn("lo", F.col("diagonal") + F.array_min("places")).withColumn("hi", F.col("diagonal") + F.array_max("places") + 2)
    along = Window.partitionBy(*key, "template").orderBy("diagonal")
    reach = along.rowsBetween(Window.unboundedPreceding, -1)
    gap = (F.col("diagonal") - F.max("diagonal").over(reach)) > drift
    runs = loose.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(along))
    spans = runs.groupBy(*key, "template", "label", "size", "run").agg(F.min("lo").cast("long").alias("start"), F.max("hi").cast("long").alias("stop"), F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    covered = F.size(F.array_union("places", F.transform("places", lambda p: p + 1)))
    spans = spans.withColumn("share", covered / F.col("size")).where((F.col("share") >= share) & (F.col("stop") - F.col("start") <= F.col("size") + drift * F.col("n")))
    found = spans.groupBy(*key).agg(F.collect_set("label").alias("more"), F.max("share").alias("best"), F.collect_list(F.struct("label", "start", "stop", "share")).alias("more_spans"))
    out = base.alias("x").join(found.alias("y"), (F.col("x.id").eqNullSafe(F.col("y.id"))) & (F.col("x.own") == F.col("y.own")), "left").select("x.*", "more", "best", "more_spans")
    none = F.array().cast("array<string>")
    result = out.select(
        "id", "own", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.least(F.coalesce("best", F.lit(0.0)), F.lit(1.0))).alias("score"),
        F.when(F.col("more_spans").isNull(), F.col("base_spans")).otherwise(F.concat("base_spans", "more_spans")).alias("spans"),
        "copies",
    )
    return result


def per_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`scan` with one row for each input row, also where rows repeat."""
    found = scan(docs, id_col, text_col, **options)
    return found.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies", "own")
