"""A session and a small dirty table set for the operators on training text."""

from __future__ import annotations

import random

import pandas as pd
import pytest

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def dirty(spark, tmp_path_factory):
    """Documents of the small table, with nulls, blanks, copies, long texts and rare characters."""
    folder = tmp_path_factory.mktemp("dirty")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().head(150)
    rng, extra = random.Random(5), []
    texts = docs["text"].tolist()
    odd = [None, "", "  \n\t ", "a", "x " * 400, "naïve 中文　\U0001f600  end .", "\x1c\x1d a\x85b c   ", "0" * 300, "MIT LICENSE mit license general public license"]
    odd += [texts[3], texts[3] + " tail", "head " + texts[4], texts[5][40:] + texts[6][:200]]
    words = texts[7].split()
    words[len(words) // 2] = "changed"
    odd += [" ".join(words), "verylong" * 3000]
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").toPandas()
    odd += ["see " + bench["text"][0] + " there", bench["text"][1].upper()]
    for i, text in enumerate(odd):
        extra.append({"doc_id": 5000 + i if i % 3 else -1 - i, "text": text, "lang": None, "source": "odd", "n_chars": rng.randint(0, 9)})
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [tuple(r) for r in docs[[f.name for f in schema]].itertuples(index=False)] + [tuple(r[f.name] for f in schema) for r in extra]
    spark.createDataFrame(rows, schema).repartition(5, "doc_id").write.parquet(f"{folder}/documents.parquet")
    items = [*bench[["item_id", "text"]].itertuples(index=False, name=None), (900, "changed"), (901, None), (902, "..."), (903, "mit license")]
    spark.createDataFrame([(int(a), b) for a, b in items], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), pd.DataFrame(rows, columns=[f.name for f in schema])
