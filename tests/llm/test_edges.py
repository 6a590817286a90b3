"""Personal data, empty tables, nulls, repeated rows and clashing names."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import catalog, decontaminate, pii, recompression, segments, simhash, suffixes, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_surrogates_are_consistent_and_distinct(spark):
    texts = [
        "call +1 (755) 555-9729 or +1 755 555 9729, mail ann.b@x.example.com and cc.1@x.example.com",
        "Mrs. Smith met Mr. Smith at 10.20.30.40; card 4387513035237269 key " + "ab12" * 10,
        "again ann.b@x.example.com and Mrs. Smith",
        None, "", "nothing here",
    ]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(0, texts[0], "en", "s", 1), (None, texts[2], None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("at", F.lit(1)).withColumn("value", F.lit("v"))
    out = pii.replace(docs, "k1")
    assert out.columns == [*docs.columns, "n_pii"] and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect() if r.doc_id}
    first = [r for r in out.collect() if r.doc_id == 0]
    assert len(first) == 2 and first[0] == first[1] and first[0].n_pii == 4
    assert got[3].text is None and got[4].text == "" and got[5].text == "nothing here"
    phones = re.findall(r"\+1 (?:\(\d{3}\) \d{3}-\d{4}|\d{3} \d{3} \d{4})", first[0].text)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1 and "555" not in phones[0][:8]
    mails = re.findall(r"\S+@\S+", first[0].text)
    assert len(set(mails)) == 2 and mails[0].rstrip(",") in got[2].text and re.match(r"[a-z]{3}\.[a-z]@", mails[0])
    women, men = re.findall(r"Mrs\. (\w+)", got[1].text)[0], re.findall(r"Mr\. (\w+)", got[1].text)[0]
    assert women != men and "Smith" not in got[1].text and f"Mrs. {women}" in got[2].text
    assert re.search(r"key [0-9a-f]{40}$", got[1].text) and "10.20.30.40" not in got[1].text
    assert re.search(r"card \d{16} ", got[1].text) and "4387513035237269" not in got[1].text


def test_secrets_of_any_case_and_length(spark):
    lower, long = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b", "0123456789abcdef" * 8
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(lower))
    texts = [f'TOKEN = "{v}"!!' for v in (lower, lower.upper(), mixed, long, long.upper(), long * 3 + "a")] + [f"0x{lower} 0X{lower.upper()}L key{lower[1:]}", "abcdef" * 5 + "a defaced"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in pii.replace(docs, "k").collect()}
    made = [re.fullmatch(r'TOKEN = "([0-9A-Fa-f]+)"!!', got[i].text)[1] for i in range(6)]
    shape = lambda v: re.sub("[a-f]", "a", re.sub("[A-F]", "A", re.sub("[0-9]", "0", v)))
    for i, v in enumerate((lower, lower.upper(), mixed, long, long.upper(), long * 3 + "a")):
        assert got[i].n_pii == 1 and shape(made[i]) == shape(v) and made[i].lower() != v.lower()
    assert len({m.lower() for m in made[:3]}) == len({m.lower() for m in made[3:5]}) == 1 and made[5][:128].lower() != made[3]
    assert got[6].n_pii == 3 and got[6].text.startswith(f"0x{made[0]} 0X{made[1]}L key") and lower[1:] not in got[6].text
    assert got[7].n_pii == 0 and got[7].text == texts[7]


def test_more_entities_than_the_first_space(spark):
    assert len(set(pii.LATIN)) == len(set(pii.CYRILLIC)) == 16
    letters = lambda alphabet, i: "".join(alphabet[i // 12**k % 12] for k in range(5))
    names = [f"Mr. X{letters('abcdefghijkl', i)}" for i in range(70000)] + [f"Г-н Ж{letters('абвгдежзийкл', i)}" for i in range(70000)]
    mails = [f"{'_' * (i % 9 + 1)}@x{i}.example.com" for i in range(100000)]
    found = spark.createDataFrame([(v,) for v in names + mails], "value string")
    made = pii.surrogates(found, "k")
    assert made.count() == made.select("kind", "surrogate").distinct().count() == 240000
    assert made.join(found, made.surrogate == found.value, "left_semi").isEmpty()
    assert made.where("kind = 'name' AND length(surrogate) > 30").isEmpty()


def test_marks_in_texts_and_clashing_names(spark):
    texts = ["\u0001 a@b.example.com\u0001\u0003\u0001\u0002 c@d.example.com", "\u0001\u0003", "1@x.example.com+1 755 555 9729z@y.example.com"]
    docs = spark.createDataFrame([(t, i, "p", "m") for i, t in enumerate(texts)], "text string, row int, parts string, made string")
    got = {r.row: r for r in pii.replace(docs, "k").collect()}
    mail = r"[a-z0-9]+@mail\d{4}\.example\.org"
    assert re.fullmatch(rf"\x01 {mail}\x01\x03\x01\x02 {mail}", got[0].text) and got[0].n_pii == 2
    assert got[1].text == texts[1] and got[1].n_pii == 0 and got[1].parts == "p" and got[1].made == "m"
    assert re.fullmatch(rf"{mail}\+1 \d{{3}} \d{{3}} \d{{4}}{mail}", got[2].text) and got[2].n_pii == 3
    assert pii.replace(docs.select("text"), "k").columns == ["text", "n_pii"]


def test_rules_of_urls(spark):
    cases = {
        "https://A.example.net/en/1?x": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://b.example.net/fr/": ("b.example.net", "/fr/", "net/", "block"),
        "x://www.example.com/de/9#t": ("www.example.com", "/de/9", "example.com/de/", "block"),
        "https://q.org/fr/1": ("q.org", "/fr/1", "org/fr/", "allow"),
        "https://planet/": ("planet", "/", None, None),
        "nothing": ("", "", None, None),
        None: ("", "", None, None),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    model = urls.train(spark.createDataFrame([], "host string, path string, label int"))
    got = {r.id: r for r in urls.judge(pages, model).collect()}
    for i, want in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule) == want[:3]
        assert got[i].verdict == (want[3] or "allow")


@pytest.mark.parametrize("name", [q for q in catalog.QUERIES if q not in ("op3_url_filter", "op6_embedding_dedup")])
def test_empty_documents(spark, tmp_path, name):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_embeddings_without_use(spark, tmp_path):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, 0.0], None), (7, [1.0, float("nan")], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], 2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id) for r in catalog.op6_embedding_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), **{i: (0, i) for i in range(4, 10)}}


@pytest.mark.parametrize("name, module, dealt", [("op4_suffix_dedup", suffixes, suffixes._anchored(50)), ("op8_substring_dedup", recompression, recompression._pieces(13))])
def test_hot_buckets_are_sliced(spark, dirty, monkeypatch, name, module, dealt):
    folder, _ = dirty
    want = sorted(map(str, catalog.QUERIES[name](spark, folder).collect()))
    monkeypatch.setattr(segments, "LARGE", 2000)
    monkeypatch.setattr(segments, "SLICE", 2000)
    assert sorted(map(str, catalog.QUERIES[name](spark, folder).collect())) == want
    # one passage in every document: no task may hold the copies of all
    passage = " ".join(f"shared{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"own{i * 7} {passage} tail{i}") for i in range(200)], "id long, text string").repartition(20, "id")
    width = 50 if module is suffixes else 13
    windows = module._windows(width)

    def watched(data, begin, end, doc, place, *rest):
        assert len(set(doc.tolist())) < 150
        return windows(data, begin, end, doc, place, *rest)

    got = {r.id for r in segments.marks(docs, dealt, 4, watched, width).collect()}
    assert got == set(range(1, 200))


def test_dense_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 3)
    values = [0, 1, 3, 7, 1 << 40, 1 << 40 | 1 << 41 | 1 << 42, 255]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    root = simhash.components(simhash.links(fps))
    got = {r.node: r.component for r in root.collect()}
    want = {0, 1, 3, 7, 1 << 40, 1 << 40 | 1 << 41 | 1 << 42}
    assert {k for k in got} == want and {got[k] for k in want} == {0}


def test_pipeline_keeps_columns_and_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:4]:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert docs.count() > 50


def test_scores_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    model = toxicity.train(spark.createDataFrame([], "text string, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.score(docs, model).collect())


def test_words_of_one_polynomial_hash_are_not_equal(spark):
    """Two words of one polynomial hash for every odd base: a Thue-Morse sequence and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    rest = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")], "doc_id long, text string")
    out = recompression.dedup(docs, digest=recompression.digest, schema="n_words long, n_removed long, kept_sha256 string")
    assert {r.id: r.n_removed for r in out.collect()} == {1: 0, 2: 0, 3: 13}


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """With one hash for everything, slices and windows are still equal only where their bytes are."""
    buf = np.frombuffer(b"ab cd ab ce cd ab", np.uint8)
    begin = np.arange(0, 18, 3)
    monkeypatch.setattr(segments, "hashes", lambda buf, begin, end: np.zeros(len(begin), np.uint64))
    rep, number = segments.distinct(buf, begin, begin + 2)
    assert [buf[begin[r] : begin[r] + 2].tobytes() for r in rep[number]] == [b"ab", b"cd", b"ab", b"ce", b"cd", b"ab"] and len(rep) == 3
    monkeypatch.setattr(recompression, "exact_hashes", lambda buf, begin, end, seed: np.zeros(len(begin), np.uint64))
    text = np.frombuffer(b"a b ca b da b c", np.uint8)
    end = np.array([5, 10, 15])
    group, doc, place, _ = recompression._windows(3)(text, end - 5, end, np.arange(3), np.zeros(3, np.int64), False)
    of = dict(zip(doc.tolist(), group.tolist()))
    assert of[0] == of[2] != of[1] and set(place.tolist()) == {0}


@pytest.mark.parametrize("module", [suffixes, recompression])
def test_ids_of_any_size_and_none(spark, module):
    """Ids above 2**53 and missing ones in one chunk: the ids come back as they are, a row without one loses nothing."""
    passage = " ".join(f"word{i}" for i in range(30))
    top = 2**62 + 1
    rows = [(top, passage), (None, passage), (top - 1, passage), (-top, None), (top + 1, passage + " tail"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    schema = {suffixes: "n_bytes long, n_removed long, n_spans long, kept_sha256 string", recompression: "n_words long, n_removed long, kept_sha256 string"}[module]
    got = {r.id: (r[1], r.n_removed) for r in module.dedup(docs, digest=module.digest, schema=schema).collect()}
    n = 30 if module is recompression else len(passage)
    assert got == {top: (n, n), None: (n, 0), top - 1: (n, 0), -top: (0, 0), top + 1: (n + (1 if n == 30 else 5), n), 3: (0, 0)}


def test_items_without_an_id_hit(spark):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {words} y"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, words), (9_007_199_254_740_993, "w1 w2")], "item_id long, text string")
    found = {r.id: (r.starts, r.ends, r["items"]) for r in decontaminate.scan(docs, items).collect()}
    assert found == {1: ([1], [13], [9_007_199_254_740_993]), 2: ([], [], [])}


def test_near_copies_go_by_row(spark):
    """Repeated rows, one id with two texts, null ids and a clashing column: one row of each group stays."""
    rows = [(1, "a b c d", "x"), (1, "a b c d", "x"), (1, "quite another text here", "y"), (None, "a b c d", "z"), (None, "nobody owns this", "z"), (5, None, "n"), (6, "", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    kept = sorted((tuple(r) for r in out.collect()), key=repr)
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)


def test_labelled_rows_are_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("toxic")).union(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int"))
    found = {r.toxic: r["count"] for r in toxicity.labelled(docs, labels, per_class=1000).groupBy("toxic").count().collect()}
    assert found[1] == 400 and 900 < found[0] < 1100
    assert toxicity.labelled(docs, labels.limit(0)).count() == 0
