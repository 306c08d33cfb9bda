"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers

from siftstone.llm import decontamination, embedding_graph, html_extraction, ngram_jaccard, packing, pii, quality_knn, sharding, suffix_dedup, url_filters

LONG = "word%d next " * 3
TEXTS = [None, "", "  \n ", "one two", "a b c d e f g h i j", "a b c d e f g h i j", "A b c d e f g h i k", "x" * 50_000, " ".join(f"w{i}" for i in range(30_000)), "mail bob@mail.com or +1 (705) 555-3138", "ünï cödé — 中文 \u0085 text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 7, 1.5, True) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "a b c d e f g h i j", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n string, rep string, key int, score double, hits boolean").repartition(3)


OPERATORS = {
    "op1": lambda s, d: ngram_jaccard.jaccard_join(s, d),
    "op2": lambda s, d: sharding.shard(s, d),
    "op5": lambda s, d: decontamination.decontaminate(s, d, s.createDataFrame([(1, "b c d e f g h i"), (2, None), (3, "two"), (1, "b c d e f g h i")], "item_id long, text string"), remove_spans=True),
    "op6": lambda s, d: suffix_dedup.remove_repeats(s, d, with_text=True),
    "op8": lambda s, d: quality_knn.score(s, d, quality_knn.fit(s, d, s.createDataFrame([(i, i % 2, 0) for i in range(11)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int"))),
    "op9": lambda s, d: packing.pack(s, d, public_tokenizers.path("word_bpe_49k.json")),
    "op10": lambda s, d: pii.find_pii(s, d, mask=True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, docs, name):
    rows = OPERATORS[name](spark, docs).collect()
    ids = sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))
    if name == "op9":
        assert set(ids) == {*range(len(TEXTS)), None}
    else:
        assert ids == [0, 1, 2, 3, 4, 4, *range(5, len(TEXTS)), None, None]
    by = {r["doc_id"]: r for r in rows}
    if name == "op1":
        assert [(by[i]["n_shingles"], by[i]["n_similar"], by[i]["component_id"]) for i in (0, 1, 2, 3, 4, 5)] == [(0, 0, 0), (0, 0, 1), (0, 0, 2), (1, 0, 3), (6, 1, 4), (6, 1, 4)]
    if name == "op2":
        assert {r["slot"] for r in rows if r["shard"] == 0} == {0} and by[0]["size"] == 1 and by[0]["text_crc32"] == 0
    if name == "op5":
        assert by[4]["n_hit"] == 8 and by[4]["text"] == "a  j" and by[3]["items"] == ["3"] and by[0]["n_words"] == 0
    if name == "op6":
        assert by[7]["n_removed"] == 50_000 and by[0]["n_bytes"] == 0
    if name == "op10":
        assert by[9]["text"] == "mail [EMAIL] or [PHONE]" and by[0]["text"] is None


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs, name):
    assert OPERATORS[name](spark, docs.where("false")).collect() == []


def test_vectors(spark):
    a, b = [1.0, 0.0], [0.999, 0.01]
    rows = [(1, a, 0), (2, b, 0), (3, a, 0), (4, a, 1), (5, None, 0), (6, [0.0, 0.0], 0), (7, [float("nan"), 1.0], 0), (8, [None, 1.0], 0), (9, a, None), (10, [1.0], 0), (1, a, 0), (None, a, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_graph.near_duplicates(spark, df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), **{i: (0, i, True) for i in range(4, 11)}, None: (0, None, True)}
    assert embedding_graph.near_duplicates(spark, df.where("false")).collect() == []


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><h1>T&amp;t</h1><p>a <b>b</b><br>c<p>d</article><footer>f"), (3, "u", "<"), (4, "u", "<p>" * 2000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted((r["page_id"], r["text"]) for r in html_extraction.extract(spark, df).collect())
    assert got == [(1, ""), (2, ""), (3, "<"), (3, "T&t\n\na b c\n\nd"), (4, "deep")]


def test_url_list(spark):
    import datetime as dt

    d = dt.date
    entries = spark.createDataFrame([("domain", "bad.org", d(2024, 1, 2), "add"), ("domain", "bad.org", d(2024, 1, 5), "remove"), ("host", "a.b.c", d(2024, 1, 1), "add"), ("prefix", "x.y/p/q", d(2024, 1, 1), "add"), (None, "z", d(2024, 1, 1), "add")], "kind string, value string, dated date, action string")
    pages = spark.createDataFrame([(1, "http://w.bad.org/", d(2024, 1, 1)), (2, "http://w.bad.org/", d(2024, 1, 2)), (3, "http://bad.org:80/x", d(2024, 1, 5)), (4, "https://A.b.C/", d(2024, 3, 1)), (5, "http://x.y/p/q/r?z", d(2024, 3, 1)), (6, "http://x.y/p", d(2024, 3, 1)), (7, None, d(2024, 1, 2)), (8, "nonsense", None), (2, "http://w.bad.org/", d(2024, 1, 2))], "page_id long, url string, fetched date")
    got = sorted((r["page_id"], r["blocked"]) for r in url_filters.judge(spark, pages, entries).collect())
    assert got == [(1, False), (2, True), (2, True), (3, False), (4, True), (5, True), (6, False), (7, False), (8, False)]
