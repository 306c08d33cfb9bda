"""Inputs on which a query of the catalog once did less than the whole job."""

import inspect
import random
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from siftstone.functions import python
from siftstone.operators import cache, corpus, metrics, rules, stories
from siftstone.plans import catalog, output_queries
from siftstone.sources import export


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with null, empty and equal texts."""
    at = str(tmp_path_factory.mktemp("nulls"))
    rows = [(1, None, "a"), (2, "one and two and three", "a"), (3, None, "b"), (4, "one and two and three", "b"), (5, None, None), (6, "quite another text of some words", "b")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{at}/documents.parquet")
    return at


@pytest.mark.parametrize("name", ["exact_dedupe", "provenance"])
def test_null_texts_are_a_group(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    df = catalog.QUERIES[name](spark, folder)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, con.sql(f"select {', '.join(df.columns)} from ({catalog.ORACLE_SQL[name]})").fetchall()))


def test_null_texts_are_near_deduped(spark, folder):
    got = {r["seq"]: (r["canonical"], r["kind"]) for r in catalog.QUERIES["near_dedupe"](spark, folder).collect()}
    assert got == {1: (1, "canonical"), 2: (2, "canonical"), 3: (1, "exact"), 4: (2, "exact"), 5: (1, "exact"), 6: (6, "canonical")}


def test_near_dedupe_decides_a_chain_of_any_length(spark, monkeypatch):
    """Each row is within distance 3 of its neighbours only, so every second row is canonical. A bound on rounds, where there is one, is set below the chain."""
    bound = {"rounds": 3} if "rounds" in inspect.signature(corpus.near_dedupe).parameters else {}
    r = random.Random(1)
    chain = [0]
    while len(chain) < 10:
        i, j = r.sample(range(16, 63), 2)
        h = chain[-1] ^ 1 << i ^ 1 << j
        if all((h ^ g).bit_count() > 3 for g in chain[:-1]):
            chain.append(h)
    monkeypatch.setattr(corpus, "simhash64", lambda c: F.col(c).cast("long"))
    rows = spark.createDataFrame([(k, str(h), str(k)) for k, h in enumerate(chain)], "seq long, text string, key string").repartition(1)
    got = sorted((x["seq"], x["canonical"], x["kind"]) for x in corpus.near_dedupe(spark, rows, "key", "seq", "text", **bound).collect())
    assert got == [(k, k - k % 2, "near" if k % 2 else "canonical") for k in range(10)]


def same_as_sql(spark, folder, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    df = catalog.QUERIES[name](spark, folder)
    got, want = df.collect(), con.sql(f"select {', '.join(df.columns)} from ({catalog.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return got


def test_references_without_semicolon_stay_as_in_sql(spark, tmp_path):
    """A page cut after &amp, as some at 0.1 GB are; archives go by the reference's rule and decode it."""
    rows = [(1, "<p>a &amp; b &lt;c&gt;</p>"), (2, "<p>d&&amp</p>e &copy f"), (3, "<p>&quot;g&quot;&nbsp;h</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    assert dict(map(tuple, same_as_sql(spark, tmp_path, "html_to_text", "pages")))[2] == "d&&amp\ne &copy f"
    assert df.where("page_id = 2").select(corpus.html_to_text(F.col("html"))).first()[0] == "d&&\ne © f"


def test_seconds_left_beyond_the_target(spark, tmp_path):
    """More sources done than the target of a million: the query follows its SQL below zero, the snapshot itself stops at none."""
    k = F.col("id")
    spark.range(1_200_000).select(k.alias("o_orderkey"), (k % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("1998-01-02").cast("date").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    assert same_as_sql(spark, tmp_path, "run_counters", "orders")[0]["eta_seconds"] == -833.3
    rows = spark.createDataFrame([("completed", *[0] * 8)] * 3, "status string, " + ", ".join(f"{c} int" for c in (*metrics.COUNTERS, "peak_worker_rss_bytes")))
    assert metrics.run_snapshot(rows, 3.0, 2).first()["eta_seconds"] == 0.0


def test_plain_latin_texts_stay_out_of_python(spark, monkeypatch):
    """Folding and repair send only texts to Python that Spark cannot treat alike, so a worker's memory does not grow with plain texts."""
    rows = ["Plain TEXT", "Straße Ärger déjà ÑANDÚ", "", None, "a & b"]
    odd = ["ﬁn", "x²", "a\xa0b", "Σας", "é", "cafÃ© &amp;"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows + odd)], "k int, t string")
    want = [(plain(t).casefold(), python.plain_repair(t)) for plain in (lambda t: unicodedata.normalize("NFKC", t or ""),) for t in rows + odd]
    of = [python.fold("t"), python.repair_text("t")]
    assert [tuple(r) for r in df.orderBy("k").select(*of).collect()] == want
    for name in ("_fold", "_repair"):
        monkeypatch.setattr(python, name, lambda c: F.when(c.isNotNull(), F.raise_error(F.lit("sent to Python"))).cast("string"))
    assert [tuple(r) for r in df.where(f"k < {len(rows)}").orderBy("k").select(python.fold("t"), python.repair_text("t")).collect()] == want[: len(rows)]


def test_python_functions_work_by_slices():
    """No more than a slice of a batch is turned into Python objects at a time, whatever the batch."""
    import pyarrow as pa

    most, live = [0], [0]

    class Counted(str):
        def __new__(cls, t):
            live[0] += 1
            most[0] = max(most[0], live[0])
            return str.__new__(cls, t)

        def __del__(self):
            live[0] -= 1

    apply = python.by_slices(lambda t: Counted(t.upper()), StringType(), 4).func
    assert [apply(b).to_pylist() for b in (pa.array(["a", "b"] * 50), pa.array([], pa.string()))] == [["A", "B"] * 50, []] and most[0] <= 8


def test_folding_and_urls_share_a_worker(spark):
    df = spark.createDataFrame([("HTTP://A.example/x#y", "É Ω")], "u string, t string").select(python.normalize_url("u").alias("u"), python.fold("t").alias("t"))
    assert tuple(df.first()) == ("http://a.example/x", "é ω")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_detector_is_given_the_beginning_only(spark):
    """What goes to Python is cut before it goes there."""
    df = spark.createDataFrame([("é" * 700,), ("  \n ",), (None,)], "t string")
    found = df.select(cache.detector(lambda t: (str(len(t)), 1.0))("t").alias("p")).select("p.*")
    assert sorted(map(tuple, found.collect())) == [("500", 1.0), ("unknown", 0.0), ("unknown", 0.0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(" in plan.lower()


def test_phrases_are_read_in_one_pass(spark):
    """Over 180 phrases were looked for one after another; now one function reads the text once, whatever asks for it."""
    df = spark.createDataFrame([("I remember my mother. " * 3,), ("may june july march april",), ("sign in or sign up",), ("one two three " * 40,), (None,)], "t string")
    out = df.select(rules.narrative_score(F.col("t")).alias("s"), rules.repetitive(F.col("t")).alias("r"))
    assert [tuple(r) for r in out.collect()] == [(15, False), (-50, False), (-50, False), (-50, True), (None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Contains(") < 20


def test_exact_export_joins_repeated_keys_only(spark, monkeypatch):
    """Rows met their marks again by three joins over all rows, texts included; passages were made twice."""
    plans = {}
    real = export.materialize
    monkeypatch.setattr(export, "materialize", lambda s, df, tag: plans.__setitem__(tag, df._jdf.queryExecution().optimizedPlan().toString()) or real(s, df, tag))
    rows = [(k, f"http://a{k % 2}.example/{k}", t) for k, t in enumerate(["one text", "two texts", "one text", "three", "one text"])]
    df = spark.createDataFrame(rows, "seq long, url string, paragraph string").withColumns({c: F.lit("x") for c in ("crawl_id", "source_file", "warc_date", "raw_paragraph", "concept_match", "document_id", "context_before", "context_after", "filter_signature", "run_id", "language")})
    manifest = export.export(spark, df, output_queries.fresh(spark, "exact"))
    assert plans["export_marked"].count("Join") == 1 and "export_passages" in plans
    assert {t: manifest["tables"][t]["rows"] for t in manifest["tables"]} == {"provenance": 5, "stories": 3, "curated": 3, "passages": manifest["tables"]["passages"]["rows"]}
    got = export.tables(spark, df)["provenance"].orderBy("seq").select("duplicate_kind", "is_canonical", F.col("story_id") == F.first("story_id").over(Window.orderBy("seq"))).collect()
    assert [tuple(r) for r in got] == [("canonical", True, True), ("canonical", True, False), ("exact", False, True), ("canonical", True, False), ("exact", False, True)]


def test_stream_of_matches_has_few_sources_a_file(spark, tmp_path, monkeypatch):
    """Matches went into four files, so one task read a quarter of them at least, whatever the number of sources."""
    from siftstone.streaming import ingest

    rows = [(k, f"text number {k}", "en", f"s{k % 20}", 10) for k in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    files, real = [], ingest.file_stream
    monkeypatch.setattr(ingest, "file_stream", lambda s, path, n: files.extend(r["n"] for r in s.read.parquet(path).groupBy(F.input_file_name()).agg(F.count_distinct("source_file").alias("n")).collect()) or real(s, path, n))
    got = catalog.QUERIES["streaming_commit"](spark, str(tmp_path)).collect()
    assert sorted(r["records"] for r in got) == [5] * 20 and sum(files) == 20 and max(files) <= 3


def test_sources_of_stories_move_once(spark):
    """A paragraph that is its own source crossed the shuffle twice, and a batch of documents was turned into Python objects at once."""
    rows = [("a", k, f"Paragraph {k} of the story, which goes on.", f"Paragraph {k} of the story,  which goes on." if k == 1 else f"Paragraph {k} of the story, which goes on.") for k in range(4)]
    parts = spark.createDataFrame(rows, "doc_id string, paragraph_index int, paragraph string, source_paragraph string")
    out = stories.story_windows(spark, parts, parts.where("paragraph_index = 2"), source="source_paragraph")
    story = out.first()["story"]
    assert [p["text"] for p in story["paragraphs"]] == [r[3] for r in rows] and [p["normalized_text"] for p in story["paragraphs"]] == [None, rows[1][2], None, None]
    assert "CASE WHEN NOT (source_paragraph" in out._jdf.queryExecution().optimizedPlan().toString()
