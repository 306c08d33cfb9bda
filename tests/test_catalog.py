"""Every query with SQL gives the rows DuckDB gives on the same tables; near dedupe against the sequential rule; archives and Python functions."""

import gzip
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from siftstone.functions.python import plain_normalize_text, plain_normalize_url, plain_repair, plain_simhash
from siftstone.plans import catalog
from siftstone.sources import archives

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if v.__class__.__name__ == "Decimal":
        return repr(round(float(v), 6))
    return v.isoformat()[:19] if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        p = f"{SF}/{t}.parquet"
        c.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    rel = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    want = sorted(repr([plain(dict(zip(rel.columns, r))[c]) for c in cols]) for r in rel.fetchall())
    assert got == want


def greedy(rows):
    """(seq, text) in order: what the sequential index would say."""
    seen, canon, want = {}, [], {}
    for i, t in rows:
        if t in seen:
            want[i] = (seen[t], "exact")
            continue
        h = plain_simhash(t) & (2**64 - 1)
        hit = min(((b, j) for j, g in canon for b in range(4) if (h >> 16 * b) & 65535 == (g >> 16 * b) & 65535 and bin(h ^ g).count("1") <= 3), default=None)
        if hit:
            want[i] = (hit[1], "near")
        else:
            canon.append((i, h))
            seen[t] = i
            want[i] = (i, "canonical")
    return want


def test_near_dedupe_is_greedy_by_first_seen(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = {r["seq"]: (r["canonical"], r["kind"]) for r in catalog.QUERIES["near_dedupe"](spark, SF).collect()}
    assert got == greedy(rows)


def test_near_dedupe_of_edited_texts(spark):
    """Long texts with a word exchanged here and there, which differ in few bits of their hashes."""
    import random

    from siftstone.operators import corpus

    r = random.Random(3)
    base = [[f"w{r.randrange(5000)}" for _ in range(400)] for _ in range(4)]
    rows = []
    for k in range(60):
        words = list(base[k % 4])
        for _ in range(k % 7):
            words[r.randrange(400)] = f"x{r.randrange(99)}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.sha2("text", 256)).repartition(5)
    got = {x["seq"]: (x["canonical"], x["kind"]) for x in corpus.near_dedupe(spark, df, "fp", "doc_id", "text").collect()}
    assert got == greedy(rows) and sum(k == "near" for _, k in got.values()) > 5


def test_simhash_values():
    """Votes of single words, trigrams of short texts, ties set the bit; values worked out by hand-made sums."""
    import hashlib

    def votes(grams):
        of = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big") for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in of) >= len(of))

    assert plain_simhash("One two, three four five two") & (2**64 - 1) == votes("one two three four five two".split())
    assert plain_simhash("a-b c") & (2**64 - 1) == votes(["a-b", "-b ", "b c"]) and plain_simhash(None) & (2**64 - 1) == votes([""])


def record(kind, body, head="WARC-Target-URI: http://a.example/x"):
    raw = body.encode()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{head}\r\nContent-Length: {len(raw)}\r\n\r\n".encode() + raw + b"\r\n\r\n"


def test_wet_records(spark, tmp_path):
    (tmp_path / "a.warc.wet.gz").write_bytes(gzip.compress(record("warcinfo", "i")) + gzip.compress(record("conversion", "")) + gzip.compress(record("conversion", "é text")))
    assert [(r["document_index"], r["text"], r["crawl_id"]) for r in archives.read_wet(spark, str(tmp_path), "c1").collect()] == [(2, "é text", "c1")]


def test_arc_records(spark, tmp_path):
    def arc(url, body):
        return f"{url} 1.2.3.4 20080102030405 text/html {len(body.encode())}\n{body}\n".encode()

    page = "HTTP/1.1 200 OK\r\nContent-Type: {}\r\n\r\n<html><head><title>t</title></head><p>Caf&eacute; &#8211; a</p><br>b</html>"
    bodies = [("filedesc://x", "1 0 X\n"), ("http://a.example/1", page.format("text/html")), ("http://a.example/2", page.format("image/png")), ("http://a.example/3", "HTTP/1.1 200 OK\r\n\r\n<p>no type</p>"), ("http://a.example/4", page.format("TEXT/HTML").split("<")[0])]
    (tmp_path / "b.arc.gz").write_bytes(b"".join(gzip.compress(arc(*x)) for x in bodies))
    got = [(r["document_index"], r["url"], r["warc_date"], r["text"]) for r in archives.read_arc(spark, str(tmp_path)).orderBy("document_index").collect()]
    assert got == [(1, "http://a.example/1", "2008-01-02T03:04:05Z", "Café – a\n\nb"), (2, "http://a.example/3", "2008-01-02T03:04:05Z", "no type")]
    with pytest.raises(ValueError):
        list(archives.records(__import__("io").BytesIO(arc("http://a.example/", "abc")[:-3])))


def test_fetch_tries_again():
    import io
    import urllib.error

    calls, waits = [], []

    def get(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", {}, None)
        return io.BytesIO(b"x")

    assert archives.fetch("http://a.example/", get=get, wait=waits.append).read() == b"x" and waits == [1.0, 2.0]
    with pytest.raises(urllib.error.HTTPError):
        archives.fetch("u", get=lambda u: (_ for _ in ()).throw(urllib.error.HTTPError(u, 404, "none", {}, None)))


def test_python_functions():
    assert plain_normalize_text(" Ａ B ß ") == "a b ss" and plain_normalize_text(None) == ""
    assert plain_normalize_url("HTTP://u@Ex.COM:80/P?q#f") == "http://ex.com:80/P?q" and plain_normalize_url("http://e.com:99999999/") == "http://e.com/"
    assert plain_repair("cafÃ© &amp; ﬁn") == "café & fin" and plain_repair("déjà") == "déjà" and plain_repair("R&copy 1") == "R&copy 1"
