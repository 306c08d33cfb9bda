"""Web archive files, read record by record: WARC (WET) and ARC, plain or in gzip members, one task per file."""

from __future__ import annotations

import gzip
import io
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.operators.corpus import html_to_text

SCHEMA = "source_file string, document_index int, kind string, url string, warc_date string, content_type string, body string"
RETRIED = (429, 500, 502, 503, 504)
BATCH = 4 << 20


def fetch(url: str, tries: int = 5, pause: float = 1.0, get: Callable[[str], BinaryIO] = urllib.request.urlopen, wait: Callable[[float], None] = time.sleep) -> BinaryIO:
    """An HTTP stream; statuses of pressure and server faults are tried again, with doubled pauses."""
    for k in range(tries + 1):
        try:
            return get(url)
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or k == tries:
                raise
            wait(pause * 2**k)
    raise AssertionError


def opened(path: str, base: str | None = None) -> BinaryIO:
    """A stream of a local path, a file: URI, any file system that Arrow knows, or else a path below the HTTP base. Nothing is read ahead."""
    from pathlib import Path

    from pyarrow import fs

    local = Path(unquote(urlparse(path).path) if path.startswith("file:") else path)
    if local.is_file():
        return local.open("rb")
    if "://" in path and not path.startswith("http"):
        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_stream(inner)
    return fetch(path if path.startswith("http") else f"{base}{path}")


def unzipped(stream: BinaryIO) -> BinaryIO:
    """The stream itself, or its gzip members one after the other."""
    ahead = io.BufferedReader(stream, 1 << 20) if not hasattr(stream, "peek") else stream
    return io.BufferedReader(gzip.GzipFile(fileobj=ahead), 1 << 20) if ahead.peek(2)[:2] == b"\x1f\x8b" else ahead


def exactly(data: BinaryIO, size: int) -> bytes:
    body = data.read(size)
    if len(body) < size:
        raise ValueError("truncated record")
    return body


def header_lines(data: BinaryIO) -> dict[str, str]:
    out: dict[str, str] = {}
    while (line := data.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def http_body(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and body of an HTTP message; what has no status line is all body."""
    if not raw.startswith(b"HTTP/"):
        return {}, raw
    data = io.BytesIO(raw)
    data.readline()
    return header_lines(data), data.read()


def records(stream: BinaryIO) -> Iterator[tuple[str, dict[str, str], bytes]]:
    """(kind, fields, body) of each record of a WARC or ARC stream; only one record is held. A truncated last record is an error."""
    data = unzipped(stream)
    while line := data.readline():
        if not line.strip():
            continue
        if line.startswith(b"WARC/"):
            fields = header_lines(data)
            body = exactly(data, int(fields.get("content-length", "0")))
            yield fields.get("warc-type", ""), {"url": fields.get("warc-target-uri", ""), "date": fields.get("warc-date", ""), "type": fields.get("content-type", "")}, body
            continue
        parts = line.decode("utf-8", "replace").split()
        if len(parts) < 5 or not parts[-1].isdigit():
            raise ValueError("neither a WARC nor an ARC record")
        body = exactly(data, int(parts[-1]))
        d = parts[-3] if len(parts) == 5 else parts[2]
        date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z" if len(d) == 14 and d.isdigit() else d
        kind = "warcinfo" if parts[0].startswith("filedesc:") else "response" if parts[0].startswith("http") else "resource"
        yield kind, {"url": parts[0], "date": date, "type": parts[-2] if len(parts) == 5 else parts[3]}, body


def _scan(spark: SparkSession, path: str, pick: Callable[[str, dict[str, str], bytes], bytes | None], base: str | None) -> DataFrame:
    """Picked records with their number among all picked ones, from 1; bodies decode with errors ignored."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for frame in frames:
            for name in frame["path"]:
                rows, size, index = [], 0, 0
                with opened(name, base) as stream:
                    for kind, fields, raw in records(stream):
                        body = pick(kind, fields, raw)
                        if body is None:
                            continue
                        index += 1
                        rows.append((name, index, kind, fields["url"], fields["date"], fields["type"], body.decode("utf-8", "ignore")))
                        size += len(body)
                        if size > BATCH:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=names)

    return archive_paths(spark, path, ("",)).select("path").mapInPandas(parse, SCHEMA)


def read_wet(spark: SparkSession, path: str, crawl: str = "", base: str | None = None) -> DataFrame:
    """Conversion records with text, numbered from 1 over all conversion records of their file, empty ones included."""
    rows = _scan(spark, path, lambda kind, fields, raw: raw if kind == "conversion" else None, base).withColumnRenamed("body", "text")
    return rows.where(F.trim("text") != "").withColumn("crawl_id", F.lit(crawl))


def page_of(kind: str, fields: dict[str, str], raw: bytes) -> bytes | None:
    """The body of a response or resource that is HTML or tells no type."""
    if kind not in ("response", "resource"):
        return None
    head, body = http_body(raw)
    kind_of = head.get("content-type", "")
    return body if not kind_of or "html" in kind_of.lower() else None


def read_arc(spark: SparkSession, path: str, crawl: str = "", base: str | None = None) -> DataFrame:
    """HTML pages of responses and resources as text, numbered from 1 over all such pages of their file, empty ones included."""
    rows = _scan(spark, path, page_of, base)
    return rows.withColumn("text", html_to_text(F.col("body"))).drop("body").where("text <> ''").withColumn("crawl_id", F.lit(crawl))


def archive_paths(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".arc.gz", ".arc")) -> DataFrame:
    """path and bytes of files below root with one of the suffixes; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    keep = F.lit(False)
    for s in suffixes:
        keep = keep | F.endswith("path", F.lit(s))
    return files.where(keep).select("path", F.col("length").alias("bytes"))


def wet_paths(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed non-blank lines of a (zipped) path listing; none if it cannot be read."""
    from pyspark.errors import AnalysisException

    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "path string")
    return lines.select(F.trim("value").alias("path")).where("path <> ''")
