"""Runs: identities and manifests, state archives, evidence, throttling of sources, schedules in chunks, embedding in batches that adapt."""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from siftstone.operators.state import SCHEMA, multiset_digest
from siftstone.sources import files

WEAK, PRESSED = ("http_429", "http_500", "http_502", "http_503", "http_504", "timeout", "connection"), ("http_429", "http_503")


def run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now(timezone.utc)):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def run_manifest(run: str, signature: str, contract: dict, crawls: Sequence[str], strategy: str, limit: int | None, chunk: int, now: str, **runtime: object) -> dict:
    """What a run was asked to do and by which filter."""
    return {"schema_version": 1, "run_id": run, "created_at": now, "filter_signature": signature, "filter_contract": contract, "crawls": list(crawls), "scheduling": {"strategy": strategy, "global_source_limit": limit, "chunk_size": chunk}, "runtime": runtime}


def digest(rows: DataFrame) -> str:
    """One digest of a snapshot, whatever the order and partitions of its rows."""
    return multiset_digest(rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("k")), "k").first()["digest"]


def archive_state(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """The snapshot as sorted zipped JSON lines with its digest, staged and swapped in. Returns the digest."""
    staged = f"{path}-staging-{uuid.uuid4().hex}"
    own = digest(rows)
    rows.repartitionByRange("file_path").sortWithinPartitions("file_path").write.option("compression", "gzip").option("ignoreNullFields", "false").json(f"{staged}/rows")
    files.write_json(spark, f"{staged}/digest.json", {"digest": own})
    files.swap(spark, path, staged)
    return own


def restore_state(spark: SparkSession, path: str) -> DataFrame:
    """The archived snapshot; raises if it is missing, holds a path twice or does not have its digest."""
    note = files.read_json(spark, f"{path}/digest.json")
    if note is None:
        raise FileNotFoundError(path)
    rows = spark.read.schema(SCHEMA).json(f"{path}/rows")
    if digest(rows) != note["digest"] or not rows.groupBy("file_path").count().where("count > 1").isEmpty():
        raise RuntimeError("the archive is damaged")
    return rows


def synchronized(spark: SparkSession, rows: DataFrame, path: str) -> bool:
    note = files.read_json(spark, f"{path}/digest.json")
    return note is not None and note["digest"] == digest(rows)


def archive_evidence(spark: SparkSession, report: dict, folder: str) -> str:
    """A validated audit report under a name made of its id and content; one that is there already must be the same. Returns the path."""
    raw = json.dumps(report, sort_keys=True, ensure_ascii=False)
    name = f"{folder}/{re.sub('[^A-Za-z0-9_-]', '_', str(report.get('audit_id', '')))}-{hashlib.sha256(raw.encode()).hexdigest()[:16]}.json"
    held = files.read_json(spark, name)
    if held is not None and held != json.loads(raw):
        raise RuntimeError(f"{name} holds another report")
    if held is None:
        files.write_json(spark, name, report)
    return name


class Throttle:
    """How many sources may be read at a time: halved by transient faults, one more after enough successes; pressure pauses all for doubled times."""

    def __init__(self, most: int, successes: int = 4, base: float = 30.0, longest: float = 600.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.most = self.now = max(1, most)
        self.needed, self.base, self.longest, self.clock = max(1, successes), base, longest, clock
        self.good = self.signs = 0
        self.until = 0.0

    def slots(self, busy: int) -> int:
        return 0 if self.clock() < self.until else max(0, self.now - busy)

    def observe(self, status: str, category: str | None = None) -> None:
        if status == "failed" and category in WEAK:
            self.now, self.good = max(1, self.now // 2), 0
            if category in PRESSED:
                self.signs += 1
                self.until = max(self.until, self.clock() + min(self.longest, self.base * 2 ** (self.signs - 1)))
        elif status == "completed":
            self.good += 1
            if self.good >= self.needed and self.now < self.most:
                self.now, self.good = self.now + 1, 0
            if self.now == self.most:
                self.signs = 0
        else:
            self.good = 0


def chunks(crawls: Sequence[str], ready: dict[str, int], limit: int | None = None, size: int = 100) -> Iterator[tuple[str, int]]:
    """(crawl, sources) in turns of at most `size`, until nothing is ready or the limit is reached."""
    left = {c: ready.get(c, 0) for c in crawls}
    room = sum(left.values()) if limit is None else limit
    while room > 0 and any(left.values()):
        for c in crawls:
            take = min(size, left[c], room)
            if take > 0:
                left[c] -= take
                room -= take
                yield c, take


class Batches:
    """Encodes lists in batches: halved (down to the least size) when memory runs out, doubled again after eight that went well."""

    def __init__(self, most: int, least: int = 8) -> None:
        self.most = self.size = most
        self.least, self.good, self.faults = min(least, most), 0, 0

    def run(self, encode: Callable[[list[str]], list], texts: list[str]) -> list:
        out: list = []
        while len(out) < len(texts):
            try:
                out += encode(texts[len(out) : len(out) + self.size])
            except MemoryError:
                if self.size <= self.least:
                    raise
                self.size, self.good, self.faults = max(self.least, self.size // 2), 0, self.faults + 1
                continue
            self.good += 1
            if self.good >= 8:
                self.size, self.good = min(self.most, self.size * 2), 0
        return out


def embedder(load: Callable[[], Callable[[list[str]], list]], batch: int = 256):
    """A vectorised embedding function over any model; load() is called once a task and gives a function from texts to vectors. Null texts have no vector."""

    def embed(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, sizes = load(), Batches(batch)
        for texts in frames:
            known = texts.dropna()
            made = pd.Series(sizes.run(encode, known.tolist()), index=known.index, dtype=object)
            yield made.reindex(texts.index).where(lambda v: v.notna(), None)

    embed.__annotations__ = {"frames": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return pandas_udf(embed, "array<float>")
