"""Benchmark decontamination: a broadcast hash set of benchmark word windows, scanned over whole documents."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siftstone.llm.state import released
from siftstone.llm.textscan import BASE, Words, mix, powers, scan
from siftstone.runtime import materialize, table

#: Word bytes: digits, lower-case letters and everything beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k, p in enumerate(powers(size)):
        out += hashes[k : k + len(out)] * p
    return mix(out + np.uint64(size * int(BASE) % 2**64))


def spelled(words: Words, at: int, size: int) -> bytes:
    return b" ".join(words.low[s:e].tobytes() for s, e in zip(words.starts[at : at + size], words.ends[at : at + size]))


@dataclass
class Index:
    """Windows of some items. texts: by size, from hash to the spelled windows and their items."""

    texts: dict[int, dict[int, dict[bytes, set[str]]]] = field(default_factory=lambda: defaultdict(lambda: defaultdict(lambda: defaultdict(set))))
    count: int = 0

    def frozen(self) -> list[tuple[int, np.ndarray, np.ndarray, dict[int, dict[bytes, set[str]]]]]:
        """(size, sorted hashes, bitmap over the leading 20 bits, texts) of each size."""
        out = []
        for size, texts in self.texts.items():
            hashes = np.sort(np.fromiter(texts, np.uint64, len(texts)))
            bits = np.zeros(1 << 20, bool)
            bits[hashes >> np.uint64(44)] = True
            out.append((size, hashes, bits, {h: dict(t) for h, t in texts.items()}))
        return out


def indexes(rows: Iterable[tuple[object, str | None]], size: int, most: int) -> Iterator[Index]:
    """Benchmark items as one index, or one after the other as several of about `most` windows each."""
    out, made = Index(), 0
    for item, text in rows:
        for words in scan(pa.array([text or ""]), INSIDE):
            n = len(words.starts)
            if n and item is not None:
                span = min(size, n)
                for at, h in enumerate(windows(words.hashes, span).tolist()):
                    out.texts[span][h][spelled(words, at, span)].add(str(item))
                out.count += n - span + 1
        if out.count >= most:
            yield out
            out, made = Index(), made + 1
    if out.count or not made:
        yield out


def found(column: pa.Array, index: list) -> Iterator[tuple[Words, np.ndarray, dict[int, set[str]]]]:
    """Of each run of rows: its words, which are hit, and the items by row."""
    for words in scan(column, INSIDE):
        hit, items = np.zeros(len(words.starts), bool), defaultdict(set)
        for size, hashes, bits, texts in index:
            h = windows(words.hashes, size)
            for at in np.flatnonzero(bits[h >> np.uint64(44)]).tolist():
                k = np.searchsorted(hashes, h[at])
                if k < len(hashes) and hashes[k] == h[at]:
                    row = int(np.searchsorted(words.first_word, at, "right")) - 1
                    if at + size <= words.first_word[row + 1] and (who := texts[int(h[at])].get(spelled(words, at, size))):
                        hit[at : at + size] = True
                        items[row] |= who
        yield words, hit, items


def scanned(batches: Iterator[pa.RecordBatch], index: list) -> Iterator[pa.RecordBatch]:
    """Adds this index's hit words and items to the columns hits and items of each row (its first is the text)."""
    for batch in batches:
        n_words, hits, items = [], batch.column("hits").to_pylist(), batch.column("items").to_pylist()
        for words, hit, who in found(batch.column(0), index):
            n_words += np.diff(words.first_word).tolist()
            marks = np.flatnonzero(hit)
            for row in np.unique(np.searchsorted(words.first_word, marks, "right") - 1).tolist():
                own = marks[(marks >= words.first_word[row]) & (marks < words.first_word[row + 1])] - words.first_word[row]
                k = words.first + row
                hits[k] = sorted({*hits[k], *own.tolist()})
                items[k] = sorted({*items[k], *who[row]})
        columns = {f.name: batch.column(f.name) for f in batch.schema} | {"n_words": pa.array(n_words, pa.int64()), "hits": pa.array(hits, pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
        yield pa.record_batch(columns)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes runs of hit words, with what stands between them, out of the texts (column 0) of rows that have hits."""
    for batch in batches:
        texts, hits = batch.column(0).to_pylist(), batch.column("hits").to_pylist()
        for k, own in enumerate(hits):
            if own:
                raw = texts[k].encode()
                words = next(scan(pa.array([texts[k]]), INSIDE))
                runs = np.split(np.array(own), np.flatnonzero(np.diff(own) > 1) + 1)
                keep, at = [], 0
                for run in runs:
                    keep.append(raw[at : words.starts[run[0]]])
                    at = words.ends[run[-1]]
                texts[k] = b"".join([*keep, raw[at:]]).decode()
        yield batch.set_column(0, batch.schema.field(0), pa.array(texts, batch.schema.field(0).type))


def decontaminate(spark: SparkSession, docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", size: int = 8, least_items: int = 2, most_windows: int = 500_000, remove_spans: bool = False) -> DataFrame:
    """docs with n_words, n_hit, n_items, items (sorted as strings), items_sha256, contaminated; columns of these names are replaced.

    The benchmark's windows go to the executors as one hash set if there are at most most_windows of them; a larger
    benchmark goes in blocks of that size, each scanned over all rows, which carry their hits along; a block's result is written before the next block is made, so one index is held at a time. Hash hits are verified on the
    words themselves. No shuffle. With remove_spans the text of rows that have hits loses the runs of hit words. Null or wordless texts have no words; null items are left out, a repeated item counts once.
    """
    from pyspark.sql import functions as F

    rows = bench.select(item_id, "text")
    own = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "hits"]
    rest = [c for c in docs.columns if c not in own]
    df = docs.select(F.col(text).alias("__text"), *rest, F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    blocks = indexes(((r[0], r[1]) for r in rows.toLocalIterator()), size, most_windows)
    block = next(blocks)
    while (after := next(blocks, None)) is not None:
        df = materialize(spark, df.mapInArrow(lambda b, index=block.frozen(): released(scanned(b, index)), df.schema), "scanned")
        block = after
    # the cut goes with the last scan, so a task has one Python worker
    df = df.mapInArrow(lambda b, index=block.frozen(): released(cut(scanned(b, index)) if remove_spans else scanned(b, index)), df.schema)
    if remove_spans:
        rest = [F.col("__text").alias(c) if c == text else c for c in rest]
    n_items = F.size("items").cast("bigint")
    return df.select(*rest, "n_words", F.size("hits").cast("bigint").alias("n_hit"), n_items.alias("n_items"), "items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_items >= least_items).alias("contaminated"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(spark, docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
