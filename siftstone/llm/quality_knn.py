"""Quality classifier: similarity-weighted votes of labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.state import released
from siftstone.llm.textscan import Words, buffers, scan
from siftstone.runtime import table

#: A word here is any run of bytes without ASCII white space.
INSIDE = np.ones(256, bool)
INSIDE[[9, 10, 11, 12, 13, 32]] = False
TERMS, SHAPES, SPREAD = 1024, 512, 64
SIZE = TERMS + SHAPES + SPREAD

#: Class bits of a byte: lower-case letter or beyond ASCII, upper-case letter, digit, sentence sign, bracket or quote, other sign.
KIND = np.full(256, 32, np.uint8)
KIND[0x61:0x7B] = KIND[0x80:] = 1
KIND[0x41:0x5B] = 2
KIND[0x30:0x3A] = 4
KIND[[ord(c) for c in ".,;:?!-"]] = 8
KIND[[ord(c) for c in "()[]{}'\""]] = 16


def counts(column: pa.Array) -> Iterator[tuple[Words, np.ndarray]]:
    """Term counts (rows x SIZE) of whole texts: hashed words, word shapes (the classes of signs in a word, how many signs end it,
    whether it repeats the word before), and how often the distinct words of the text recur."""
    for words in scan(column, INSIDE, most_rows=512):
        rows = words.last - words.first
        n = np.diff(words.first_word)
        row = np.repeat(np.arange(rows), n)
        out = np.zeros((rows, SIZE), np.float32)
        if len(row):
            # upper case is lost in low, so shapes read the batch's own bytes
            shape = shapes(column, words)
            same = np.zeros(len(row), bool)
            same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
            for at, wide, value in ((0, TERMS, (words.hashes % np.uint64(TERMS)).astype(np.int64)), (TERMS, SHAPES, shape + same * (SHAPES // 2))):
                out[:, at : at + wide] = np.bincount(row * wide + value, minlength=rows * wide).reshape(rows, wide)
            order = np.lexsort((words.hashes, row))
            h, r = words.hashes[order], row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            times = np.diff(np.append(np.flatnonzero(new), len(h)))
            level = np.minimum(SPREAD // 2 - 1, (2 * np.log2(times)).astype(np.int64))
            share = np.bincount(r[new], minlength=rows) / np.maximum(n, 1)
            long = n >= 20
            out[:, TERMS + SHAPES : TERMS + SHAPES + SPREAD // 2] = np.bincount(r[new] * (SPREAD // 2) + level, weights=times, minlength=rows * (SPREAD // 2)).reshape(rows, -1)
            out[np.flatnonzero(long), TERMS + SHAPES + SPREAD // 2 + np.minimum(31, (share * 32).astype(np.int64))[long]] = n[long]
        yield words, out


def shapes(column: pa.Array, words: Words) -> np.ndarray:
    data, offsets = buffers(column)
    kind = KIND[data[offsets[words.first] : offsets[words.last]]]
    classes = np.bitwise_or.reduceat(kind, np.stack((words.starts, words.ends), 1).ravel()[:-1])[::2] if len(words.starts) else np.zeros(0, np.uint8)
    signs = (kind[words.ends - 1] >= 8).astype(np.int64) + ((words.ends - words.starts > 1) & (kind[np.maximum(words.ends - 2, 0)] >= 8))
    return classes.astype(np.int64) + 64 * signs


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    weights: np.ndarray
    neighbours: int
    sharpness: float

    def latent(self, tf: np.ndarray) -> np.ndarray:
        x = weighted(tf, self.idf) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, tf: np.ndarray, block: int = 512) -> np.ndarray:
        """Votes of the nearest labelled vectors; a text without words gets the labelled share of quality 1."""
        out = np.full(len(tf), float((self.votes * self.weights).sum() / self.weights.sum()))
        for k in range(0, len(tf), block):
            part = tf[k : k + block]
            cosine = self.latent(part) @ self.vectors.T
            near = np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, : self.neighbours]
            pull = np.exp(self.sharpness * (np.take_along_axis(cosine, near, 1).astype(np.float64) - 1)) * self.weights[near]
            out[k : k + block] = np.where(part.any(1), (pull * self.votes[near]).sum(1) / pull.sum(1), out[k : k + block])
        return np.clip(out, 0.0, 1.0)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log term counts by idf; words, shapes and spread each at unit length, words at a third of it."""
    x = np.log1p(tf) * idf
    for at, end, weight in ((0, TERMS, 1 / 3), (TERMS, TERMS + SHAPES, 1.0), (TERMS + SHAPES, SIZE, 1.0)):
        part = x[:, at:end]
        part *= weight / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    return x


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", per_class: int = 1500, dims: int = 48, neighbours: int = 15, sharpness: float = 20.0) -> Model | None:
    """Latent-semantic model of labelled rows that are not held out (crc32 of the doc_id as text, mod 4, is not 2).

    Bound (documented): the per_class labelled rows of each class with the least hash of their doc_id; their votes are weighted
    back to the shares of the classes. Document frequencies are over all documents. None without any labelled row.
    """
    body = docs.select(F.col(text).alias("text"))
    learn = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y")).where(~held_out(F.col("doc_id")))
    shares = {r["y"]: r["count"] for r in learn.groupBy("y").count().collect()}
    picked = None
    for y in shares:
        part = learn.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    if picked is None:
        return None

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            for _, tf in counts(batch.column(0)):
                total += (tf > 0).sum(0)
                rows += len(tf)
        yield pa.record_batch([pa.array(np.arange(SIZE + 1)), pa.array(np.append(total, rows))], ["term", "df"])

    df = np.zeros(SIZE + 1)
    for r in body.mapInArrow(lambda b: released(frequencies(b)), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, tf in counts(batch.column(0)):
                yield pa.record_batch([batch.column(1).slice(words.first, words.last - words.first), pa.array([x.astype(np.float32).tobytes() for x in tf], pa.binary())], ["y", "tf"])

    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), "doc_id").select("text", "y")
    rows = labelled.mapInArrow(lambda b: released(vectors(b)), "y int, tf binary").collect()
    if not rows:
        return None
    tf = np.stack([np.frombuffer(r["tf"], np.float32) for r in rows])
    y = np.array([r["y"] for r in rows], np.float64)
    order = np.lexsort((*tf.T[:8], y))
    tf, y = tf[order], y[order]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + 1
    x = weighted(tf, idf)
    _, _, basis = np.linalg.svd(x, full_matrices=False)
    weights = np.array([shares[int(v)] / (y == v).sum() for v in y])
    model = Model(idf, basis[:dims].T.astype(np.float32), np.zeros(0), y, weights, min(neighbours, len(y)), sharpness)
    model.vectors = model.latent(tf)
    return model


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def score(spark: SparkSession, docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with score and predicted; columns of these names are replaced.

    Exact cosine products of every document's latent vector with every labelled one, in blocks; the labelled vectors
    (2 * per_class * dims floats at most) travel with the function. No shuffle. Null, empty or blank texts score the labelled share of
    quality 1; without a model every score is 0.5.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(F.col(text).alias("__text"), *rest)
    schema = docs.select(*rest).schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.full(w.last - w.first, 0.5) if model is None else model.score(tf) for w, tf in counts(batch.column(0))]
            values = pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            yield pa.record_batch({name: batch.column(k + 1) for k, name in enumerate(rest)} | {"score": values})

    return rows.mapInArrow(lambda b: released(scored(b)), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(spark, docs, table(spark, sf_dir, "labels"))
    slim = docs.withColumn("held_out", held_out(F.col("doc_id")))
    return score(spark, slim, model).select("doc_id", "held_out", "score", "predicted")
