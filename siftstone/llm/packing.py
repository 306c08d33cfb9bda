"""Best-fit packing of tokenized documents into fixed-length sequences by large-item matching."""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.llm.state import release
from siftstone.llm.textscan import BASE, mix
from siftstone.runtime import materialize, table

#: Texts of these characters only (composed Latin letters and signs) are lower-cased and split here as the tokenizer does it; U+001C to U+001F
#: are white space to Python only, and U+0130 becomes two characters.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\u012f\u0131-\u022f]*+")
CODES = 0x230
LOW = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(CODES)], np.uint16)
SPACE, LETTER, NUMBER, SIGN = range(4)
KIND = np.array([SPACE if chr(c).isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], SIGN) for c in range(CODES)], np.uint8)
RANDOM = np.random.default_rng(16).integers(0, 2**63, CODES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The character by which the byte-level pre-tokenizer writes a byte: printable ones stand for themselves, the rest come in order from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {c: chr(c) for c in _SHOWN} | {c: chr(256 + k) for k, c in enumerate(sorted({*range(256)} - {*_SHOWN}))}
#: A longer pre-token sends its text through the library.
LONGEST = 256
CHUNK = 1 << 18


def edges(units: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens: contractions, runs of letters, single numbers, runs of other signs. units end with three spaces."""
    start = kind != SPACE
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    mark = np.flatnonzero((units == 39) & start)
    mark = mark[mark + 2 < len(units)]
    one, two = units[mark + 1], units[mark + 2]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    size = np.where(single, 2, np.where(double, 3, 0))
    mark, size = mark[size > 0], size[size > 0]
    start[mark + 1] = False
    rest = mark + size
    start[rest[kind[rest] == LETTER]] = True
    stop = kind != SPACE
    stop[:-1] &= start[1:] | (kind[1:] == SPACE)
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


class Words:
    """Ids of pre-tokens, made by the tokenizer, in an open-addressing table of 64-bit hashes; emptied when it would be more than half full."""

    def __init__(self, path: str, slots: int = 1 << 20) -> None:
        import tokenizers

        self.tokenizer, self.mask = tokenizers.Tokenizer.from_file(path), slots - 1
        power = np.full(CHUNK + LONGEST, BASE, np.uint64)
        inverse = np.full(CHUNK + LONGEST, pow(int(BASE), -1, 2**64), np.uint64)
        power[0] = inverse[0] = 1
        self.power, self.inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        self.clear()

    def clear(self) -> None:
        self.keys, self.first, self.count = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, np.int32), np.zeros(self.mask + 1, np.int32)
        self.used, self.ids, self.filled = 0, np.zeros(1 << 16, "<u4"), 0

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash: where it is, or the empty one where it would go."""
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        held = self.keys[slot]
        off = np.flatnonzero((held != hashes) & (held != 0))
        while len(off):
            slot[off] = (slot[off] + 1) & self.mask
            held = self.keys[slot[off]]
            off = off[(held != hashes[off]) & (held != 0)]
        return slot

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """New words go to the tokenizer's model one by one, as its byte-level pre-tokenizer would hand them over."""
        model = self.tokenizer.model
        made = [[t.id for t in model.tokenize(w)] for w in "\x20".join(words).encode().decode("latin-1").translate(BYTES).split(BYTES[32])]
        cut = np.append(0, np.cumsum(np.fromiter(map(len, made), np.int64, len(made))))
        ids = np.fromiter(itertools.chain.from_iterable(made), "<u4", cut[-1])
        if self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), "<u4")))
        self.ids[self.filled : self.filled + len(ids)] = ids
        left = np.arange(len(words))
        while len(left):
            slot = self.places(hashes[left])
            _, lead = np.unique(slot, return_index=True)
            now = left[lead]
            self.keys[slot[lead]], self.first[slot[lead]], self.count[slot[lead]] = hashes[now], self.filled + cut[now], cut[now + 1] - cut[now]
            left = np.delete(left, lead)
        self.filled += len(ids)
        self.used += len(words)

    def encode(self, text: str) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")]

    def plain(self, texts: list[str]) -> list[np.ndarray] | None:
        """Ids of each of these PLAIN texts; None if a pre-token is too long for here. Together they have at most CHUNK characters."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        units = LOW[np.frombuffer(("\n".join(texts) + "\n\n\n\n").encode("utf-16-le"), "<u2")]
        starts, ends = edges(units, KIND[units])
        if not len(starts):
            return [self.ids[:0]] * len(texts)
        lengths = ends - starts
        if lengths.max() > LONGEST:
            return None
        sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(RANDOM[units] * self.power[: len(units)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts] + lengths.astype(np.uint64)) | np.uint64(1)
        slot = self.places(hashes)
        new = np.flatnonzero(self.keys[slot] == 0)
        if len(new):
            _, lead = np.unique(hashes[new], return_index=True)
            if self.used + len(lead) > self.mask // 2:
                self.clear()
                _, lead = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
            lead = new[lead]
            low = units.tobytes().decode("utf-16-le")
            self.learn(hashes[lead], [low[a:b] for a, b in zip(starts[lead].tolist(), ends[lead].tolist())])
            slot = self.places(hashes)
        count = self.count[slot].astype(np.int64)
        after = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[slot] - (after - count), count) + np.arange(after[-1])]
        edge = np.append(0, after)[np.searchsorted(starts, np.append(0, np.cumsum(sizes)))].tolist()
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]


def tokenized(column: pa.Array, words: Words) -> Iterator[np.ndarray]:
    """Ids of each text as tokenizers gives them. Texts beyond PLAIN, with the marker of a special token or a very long pre-token take the library's own path; so do texts of more than CHUNK characters, in which pieces could not be cut."""
    held: list[str] = []
    size = 0

    def done() -> Iterator[np.ndarray]:
        if held:
            ids = words.plain(held)
            if ids is None and len(held) == 1:
                ids = words.encode(held[0])
            yield from ids if ids is not None else (x for t in held for x in (words.plain([t]) or words.encode(t)))

    for cell in column:
        text = cell.as_py() or ""
        plain = len(text) < CHUNK - 8 and "<|" not in text and (not any(c in text for c in "\x1c\x1d\x1e\x1f") if text.isascii() else PLAIN.fullmatch(text) is not None)
        if not plain or size + len(text) + 1 >= CHUNK - 4:
            yield from done()
            held, size = [], 0
        if plain:
            held.append(text)
            size += len(text) + 1
        else:
            yield from words.encode(text)
    yield from done()


def pieces(batches: Iterator[pa.RecordBatch], path: str, length: int, end: int) -> Iterator[pa.RecordBatch]:
    words = None
    stop = end.to_bytes(4, "little")
    for batch in batches:
        words = words or Words(path)
        out: list[list] = [[], [], [], [], []]
        for doc_id, ids in zip(batch.column(0).to_pylist(), tokenized(batch.column(1), words)):
            for piece, at in enumerate(range(0, len(ids) + 1, length)):
                part = ids[at : at + length]
                last = at + length > len(ids)
                for column, value in zip(out, (doc_id, piece, at, len(part) + last, zlib.crc32(stop, zlib.crc32(part)) if last else zlib.crc32(part))):
                    column.append(value)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])
    del words
    release()


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset): pieces of one length go, rank by rank, into consecutive sequences at one offset.

    Works on the histogram of lengths, so it costs the same for any number of pieces. Pieces above a third of the capacity
    are at most two to a sequence: from the longest down each opens a sequence and takes the longest that still fits beside it.
    The rest, from the longest down, each go where the least room is left. Open sequences are runs of consecutive numbers, by room.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    left, given = {k: v for k, v in counts.items() if v}, defaultdict(int)
    rooms: dict[int, list[list[int]]] = defaultdict(list)
    sequence = 0

    def take(size: int, many: int, first: int, offset: int) -> None:
        runs.append((size, given[size], many, first, offset))
        given[size] += many
        left[size] -= many

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for size in large:
        while left[size]:
            mate = next((m for m in large if m <= capacity - size and left[m] > (m == size)), None)
            many = left[size] if mate is None else left[size] // 2 if mate == size else min(left[size], left[mate])
            take(size, many, sequence, 0)
            used = size
            if mate is not None:
                take(mate, many, sequence, size)
                used += mate
            rooms[capacity - used].append([sequence, many])
            sequence += many
    open_rooms = sorted(k for k in rooms if k)
    for size in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[size]:
            at = bisect.bisect_left(open_rooms, size)
            if at == len(open_rooms):
                many = -(-left[size] // (capacity // size))
                rooms[capacity].append([sequence, many])
                sequence += many
                open_rooms.append(capacity)
            room = open_rooms[at]
            first, many = rooms[room].pop()
            if not rooms[room]:
                del open_rooms[at]
            took = min(many, left[size])
            take(size, took, first, capacity - room)
            for rest, run in ((room - size, [first, took]), (room, [first + took, many - took])):
                if rest and run[1]:
                    if not rooms[rest]:
                        bisect.insort(open_rooms, rest)
                    rooms[rest].append(run)
    return runs


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, doc_id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents of more than `capacity` ids are cut. Null or empty text is the end id alone. Each text is tokenized once,
    into a narrow shared table; the driver sees the counts by (length, salt), `capacity * salts` at most. Ranks are by
    (length, salt), so a length that a third of all rows has is ranked in `salts` parts. Rows repeated whole are packed each.
    """
    key = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = rows.mapInArrow(lambda b: pieces(b, path, capacity, end), f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint")
    cut = materialize(spark, cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")), "pieces")
    by_salt = {(r["length"], r["salt"]): r["count"] for r in cut.groupBy("length", "salt").count().collect()}
    counts: dict[int, int] = defaultdict(int)
    before = []
    for (size, salt), many in sorted(by_salt.items()):
        before.append((size, salt, counts[size]))
        counts[size] += many
    runs = plan(counts, capacity)
    starts = F.broadcast(spark.createDataFrame(before, "length bigint, salt int, before bigint"))
    table_of_runs = F.broadcast(spark.createDataFrame(runs, "length bigint, first_rank bigint, many bigint, first_sequence bigint, offset bigint"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(order) - 1).join(starts, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(table_of_runs, "length").where("rank >= first_rank and rank < first_rank + many")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack(spark, table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
