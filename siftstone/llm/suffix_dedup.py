"""Removal of repeated byte strings by blockwise hashing of windows around a cover sample."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.state import kept, released
from siftstone.llm.textscan import BASE, BYTE, buffers, mix
from siftstone.runtime import discard, materialize, sized, table

GRAM = 32
CHUNK = 1 << 20
ROOM = 1 << 21  # of the tables of powers; a bucket of HOT contexts fits
HOT = 4000
PLACE = (1 << 22) - 1


def tables() -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(ROOM, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(int(BASE)), run(pow(int(BASE), -1, 2**64))


#: Other numbers for bytes, of the second hash of windows that travel without their bytes.
OTHER = np.random.default_rng(41).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hashes(data: np.ndarray, size: int, numbers: np.ndarray = BYTE) -> np.ndarray:
    """64-bit hash of data[s : s + size] for every s."""
    power, inverse = kept("powers", tables)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * power[: len(data)], out=sums[1:])
    n = max(0, len(data) - size + 1)
    return mix((sums[size : size + n] - sums[:n]) * inverse[:n] + np.uint64(size))


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys) - width + 1
    whole = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    whole[: len(keys)] = keys
    rows = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def stretches(offsets: np.ndarray, span: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, first byte, last byte): runs of whole rows of about CHUNK bytes, or parts of one longer row that share span - 1 bytes."""
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        if offsets[last] - offsets[row] <= CHUNK:
            yield row, last, int(offsets[row]), int(offsets[last])
        else:
            for at in range(int(offsets[row]), int(offsets[last]) - span + 1, CHUNK):
                yield row, last, at, min(at + CHUNK + span - 1, int(offsets[last]))
        row = last


def cover(data: np.ndarray, edges: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cover sample of a stretch: (row, first start, last start, position, hash) runs of windows that share their sample, as arrays.

    A window (span bytes inside one row) samples the position of the least hash of its GRAM-byte strings, the first of equal ones. Equal
    windows therefore have a sampled position at the same shift, wherever they stand: the property of a difference cover,
    at a density of about 2 / (span - GRAM + 2) rather than 1 / sqrt(span).
    """
    width = span - GRAM + 1
    empty = np.zeros(0, np.int64)
    if len(data) < span:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    grams = hashes(data, GRAM)
    places = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & ~np.uint64(PLACE)) | places, width)
    starts = np.arange(len(least))
    row = np.searchsorted(edges, starts, "right") - 1
    valid = starts + span <= edges[row + 1]
    starts, row, at = starts[valid], row[valid], (least[valid] & np.uint64(PLACE)).astype(np.int64)
    if not len(starts):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1]))))
    end = np.append(new[1:], len(starts)) - 1
    return row[new], starts[new], starts[end], at[new], grams[at[new]]


def covers(column: pa.Array, span: int):
    """Of every stretch: first row, data, edges of its rows in data, the row's byte at which data begins, and its cover."""
    data, offsets = buffers(column)
    for first, last, a, b in stretches(offsets, span):
        part = data[a:b]
        edges = np.clip(offsets[first : last + 1] - a, 0, b - a)
        yield first, part, edges, a - np.minimum(offsets[first:last], a) if last - first == 1 else np.zeros(last - first, np.int64), cover(part, edges, span)


def sampled(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """(h, k1, k2, times): sample hashes of each stretch of a row. Where samples are dense (a periodic text) they count as too frequent for a bucket, for all rows."""
    for batch in batches:
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        for first, _, edges, _, (row, _, _, _, h) in covers(batch.column(0), span):
            if len(h):
                dense = np.bincount(row, minlength=len(edges) - 1) * 16 > np.diff(edges)
                times = np.where(dense[row], HOT + 1, 1).astype(np.int64)
                if dense.any():
                    _, own = np.unique(np.stack((row.astype(np.uint64), h)), axis=1, return_index=True)
                    again = np.isin(np.arange(len(h)), own, invert=True) & dense[row]
                    row, h, times = row[~again], h[~again], times[~again]
                at = row + first
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(k1[at]), pa.array(k2[at]), pa.array(times)], ["h", "k1", "k2", "times"])


def contexts(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """(key, k1, k2, start, shift, context) of what may repeat.

    shift >= 0: the bytes of a run of windows, with their sample at shift in it, in the bucket of the sample's hash. shift -1: one
    window, in a bucket of its own hash; so for samples too frequent for one bucket, and for rows whose samples are dense (periodic texts).
    shift -2: a settled span from start to key.
    """
    for batch in batches:
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        common, hot = batch.column("common").to_pylist(), batch.column("hot").to_pylist()
        for first, data, edges, begun, (row, lo, hi, at, h) in covers(batch.column(0), span):
            signed = h.view(np.int64)
            out: list[tuple] = []
            for r in np.unique(row).tolist():
                own = np.flatnonzero(row == r) if edges.size > 2 else np.arange(len(row))
                wanted = own[np.isin(signed[own], np.array(common[first + r], np.int64))]
                if not len(wanted):
                    continue
                shift = int(begun[r]) - int(edges[r])
                single = np.isin(signed[wanted], np.array(hot[first + r], np.int64))
                a, b = int(k1[first + r]), int(k2[first + r])
                for k in wanted[~single].tolist():
                    out.append((int(signed[k]), a, b, int(lo[k]) + shift, int(at[k] - lo[k]), data[lo[k] : hi[k] + span].tobytes()))
                if single.any():
                    starts = np.concatenate([np.arange(lo[k], hi[k] + 1) for k in wanted[single]])
                    w, second = (hashes(data[edges[r] : edges[r + 1]], span, numbers)[starts - edges[r]] for numbers in (BYTE, OTHER))
                    order = np.lexsort((second, w))
                    same = (w[order][1:] == w[order][:-1]) & (second[order][1:] == second[order][:-1])
                    twice = np.zeros(len(w), bool)
                    twice[order[1:][same]] = twice[order[:-1][same]] = True
                    later = np.zeros(len(w), bool)
                    later[order[1:][same]] = True
                    for s, e in spans(np.sort(starts[twice]), span):
                        out.append((e + shift, a, b, s + shift, -2, b""))
                    for k in np.flatnonzero(~later).tolist():
                        out.append((int(w[k].view(np.int64)), a, b, int(starts[k]) + shift, -1, second[k].tobytes()))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["key", "k1", "k2", "start", "shift", "context"])


def spans(starts: np.ndarray, span: int) -> Iterator[tuple[int, int]]:
    """Maximal [start, end) that windows at these sorted starts cover."""
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > span)
        for s, e in zip(np.append(0, cut + 1), np.append(cut, len(starts) - 1)):
            yield int(starts[s]), int(starts[e]) + span


def repeats(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, start, stop) of bytes whose window occurs at two places; input sorted by key. One or more whole buckets are sorted at a time."""
    held: pa.Table | None = None
    schema = None
    for batch in batches:
        schema = batch.schema
        now = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = now.column("key").to_numpy()
        at = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
        held = now.slice(at)
        tail = held.column("shift").to_numpy()
        if len(tail) > 3 * HOT and (tail < 0).all():  # a window of many places: the first two settle that all repeat; settled spans are done
            yield from settled(held, span)
            held = held.filter(pa.array(tail == -1))
            places: dict[bytes, set[tuple]] = {}
            first: dict[bytes, int] = {}
            for k, p in enumerate(held.select(["k1", "k2", "start", "context"]).to_pylist()):
                places.setdefault(p["context"], set()).add((p["k1"], p["k2"], p["start"]))
                first.setdefault(p["context"], k)
            one = [held.slice(k, 1) for k in first.values()]
            held = pa.concat_tables([t for c, row in zip(first, one) for t in ([row, row.set_column(3, "start", pa.array([-1 - span], pa.int64()))] if len(places[c]) > 1 else [row])]) if one else held
        yield from settled(now.slice(0, at), span)
    if held is not None and schema is not None:
        yield from settled(held, span)


def proven(data: np.ndarray, at: np.ndarray, owner: np.ndarray, windows: np.ndarray, lead: np.ndarray, w: np.ndarray, span: int) -> np.ndarray:
    """Which windows of equal hash have an equal one byte by byte. A window is compared with the first of its hash: all its bytes, or only the last where
    its neighbour was compared with that one's neighbour. Should any differ, all are told apart by their bytes."""
    if not len(windows):
        return np.zeros(0, bool)
    follows = np.zeros(len(windows), bool)
    follows[1:] = (windows[1:] == windows[:-1] + 1) & (owner[windows[1:]] == owner[windows[:-1]]) & (lead[1:] == lead[:-1] + 1) & (owner[lead[1:]] == owner[lead[:-1]])
    mine, its = at[windows], at[lead]
    same = (data[mine[follows] + span - 1] == data[its[follows] + span - 1]).all()
    heads = np.flatnonzero(~follows)
    for k in range(0, len(heads) if same else 0, 4096):
        part = heads[k : k + 4096]
        same = same and (data[mine[part][:, None] + np.arange(span)] == data[its[part][:, None] + np.arange(span)]).all()
    if same:
        return np.ones(len(windows), bool)
    count: dict[tuple[int, bytes], int] = {}
    keys = [(int(w[k]), data[at[k] : at[k] + span].tobytes()) for k in windows.tolist()]
    for x in keys:
        count[x] = count.get(x, 0) + 1
    return np.array([count[x] > 1 for x in keys], bool)


def settled(rows: pa.Table, span: int) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    rows = rows.combine_chunks()
    key, k1, k2 = (rows.column(c).to_numpy() for c in ("key", "k1", "k2"))
    start, shift = rows.column("start").to_numpy(), rows.column("shift").to_numpy()
    order = np.lexsort((shift, start, k2, k1, key))
    again = np.zeros(len(key), bool)
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (k1[order[1:]] == k1[order[:-1]]) & (k2[order[1:]] == k2[order[:-1]]) & (start[order[1:]] == start[order[:-1]]) & (shift[order[1:]] == shift[order[:-1]])
    column = rows.column("context").combine_chunks() if isinstance(rows.column("context"), pa.ChunkedArray) else rows.column("context")
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    out: list[tuple[int, int, int, int]] = []
    done = np.flatnonzero((shift == -2) & (start >= 0) & ~again)
    out += zip(k1[done].tolist(), k2[done].tolist(), start[done].tolist(), key[done].tolist())
    alone = np.flatnonzero((shift == -1) & ~again)
    second = np.zeros(len(alone), np.uint64)
    full = offsets[alone + 1] - offsets[alone] == 8
    if full.any():
        second[full] = data[offsets[alone[full]][:, None] + np.arange(8)].view("<u8").ravel()
    sort = np.lexsort((second, key[alone]))
    equal = (key[alone][sort][1:] == key[alone][sort][:-1]) & (second[sort][1:] == second[sort][:-1])
    paired = np.zeros(len(alone), bool)
    paired[sort[1:][equal]] = paired[sort[:-1][equal]] = True
    for k in alone[paired].tolist():
        if start[k] >= 0:
            out.append((int(k1[k]), int(k2[k]), int(start[k]), int(start[k]) + span))
    runs = np.flatnonzero((shift >= 0) & ~again)
    begin = 0
    while begin < len(runs):
        end = begin + 1
        limit = begin + max(1, int(np.searchsorted(np.cumsum((offsets[1:] - offsets[:-1])[runs[begin:]]), CHUNK // 2, "right")))
        end = max(end, min(limit, len(runs)))
        while end < len(runs) and key[runs[end]] == key[runs[end - 1]]:
            end += 1
        part = runs[begin:end]
        begin = end
        lengths = (offsets[part + 1] - offsets[part]).astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(lengths)))
        bytes_ = data[np.arange(edges[-1]) - np.repeat(edges[:-1], lengths) + np.repeat(offsets[part], lengths)]
        windows = lengths - span + 1
        owner = np.repeat(np.arange(len(part)), windows)
        place = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
        w = hashes(bytes_, span)[edges[:-1][owner] + place]
        w = mix(w + key[part].view(np.uint64)[owner] * np.uint64(0xD6E8FEB86659FD93) + (shift[part][owner] - place).astype(np.uint64))
        _, lead, group, many = np.unique(w, return_index=True, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(many[group] > 1)
        twice = twice[proven(bytes_, edges[:-1][owner] + place, owner, twice, lead[group[twice]], w, span)]
        if len(twice):
            who, at = owner[twice], place[twice]
            cut = np.flatnonzero((np.diff(who) != 0) | (np.diff(at) != 1))
            for s, e in zip(np.append(0, cut + 1).tolist(), np.append(cut, len(twice) - 1).tolist()):
                k = part[who[s]]
                out.append((int(k1[k]), int(k2[k]), int(start[k] + at[s]), int(start[k] + at[e]) + span))
    if out:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["k1", "k2", "start", "stop"])


def finished(batches: Iterator[pa.RecordBatch], text: bool) -> Iterator[pa.RecordBatch]:
    """Of each row (its text first): bytes, removed bytes, spans, digest of the rest, and with text the rest itself."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for body, copied, begin, end in zip(batch.column(0), batch.column("copied").to_pylist(), batch.column("begin").to_pylist(), batch.column("end").to_pylist()):
            raw = (body.as_py() or "").encode()
            parts, at, removed, n = [], 0, 0, 0
            if copied:
                removed, n, at = len(raw), 1, len(raw)
            elif begin:
                reach = -1
                for s, e in sorted(zip(begin, end)):
                    if s > reach:
                        n += 1
                        parts.append(raw[at:s])
                        removed += e - s
                        at = reach = e
                    elif e > reach:
                        removed += e - reach
                        at = reach = e
            rest = b"".join([*parts, raw[at:]])
            for c, v in zip(out, (len(raw), removed, n, hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore") if text else None)):
                c.append(v)
        own = dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"), (pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())))))
        if not text:
            own.pop("kept_text")
        yield pa.record_batch({f.name: batch.column(f.name) for f in batch.schema if f.name not in ("__text", "copied", "begin", "end")} | own)


def remove_repeats(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", span: int = 200, with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text on demand).

    A byte goes if a string of `span` bytes over it also starts at another place, in the same text or any other.
    1. Equal texts are one: every copy of a text of span bytes or more goes whole, and one copy stands for it below.
    2. Each text's cover sample (see cover()) is hashed; hashes that occur once in the corpus are out (plain aggregation).
    3. Rows with other samples send the bytes around them to the bucket of the sample's hash. Buckets are taken one after the
       other: windows of one shift with equal hashes meet and are compared byte by byte; no suffix is sorted and no sample ranks are computed. Memory is bounded by HOT contexts of a bucket; windows of
       more frequent samples, and of periodic texts, travel as two 64-bit hashes each, which need no bucket in memory.
    4. The spans of a text are united, and the text is cut.
    Null text counts as empty; texts shorter than span lose nothing (unless a longer match covers none of them either).
    Rows repeated whole are copies. Results do not depend on the order of rows. Cut UTF-8 is dropped only from kept_text.
    """
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col(doc_id).alias("doc_id"))
    rows = rows.withColumn("k1", F.xxhash64("__text")).withColumn("k2", F.xxhash64(F.lit("second"), "__text"))
    counted = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"))
    copied = materialize(spark, counted.where("copies > 1").select("k1", "k2", "rep"), "copied")
    n_copied = copied.count()
    mark = rows.join(sized(copied.withColumn("is_copy", F.lit(True)), n_copied, 200_000), ["k1", "k2"], "left")
    single = mark.where("is_copy is null or doc_id is null or doc_id = rep").where(F.octet_length("__text") >= span).select("__text", "k1", "k2")

    samples = materialize(spark, single.mapInArrow(lambda b: released(sampled(b, span)), "h bigint, k1 bigint, k2 bigint, times bigint"), "samples")
    often = samples.groupBy("h").agg(F.sum("times").alias("times")).where("times > 1")
    wanted = samples.select("h", "k1", "k2").join(often, "h").groupBy("k1", "k2").agg(F.collect_set("h").alias("common"), F.collect_set(F.when(F.col("times") > HOT, F.col("h"))).alias("hot"))
    wanted = materialize(spark, wanted, "wanted")
    discard(spark, samples)
    near = single.join(sized(wanted, wanted.count(), 200_000), ["k1", "k2"]).select("__text", "k1", "k2", "common", "hot")
    buckets = near.mapInArrow(lambda b: released(contexts(b, span)), "key bigint, k1 bigint, k2 bigint, start bigint, shift int, context binary")
    found = buckets.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: released(repeats(b, span)), "k1 bigint, k2 bigint, start bigint, stop bigint")
    cuts = found.groupBy("k1", "k2").agg(F.collect_list("start").alias("begin"), F.collect_list("stop").alias("end"))
    cuts = materialize(spark, cuts, "cuts")
    whole = mark.join(sized(cuts, cuts.count(), 200_000), ["k1", "k2"], "left")
    whole = whole.select("__text", "doc_id", (F.col("is_copy").isNotNull() & (F.octet_length("__text") >= span)).alias("copied"), "begin", "end")
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    if with_text:
        schema = schema.add("kept_text", "string")
    return whole.mapInArrow(lambda b: released(finished(b, with_text)), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"))
