"""Inputs on which an operator once did less than the whole job."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from siftstone.llm import embedding_graph, pii, suffix_dedup


def vectors(sizes, loners, noise=0.1, dim=64, seed=5):
    """Families of distinct near copies, and vectors near none."""
    r = np.random.default_rng(seed)
    parts = [r.normal(size=(loners, dim))]
    for n in sizes:
        centre, away = r.normal(size=dim), r.normal(size=(n, dim))
        parts.append(centre / np.linalg.norm(centre) + noise * away / np.linalg.norm(away, axis=1, keepdims=True))
    x = r.permutation(np.concatenate(parts))
    return pd.DataFrame({"vec_id": range(len(x)), "embedding": x.tolist(), "label": 0})


def test_every_link_of_families_larger_than_the_pool(spark):
    table = vectors([100] * 5 + [30] * 10, 50)
    found = embedding_graph.near_duplicates(spark, spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")).toPandas()
    assert embedding_graph.audit(table, found) == 1.0


def test_pools_of_a_large_family_are_bounded(monkeypatch):
    widths = []
    prune = embedding_graph.robust_prune
    monkeypatch.setattr(embedding_graph, "robust_prune", lambda *a: widths.append(a[1].shape[1]) or prune(*a))
    table = vectors([300], 50).rename(columns={"vec_id": "id"}).assign(shard="s", home=True, copies=1)
    found = embedding_graph.build(table, 24, 1.2, 64, 0.98)
    assert len(found) == 350 and max(widths) <= 64


@pytest.mark.parametrize("shape", ["ring", "families"])
def test_links_are_counted_not_listed(spark, monkeypatch, shape):
    """A ring, whose links cross all its shards, and families larger than a shard may be: all links, from a table no larger than the shards."""
    angle = np.random.default_rng(3).uniform(0, 2 * np.pi, 1500)
    table = pd.DataFrame({"vec_id": range(1500), "embedding": np.stack((np.cos(angle), np.sin(angle)), 1).tolist(), "label": 0}) if shape == "ring" else vectors([400, 200] + [20] * 10, 300)
    table = pd.concat([table, table.head(50).assign(vec_id=range(10_000, 10_050))])
    rows = {}
    write = embedding_graph.materialize

    def counting(s, df, tag):
        out = write(s, df, tag)
        rows[tag] = rows.get(tag, 0) + out.count()
        return out

    monkeypatch.setattr(embedding_graph, "materialize", counting)
    found = embedding_graph.near_duplicates(spark, spark.createDataFrame(table, "vec_id long, embedding array<double>, label int"), target=32).toPandas().set_index("vec_id")
    x = embedding_graph.unit(table["embedding"])
    links = x @ x.T >= 0.98
    assert len(found) == len(table) and rows["vector_links"] <= 4 * len(table)
    n, want = found.loc[table["vec_id"], "n_links"].to_numpy(), links.sum(1) - 1
    assert (n <= want).all() and n.sum() >= 0.99 * want.sum()
    component = found.loc[table["vec_id"], "component_id"].to_numpy()
    assert (links & (component[:, None] != component)).sum() <= 0.01 * want.sum()


def test_spans_of_one_end_in_many_texts(monkeypatch):
    """More than 3 * HOT texts with a settled span, or a hot window, at the same place: none gets a span of another place."""
    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    types = [("key", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("shift", pa.int32()), ("context", pa.binary())]
    rows = [(7, 99, 99, 30, -1, b"")] + [(450, i, i, 150, -2, b"") for i in range(20)] + [(900, i, i, 20, -1, b"") for i in range(20)]
    batches = [pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows[a : a + 5]), types)], [n for n, _ in types]) for a in range(0, len(rows), 5)]
    got = sorted({tuple(r.values()) for b in suffix_dedup.repeats(iter(batches), 200) for r in b.to_pylist()})
    assert got == sorted([(i, i, 150, 450) for i in range(20)] + [(i, i, 20, 220) for i in range(20)])


def test_hot_lines_behind_a_header(monkeypatch):
    """Texts with a ruler line behind a header of fixed length, from samples to cuts."""
    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    r = np.random.default_rng(3)
    texts = ["".join(map(chr, [*r.integers(97, 123, 49), 65 + i, *[45] * 300, 65 + i, *r.integers(97, 123, 149)])) for i in range(20)]
    ids = list(range(20))
    table = pa.record_batch([pa.array(texts), pa.array(ids, pa.int64()), pa.array(ids, pa.int64())], ["t", "k1", "k2"])
    samples = pa.Table.from_batches(suffix_dedup.sampled(iter([table]), 200)).to_pandas()
    times = samples.groupby("h")["times"].sum()
    own = samples.groupby("k1")["h"].unique()
    common = [[int(h) for h in own[i] if times[h] > 1] for i in ids]
    hot = [[h for h in c if times[h] > 4] for c in common]
    wide = pa.record_batch([*table.columns, pa.array(common, pa.list_(pa.int64())), pa.array(hot, pa.list_(pa.int64()))], ["t", "k1", "k2", "common", "hot"])
    buckets = pa.Table.from_batches(suffix_dedup.contexts(iter([wide]), 200)).sort_by("key")
    cuts = pa.concat_tables([pa.Table.from_batches([b]) for b in suffix_dedup.repeats(iter(buckets.to_batches(max_chunksize=5)), 200)]).to_pandas()
    assert {(i, c["start"].min(), c["stop"].max()) for i, c in cuts.groupby("k1")} == {(i, 50, 350) for i in ids}


def test_windows_of_one_hash_are_told_apart_by_their_bytes():
    """Two contexts that share their hashes but not their bytes, and two that share both."""
    r = np.random.default_rng(8)
    a, b = r.integers(97, 123, 210, dtype=np.uint8), r.integers(97, 123, 210, dtype=np.uint8)
    data = np.concatenate((a, b, a))
    owner, at = np.repeat([0, 1, 2], 11), np.concatenate([np.arange(11) + 210 * k for k in range(3)])
    windows, lead, w = np.arange(33), np.tile(np.arange(11), 3), np.tile(np.arange(11), 3).astype(np.uint64)
    assert suffix_dedup.proven(data, at, owner, windows, lead, w, 200).tolist() == [True] * 11 + [False] * 11 + [True] * 11
    assert suffix_dedup.proven(np.concatenate((a, a, a)), at, owner, windows, lead, w, 200).all()


@pytest.fixture(scope="module")
def model():
    return pii.trained()


DISGUISED = ["john at example.com", "john[at]example.com", "john (at) mail.example.com", "john@example dot com", "john @ example.com", "john@example[.]com", "705\u2013555\u20133138", "705\u00a0555\u00a03138", "[705] 555-3138", "705-555-\n3138", "4111\u00a01111\u00a01111\u00a01111", "4111\u20131111\u20131111\u20131111", "192[.]168[.]10[.]12"]


@pytest.mark.parametrize("hidden", DISGUISED)
def test_disguised_data_is_found(model, hidden):
    text = f"write {hidden}, thanks"
    assert pii.SOME.search(text)
    assert [(s, e) for _, s, e in pii.added_spans(text, pii.base_spans(text), model)] == [(6, 6 + len(hidden))]


@pytest.mark.parametrize("text", ["look at example.com, thanks", "in 1990\u20131995 and 2001", "rows\n12\n345\n67\n8901\nend", "meet at noon.Then go", "costs 12\t340\t5600\t9 now"])
def test_look_alikes_are_left(model, text):
    assert pii.added_spans(text, pii.base_spans(text), model) == []
