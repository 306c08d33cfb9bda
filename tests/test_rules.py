"""Rules of which the tables have no case: narrative markers, keywords, metadata, headings, story windows, committed output that is damaged."""

import pytest
from pyspark.sql import functions as F

from siftstone.functions import text as T
from siftstone.operators import metrics, rules, state, stories
from siftstone.runtime import shared_dir
from siftstone.sources import files, output

FILL = "The road went on past the mill and the old barn stood there in the rain all day long. "


def value(spark, column, **cells):
    return spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} string" for k in cells)).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, points", [
    ("my my my my my", 8), ("I was born here", 4), ("Ich und mein Haus", 2), ("我的 我的 我的 我的 我", 5), ("я мой дом", 2), ("của tôi", 2),
    ("please reserve a seat", -50), ("[Verse 2] la", -50), ("a:b:c:d:e:f:g", -50), ("english french german italian spanish", -50), ("my train", 0), ("plain words only", 0),
])
def test_narrative(spark, text, points):
    assert value(spark, rules.narrative_score(F.col("t")), t=text) == points


def test_repetition(spark):
    assert value(spark, rules.repetitive(F.col("t")), t="one two three " * 20) and not value(spark, rules.repetitive(F.col("t")), t=" ".join(f"w{i}" for i in range(60)))


@pytest.mark.parametrize("finder", [lambda c: rules.keyword_finder(["hem", "heimat", "故郷", "根"])(c), lambda c: rules.keyword_hits(c, ["hem", "heimat", "故郷", "根"])])
def test_keywords(spark, finder):
    """Short words only as wholes, but anywhere in scripts without blanks; long ones anywhere."""
    cases = {"them and hem": ["hem"], "Them": [], "HEM!": ["hem"], "hemé": [], "Urheimatliche": ["heimat"], "私の根です": ["根"], "故郷へ": ["故郷"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["h"] for r in df.select("t", finder(F.col("t")).alias("h")).collect()} == {k: sorted(v) for k, v in cases.items()}


def test_metadata(spark):
    text = "When I was young we moved from New York to Lisbon in 1961. I was born in Old Town. Five years ago, in the 1990s and 1961, I grew up in home."
    m = value(spark, T.story_metadata(F.col("t"), F.col("d")), t=text, d="2020-01-01")
    assert m["year_mentions"] == [1961] and m["decade_mentions"] == ["1990s"] and m["migration_routes"] == ["New York -> Lisbon"] and m["capture_year"] == 2020
    assert m["place_mentions"] == ["New York", "Old Town", "Lisbon"] and m["time_expressions"] == ["When I was young", "years ago"] and m["metadata_confidence"] == 0.95


@pytest.mark.parametrize("text, is_heading", [("Chapter 3", True), ("* * *", True), ("Dear Anna,", True), ("THE END", True), ("The Old House", True), ("he went home", False), ("It ended.", False), ("", True)])
def test_headings(spark, text, is_heading):
    assert value(spark, T.heading(F.col("t")), t=text) == is_heading == stories.is_heading(text)


def test_story_window():
    p = ["Chapter 1", FILL, FILL, FILL + "seed", FILL, "he said this:", "PART TWO", FILL]
    w = stories.story_window(p, 3)
    assert [x["paragraph_index"] for x in w["paragraphs"]] == [1, 2, 3, 4] and w["boundary_before"] == "context_limit" and w["boundary_after"] == "structural_boundary"
    assert [x["role"] for x in w["paragraphs"]] == ["context_before", "context_before", "seed", "context_after"] and w["story_length_ready"]
    assert stories.story_window(p[:5], 1, before=2)["boundary_before"] == "structural_boundary" and stories.story_window([FILL], 0)["boundary_after"] == "document_end"
    assert stories.story_window(["a b c d. " * 9, FILL, "x y. " * 9], 1, chars=len(FILL) + 10)["boundary_before"] == "character_limit"
    with pytest.raises(IndexError):
        stories.story_window(p, 9)


def test_linked_loss():
    p = ["My brother died in spring. " + FILL, FILL, "Following this letter came:", FILL, FILL, FILL, FILL, "The death of my brother changed us. " + FILL]
    w = stories.story_window(p, 7)
    assert [(x["paragraph_index"], x["role"]) for x in w["paragraphs"]] == [(0, "referenced_event"), (1, "referenced_context"), (5, "context_before"), (6, "context_before"), (7, "seed")]
    assert w["linked_context"]["matched_kinship"] == "brother" and w["omissions"] == [{"after_paragraph_index": 1, "before_paragraph_index": 5, "paragraph_count": 3}]
    assert stories.story_window([x.replace("brother", "uncle") for x in p], 7)["linked_context"] is None


def test_recovery_serves_each_target_once(spark):
    story = stories.story_window([FILL], 0)
    parsed = spark.createDataFrame([("r1", "u", "d", "a", story, 0), ("zz", "u", "d", "same  text", story, 1), ("yy", "u", "d", "same text", {**story, "expansion_version": "old"}, 2)], f"record_id string, url string, warc_date string, paragraph string, story struct<{stories.STORY.replace(' string', ':string').replace(' int', ':int').replace(' boolean', ':boolean').replace(' array<', ':array<').replace(' struct<', ':struct<')}>, seq int")
    targets = spark.createDataFrame([("r1", "u", "d", "other"), ("r2", "u", "d", "same text"), ("r3", "u", "d", "same text")], "record_id string, url string, warc_date string, paragraph string")
    assert sorted(r["record_id"] for r in stories.recover(targets, parsed).collect()) == ["r1", "r2"]


def test_damaged_output_is_told(spark):
    root = f"{shared_dir(spark)}/damaged"
    rows = spark.createDataFrame([(f"s{k % 2}", f"r{k}", "f", 5, "en", k) for k in range(6)], "source_file string, record_id string, content_fingerprint string, schema_version int, language string, seq int")
    output.commit(spark, root, rows, rows.select("source_file"), "1")
    assert output.verify(spark, root).isEmpty()
    (shard,) = (r["p"] for r in output.effective(spark, root).where("source_file = 's1'").select(F.explode("shards.path").alias("p")).collect())
    other = rows.where("source_file = 's0'").withColumn("record_id", F.lit(""))
    files.remove(spark, f"{root}/{shard.rpartition('/')[0]}")
    other.write.option("compression", "gzip").json(f"{root}/en/source=0123456789abcdef")
    found = {r["source_file"]: [e.split(":")[0] for e in r["errors"]] for r in output.verify(spark, root).collect()}
    assert found["s1"] == ["missing shard", "manifest total mismatch"] and set(found[None]) >= {"no manifest"}
    files.remove(spark, root)


@pytest.mark.parametrize("state_, kept", [("staged", "old"), ("swapping", "old"), ("swapped", "new")])
def test_broken_swap_recovers(spark, state_, kept):
    root = f"{shared_dir(spark)}/swap-{state_}"
    for name in ("data", "staged"):
        files.write_json(spark, f"{root}/{name}/x.json", {"v": "old" if name == "data" else "new"})
    note = {"state": state_, "target": f"{root}/data", "staged": f"{root}/staged", "backup": f"{root}/backup"}
    if state_ != "staged":
        files.move(spark, f"{root}/data", f"{root}/backup")
    if state_ == "swapped":
        files.move(spark, f"{root}/staged", f"{root}/data")
    files.write_json(spark, f"{root}/.data-journal.json", note)
    done = []
    assert files.recover(spark, f"{root}/data", lambda: done.append(1)) == state_ and files.read_json(spark, f"{root}/data/x.json") == {"v": kept}
    assert files.children(spark, root) == ["data"] and done == [1] * (state_ == "swapped") and files.recover(spark, f"{root}/data") is None


def test_refused_work(spark):
    rows = spark.createDataFrame([("a", "c", "processing")], "file_path string, crawl_id string, status string")
    full = state.initialize(spark.createDataFrame([], state.SCHEMA), rows.select("file_path"), "c").withColumn("status", F.lit("processing"))
    with pytest.raises(RuntimeError):
        state.compact(full, "/tmp/never")
    with pytest.raises(RuntimeError):
        state.with_counts(full, spark.createDataFrame([("a", 1)], "file_path string, matches int"))
    with pytest.raises(RuntimeError):
        output.shard_sources(rows, spark.createDataFrame([("none",)], "name string"))
    with pytest.raises(ValueError):
        state.crawl_order(rows, "sideways")
    assert metrics.overall(spark.createDataFrame([("pass",), ("warning",)], "status string")).first()[0] == "attention"


def test_throttle_and_batches():
    from siftstone.operators.runs import Batches, Throttle, chunks

    now = [0.0]
    t = Throttle(8, clock=lambda: now[0])
    t.observe("failed", "http_503")
    assert t.slots(0) == 0 and t.now == 4
    now[0] = 31.0
    assert t.slots(1) == 3
    for _ in range(4):
        t.observe("completed")
    assert t.now == 5
    t.observe("failed", "other")
    assert t.now == 5 and list(chunks(["a", "b"], {"a": 150, "b": 20}, 160)) == [("a", 100), ("b", 20), ("a", 40)]

    def encode(texts):
        if len(texts) > 10:
            raise MemoryError
        return texts

    b = Batches(32)
    assert b.run(encode, list("x" * 100)) == list("x" * 100) and b.faults >= 2
    with pytest.raises(MemoryError):
        Batches(32).run(lambda x: (_ for _ in ()).throw(MemoryError()), ["a"])


def test_evidence_is_kept_once(spark):
    from siftstone.operators.runs import archive_evidence

    folder = f"{shared_dir(spark)}/evidence"
    one = archive_evidence(spark, {"audit_id": "a/1", "x": 1}, folder)
    assert archive_evidence(spark, {"audit_id": "a/1", "x": 1}, folder) == one != archive_evidence(spark, {"audit_id": "a/1", "x": 2}, folder)
    assert len(files.children(spark, folder)) == 2
    files.remove(spark, folder)
