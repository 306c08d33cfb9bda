"""Committed matches: one shard a source and language, manifests with checksums, verification, refiltering.

    <root>/<language>/source=<digest>/part-*.json.gz      matches of one source
    <root>/_manifests/<token>                             manifests of one commit; of a source the latest counts
    <root>/_catalog                                       compacted manifests

A commit stages all its sources, moves what they replace into a backup, and moves the staged shards in; an error moves everything back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.functions import text as T
from siftstone.functions.python import repair_text
from siftstone.operators import rules
from siftstone.operators.state import latest, overlay
from siftstone.runtime import materialize
from siftstone.sources import files

VERSION, SUPPORTED = 5, (2, 3, 4, 5)
SHARD = "language string, path string, records bigint, bytes bigint, sha256 string"
MANIFEST = f"source_file string, source_digest string, records bigint, committed_at string, filter_signature string, run_id string, tombstone boolean, shards array<struct<{SHARD.replace(' ', ':').replace(',:', ',')}>>"


def match_records(matches: DataFrame, signature: str = "", run: str = "", seq: str = "seq") -> DataFrame:
    """Output records of matches: identities, a plain language, four-place scores, raw_paragraph only where it differs; of a record_id in a source the first by seq."""
    ids = T.record_id(F.col("crawl_id"), F.col("source_file"), F.col("url"), F.col("warc_date"), F.col("paragraph"))
    rows = matches.withColumn("record_id", ids).withColumn("content_fingerprint", T.content_fingerprint(F.col("url"), F.col("paragraph")))
    rows = rows.withColumn("language", T.safe_language(F.col("language"))).withColumn("language_confidence", F.bround("language_confidence", 4)).withColumn("semantic_score", F.bround("semantic_score", 4))
    rows = rows.withColumns({"schema_version": F.lit(VERSION), "filter_signature": F.lit(signature), "run_id": F.lit(run)})
    if "raw_paragraph" in rows.columns:
        rows = rows.withColumn("raw_paragraph", F.when((F.col("raw_paragraph") != "") & (F.col("raw_paragraph") != F.col("paragraph")), F.col("raw_paragraph")))
    fields = [c for c in rows.columns if c not in ("source_file", "record_id")]
    first = rows.groupBy("source_file", "record_id").agg(F.min_by(F.struct(*fields), seq).alias("r"))
    return first.select("source_file", "record_id", *[F.col(f"r.{c}").alias(c) for c in fields])


def shard_path(root: str, language: str, digest: str) -> str:
    return f"{root}/{language}/source={digest}"


def _manifests(spark: SparkSession, staged: str, records: DataFrame, sources: DataFrame, known: DataFrame, signature: str, run: str, now: str) -> DataFrame:
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").load(staged)
    where = F.regexp_extract("path", "([^/]+)/source=([0-9a-f]+)/[^/]+$", 1), F.regexp_extract("path", "source=([0-9a-f]+)/[^/]+$", 1)
    read = parts.select(where[0].alias("language"), where[1].alias("source_digest"), F.regexp_extract("path", "([^/]+/source=[0-9a-f]+/[^/]+)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    counts = spark.read.text(f"{staged}/*/*").groupBy(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/source=[0-9a-f]+/[^/]+)$", 1).alias("path")).agg(F.count("*").alias("records"))
    shards = read.join(counts, "path").groupBy("source_digest").agg(F.array_sort(F.collect_list(F.struct("language", "path", "records", "bytes", "sha256"))).alias("shards"), F.sum("records").alias("records"))
    asked = sources.select("source_file").distinct().withColumn("source_digest", T.source_digest(F.col("source_file")))
    before = known.select(F.col("source_file").alias("__s"))
    out = asked.join(shards, "source_digest", "left").join(before, F.col("source_file") == F.col("__s"), "left").where(F.col("shards").isNotNull() | F.col("__s").isNotNull())
    none = F.array().cast(shards.schema["shards"].dataType)
    return out.select("source_file", "source_digest", F.coalesce("records", F.lit(0)).alias("records"), F.lit(now).alias("committed_at"), F.lit(signature).alias("filter_signature"), F.lit(run).alias("run_id"), F.col("shards").isNull().alias("tombstone"), F.coalesce("shards", none).alias("shards"))


def commit(spark: SparkSession, root: str, records: DataFrame, sources: DataFrame, now: str, signature: str = "", run: str = "") -> DataFrame:
    """Replaces everything committed of the sources (source_file) by records; a source without records that had some gets a tombstone. Returns the manifests written."""
    token = uuid.uuid4().hex
    staged, backup = f"{root}/_staging/{token}", f"{root}/_backup/{token}"
    rows = records.withColumn("__language", T.safe_language(F.col("language"))).withColumn("source", T.source_digest(F.col("source_file")))
    columns = [c for c in records.columns]
    named = rows.select(*columns, F.col("__language").alias("lang_dir"), "source")
    named.repartition("lang_dir", "source").sortWithinPartitions("lang_dir", "source", "record_id").write.partitionBy("lang_dir", "source").option("compression", "gzip").json(staged)
    for name in files.children(spark, staged):
        if name.startswith("lang_dir="):
            files.move(spark, f"{staged}/{name}", f"{staged}/{name[9:]}")
    made = [n for n in files.children(spark, staged) if not n.startswith(("_", "."))]
    manifest = materialize(spark, _manifests(spark, staged, records, sources, effective(spark, root), signature, run, now), "manifests") if made else materialize(spark, spark.createDataFrame([], MANIFEST).unionByName(_tombstones(spark, sources, effective(spark, root), signature, run, now)), "manifests")
    digests = {r["d"] for r in sources.select(T.source_digest(F.col("source_file")).alias("d")).distinct().toLocalIterator()}
    moved: list[tuple[str, str]] = []
    try:
        for language in [n for n in files.children(spark, root) if not n.startswith(("_", "."))]:
            for source in files.children(spark, f"{root}/{language}"):
                if source.removeprefix("source=") in digests:
                    files.move(spark, f"{root}/{language}/{source}", f"{backup}/{language}/{source}")
                    moved.append((f"{root}/{language}/{source}", f"{backup}/{language}/{source}"))
        for language in made:
            for source in files.children(spark, f"{staged}/{language}"):
                files.move(spark, f"{staged}/{language}/{source}", f"{root}/{language}/{source}")
                moved.append((f"{staged}/{language}/{source}", f"{root}/{language}/{source}"))
        manifest.coalesce(1).write.json(f"{root}/_manifests/{token}")
    except Exception:
        for source, target in reversed(moved):
            files.move(spark, target, source)
        files.remove(spark, f"{root}/_manifests/{token}")
        raise
    finally:
        files.remove(spark, staged)
    files.remove(spark, backup)
    return manifest


def _tombstones(spark: SparkSession, sources: DataFrame, known: DataFrame, signature: str, run: str, now: str) -> DataFrame:
    gone = sources.select("source_file").distinct().join(known.select("source_file"), "source_file", "left_semi")
    none = F.array().cast(spark.createDataFrame([], MANIFEST).schema["shards"].dataType)
    return gone.select("source_file", T.source_digest(F.col("source_file")).alias("source_digest"), F.lit(0).cast("bigint").alias("records"), F.lit(now).alias("committed_at"), F.lit(signature).alias("filter_signature"), F.lit(run).alias("run_id"), F.lit(True).alias("tombstone"), none.alias("shards"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path)


def loose(spark: SparkSession, root: str) -> DataFrame:
    """The latest manifest of each source among those not compacted, tombstones too."""
    if not files.children(spark, f"{root}/_manifests"):
        return spark.createDataFrame([], MANIFEST)
    return latest(_read(spark, f"{root}/_manifests/*"), "source_file", F.col("committed_at")).select(*[f.name for f in spark.createDataFrame([], MANIFEST).schema.fields])


def effective(spark: SparkSession, root: str) -> DataFrame:
    """The compacted catalog under loose manifests; tombstones remove; by source."""
    catalog = _read(spark, f"{root}/_catalog") if files.exists(spark, f"{root}/_catalog") else spark.createDataFrame([], MANIFEST)
    return overlay(catalog, loose(spark, root), "source_file")


def compact_manifests(spark: SparkSession, root: str) -> int:
    """All effective manifests in one sorted zipped file; returns their number."""
    rows = materialize(spark, effective(spark, root), "catalog")
    staged = f"{root}/_staging/catalog-{uuid.uuid4().hex}"
    rows.coalesce(1).sortWithinPartitions("source_file").write.option("compression", "gzip").json(staged)
    files.swap(spark, f"{root}/_catalog", staged, lambda: files.remove(spark, f"{root}/_manifests"))
    return rows.count()


def read_records(spark: SparkSession, root: str, schema: str | None = None, sources: list[str] | None = None, crawls: list[str] | None = None) -> DataFrame:
    """Committed records with seq columns that give the scan order (language, shard, line). With sources, only their shards are read; crawls keep sources by the crawl of their first record."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if sources is None:
        names = [n for n in files.children(spark, root) if not n.startswith(("_", "."))]
        paths = [f"{root}/{n}/*" for n in names]
    else:
        wanted = effective(spark, root).where(F.col("source_file").isin(*sources)).select(F.explode("shards.path").alias("p"))
        paths = [f"{root}/{r['p']}" for r in wanted.toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], schema or "record_id string")
    rows = reader.json(paths).withColumns({"scan_file": F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/source=[0-9a-f]+/[^/]+)$", 1), "scan_line": F.monotonically_increasing_id()})
    if crawls is None:
        return rows
    first = rows.groupBy(F.col("source_file").alias("__s")).agg(F.min_by("crawl_id", F.struct("scan_file", "scan_line")).alias("__c")).where(F.col("__c").isin(*crawls))
    return rows.join(first.select("__s"), F.col("source_file") == F.col("__s"), "left_semi")


def verify(spark: SparkSession, root: str) -> DataFrame:
    """source_file and sorted errors of every source whose shards do not agree with its manifest, and of shards without a manifest (source_file null)."""
    want = effective(spark, root).select("source_file", F.col("records").alias("total"), F.explode_outer("shards").alias("s")).select("source_file", "total", "s.*")
    names = [n for n in files.children(spark, root) if not n.startswith(("_", "."))]
    tail = "([^/]+/source=[0-9a-f]+/[^/]+)$"
    if names:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{root}/{n}" for n in names]).select(F.regexp_extract("path", tail, 1).alias("there"), F.sha2("content", 256).alias("digest"))
        lines = spark.read.text([f"{root}/{n}/*" for n in names]).select(F.regexp_extract(F.col("_metadata.file_path"), tail, 1).alias("at"), F.from_json("value", "source_file string, schema_version int, record_id string, content_fingerprint string").alias("r"))
        facts = lines.groupBy("at").agg(F.count("*").alias("rows"), F.collect_set("r.source_file").alias("sources"), F.count_if(~F.coalesce(F.col("r.schema_version").isin(*SUPPORTED), F.lit(False))).alias("old"), F.count_if((F.coalesce("r.record_id", F.lit("")) == "") | (F.coalesce("r.content_fingerprint", F.lit("")) == "")).alias("nameless"))
    else:
        found = spark.createDataFrame([], "there string, digest string")
        facts = spark.createDataFrame([], "at string, rows bigint, sources array<string>, old bigint, nameless bigint")
    both = want.join(found, F.col("path") == F.col("there"), "full_outer").join(facts, F.col("there") == F.col("at"), "left")
    named = lambda what: F.concat(F.lit(f"{what}: "), F.coalesce("path", "there"))
    here = F.col("there").isNotNull() & F.col("path").isNotNull()
    errors = F.array_compact(F.array(
        F.when(F.col("path").isNotNull() & F.col("there").isNull(), named("missing shard")),
        F.when(F.col("there").isNotNull() & F.col("source_file").isNull(), named("no manifest")),
        F.when(here & (F.col("digest") != F.col("sha256")), named("checksum mismatch")),
        F.when(here & (F.coalesce("rows", F.lit(0)) != F.col("records")), named("row count mismatch")),
        F.when(here & (F.size(F.array_except("sources", F.array("source_file"))) > 0), named("source mismatch")),
        F.when(here & (F.col("old") > 0), named("schema mismatch")),
        F.when(here & (F.col("nameless") > 0), named("missing identity")),
    ))
    per = both.withColumn("e", errors).groupBy("source_file").agg(F.array_sort(F.flatten(F.collect_list("e"))).alias("errors"), F.sum("rows").alias("have"), F.max("total").alias("total"))
    total = F.when(F.col("source_file").isNotNull() & (F.coalesce("have", F.lit(0)) != F.col("total")), F.array(F.lit("manifest total mismatch"))).otherwise(F.array().cast("array<string>"))
    return per.select("source_file", F.concat("errors", total).alias("errors")).where(F.size("errors") > 0)


def shard_sources(state: DataFrame, names: DataFrame) -> DataFrame:
    """name and source of shard files by either naming scheme; raises if a name fits several sources or none."""
    both = state.select("file_path", F.explode(F.array_distinct(F.array(T.shard_name(F.col("file_path")), T.old_shard_name(F.col("file_path"))))).alias("name"))
    found = names.select("name").distinct().join(both, "name", "left").groupBy("name").agg(F.collect_set("file_path").alias("s"))
    found = materialize(state.sparkSession, found, "shard_sources")
    bad = found.where(F.size("s") != 1).head(1)
    if bad:
        raise RuntimeError(f"{'ambiguous' if bad[0]['s'] else 'unknown'} shard name: {bad[0]['name']}")
    return found.select("name", F.col("s")[0].alias("source_file"))


def refiltered(records: DataFrame, state: DataFrame, score: float = 0.45, narrative: int = 8, order: tuple[str, ...] = ("record_id",)) -> DataFrame:
    """records of completed sources that pass the thresholds after repair and a new narrative score, with new identities; of equal ones in a source the first.

    A source with two shards of one name cannot occur here: shards are written per source.
    """
    done = state.where("status = 'completed'").select(F.col("file_path").alias("__p")).distinct()
    rows = records.join(done, F.col("source_file") == F.col("__p"), "left_semi").withColumn("__old", F.col("paragraph"))
    rows = rows.withColumn("paragraph", repair_text("paragraph")).withColumn("narrative_score", rules.narrative_score(F.col("paragraph")))
    rows = rows.where((F.coalesce("semantic_score", F.lit(0.0)) >= score) & (F.col("narrative_score") >= narrative))
    raw = F.col("raw_paragraph") if "raw_paragraph" in records.columns else F.lit(None).cast("string")
    rows = rows.withColumn("raw_paragraph", F.coalesce(raw, F.when(F.col("paragraph") != F.col("__old"), F.col("__old"))))
    rows = rows.withColumn("__order", F.struct(*order)).withColumn("record_id", T.record_id(F.col("crawl_id"), F.col("source_file"), F.col("url"), F.col("warc_date"), F.col("paragraph"))).withColumn("content_fingerprint", T.content_fingerprint(F.col("url"), F.col("paragraph"))).withColumn("schema_version", F.lit(VERSION))
    fields = [c for c in rows.columns if c not in ("source_file", "record_id", "__old", "__order")]
    first = rows.groupBy("source_file", "record_id").agg(F.min_by(F.struct(*fields), "__order").alias("r"))
    return first.select("source_file", "record_id", *[F.col(f"r.{c}").alias(c) for c in fields])


def audit_sources(rows: DataFrame, signature: str, per_crawl: int, crawls: list[str] | None = None, include_current: bool = False) -> DataFrame:
    """Completed sources to audit: of each crawl first one with and one without matches, then by hash rank, per_crawl in all."""
    from siftstone.operators.state import signature_state

    done = rows.where("status = 'completed'").where(F.lit(True) if not crawls else F.col("crawl_id").isin(*crawls))
    done = done.withColumn("signature_state", signature_state(signature))
    done = done if include_current else done.where("signature_state <> 'current'")
    rank = F.substring(F.sha2(F.concat_ws("\x00", F.lit(signature), "file_path"), 256), 1, 16)
    done = done.select("crawl_id", "file_path", F.col("matches_found").alias("historical_matches"), "completed_at", "signature_state", rank.alias("rank"), (F.col("matches_found") > 0).alias("matched"))
    inner = done.withColumn("place", F.row_number().over(Window.partitionBy("crawl_id", "matched").orderBy("rank", F.desc("file_path")))).where(F.col("place") <= per_crawl)
    first = F.when(F.col("place") == 1, F.when(F.col("matched"), 0).otherwise(1)).otherwise(2)
    place = F.row_number().over(Window.partitionBy("crawl_id").orderBy(first, "rank", F.desc("file_path")))
    return inner.withColumn("position", place).where(F.col("position") <= per_crawl).drop("place", "rank", "matched")


def audit_compare(plan: DataFrame, states: DataFrame, historical: DataFrame, current: DataFrame, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(sources, crawls): of each planned source its state and how its records (source_file, url, paragraph) differ as multisets of content; of each crawl whether it may be adopted, and why not."""
    from siftstone.operators.state import multiset_difference

    keyed = lambda d: d.select("source_file", T.content_fingerprint(F.col("url"), repair_text("paragraph")).alias("k"))
    gap = multiset_difference(keyed(historical), keyed(current), "source_file", "k").groupBy(F.col("source_file").alias("__s")).agg(F.sum("shared").alias("normalized_overlap"), F.sum("only_a").alias("removed_matches"), F.sum("only_b").alias("added_matches"))
    out = plan.join(states.select(F.col("file_path").alias("__p"), "status"), F.col("file_path") == F.col("__p"), "left").join(gap, F.col("file_path") == F.col("__s"), "left")
    done = F.coalesce(F.col("status") == "completed", F.lit(False))
    number = lambda c: F.when(done, F.coalesce(F.col(c), F.lit(0)))
    sources = out.select("crawl_id", "file_path", F.coalesce("status", F.lit("missing")).alias("audit_status"), *[number(c).alias(c) for c in ("normalized_overlap", "removed_matches", "added_matches")])
    crawls = sources.groupBy("crawl_id").agg(F.count("*").alias("selected_sources"), F.count_if(F.col("audit_status") == "completed").alias("completed_sources"), F.coalesce(F.sum("added_matches"), F.lit(0)).alias("added_matches"), F.coalesce(F.sum("removed_matches"), F.lit(0)).alias("removed_matches"))
    reasons = F.array_compact(F.array(F.when(F.col("selected_sources") < least, f"requires at least {least} audited sources"), F.when(F.col("completed_sources") != F.col("selected_sources"), "not every selected source completed"), F.when((F.col("added_matches") > 0) | (F.col("removed_matches") > 0), "the normalized match set changed")))
    return sources, crawls.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def adoptable(sources: DataFrame, crawls: DataFrame, requested: list[str], least: int = 5) -> list[str]:
    """The requested crawls if the evidence allows all of them; raises for one that is not eligible or whose sources do not bear the summary out."""
    bad = F.count_if((F.col("audit_status") != "completed") | (F.coalesce("added_matches", F.lit(0)) > 0) | (F.coalesce("removed_matches", F.lit(0)) > 0))
    seen = sources.groupBy(F.col("crawl_id").alias("__c")).agg(F.count("*").alias("n"), bad.alias("bad"))
    good = crawls.join(seen, F.col("crawl_id") == F.col("__c")).where(F.col("eligible") & (F.col("bad") == 0) & (F.col("n") == F.col("selected_sources")) & (F.col("n") >= least) & (F.col("completed_sources") == F.col("n")))
    allowed = {r["crawl_id"] for r in good.select("crawl_id").toLocalIterator()}
    if not requested or set(requested) - allowed:
        raise ValueError(f"audit evidence is insufficient for: {sorted(set(requested) - allowed) or 'no crawl'}")
    return sorted(set(requested))
