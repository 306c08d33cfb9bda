"""Publication of datasets: partitioned Parquet with a checked manifest, the four tables of stories, and Markdown."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import text as T
from siftstone.functions.columns import domain
from siftstone.operators import corpus, stories
from siftstone.operators.ranks import ranked
from siftstone.runtime import materialize, shared_dir
from siftstone.sources import files


def safe_value(value: Column) -> Column:
    """Partition values of at most 120 plain characters; empty is unknown."""
    given = F.when(F.coalesce(value.cast("string"), F.lit("")) == "", "unknown").otherwise(value.cast("string"))
    out = F.substring(T.safe_name(given), 1, 120)
    return F.when(out == "", F.lit("unknown")).otherwise(out)


def publish(spark: SparkSession, rows: DataFrame, by: list[str], path: str | None = None, per_file: int = 1_000) -> DataFrame:
    """Writes zstd Parquet partitioned by copies of the columns `by`, which stay in the files, at most per_file rows each, and reads it back; raises if a partition's rows differ."""
    path = path or f"{shared_dir(spark)}/publish-{uuid.uuid4().hex}"
    parted = rows.select("*", *[safe_value(F.col(c)).alias(f"part_{c}") for c in by])
    parted.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", per_file).partitionBy(*[f"part_{c}" for c in by]).parquet(path)
    out = spark.read.parquet(path)
    keys = [f"part_{c}" for c in by]
    want = parted.groupBy(*keys).agg(F.count("*").alias("want"))
    have = out.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(F.count("*").alias("have"))
    if not want.join(have, keys, "full_outer").where("not (want <=> have)").isEmpty():
        raise ValueError("published rows differ from the input")
    return out.select(*rows.columns)


def with_identity(records: DataFrame) -> DataFrame:
    """Records of any age with all fields: stored identities stay, missing ones are made; the story fingerprint is always made; nulls get their defaults."""
    text = lambda c, default="": F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)) if c in records.columns else F.lit(default)
    made = T.record_id(text("crawl_id"), text("source_file"), text("url"), text("warc_date"), text("paragraph"))
    number = lambda c, kind, default: (F.coalesce(F.col(c), F.lit(default)) if c in records.columns else F.lit(default)).cast(kind)
    words = F.coalesce("matched_keywords", F.array().cast("array<string>")) if "matched_keywords" in records.columns else F.array().cast("array<string>")
    new = {
        "schema_version": number("schema_version", "int", 5), "record_id": F.coalesce(F.nullif(text("record_id"), F.lit("")), made), "content_fingerprint": F.coalesce(F.nullif(text("content_fingerprint"), F.lit("")), T.content_fingerprint(text("url"), text("paragraph"))), "story_fingerprint": T.text_fingerprint(text("paragraph")),
        "crawl_id": text("crawl_id", "unknown"), "language": text("language", "unknown"), "language_confidence": number("language_confidence", "double", 0.0), "semantic_score": number("semantic_score", "double", 0.0), "narrative_score": number("narrative_score", "int", 0), "paragraph_index": number("paragraph_index", "int", 0), "matched_keywords": words,
    }
    plain = ("source_file", "url", "warc_date", "paragraph", "raw_paragraph", "concept_match", "document_id", "context_before", "context_after", "filter_signature", "run_id")
    rest = [c for c in records.columns if c not in new and c not in plain]
    return records.select(*rest, *[v.alias(k) for k, v in new.items()], *[text(c).alias(c) for c in plain])


def tables(spark: SparkSession, records: DataFrame, dedupe: str = "exact", distance: int = 3, cap: int = 100, seq: str = "seq") -> dict[str, DataFrame]:
    """provenance (every capture), stories (canonical ones), curated stories and passages, in scan order by seq; raises if counts do not add up.

    dedupe none: each record is a story under its record_id; exact and near: under the fingerprint of its canonical text.
    """
    if dedupe not in ("none", "exact", "near"):
        raise ValueError("dedupe is none, exact or near")
    rows = materialize(spark, with_identity(records).withColumn("domain", domain(F.col("url"))), "export_rows")
    if dedupe == "none":
        marks = rows.withColumns({"story_id": F.col("record_id"), "duplicate_kind": F.lit("canonical"), "duplicate_distance": F.lit(0)})
    elif dedupe == "exact":  # exact copies have the fingerprint of their canonical row, so no row has to meet another
        marks = corpus.exact_dedupe(rows, "story_fingerprint", seq).drop("canonical").withColumnRenamed("kind", "duplicate_kind").withColumns({"story_id": F.col("story_fingerprint"), "duplicate_distance": F.lit(0)})
    else:
        own = rows.select(seq, "story_fingerprint", "paragraph")
        found = corpus.near_dedupe(spark, own, "story_fingerprint", seq, "paragraph", distance).select(F.col("seq").alias("__s"), "canonical", F.col("kind").alias("duplicate_kind"), F.col("distance").alias("duplicate_distance"))
        found = found.join(own.select(F.col(seq).alias("canonical"), F.col("story_fingerprint").alias("story_id")), "canonical").drop("canonical")
        marks = rows.join(found, F.col(seq) == F.col("__s")).drop("__s")
    marked = materialize(spark, marks.withColumn("is_canonical", F.col("duplicate_kind") == "canonical"), "export_marked")
    provenance = marked.select("schema_version", "record_id", "story_id", "content_fingerprint", "crawl_id", "source_file", "run_id", "filter_signature", "document_id", "paragraph_index", "url", "domain", "warc_date", "language", "language_confidence", "duplicate_kind", "duplicate_distance", "is_canonical", seq)
    canonical = corpus.domain_rank(spark, marked.where("is_canonical"), "domain", seq, cap)
    canonical = canonical.withColumn("boilerplate_features", T.boilerplate_features(F.col("paragraph"))).withColumn("boilerplate_score", T.boilerplate_score(F.col("boilerplate_features")))
    canonical = canonical.withColumn("__class", T.content_class(F.col("paragraph"), T.normal(F.col("paragraph")), F.col("domain")))
    curated = (F.col("__class.category") == "personal_prose") & (F.col("boilerplate_score") < 4) & F.col("within_domain_cap")
    canonical = canonical.withColumns({"concept_cluster_id": T.concept_cluster(F.col("concept_match")), "template_fingerprint": T.template_fingerprint(F.col("paragraph")), "content_category": F.col("__class.category"), "content_confidence": F.col("__class.confidence"), "content_flags": F.col("__class.flags"), "content_reasons": F.col("__class.reasons"), "curated_default": curated})
    kept = materialize(spark, canonical.drop("__class", "duplicate_kind", "duplicate_distance", "is_canonical"), "export_stories")
    total, n_stories, n_duplicates = rows.count(), kept.count(), marked.where("not is_canonical").count()
    if provenance.count() != total or n_stories + n_duplicates != total:
        raise RuntimeError("captures, stories and duplicates do not add up")
    return {"provenance": provenance, "stories": kept, "curated": kept.where("curated_default"), "passages": stories.passages(kept, seq)}


def top(rows: DataFrame, by: str, name: str, limit: int = 20) -> DataFrame:
    return rows.groupBy(F.col(by).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(limit).select(F.lit(name).alias("table"), "value", "n")


def diversity(kept: DataFrame, warning: float = 0.1, cap: int = 100) -> tuple[DataFrame, DataFrame]:
    """(summary of one row, top lists): how concentrated canonical stories are over domains, languages, categories, concepts and templates."""
    largest = kept.groupBy("domain").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    counts = {"unique_domains": "domain", "unique_languages": "language", "concept_clusters": "concept_match"}
    out = kept.agg(F.count("*").alias("canonical_stories"), *[F.count_distinct(c).alias(n) for n, c in counts.items()], F.count_if(F.col("boilerplate_score") >= 4).alias("boilerplate_candidates"), F.count_if("curated_default").alias("curated_default_stories"), F.count_if("within_domain_cap").alias("stories_within_domain_cap"))
    share = F.when(F.col("canonical_stories") > 0, F.lit(largest) / F.col("canonical_stories")).otherwise(0.0)
    out = out.withColumn("top_domain_share", F.round(share, 4)).withColumn("domain_concentration_warning", share > warning).withColumn("stories_over_domain_cap", F.col("canonical_stories") - F.col("stories_within_domain_cap"))
    lists = None
    for name, by in (("top_domains", "domain"), ("top_languages", "language"), ("content_categories", "content_category"), ("top_concepts", "concept_match"), ("repeated_templates", "template_fingerprint")):
        part = top(kept, by, name)
        part = part.where("n > 1") if name == "repeated_templates" else part
        lists = part if lists is None else lists.unionByName(part)
    return out, lists


def export(spark: SparkSession, records: DataFrame, target: str, dedupe: str = "exact", distance: int = 3, cap: int = 100, warning: float = 0.1, per_file: int = 1_000, now: str = "") -> dict:
    """The four tables, duplicates as JSON lines and a manifest with partitions, diversity and checksums, staged and swapped in for the target as a whole."""
    files.recover(spark, target)
    parent, _, name = target.rstrip("/").rpartition("/")
    staged = f"{parent}/.{name}-staging-{uuid.uuid4().hex}"
    out = tables(spark, records, dedupe, distance, cap)
    out["passages"] = materialize(spark, out["passages"], "export_passages")  # else they are made for their file and again to be counted
    manifest: dict = {"schema_version": 5, "generated_at": now, "dedupe_mode": dedupe, "near_distance": distance if dedupe == "near" else None, "tables": {}}
    try:
        for table, rows in out.items():
            written = publish(spark, rows, ["crawl_id", "language"], f"{staged}/{table}", per_file)
            parts = written.groupBy(safe_value(F.col("crawl_id")).alias("c"), safe_value(F.col("language")).alias("l")).count().orderBy("c", "l").collect()
            manifest["tables"][table] = {"rows": sum(r["count"] for r in parts), "partitions": {f"crawl_id={r['c']}/language={r['l']}": r["count"] for r in parts}}
        duplicates = out["provenance"].where("not is_canonical")
        duplicates.select("record_id", "story_id", F.col("duplicate_kind").alias("kind"), F.col("duplicate_distance").alias("distance")).write.json(f"{staged}/duplicates")
        manifest["duplicates"] = {r["duplicate_kind"]: r["count"] for r in duplicates.groupBy("duplicate_kind").count().collect()}
        summary, lists = diversity(out["stories"], warning, cap)
        manifest["quality"] = summary.first().asDict()
        for r in lists.collect():
            manifest["quality"].setdefault(r["table"], []).append({"value": r["value"], "stories": r["n"]})
        manifest["capture_domains"] = [{"domain": r["value"], "captures": r["n"]} for r in top(out["provenance"], "domain", "d").collect()]
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(staged).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        listed.withColumn("path", F.regexp_replace("path", "^.*?" + staged.rpartition("/")[2] + "/", "")).orderBy("path").coalesce(1).write.json(f"{staged}/files")
        files.write_json(spark, f"{staged}/_manifest.json", manifest)
        files.swap(spark, target, staged)
    except Exception:
        files.remove(spark, staged)
        raise
    return manifest


# Markdown

def match_ranks(spark: SparkSession, records: DataFrame) -> DataFrame:
    """records with their rank in their language: best score first, then date and record."""
    known = records.withColumn("language", F.coalesce("language", F.lit("unknown")))
    order = [(F.coalesce("semantic_score", F.lit(0.0)), "desc"), F.coalesce("warc_date", F.lit("")), F.coalesce("record_id", F.lit("")), F.xxhash64(*known.columns)]
    return ranked(spark, known, ["language"], order)


def match_block(rank: Column) -> Column:
    text = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    quoted = F.array_join(F.transform(F.split(F.regexp_replace(text("paragraph", ""), f"(?:{T.LINE_END})\\z", ""), T.LINE_END), lambda x: F.concat(F.lit("> "), x)), "\n")
    parts = ["### ", rank.cast("string"), ". Match Score: ", F.format_string("%.3f", F.coalesce("semantic_score", F.lit(0.0))), "\n- **Keywords:** `", F.array_join(F.coalesce("matched_keywords", F.array().cast("array<string>")), ", "), "`\n- **Nearest Semantic Reference (Not a Summary):** '", text("concept_match", "N/A"), "'\n- **Source URL:** [", text("url", "#"), "](", text("url", "#"), ")\n- **Capture Date:** ", text("warc_date", "Unknown date"), "\n- **Crawl Dataset:** `", text("crawl_id", "Unknown"), "`\n- **Source File:** `", text("source_file", "Legacy output"), "`\n\n", F.when(text("paragraph", "") == "", "").otherwise(quoted), "\n\n---\n"]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def story_block() -> Column:
    """Markdown of one grouped story with match_numbers."""
    story, seed, numbers = F.col("story"), F.col("seed"), F.col("match_numbers")
    parts = story["paragraphs"]
    first = F.array_position(F.transform(parts, lambda p: p["role"]), "seed").cast("int")
    heading = F.when(F.size(numbers) > 0, T.match_label(numbers)).otherwise(F.concat(F.lit("Unmapped Match ("), F.substring("story_id", 1, 12), F.lit(")")))
    refs = F.when(F.size(numbers) > 0, F.concat(F.lit("- **Matches Export References:** `matches_"), F.col("language"), F.lit(".md` "), F.array_join(F.transform(numbers, lambda n: F.concat(F.lit("#"), n.cast("string"))), ", "), F.lit("\n"))).otherwise("")

    def excerpt(p: Column, k: Column) -> Column:
        before = F.get(parts, k - 1)["paragraph_index"]
        gap = p["paragraph_index"] - before - 1
        note = F.when((k > 0) & (gap > 0), F.concat(F.lit("*"), T.count_label(gap, "intervening source paragraph"), F.lit(" omitted; excerpts remain in source order.*\n\n"))).otherwise("")
        return F.concat(note, T.blockquote(p["text"]))

    size = F.concat(T.count_label(story["paragraph_count"], "source paragraph"), F.lit(", "), T.count_label(story["sentence_count"], "sentence"), F.lit(", "), T.count_label(story["segment_count"], "excerpt"))
    out = ["### Source Story for ", heading, "\n- **Seed Score:** ", F.format_string("%.3f", seed["semantic_score"]), "\n- **Story-Length Passage:** `", F.when(story["story_length_ready"], "yes").otherwise("no"), "`\n- **Story Size:** ", size, "\n- **Filter-Matched Paragraph:** ", first.cast("string"), " of ", story["paragraph_count"].cast("string"), "\n", refs, "- **Keywords:** `", F.array_join(seed["matched_keywords"], ", "), "`\n- **Nearest Semantic Reference (Not a Summary):** '", seed["concept_match"], "'\n- **Extraction Method:** deterministic source-paragraph selection; no generated text\n- **Source URL:** [", F.col("url"), "](", F.col("url"), ")\n- **Capture Count:** ", F.col("capture_count").cast("string"), "\n- **Crawl Dataset:** `", F.col("crawl_id"), "`\n- **Source File:** `", F.col("source_file"), "`\n\n#### Accepted Filter Paragraph\n\n", T.blockquote(F.get(parts, first - 1)["text"]), "\n\n#### Extracted Source Story\n\n", F.array_join(F.transform(parts, excerpt), "\n\n"), "\n\n---\n"]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in out])


def write_markdown(spark: SparkSession, blocks: DataFrame, target: str, kind: str, title: str, counted: str) -> DataFrame:
    """blocks (language, rank, block) as text below target/<kind>_language=<safe language>, a header before the first; parts of a language are in order of their names. The whole folder is swapped in, so stale languages go. Returns language and rows."""
    totals = blocks.groupBy("language").agg(F.count("*").alias("n"))
    header = totals.select("language", F.lit(0).alias("rank"), F.concat(F.lit(f"# {title}\n\n**Language:** `"), "language", F.lit(f"`\n**{counted}:** "), F.col("n").cast("string"), F.lit("\n\n---\n")).alias("block"))
    rows = header.unionByName(blocks.select("language", F.col("rank").cast("int").alias("rank"), "block")).withColumn(f"{kind}_language", F.regexp_replace("language", "[^A-Za-z0-9_-]", "_"))
    staged = f"{target}-staging-{uuid.uuid4().hex}"
    rows.repartitionByRange(f"{kind}_language", "rank").sortWithinPartitions(f"{kind}_language", "rank").select(f"{kind}_language", F.col("block").alias("value")).write.partitionBy(f"{kind}_language").text(staged)
    files.swap(spark, target, staged)
    return totals


def export_matches(spark: SparkSession, records: DataFrame, target: str) -> DataFrame:
    blocks = match_ranks(spark, records).select("language", "rank", match_block(F.col("rank")).alias("block"))
    return write_markdown(spark, blocks, target, "matches", "Extracted Concepts: Home & Belonging", "Total Matches")


def export_stories(spark: SparkSession, records: DataFrame, ranks: DataFrame, target: str, short: bool = False) -> DataFrame:
    """Grouped stories as sorted zipped JSON lines and Markdown; stories that are not of length only on demand."""
    every = materialize(spark, stories.with_match_numbers(stories.grouped(records), ranks), "grouped")
    chosen = every if short else every.where("story.story_length_ready")
    order = [(F.col("seed.semantic_score"), "desc"), F.col("story_id")]
    placed = ranked(spark, chosen.withColumn("__all", F.lit(1)), ["__all"], order, "position").drop("__all")
    placed.orderBy("position").write.mode("overwrite").option("compression", "gzip").json(f"{target}/stories.jsonl")
    blocks = ranked(spark, chosen, ["language"], order).select("language", "rank", story_block().alias("block"))
    return write_markdown(spark, blocks, f"{target}/markdown", "stories", "Expanded Home and Belonging Stories", "Unique Stories")
