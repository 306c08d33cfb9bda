"""Committed output, datasets, stories, caches and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siftstone.functions import text as T
from siftstone.operators import cache, stories
from siftstone.plans.corpus_queries import TOLD, class_sql, features_sql, parts, score_sql
from siftstone.plans.registry import query
from siftstone.plans.views import CAPTURES, DOMAIN, IDENTITY, NORM, captures, rank_sql
from siftstone.runtime import materialize, shared_dir, table
from siftstone.sources import archives, export, output

DOMAIN_OF_PAGES = DOMAIN.format(u="url")


def fresh(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def matches(spark, sf_dir):
    return captures(spark, sf_dir).withColumns({"matched_keywords": F.array(F.lit("home")), "raw_paragraph": F.lit("")})


@query("select doc_id, n_chars from documents order by n_chars desc, doc_id limit 25")
def top_matches(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query("select lang, count(*)::bigint as n from documents group by lang")
def language_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))


@query(f"select {DOMAIN_OF_PAGES} as value, count(*)::bigint as n from pages group by 1 order by n desc, value limit 20")
def capture_domains(spark, sf_dir):
    from siftstone.functions.columns import domain

    return export.top(table(spark, sf_dir, "pages").select(domain(F.col("url")).alias("domain")), "domain", "d").select("value", "n")


@query("select lang, count(*)::bigint as rows, sum(n_chars)::bigint as chars from documents group by lang")
def partitioned_export_roundtrip(spark, sf_dir):
    out = export.publish(spark, table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), ["lang"])
    return out.groupBy("lang").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))


_EXPORT = f"""{CAPTURES}, {IDENTITY}, x as (select *, min(seq) over (partition by story_fingerprint) as canonical from ids), st as (select *, row_number() over (partition by domain order by seq)::int as domain_story_rank, {NORM.format(x='paragraph')} as m from x where canonical = seq),
 sk as (select *, domain_story_rank <= 25 as capped, {score_sql(features_sql('paragraph'))} as boilerplate_score, {class_sql('paragraph', 'm', 'domain', 'category')} as category from st), story as (select *, category = 'personal_prose' and boilerplate_score < 4 and capped as curated from sk)"""


def exported(spark, sf_dir):
    return export.tables(spark, matches(spark, sf_dir), "exact", cap=25)


@query(f"with {_EXPORT} select seq, record_id, story_fingerprint as story_id, content_fingerprint, domain, case when canonical = seq then 'canonical' else 'exact' end as duplicate_kind, canonical = seq as is_canonical from x")
def export_provenance(spark, sf_dir):
    return exported(spark, sf_dir)["provenance"].select("seq", "record_id", "story_id", "content_fingerprint", "domain", "duplicate_kind", "is_canonical")


@query(f"with {_EXPORT} select seq, story_fingerprint as story_id, domain_story_rank, capped as within_domain_cap, boilerplate_score, category as content_category, curated as curated_default, substr(sha256({NORM.format(x='concept_match')}), 1, 16) as concept_cluster_id from story")
def export_stories(spark, sf_dir):
    return exported(spark, sf_dir)["stories"].select("seq", "story_id", "domain_story_rank", "within_domain_cap", "boilerplate_score", "content_category", "curated_default", "concept_cluster_id")


@query(f"with {_EXPORT} select crawl_id, language, count(*)::bigint as n from story where curated group by all")
def export_curated(spark, sf_dir):
    return exported(spark, sf_dir)["curated"].groupBy("crawl_id", "language").agg(F.count("*").alias("n"))


@query(f"with {_EXPORT} select count(*)::bigint as canonical_stories, count(distinct domain)::bigint as unique_domains, count(distinct language)::bigint as unique_languages, count(distinct concept_match)::bigint as concept_clusters, count_if(boilerplate_score >= 4)::bigint as boilerplate_candidates, count_if(curated)::bigint as curated_default_stories, count_if(capped)::bigint as stories_within_domain_cap, round((select max(n) from (select count(*) as n from story group by domain)) / count(*), 4) as top_domain_share, (select max(n) from (select count(*) as n from story group by domain)) / count(*) > 0.1 as domain_concentration_warning from story")
def diversity_report(spark, sf_dir):
    return export.diversity(exported(spark, sf_dir)["stories"], 0.1, 25)[0].drop("stories_over_domain_cap")


@query(f"with {_EXPORT}, t as (select 'top_domains' as \"table\", domain as value, count(*) as n from story group by 2 order by n desc, value limit 20), l as (select 'content_categories' as \"table\", category as value, count(*) as n from story group by 2 order by n desc, value limit 20) select \"table\", value, n::bigint as n from t union all select \"table\", value, n::bigint from l")
def diversity_lists(spark, sf_dir):
    return export.diversity(exported(spark, sf_dir)["stories"], 0.1, 25)[1].where("table in ('top_domains', 'content_categories')")


@query(f"with {_EXPORT}, n as (select 'provenance' as name, count(*) as n from x union all select 'stories', count(*) from story union all select 'curated', count(*) from story where curated) select name, n::bigint as n from n")
def export_published(spark, sf_dir):
    """The whole export, staged and swapped in; twice, so the second replaces the first."""
    target = fresh(spark, "dataset")
    for _ in range(2):
        manifest = export.export(spark, matches(spark, sf_dir), target, cap=25)
    rows = [(t, spark.read.parquet(f"{target}/{t}").count()) for t in ("provenance", "stories", "curated")]
    if [n for _, n in rows] != [manifest["tables"][t]["rows"] for t, _ in rows]:
        raise RuntimeError("manifest and tables differ")
    return spark.createDataFrame(rows, "name string, n bigint")


@query("select md5(text) as story_id, count(*)::bigint as captures, arg_min(source, doc_id) as representative, array_to_string(list_sort(list(distinct lang)), ',') as langs from documents group by 1")
def group_stories(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("story_id")).agg(F.count("*").alias("captures"), F.min_by("source", "doc_id").alias("representative"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


def told(spark, sf_dir):
    """Story records: each capture's paragraph is a document of its lines, the longest of which is the seed."""
    caps = captures(spark, sf_dir)
    ids = caps.withColumn("record_id", T.record_id(F.col("crawl_id"), F.col("source_file"), F.col("url"), F.col("warc_date"), F.col("paragraph")))
    p = materialize(spark, parts(spark, sf_dir).select("doc_id", "paragraph_index", "paragraph", "source_paragraph"), "parts", "zstd")
    seeds = p.groupBy("doc_id").agg(F.max_by("paragraph_index", F.struct(F.length("paragraph"), -F.col("paragraph_index"))).alias("paragraph_index"))
    windows = stories.story_windows(spark, p, seeds, source="source_paragraph").select(F.col("doc_id").alias("seq"), "story")
    rows = ids.join(windows, "seq").withColumns({"matched_keywords": F.array(F.lit("home")), "filter_signature": F.lit("")})
    return stories.enriched(rows)


@query()
def enriched_stories(spark, sf_dir):
    """Stories of all captures, grouped, with the ranks of their captures."""
    records = materialize(spark, told(spark, sf_dir), "told", "zstd")
    ranks = export.match_ranks(spark, records.select("record_id", "language", F.col("seed.semantic_score").alias("semantic_score"), "warc_date"))
    out = stories.with_match_numbers(stories.grouped(records), ranks)
    return out.select("story_id", "record_id", "capture_count", F.array_join("match_numbers", ",").alias("match_numbers"), F.size("captures").alias("captures"))


@query(f"with {CAPTURES}, {IDENTITY}, d as (select record_id from ids where seq % 3 = 0) select source_file, count(*)::bigint as matches, count(distinct case when record_id not in (select record_id from d) then record_id end)::bigint as missing_matches from ids group by 1")
def enrichment_plan(spark, sf_dir):
    rows = captures(spark, sf_dir)
    ids = rows.withColumn("record_id", T.record_id(F.col("crawl_id"), F.col("source_file"), F.col("url"), F.col("warc_date"), F.col("paragraph")))
    return stories.plan(ids, ids.where("seq % 3 = 0")).select("source_file", "matches", "missing_matches")


@query(f"with {CAPTURES}, {IDENTITY} select source_file, count(distinct record_id)::bigint as records, count(distinct language)::bigint as shards from ids group by 1")
def source_manifests(spark, sf_dir):
    """Captures committed source by source, then all again: the second commit replaces the first."""
    root = fresh(spark, "output")
    records = materialize(spark, output.match_records(matches(spark, sf_dir), "sig", "run"), "records")
    for now in ("2024-01-01", "2024-01-02"):
        output.commit(spark, root, records, records.select("source_file"), now)
    if not output.verify(spark, root).isEmpty():
        raise RuntimeError("committed output does not verify")
    return output.effective(spark, root).select("source_file", "records", F.size("shards").cast("bigint").alias("shards"))


@query(f"with {CAPTURES}, {IDENTITY}, t as (select distinct source_file from ids order by 1 limit 3) select source_file, count(distinct record_id)::bigint as records from ids where source_file not in (select source_file from t) group by 1")
def tombstones_and_catalog(spark, sf_dir):
    """Three sources committed without matches become tombstones; then manifests are compacted."""
    root = fresh(spark, "output")
    records = materialize(spark, output.match_records(matches(spark, sf_dir)), "records")
    output.commit(spark, root, records, records.select("source_file"), "2024-01-01")
    gone = materialize(spark, records.select("source_file").distinct().orderBy("source_file").limit(3), "gone")
    output.commit(spark, root, records.where("false"), gone, "2024-01-02")
    before = materialize(spark, output.effective(spark, root), "effective")
    output.compact_manifests(spark, root)
    after = output.effective(spark, root)
    if not output.verify(spark, root).isEmpty() or before.select("source_file", "records").exceptAll(after.select("source_file", "records")).count():
        raise RuntimeError("compaction changed the manifests")
    return after.select("source_file", "records")


@query(f"with {CAPTURES}, {IDENTITY}, s as (select distinct source_file from ids order by 1 limit 2) select distinct record_id, language from ids where source_file in (select source_file from s)")
def pruned_scan(spark, sf_dir):
    """Only the shards that manifests name for two sources are read."""
    root = fresh(spark, "output")
    records = materialize(spark, output.match_records(matches(spark, sf_dir)), "records")
    output.commit(spark, root, records, records.select("source_file"), "2024-01-01")
    two = [r["source_file"] for r in records.select("source_file").distinct().orderBy("source_file").limit(2).collect()]
    return output.read_records(spark, root, sources=two).select("record_id", "language")


@query(f"with {TOLD}, {CAPTURES}, {IDENTITY}, k as (select ids.source_file, record_id, narrative from ids join told on told.doc_id = ids.seq where semantic_score >= 0.3 and narrative >= 1 and ids.seq % 5 <> 0) select source_file, record_id, max(narrative)::int as narrative_score from k group by all")
def refilter_rows(spark, sf_dir):
    """Records of completed sources that pass other thresholds; sources of every fifth record are one unfinished source."""
    rows = captures(spark, sf_dir).withColumn("source_file", F.when(F.col("seq") % 5 == 0, "open").otherwise(F.col("source_file")))
    state = rows.select(F.col("source_file").alias("file_path")).distinct().withColumn("status", F.when(F.col("file_path") == "open", "pending").otherwise("completed"))
    return output.refiltered(rows, state, 0.3, 1, ("seq",)).select("source_file", "record_id", "narrative_score")


@query(f"with {CAPTURES} select distinct source_file, substr(sha256(source_file), 1, 16) || '_' || regexp_replace(regexp_extract(source_file, '([^/]+)$', 1), '\\.gz$', '') || '.jsonl.gz' as name from cap")
def legacy_shards(spark, sf_dir):
    sources = captures(spark, sf_dir).select(F.col("source_file").alias("file_path")).distinct()
    return output.shard_sources(sources, sources.select(T.shard_name(F.col("file_path")).alias("name"))).select("source_file", "name")


@query(f"with {CAPTURES}, {IDENTITY}, r as (select language, row_number() over (partition by language order by semantic_score desc, warc_date, record_id) as rank, '### ' || row_number() over (partition by language order by semantic_score desc, warc_date, record_id) || '. Match Score: ' || printf('%.3f', semantic_score) as head from ids) select language, count(*)::bigint as n, min(head) as least_head, max(head) as most_head from r group by 1")
def markdown_matches(spark, sf_dir):
    ids = captures(spark, sf_dir).withColumns({"record_id": T.record_id(F.col("crawl_id"), F.col("source_file"), F.col("url"), F.col("warc_date"), F.col("paragraph")), "matched_keywords": F.array(F.lit("home"))})
    ranks = export.match_ranks(spark, ids)
    blocks = ranks.select("language", F.substring_index(export.match_block(F.col("rank")), "\n", 1).alias("head"))
    return blocks.groupBy("language").agg(F.count("*").alias("n"), F.min("head").alias("least_head"), F.max("head").alias("most_head"))


@query("select lang as language, count(*)::bigint as n from documents group by 1")
def markdown_export(spark, sf_dir):
    """Markdown of all matches, written and read back."""
    ids = matches(spark, sf_dir).withColumn("record_id", F.col("seq").cast("string"))
    target = fresh(spark, "markdown")
    export.export_matches(spark, ids, target)
    text = spark.read.option("basePath", target).text(target)
    return text.where("value like '### %'").groupBy(F.col("matches_language").alias("language")).agg(F.count("*").alias("n"))


# Caches

@query(f"with {TOLD}, d as (select doc_id, narrative as n, case when narrative <= -50 then -1.0 else {rank_sql(NORM.format(x='text'))} end as s from told) select doc_id, round(s, 6)::double as semantic_score, n <= -50 as skipped, case when n <= -50 then 'boilerplate_pre_filter' when s < 0.45 then 'semantic_threshold' when n < 8 then 'narrative_threshold' end as rejection_reason from d")
def cached_decisions(spark, sf_dir):
    """Decisions through a cache that holds half of the texts; the rest is scored by a stand-in model, the rank of the text's fingerprint, and put into the cache."""
    from siftstone.operators.state import unit_hash

    root, name = fresh(spark, "cache"), cache.namespace("stand-in", "1", anchors=["a"])
    score = lambda d: d.select("text_hash", unit_hash(T.normal(F.col("text"))).alias("score"), F.lit("a").alias("concept"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = cache.get(spark, root, "semantic_scores", name, cache.SCORES)
    _, new = cache.decide(spark, docs.where("doc_id % 2 = 0"), first, score)
    cache.put(spark, root, "semantic_scores", name, new, "2024-01-01", "one")
    held = cache.get(spark, root, "semantic_scores", name, cache.SCORES)
    out, _ = cache.decide(spark, docs, held, score)
    return out.select("doc_id", F.round("semantic_score", 6).alias("semantic_score"), (F.col("concept_match") == "pre-filtered boilerplate").alias("skipped"), "rejection_reason")


@query("select lang, case when n_chars % 10 >= 5 then lang else 'unknown' end as routed, count(*)::bigint as n from documents group by all")
def detected_languages(spark, sf_dir):
    """Language and confidence of a stand-in model, routed by confidence."""
    from siftstone.operators.rules import routed

    rows = table(spark, sf_dir, "documents").select("lang", cache.detector(lambda t: ("xx", 1.0))("text").alias("p"), ((F.col("n_chars") % 10) / 10).alias("c"))
    return rows.groupBy("lang", routed(F.col("lang"), F.col("c") * F.col("p.confidence")).alias("routed")).agg(F.count("*").alias("n"))


# Sources

@query("select trim(source || '/' || (doc_id // 10)) as path, count(*)::bigint as n from documents group by 1")
def path_listing(spark, sf_dir):
    """A zipped listing with blank lines and outer blanks."""
    target = fresh(spark, "paths")
    d = table(spark, sf_dir, "documents")
    lines = d.select(F.concat(F.lit("  "), "source", F.lit("/"), F.floor(F.col("doc_id") / 10).cast("string"), F.lit(" ")).alias("value"))
    lines.union(d.select(F.lit("   ").alias("value"))).write.option("compression", "gzip").text(target)
    return archives.wet_paths(spark, target).groupBy("path").agg(F.count("*").alias("n"))


@query("select 'documents.parquet' as name, true as found")
def object_listing(spark, sf_dir):
    rows = archives.archive_paths(spark, sf_dir, (".parquet",)).select("path")
    found = rows.where(F.col("path").contains("documents.parquet")).count() > 0
    return spark.createDataFrame([("documents.parquet", found)], "name string, found boolean")


# Streams

@query("select user_id, count(*)::bigint as n, round(sum(value), 4) as total from events group by user_id")
def streaming_equals_batch(spark, sf_dir):
    from siftstone.streaming.ingest import totals

    return totals(spark, f"{sf_dir}/events.parquet")


@query("select date_trunc('day', ts)::timestamp as window_start, event_type, count(*)::bigint as n from events group by all")
def streaming_windows(spark, sf_dir):
    from siftstone.streaming.ingest import windows

    return windows(spark, f"{sf_dir}/events.parquet")


@query("select event_type, event_id from (select *, row_number() over (partition by event_type order by event_id) as r from events) where r <= 20")
def streaming_state(spark, sf_dir):
    from siftstone.streaming.ingest import least_of_each

    return least_of_each(spark, f"{sf_dir}/events.parquet")


@query(f"with {CAPTURES}, {IDENTITY} select source_file, count(distinct record_id)::bigint as records from ids group by 1")
def streaming_commit(spark, sf_dir):
    """Matches of a file stream, committed source by source. A source is in one file, but few share one, so that no task holds a large part of all matches."""
    from siftstone.streaming.ingest import commit_sources, file_stream

    folder, root, base = fresh(spark, "matches"), fresh(spark, "output"), fresh(spark, "stream")
    output.match_records(matches(spark, sf_dir)).repartition(256, "source_file").write.parquet(folder)
    commit_sources(spark, file_stream(spark, f"{folder}/*.parquet", 4), root, base, "2024-01-01")
    return output.effective(spark, root).select("source_file", "records")


