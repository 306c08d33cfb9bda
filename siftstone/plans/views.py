"""Tables the queries share: captures made of documents, sources made of orders, samples made of labels; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions.columns import domain, hash_rank
from siftstone.runtime import table


def rank_sql(key: str) -> str:
    return f"(('0x' || substr(sha256({key}), 1, 16))::ubigint::double / 18446744073709551616.0)"


#: Text as the rules see it: on these tables NFKC changes nothing, and casefold is lower case but for one letter.
FOLD = "replace(lower({x}), 'ß', 'ss')"
NORM = "trim(regexp_replace(" + FOLD + r", '\s+', ' ', 'g'))"
SQUASH = r"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
HOSTS = ((0, "Genius.com"), (1, "poemhunter.com"), (2, "shop.etsy.com"), (3, "m.ebay.de"), (4, "ancestry.com"), (5, "asstr.org"), (6, "notgenius.com"))
HOST_SQL = "case doc_id % 23 " + " ".join(f"when {k} then '{h}'" for k, h in HOSTS) + " else source || '.Example.org' end"

#: Captures: every document as one captured paragraph; twenty successive ones are a document, with a gap every seventh.
CAPTURES = f"""cap as (select doc_id as seq, 'crawl-' || (doc_id % 4) as crawl_id, 'archive/' || source || '.warc.wet.gz' as source_file,
 'HTTP://user@WWW.' || {HOST_SQL} || ':8080/P/' || (doc_id // 10) || '?q=' || (doc_id % 3) || '#top' as url,
 '2024-01-' || lpad((doc_id % 28 + 1)::varchar, 2, '0') || 'T00:00:00Z' as warc_date, lang as language, (doc_id % 100) / 100.0 as language_confidence, text as paragraph,
 'd' || (doc_id // 20) as document_id, (doc_id % 20 + doc_id % 20 // 7)::int as paragraph_index, round({rank_sql('doc_id::varchar')}, 4) as semantic_score, (doc_id % 17)::int as narrative_score, 'Concept ' || (doc_id % 6) as concept_match from documents)"""
URL = "lower(regexp_extract({u}, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract({u}, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#]*)', 1)) || regexp_extract({u}, '^[A-Za-z]+://[^/?#]*([^#]*)', 1)"
DOMAIN = r"coalesce(nullif(regexp_replace(trim(regexp_extract(lower(coalesce({u}, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '^www\.', ''), ''), 'unknown')"
IDENTITY = f"""ids as (select *, sha256(concat_ws(chr(31), crawl_id, source_file, {URL.format(u='url')}, warc_date, {NORM.format(x='paragraph')})) as record_id, sha256(concat_ws(chr(31), {URL.format(u='url')}, {NORM.format(x='paragraph')})) as content_fingerprint,
 sha256({NORM.format(x='paragraph')}) as story_fingerprint, {DOMAIN.format(u='url')} as domain from cap)"""


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    host = F.when(d % 23 == HOSTS[0][0], HOSTS[0][1])
    for k, h in HOSTS[1:]:
        host = host.when(d % 23 == k, h)
    host = host.otherwise(F.concat("source", F.lit(".Example.org")))
    whole = lambda n: F.floor(d / n).cast("bigint")
    url = F.concat(F.lit("HTTP://user@WWW."), host, F.lit(":8080/P/"), whole(10).cast("string"), F.lit("?q="), (d % 3).cast("string"), F.lit("#top"))
    date = F.concat(F.lit("2024-01-"), F.lpad((d % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    return table(spark, sf_dir, "documents").select(
        d.alias("seq"), F.concat(F.lit("crawl-"), (d % 4).cast("string")).alias("crawl_id"), F.concat(F.lit("archive/"), "source", F.lit(".warc.wet.gz")).alias("source_file"), url.alias("url"), date.alias("warc_date"), F.col("lang").alias("language"), ((d % 100) / 100.0).alias("language_confidence"), F.col("text").alias("paragraph"),
        F.concat(F.lit("d"), whole(20).cast("string")).alias("document_id"), (d % 20 + F.floor((d % 20) / 7)).cast("int").alias("paragraph_index"), F.round(hash_rank(d), 4).alias("semantic_score"), (d % 17).cast("int").alias("narrative_score"), F.concat(F.lit("Concept "), (d % 6).cast("string")).alias("concept_match"))


def with_domain(rows: DataFrame) -> DataFrame:
    return rows.withColumn("domain", domain(F.col("url")))


NOW, SIGNATURE = "1998-06-01T00:00:00+00:00", "current-signature"
ERRORS = ("BrokenProcessPool: died", "CUDA out of memory", "Output commit failed", "HTTP 429 received", "status 503", "code 15030 of 500", "read timed out", "ConnectionError: reset", "Not Found", "code 14290", "getaddrinfo failed", "502 Bad Gateway", "x")
_E = "case o_orderkey % 13 " + " ".join(f"when {k} then '{e}'" for k, e in enumerate(ERRORS)) + " end"
_D = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00')"
#: Sources made of orders: completed, pending, failed and processing ones.
WORK = f"""w as (select 'f/' || o_orderkey as file_path, 'crawl-' || (o_custkey % 5) as crawl_id, case o_orderstatus when 'F' then 'completed' when 'O' then 'pending' else case when o_orderkey % 2 = 0 then 'failed' else 'processing' end end as status, o_orderkey as k, o_orderstatus as s, o_orderdate as d,
 case o_orderstatus when 'F' then o_orderkey % 1000 else 0 end as records_processed, case o_orderstatus when 'F' then o_orderkey % 4 else 0 end as matches_found, case when o_orderstatus = 'P' and o_orderkey % 2 = 0 then {_E} end as error_message,
 case when o_orderstatus = 'P' and o_orderkey % 3 <> 0 then {_D} end as started_at, case when o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderkey % 2 = 0 and o_orderkey % 5 <> 0) then {_D} end as completed_at, o_orderkey % 6 as attempt_count,
 case when o_orderstatus = 'P' and o_orderkey % 4 = 0 then {_D} end as next_retry_at, case when o_orderstatus = 'P' and o_orderkey % 2 = 1 then md5('f/' || o_orderkey) end as lease_id, case when o_orderstatus = 'P' and o_orderkey % 7 > 2 then {_D} end as heartbeat_at,
 case when o_orderstatus = 'F' then case o_orderkey % 3 when 0 then '{SIGNATURE}' when 1 then '' else 'older' end end as filter_signature, case when o_orderkey % 2 = 0 then 'run-1' end as run_id from orders)"""


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    path, day = F.concat(F.lit("f/"), k.cast("string")), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    error = F.when(k % 13 == 0, ERRORS[0])
    for n, e in enumerate(ERRORS[1:], 1):
        error = error.when(k % 13 == n, e)
    failed, processing, done = (s == "P") & (k % 2 == 0), (s == "P") & (k % 2 == 1), s == "F"
    status = F.when(done, "completed").when(s == "O", "pending").when(failed, "failed").otherwise("processing")
    return table(spark, sf_dir, "orders").select(
        path.alias("file_path"), F.concat(F.lit("crawl-"), (F.col("o_custkey") % 5).cast("string")).alias("crawl_id"), status.alias("status"), F.when(done, k % 1000).otherwise(0).alias("records_processed"), F.when(done, k % 4).otherwise(0).alias("matches_found"), F.when(failed, error).alias("error_message"),
        F.when((s == "P") & (k % 3 != 0), day).alias("started_at"), F.when(done | (failed & (k % 5 != 0)), day).alias("completed_at"), (k % 6).alias("attempt_count"), F.when((s == "P") & (k % 4 == 0), day).alias("next_retry_at"), F.when(processing, F.md5(path)).alias("lease_id"), F.when((s == "P") & (k % 7 > 2), day).alias("heartbeat_at"),
        F.when(done, F.when(k % 3 == 0, SIGNATURE).when(k % 3 == 1, "").otherwise("older")).alias("filter_signature"), F.when(k % 2 == 0, "run-1").alias("run_id"))


#: Samples made of labelled documents: scores, predictions, roles, probabilities (some void) and labels (some missing).
_S = rank_sql("l.doc_id::varchar")
SAMPLES = f"""smp0 as (select sha256(l.doc_id::varchar) as sample_id, l.doc_id as n, d.lang as language, case when l.doc_id % 11 = 0 then null else round({_S}, 4) end as semantic_score, case when l.doc_id % 13 = 0 then null else (l.doc_id * 7 % 17)::int end as narrative_score,
 round({_S}, 4) >= 0.4 and l.doc_id * 7 % 17 >= 5 as predicted_accept, case when l.doc_id % 9 = 0 then 'keyword_prefilter' end as rejection_reason, case l.doc_id % 3 when 0 then 'benchmark' when 1 then 'tuning' end as role0, case l.doc_id % 4 when 0 then 0.002 when 1 then 0.5 when 2 then 2.0 end as sampling_probability,
 case when l.doc_id % 5 = 0 then null when quality = 1 then 'positive' else 'negative' end as label, case when l.doc_id % 6 = 0 then 'poetry' when l.doc_id % 6 = 1 then 'personal_prose' end as content_label, 'personal_prose' as predicted_content_category from labels l join documents d using (doc_id)),
smp1 as (select *, coalesce(role0, 'legacy') as sample_role, case when rejection_reason is not null then 'keyword_reject' when predicted_accept then 'filter_accept' else 'filter_reject' end as sampling_stratum,
 greatest(coalesce(greatest(0.0, 1 - abs(semantic_score - 0.45) / 0.08), 0.0), coalesce(greatest(0.0, 1 - abs(narrative_score - 8.0) / 4.0), 0.0)) as u from smp0),
smp as (select * exclude (u, role0), (floor(u * 10000 + 0.5) / 10000) as uncertainty_score, case when sample_role = 'benchmark' and {rank_sql("'holdout' || chr(0) || sample_id")} < 0.2 then 'holdout' else 'tuning' end as evaluation_split, case when sampling_probability > 0 and sampling_probability <= 1 then 1 / sampling_probability end as sample_weight,
 case when (floor(u * 10000 + 0.5) / 10000) >= 0.5 then 'decision_boundary' else 'coverage' end as selection_reason from smp1)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    score = F.round(hash_rank(d), 4)
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rows.select(
        F.sha2(d.cast("string"), 256).alias("sample_id"), d.alias("n"), F.col("lang").alias("language"), F.when(d % 11 != 0, score).alias("semantic_score"), F.when(d % 13 != 0, d * 7 % 17).cast("int").alias("narrative_score"), ((score >= 0.4) & (d * 7 % 17 >= 5)).alias("predicted_accept"), F.when(d % 9 == 0, "keyword_prefilter").alias("rejection_reason"),
        F.when(d % 3 == 0, "benchmark").when(d % 3 == 1, "tuning").alias("sample_role"), F.when(d % 4 == 0, 0.002).when(d % 4 == 1, 0.5).when(d % 4 == 2, 2.0).alias("sampling_probability"), F.when(d % 5 == 0, F.lit(None)).when(F.col("quality") == 1, "positive").otherwise("negative").alias("label"),
        F.when(d % 6 == 0, "poetry").when(d % 6 == 1, "personal_prose").alias("content_label"), F.lit("personal_prose").alias("predicted_content_category"))
