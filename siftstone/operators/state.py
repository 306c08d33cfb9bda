"""Work state, failures, schedules, manifests and caches as snapshot-to-snapshot DataFrame operations.

A snapshot has a row a source: file_path, crawl_id, status, records_processed, matches_found, error_message, started_at, completed_at, attempt_count,
next_retry_at, lease_id, heartbeat_at, filter_signature, run_id; times are ISO strings. An operation gives the next snapshot; changed() counts its rows.
Nothing is drawn at random, so a task that runs again after a lost executor gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.runtime import materialize, sized

SCHEMA = "file_path string, crawl_id string, status string, records_processed bigint, matches_found bigint, error_message string, started_at string, completed_at string, attempt_count bigint, next_retry_at string, lease_id string, heartbeat_at string, filter_signature string, run_id string"
FRESH = {"status": "pending", "records_processed": 0, "matches_found": 0, "attempt_count": 0}
MOST_ATTEMPTS = 4


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """A written snapshot; older ones lack later columns, which are then null (numbers 0)."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)
    want = spark.createDataFrame([], SCHEMA).schema
    return rows.select(*[(F.coalesce(F.col(f.name), F.lit(FRESH.get(f.name))) if f.name in rows.columns and f.name in FRESH else F.col(f.name) if f.name in rows.columns else F.lit(FRESH.get(f.name))).cast(f.dataType).alias(f.name) for f in want.fields])


def updated(rows: DataFrame, where: Column, **new: object) -> DataFrame:
    """rows with the named columns replaced where the condition holds (null counts as not)."""
    hit = F.coalesce(where, F.lit(False))
    kinds = dict(rows.dtypes)
    value = lambda n, v: (v if isinstance(v, Column) else F.lit(v)).cast(kinds[n])
    return rows.select(*[F.when(hit, value(c, new[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def updated_keys(rows: DataFrame, chosen: DataFrame, key: str = "file_path", **new: object) -> DataFrame:
    """The same for the rows whose key is chosen; chosen is written once, so it is drawn from the old snapshot only."""
    spark = rows.sparkSession
    picked = materialize(spark, chosen.select(F.col(key).alias("__key")).distinct(), "chosen")
    marked = rows.join(sized(picked, picked.count()), F.col(key) == F.col("__key"), "left")
    return updated(marked, F.col("__key").isNotNull(), **new).drop("__key")


def changed(before: DataFrame, after: DataFrame, key: str = "file_path") -> int:
    """How many rows differ between two snapshots."""
    other = after.select(F.col(key).alias("__key"), F.struct(*[c for c in after.columns if c != key]).alias("__after"))
    both = before.join(other, F.col(key) == F.col("__key"), "full_outer")
    return both.where(~F.struct(*[c for c in before.columns if c != key]).eqNullSafe(F.col("__after"))).count()


# Failures and retries

#: In this order; the first that holds names the failure.
FAILURES = (
    ("process_pool", "process pool|brokenprocesspool"),
    ("inference", "inference service|cuda"),
    ("output", "output commit"),
    ("http_429", "(?<!\\d)429(?!\\d)|too many requests"),
    *((f"http_{s}", f"(?<!\\d){s}(?!\\d)") for s in (500, 502, 503, 504)),
    ("timeout", "timed out|timeout"),
    ("connection", "connection aborted|connection reset|connectionerror|dns|failed to resolve|getaddrinfo|nameresolutionerror|protocolerror|remotedisconnected"),
    ("http_404", "(?<!\\d)404(?!\\d)|not found"),
)
TRANSIENT = ("http_429", "http_500", "http_502", "http_503", "http_504", "timeout", "connection")


def failure_category(message: Column) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    out = None
    for name, pattern in FAILURES:
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return out.otherwise("other")


def transient(message: Column) -> Column:
    return failure_category(message).isin(*TRANSIENT)


def unit_hash(key: Column) -> Column:
    """The leading 64 bits of a SHA-256 as a share of 2^64."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def retry_delay(path: Column, attempt: Column, base: int = 300, most: int = 21_600, spread: float = 0.25) -> Column:
    """Seconds: base doubled with each attempt, times 1 +- spread by a hash of path and attempt; halves round to even."""
    jitter = 1 + spread * (2 * unit_hash(F.concat_ws("\x00", F.lit("retry"), path.cast("string"), attempt.cast("string"))) - 1)
    delay = F.bround(base * F.pow(F.lit(2.0), attempt - 1) * jitter)
    return F.lit(0).cast("bigint") if base <= 0 else F.least(F.lit(most), F.greatest(F.lit(1), delay)).cast("bigint")


def later(now: str, seconds: Column) -> Column:
    """now plus seconds, as an ISO string in UTC."""
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(F.lit(now))) + seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


# Changes of the work state

def initialize(rows: DataFrame, paths: DataFrame, crawl: str = "") -> DataFrame:
    """New paths are added as pending; known ones stay as they are; repeated ones count once."""
    new = paths.select(F.col(paths.columns[0]).alias("file_path")).where("file_path is not null").distinct().join(rows.select("file_path"), "file_path", "left_anti")
    values = FRESH | {"crawl_id": crawl}
    return rows.unionByName(new.select("file_path", *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != "file_path"]))


def ready(now: str, attempts: int = MOST_ATTEMPTS) -> Column:
    due = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)
    return (F.col("status") == "pending") | ((F.col("status") == "failed") & (F.col("attempt_count") < attempts) & due)


def claimable(rows: DataFrame, limit: int, now: str, crawl: str | None = None, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """The `limit` rows to claim: failed before pending, then oldest completion (none first), then path."""
    scope = F.lit(True) if crawl is None else F.col("crawl_id") == crawl
    return rows.where(scope & ready(now, attempts)).orderBy(F.col("status") != "failed", F.col("completed_at").asc_nulls_first(), "file_path").limit(max(0, limit))


def claim(rows: DataFrame, limit: int, now: str, token: str, crawl: str | None = None, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """Claimed rows become processing with one more attempt and a lease made of token, path and attempt."""
    attempt = F.col("attempt_count") + 1
    lease = F.sha2(F.concat_ws("\x00", F.lit(token), "file_path", attempt.cast("string")), 256)
    return updated_keys(rows, claimable(rows, limit, now, crawl, attempts), status="processing", attempt_count=attempt, lease_id=lease, started_at=now, heartbeat_at=now, next_retry_at=None)


def held(rows: DataFrame, claims: DataFrame) -> DataFrame:
    """Rows that are processing under the very lease of a claim (file_path, lease_id)."""
    own = claims.select(F.col("file_path").alias("__p"), F.col("lease_id").alias("__l")).distinct()
    return rows.join(own, (F.col("file_path") == F.col("__p")) & (F.col("lease_id") == F.col("__l")) & (F.col("status") == "processing"), "left_semi")


def heartbeat(rows: DataFrame, claims: DataFrame, now: str) -> DataFrame:
    return updated_keys(rows, held(rows, claims), heartbeat_at=now)


def release(rows: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims given back: pending, the attempt not counted."""
    return updated_keys(rows, held(rows, claims), status="pending", started_at=None, heartbeat_at=None, lease_id=None, next_retry_at=None, attempt_count=F.greatest(F.col("attempt_count") - 1, F.lit(0)))


def recover(rows: DataFrame, cutoff: str) -> DataFrame:
    """Leases without a sign of life since the cutoff (or without any) are released; a planned retry stays."""
    seen = F.coalesce("heartbeat_at", "started_at")
    stale = (F.col("status") == "processing") & (seen.isNull() | (seen < cutoff))
    return updated(rows, stale, status="pending", started_at=None, heartbeat_at=None, lease_id=None, attempt_count=F.greatest(F.col("attempt_count") - 1, F.lit(0)))


def owned(results: DataFrame, leased: bool) -> Column:
    """Join condition of a result row with its source, under its lease where leases are asked for."""
    same = F.col("file_path") == F.col("__path")
    return same & (F.col("status") == "processing") & (F.col("lease_id") == F.col("__lease")) if leased else same


def complete(rows: DataFrame, results: DataFrame, now: str, signature: str = "", run: str = "", leased: bool = True) -> DataFrame:
    """Sources with results (file_path, lease_id, records, matches) become completed; those whose lease is another's stay."""
    own = results.select(F.col("file_path").alias("__path"), F.col("lease_id").alias("__lease"), F.col("records").alias("__records"), F.col("matches").alias("__matches"))
    marked = rows.join(own, owned(own, leased), "left")
    after = updated(marked, F.col("__path").isNotNull(), status="completed", records_processed=F.col("__records"), matches_found=F.col("__matches"), completed_at=now, filter_signature=signature or None, run_id=run or None, error_message=None, next_retry_at=None, lease_id=None, heartbeat_at=None)
    return after.select(*rows.columns)


def fail(rows: DataFrame, errors: DataFrame, now: str, base: int = 300, leased: bool = True) -> DataFrame:
    """Sources with an error (file_path, lease_id, error) become failed and wait for their retry_delay(); an error keeps 4,000 characters."""
    own = errors.select(F.col("file_path").alias("__path"), F.col("lease_id").alias("__lease"), F.col("error").alias("__error"))
    marked = rows.join(own, owned(own, leased), "left")
    wait = retry_delay(F.col("file_path"), F.greatest(F.col("attempt_count"), F.lit(1)), base)
    after = updated(marked, F.col("__path").isNotNull(), status="failed", error_message=F.substring("__error", 1, 4000), completed_at=now, next_retry_at=later(now, wait), lease_id=None, heartbeat_at=None)
    return after.select(*rows.columns)


def first_done(rows: DataFrame, limit: int | None) -> DataFrame:
    """Oldest completion first (none before all), then path."""
    return rows if limit is None else rows.orderBy(F.col("completed_at").asc_nulls_first(), "file_path").limit(max(0, limit))


def retry(rows: DataFrame, crawl: str | None = None, category: str | None = None, limit: int | None = None) -> DataFrame:
    """Failed sources, of one crawl or category if asked, are pending again with no attempt counted."""
    failed = rows.where("status = 'failed'").where(F.lit(True) if crawl is None else F.col("crawl_id") == crawl)
    failed = failed.where(F.lit(True) if category is None else failure_category(F.col("error_message")) == category)
    return updated_keys(rows, first_done(failed, limit), status="pending", attempt_count=0, next_retry_at=None, started_at=None, heartbeat_at=None, lease_id=None)


def signature_state(current: str) -> Column:
    own = F.coalesce("filter_signature", F.lit(""))
    return F.when(own == "", "unknown").when(own == current, "current").otherwise("stale")


def reset_stale(rows: DataFrame, current: str, unknown: bool = False, crawl: str | None = None, limit: int | None = None) -> DataFrame:
    """Completed sources of another signature (and of none, if asked) are pending again, all results cleared."""
    states = ("stale", "unknown") if unknown else ("stale",)
    old = rows.where((F.col("status") == "completed") & signature_state(current).isin(*states)).where(F.lit(True) if crawl is None else F.col("crawl_id") == crawl)
    cleared = {c: FRESH.get(c) for c in rows.columns if c not in ("file_path", "crawl_id")}
    return updated_keys(rows, first_done(old, limit), **cleared)


def adopt(rows: DataFrame, log: DataFrame, current: str, crawls: list[str], audit: str, report: str, now: str) -> tuple[DataFrame, DataFrame]:
    """(snapshot, log): completed sources of audited crawls without a signature get it; the log gains a row a crawl, also where no source changed."""
    if not crawls or not audit or not report:
        raise ValueError("crawls, audit id and report hash are required")
    hit = (F.col("status") == "completed") & F.col("crawl_id").isin(*crawls) & (F.coalesce("filter_signature", F.lit("")) == "")
    spark = rows.sparkSession
    counts = rows.where(hit).groupBy("crawl_id").agg(F.count("*").alias("rows_stamped"))
    asked = spark.createDataFrame([(c,) for c in sorted(set(crawls))], "crawl_id string")
    new = asked.join(counts, "crawl_id", "left").select(F.lit(now).alias("adopted_at"), F.lit(current).alias("filter_signature"), "crawl_id", F.lit(audit).alias("audit_id"), F.lit(report).alias("audit_report_sha256"), F.coalesce("rows_stamped", F.lit(0)).cast("bigint").alias("rows_stamped"))
    return updated(rows, hit, filter_signature=current, run_id=F.coalesce("run_id", F.lit(f"historical-audit:{audit}"))), log.unionByName(new) if log is not None else new


def states_of(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """Current state of the asked paths, each once; unknown paths are left out."""
    asked = paths.select(F.col(paths.columns[0]).alias("file_path")).distinct()
    return rows.join(asked, "file_path", "left_semi").select("file_path", "status", F.coalesce("records_processed", F.lit(0)).alias("records_processed"), F.coalesce("matches_found", F.lit(0)).alias("matches_found"), F.col("error_message").alias("error"))


def compact(rows: DataFrame, path: str, files: int = 1) -> DataFrame:
    """The snapshot written anew in few files; refused while a source is processing."""
    if not rows.where("status = 'processing'").isEmpty():
        raise RuntimeError("cannot compact while sources are processing")
    rows.coalesce(files).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Match counts of completed sources set to 0 and then to counts (file_path, matches); raises for a source that is not completed."""
    unknown = counts.join(rows.where("status = 'completed'").select("file_path"), "file_path", "left_anti")
    if not unknown.isEmpty():
        raise RuntimeError(f"not a completed source: {unknown.first()['file_path']}")
    new = counts.select(F.col("file_path").alias("__path"), F.col("matches").alias("__matches"))
    marked = rows.join(new, F.col("file_path") == F.col("__path"), "left")
    return updated(marked, F.col("status") == "completed", matches_found=F.coalesce("__matches", F.lit(0))).select(*rows.columns)


# Summaries

def _by(rows: DataFrame, by: tuple[str, ...]):
    return rows.groupBy(*by)


def summary(rows: DataFrame, now: str, by: tuple[str, ...] = (), attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """Counts by status, failed rows that may be tried now and that may not any more, sums, and the share done in percent."""
    count = lambda c: F.count_if(c)
    due = (F.col("attempt_count") < attempts) & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now))
    failed = F.col("status") == "failed"
    status = [count(F.col("status") == s).alias(s) for s in ("completed", "failed", "pending", "processing")]
    out = _by(rows, by).agg(F.count("*").alias("total_files"), *status, count(failed & due).alias("retryable"), count(failed & (F.col("attempt_count") >= attempts)).alias("exhausted"), F.coalesce(F.sum("records_processed"), F.lit(0)).alias("total_records"), F.coalesce(F.sum("matches_found"), F.lit(0)).alias("total_matches"))
    return out.withColumn("ready", F.col("pending") + F.col("retryable")).withColumn("progress_pct", F.when(F.col("total_files") > 0, F.col("completed") / F.col("total_files") * 100).otherwise(0.0))


def signature_summary(rows: DataFrame, current: str) -> DataFrame:
    done = F.col("status") == "completed"
    state = signature_state(current)
    return rows.agg(F.count_if(done).alias("completed"), *[F.count_if(done & (state == s)).alias(s) for s in ("current", "unknown", "stale")])


def failure_summary(rows: DataFrame, examples: int = 3) -> DataFrame:
    """Categories of failed sources by size, each with its first examples by crawl and path (errors cut at 500 characters).

    The examples are the least by (crawl, path): each task keeps `examples` rows a category before the shuffle.
    """
    failed = rows.where("status = 'failed'").withColumn("category", failure_category(F.col("error_message")))
    counts = failed.groupBy("category").agg(F.count("*").alias("count"))
    place = F.row_number().over(Window.partitionBy("category").orderBy("crawl_id", "file_path"))
    row = F.struct("crawl_id", "file_path", "attempt_count", "next_retry_at", F.substring(F.coalesce("error_message", F.lit("")), 1, 500).alias("error"))
    first = failed.withColumn("place", place).where(F.col("place") <= examples).groupBy("category").agg(F.sort_array(F.collect_list(row)).alias("examples"))
    return counts.join(first, "category", "left").withColumn("examples", F.coalesce("examples", F.array().cast(first.schema["examples"].dataType))).orderBy(F.desc("count"), "category")


# Schedules

def yield_order(crawls: DataFrame, summaries: DataFrame, prior: float = 200.0) -> DataFrame:
    """crawl_id, smoothed, score, position: matches per file smoothed to the mean of all asked crawls, plus an exploration bonus and a little for what remains.

    crawls: crawl_id; summaries: crawl_id, completed, matches, total. Crawls are a list of some hundred rows.
    """
    zero = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0))
    rows = crawls.select("crawl_id").join(summaries, "crawl_id", "left").select("crawl_id", zero("completed").alias("c"), zero("matches").alias("m"), F.col("total").alias("t"))
    every = Window.partitionBy()
    done, found = F.sum("c").over(every), F.sum("m").over(every)
    mean = F.when(done > 0, found / done).otherwise(0.0)
    base = F.greatest(mean, F.lit(0.01))
    total = F.greatest(F.col("c") + 1, F.coalesce("t", F.col("c") + 1))
    smoothed = (F.col("m") + prior * mean) / (F.col("c") + prior)
    score = smoothed + base * F.sqrt(F.log(done + prior + 1) / (F.col("c") + prior)) + base * 0.05 * (F.greatest(total - F.col("c"), F.lit(0)) / total)
    out = rows.select("crawl_id", smoothed.alias("smoothed"), score.alias("score"))
    return out.withColumn("position", F.row_number().over(Window.orderBy(F.desc("score"), F.desc("smoothed"), F.desc("crawl_id"))))


def crawl_order(crawls: DataFrame, strategy: str, summaries: DataFrame | None = None) -> DataFrame:
    """crawl_id and position of crawls (crawl_id, age from 0, the oldest): oldest, newest, round-robin (from both ends, the newest first) or yield-aware."""
    if strategy == "yield-aware":
        return yield_order(crawls, summaries).select("crawl_id", "position")
    from_end = F.count("*").over(Window.partitionBy()) - 1 - F.col("age")
    keys = {"oldest": [F.col("age")], "newest": [F.desc("age")], "round-robin": [F.least(from_end * 2, F.col("age") * 2 + 1)]}
    if strategy not in keys:
        raise ValueError(f"unknown strategy: {strategy}")
    return crawls.select("crawl_id", F.row_number().over(Window.orderBy(*keys[strategy])).alias("position"))


def cooldown(events: Column, base: float = 30.0, most: float = 600.0) -> Column:
    """Seconds of the circuit breaker after so many signs of pressure in a row."""
    return F.least(F.lit(most), base * F.pow(F.lit(2.0), events - 1))


# Latest rows, manifests, histories, multisets

def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key: a max over structs, aggregated before the shuffle."""
    fields = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("last"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in fields])


def overlay(catalog: DataFrame, loose: DataFrame, key: str) -> DataFrame:
    """Catalog rows replaced by loose ones of the same key; tombstones remove; by key."""
    kept = catalog.join(loose.select(key), key, "left_anti")
    return kept.unionByName(loose, allowMissingColumns=True).where(~F.coalesce(F.col("tombstone"), F.lit(False))).orderBy(key)


def history(shared: DataFrame, local: DataFrame, most: int | None = None) -> DataFrame:
    """Runs by start and session; a local row of a session replaces the shared one. With most, only that many of the last."""
    both = shared.withColumn("__rank", F.lit(0)).unionByName(local.withColumn("__rank", F.lit(1)), allowMissingColumns=True)
    rows = latest(both, "session_id", F.col("__rank")).drop("__rank")
    if most is not None:
        rows = rows.orderBy(F.desc("started_at"), F.desc("session_id")).limit(most)
    return rows.orderBy("started_at", "session_id")


def multiset_difference(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    left, right = (x.groupBy(*keys).agg(F.count("*").alias(n)) for x, n in ((a, "a"), (b, "b")))
    return left.join(right, list(keys), "full_outer").na.fill(0, ["a", "b"]).select(*keys, F.least("a", "b").alias("shared"), F.greatest(F.col("a") - F.col("b"), F.lit(0)).alias("only_a"), F.greatest(F.col("b") - F.col("a"), F.lit(0)).alias("only_b"))


def multiset_digest(rows: DataFrame, key: str, parts: int = 4096) -> DataFrame:
    """One digest of a multiset that does not depend on order: hashes of sorted parts by hash of the key, then of the sorted part hashes. No part holds more than its share of the distinct keys."""
    counts = rows.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    part = counts.groupBy(F.pmod(F.xxhash64("k"), F.lit(parts)).alias("p")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "k", "n"))), ","), 256).alias("h"))
    return part.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", F.lpad(F.col("p").cast("string"), 5, "0"), "h"))), ","), 256).alias("digest"))
