"""Run metrics: counters, rates and funnel of a run, histories, profiles, health rules, benchmark choices and dependency policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.operators.state import failure_category, history

COUNTERS = ("records_processed", "eligible_paragraphs", "keyword_rejected", "keyword_candidates", "matches_accepted", "matches_committed", "bytes_read")


def run_snapshot(sources: DataFrame, elapsed: float, target: int, overrun: bool = False) -> DataFrame:
    """One row of a run: sources by status, summed counters, rates, the funnel and the seconds that are left at this pace: none beyond the target, or, with overrun, less than none.

    sources: status, the COUNTERS and peak_worker_rss_bytes, a row a source. Counters add and peaks are maxima, so partial results combine before the shuffle.
    """
    of = lambda s: F.count_if(F.col("status") == s).alias(f"files_{s}")
    out = sources.agg(*[of(s) for s in ("completed", "failed", "interrupted")], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], F.round(F.coalesce(F.max("peak_worker_rss_bytes"), F.lit(0)) / 1048576, 1).alias("peak_worker_rss_mb"))
    done = F.col("files_completed") + F.col("files_failed") + F.col("files_interrupted")
    rate = done / elapsed
    left = F.lit(target) - done if overrun else F.greatest(F.lit(target) - done, F.lit(0))
    rates = {"files_per_hour": rate * 3600, "records_per_second": F.col("records_processed") / elapsed, "candidates_per_second": F.col("keyword_candidates") / elapsed, "matches_per_hour": F.col("matches_committed") / elapsed * 3600, "megabytes_per_second": F.col("bytes_read") / 1_000_000 / elapsed}
    out = out.withColumns({n: F.round(c, 3) for n, c in rates.items()}).withColumn("eta_seconds", F.when(rate > 0, F.round(left / rate, 1)))
    return out.withColumn("filter_rejected", F.greatest(F.lit(0), F.col("keyword_candidates") - F.col("matches_accepted"))).withColumn("target_files", F.lit(target)).withColumn("elapsed_seconds", F.lit(round(elapsed, 3)))


def failures(sources: DataFrame) -> DataFrame:
    return sources.where("status = 'failed'").groupBy(failure_category(F.col("error")).alias("category")).agg(F.count("*").alias("n")).orderBy("category")


def cache_rate(hits: Column, misses: Column) -> Column:
    return F.round(hits / F.greatest(hits + misses, F.lit(1)), 4)


def concise(runs: DataFrame) -> DataFrame:
    """What tells the health of runs: identity, files by status, rates and funnel; no contracts."""
    keep = ("session_id", "started_at", "profile", "target_files", "elapsed_seconds", "eta_seconds", "files_completed", "files_failed", "files_interrupted", "files_per_hour", "records_per_second", "eligible_paragraphs", "keyword_rejected", "keyword_candidates", "matches_accepted", "matches_committed", "filter_rejected", "peak_worker_rss_mb", "filter_signature")
    return runs.select(*[c for c in keep if c in runs.columns])


def recent(shared: DataFrame, local: DataFrame, limit: int = 20, profile: str | None = None) -> DataFrame:
    """The last `limit` runs (of a profile), in order."""
    rows = history(shared, local)
    rows = rows if profile is None else rows.where(F.col("profile") == profile)
    return concise(rows.orderBy(F.desc("started_at"), F.desc("session_id")).limit(limit)).orderBy("started_at", "session_id")


def profiles(runs: DataFrame) -> DataFrame:
    """Profiles compared by rates of their summed totals and by their peaks."""
    out = runs.groupBy(F.coalesce("profile", F.lit("unknown")).alias("profile")).agg(F.count("*").alias("runs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files_completed", "files_failed")], F.sum("elapsed_seconds").alias("e"), F.sum("bytes_read").alias("b"), F.coalesce(F.max("peak_worker_rss_mb"), F.lit(0.0)).alias("peak_worker_rss_mb"))
    per = lambda c, times: F.when(F.col("e") > 0, F.round(c / F.col("e") * times, 3)).otherwise(0.0)
    return out.withColumn("files_per_hour", per(F.col("files_completed"), 3600)).withColumn("megabytes_per_second", per(F.col("b") / 1_000_000, 1)).drop("e", "b")


#: name, severity, condition over the facts that is a fault, and what to do.
CHECKS = (
    ("git_worktree", "warning", "dirty", "commit or drop local changes"),
    ("git_upstream", "fail", "coalesce(behind, 0) > 0", "pull the remote branch"),
    ("crawler_lock", "fail", "lock_exists", "stop the crawler"),
    ("runtime_profile", "fail", "not runtime_valid", "set up the profile of this machine"),
    ("database_checkpoint", "fail", "not synchronized", "create or restore a checkpoint"),
    ("active_sources", "fail", "processing > 0", "recover or finish active sources"),
    ("dependency_profiles", "fail", "not dependencies_valid", "install the pinned dependencies"),
    ("dependency_security", "warning", "migration_required", "migrate the model stack"),
    ("evaluation_baseline", "warning", "not baseline_ready", "label more samples"),
    ("filter_signatures", "warning", "current_sources = 0", "audit before adopting"),
    ("hardware_metrics", "warning", "missing_profiles > 0", "measure every profile"),
    ("model_baseline", "warning", "not model_baseline_exists", "capture a model snapshot"),
    ("output_integrity", "fail", "integrity_errors > 0", "restore damaged shards"),
)


def health(facts: DataFrame, full: bool = False) -> DataFrame:
    """name, status (pass, warning or fail) and action of each rule over one row of facts; the last rule only in full."""
    rules = CHECKS if full else CHECKS[:-1]
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.when(F.expr(c), s).otherwise("pass").alias("status"), F.when(F.expr(c), a).alias("action")) for n, s, c, a in rules])
    return facts.select(F.explode(rows).alias("c")).select("c.*")


def overall(checks: DataFrame) -> DataFrame:
    bad = F.max(F.when(F.col("status") == "fail", 2).when(F.col("status") == "warning", 1).otherwise(0))
    return checks.agg(F.when(bad == 2, "fail").when(bad == 1, "attention").otherwise("healthy").alias("status"))


def best_run(runs: DataFrame, by: str = "paragraphs_per_second") -> DataFrame:
    """The fastest run that went well."""
    return runs.where("status = 'ok'").orderBy(F.desc(by), "name").limit(1)


def half_precision(best: Column, half: Column, safe: Column, gain: float = 1.05) -> Column:
    """Half precision is used where it is safe and at least gain times as fast."""
    return F.when(safe & half.isNotNull() & (best.isNull() | (half >= best * gain)), "fp16").otherwise("fp32")


def vulnerable(dependencies: DataFrame, allowed: list[str]) -> DataFrame:
    """Packages with vulnerabilities (name, version, vulns: array of ids), whether the policy lets them pass."""
    return dependencies.where(F.size("vulns") > 0).select("name", "version", F.array_sort(F.array_distinct("vulns")).alias("ids"), F.lower("name").isin(*[a.lower() for a in allowed]).alias("allowed"))
