"""The catalog of crawls: modern ones from an index, newest first, and three of the old format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Crawls of ARC files, oldest first, with the folder of their files; and index names that hold no text files.
LEGACY = (("CC-CRAWL-001", "crawl-001/"), ("CC-CRAWL-002", "crawl-002/"), ("CC-2012", "parse-output/"))
NOT_MODERN = ("CC-MAIN-2008-2009", "CC-MAIN-2009-2010", "CC-MAIN-2012")
SCHEMA = "crawl_id string, era string, format string, paths_file string, age bigint"


def modern_ids(index: Sequence[dict] | None, fallback: Sequence[str] = ()) -> list[str]:
    """Ids of an index listing (newest first) without those that hold no text; the fallback where there is no listing."""
    return [e["id"] for e in index if "id" in e and e["id"] not in NOT_MODERN] if index is not None else list(fallback)


def catalog(spark: SparkSession, modern: Sequence[str], legacy: Sequence[tuple[str, str]] = LEGACY) -> DataFrame:
    """All crawls by age, the oldest first (0): legacy ones, then modern ones (given newest first)."""
    rows = [(c, "legacy", "arc", p) for c, p in legacy] + [(c, "modern", "wet", f"crawl-data/{c}/wet.paths.gz") for c in reversed(modern)]
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], SCHEMA)


def crawl(rows: DataFrame, crawl_id: str) -> dict[str, object]:
    found = rows.where(F.col("crawl_id") == crawl_id).head(1)
    if not found:
        raise ValueError(f"unknown crawl: {crawl_id}")
    return found[0].asDict()


def is_legacy(rows: DataFrame, crawl_id: str) -> bool:
    return not rows.where((F.col("crawl_id") == crawl_id) & (F.col("era") == "legacy")).isEmpty()


def with_summaries(crawls: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every crawl with its summary; missing numbers are 0."""
    return crawls.join(summaries, "crawl_id", "left").na.fill(0)
