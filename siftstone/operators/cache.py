"""A versioned cache of model results by namespace and text hash, and the scoring of candidates through it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions.columns import digest
from siftstone.functions.text import text_fingerprint
from siftstone.operators import rules
from siftstone.operators.state import latest
from siftstone.runtime import materialize

VERSION = 1
SCORES = "text_hash string, score double, concept string, updated_at string"
VECTORS = "text_hash string, dimensions int, vector array<float>, updated_at string"
LANGUAGES = "text_hash string, language string, confidence double, updated_at string"


def namespace(model: str, revision: str, precision: str = "fp32", anchors: list[str] | None = None) -> str:
    """A cache is valid for a model, its revision and precision, and for scores also for the anchors."""
    import hashlib

    name = f"{model}@{revision}:{precision}"
    return name if anchors is None else f"{name}:anchors={hashlib.sha256(chr(31).join(anchors).encode()).hexdigest()[:16]}"


def _folder(root: str, table: str, name: str) -> str:
    import hashlib

    return f"{root}/v{VERSION}/{table}/namespace={hashlib.sha256(name.encode()).hexdigest()[:16]}"


def get(spark: SparkSession, root: str, table: str, name: str, schema: str) -> DataFrame:
    """The latest entry of each hash; a cache that is missing or cannot be read is empty, and vectors of a wrong length are misses."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(f"{_folder(root, table, name)}/*")
    except AnalysisException:
        return spark.createDataFrame([], schema)
    rows = latest(rows, "text_hash", F.col("updated_at"))
    return rows.where(F.size("vector") == F.col("dimensions")) if "vector" in rows.columns else rows


def put(spark: SparkSession, root: str, table: str, name: str, rows: DataFrame, now: str, token: str) -> None:
    """Entries added under the token of their run, so that a repeated run overwrites itself; later entries of a hash win."""
    rows.withColumn("updated_at", F.lit(now)).write.mode("overwrite").parquet(f"{_folder(root, table, name)}/run={token}")


def stats(spark: SparkSession, root: str, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """table and entries of each (namespace, schema)."""
    out = None
    for table, (name, schema) in tables.items():
        part = get(spark, root, table, name, schema).agg(F.count("*").alias("entries")).select(F.lit(table).alias("table"), "entries")
        out = part if out is None else out.unionByName(part)
    return out


def through(spark: SparkSession, rows: DataFrame, cached: DataFrame, compute: Callable[[DataFrame], DataFrame], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with the cached or computed columns, new entries). compute takes distinct (text_hash, text) that the cache lacks and returns their entries."""
    hashed = rows.withColumn("text_hash", text_fingerprint(F.col(text)))
    hashed = materialize(spark, hashed, "hashed")
    asked = hashed.groupBy("text_hash").agg(F.min(text).alias(text))
    new = materialize(spark, compute(asked.join(cached.select("text_hash"), "text_hash", "left_anti")), "computed")
    known = cached.drop("updated_at").unionByName(new)
    return hashed.join(known, "text_hash", "left").drop("text_hash"), new


def decide(spark: SparkSession, candidates: DataFrame, cached: DataFrame, score: Callable[[DataFrame], DataFrame], text: str = "text", threshold: float = 0.45, least: int = 8) -> tuple[DataFrame, DataFrame]:
    """(candidates with narrative_score, semantic_score, concept_match, accepted and rejection_reason, new score entries).

    Hard negatives of the narrative rules never reach the model: they score -1 as pre-filtered. score gives (text_hash, score, concept).
    """
    told = materialize(spark, candidates.withColumn("narrative_score", rules.narrative_score(F.col(text))), "narrated")
    hard = F.col("narrative_score") <= -50
    rest, new = through(spark, told.where(~hard), cached, score, text)
    skipped = told.where(hard).withColumns({"score": F.lit(-1.0), "concept": F.lit(rules.SKIPPED)})
    out = rest.unionByName(skipped).withColumnsRenamed({"score": "semantic_score", "concept": "concept_match"})
    why = rules.decision(F.col("semantic_score"), F.col("narrative_score"), threshold, least)
    return out.withColumn("accepted", why == "accepted").withColumn("rejection_reason", F.nullif(why, F.lit("accepted"))), new


def matches(decisions: DataFrame) -> DataFrame:
    """Accepted candidates."""
    return decisions.where("accepted").drop("accepted", "rejection_reason")


def signature(contract: dict) -> str:
    """SHA-256 of a filter contract in canonical JSON: whatever changes results changes it."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(contract, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def contract(anchors: list[str], model: str, revision: str, threshold: float = 0.45, language: float = 0.5, rules_version: str = "1", text_version: str = "1") -> dict:
    from siftstone.functions.vocabulary import keywords

    return {"schema_version": 1, "semantic_model": {"name": model, "revision": revision}, "semantic_threshold": round(threshold, 8), "language_threshold": round(language, 8), "paragraph_length": {"minimum": 150, "maximum": 5000}, "text_normalization": {"version": text_version}, "narrative_filter": {"minimum_indicators": 8, "ruleset_version": rules_version}, "keywords": list(keywords()), "concept_anchors": list(anchors)}


def signature_of(*parts: Column) -> Column:
    return digest(*parts)


def detector(model: Callable[[str], tuple[str, float]], chars: int = 500):
    """A vectorised language function over any model: the first `chars` characters on one line; blank text is unknown with confidence 0. No more of a text goes to Python."""
    from pyspark.sql.types import StructType

    from siftstone.functions.python import by_slices

    def one(t: str | None) -> dict[str, object]:
        clean = (t or "").replace("\n", " ").strip()
        return dict(zip(("language", "confidence"), model(clean) if clean else ("unknown", 0.0)))

    detect = by_slices(one, StructType().add("language", "string").add("confidence", "double"))
    return lambda text: detect(F.substring(text, 1, chars))
