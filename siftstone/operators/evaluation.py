"""Sampling by hash rank, label metrics, threshold search, reservoirs, label queues and reports.

A sample row has sample_id, language, semantic_score, narrative_score, predicted_accept, rejection_reason, sample_role, evaluation_split,
sampling_stratum, sampling_probability, label, content_label and others; missing values are filled by enriched().
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.functions.columns import hash_rank, wilson
from siftstone.runtime import materialize, sized

def labeled() -> Column:
    return F.coalesce(F.col("label").isin("positive", "negative"), F.lit(False))


def uncertainty(score: Column, narrative: Column, threshold: float = 0.45, least: int = 8) -> Column:
    """The larger of two tents around the thresholds, 0.08 and 4 wide on each side; a null counts as far off."""
    tent = lambda x, at, wide: F.coalesce(F.greatest(F.lit(0.0), 1 - F.abs(x - at) / wide), F.lit(0.0))
    return F.floor(F.greatest(tent(score, threshold, 0.08), tent(narrative, float(least), 4.0)) * 10_000 + 0.5) / 10_000


def evaluation_split(sample_id: Column, role: Column, share: float = 0.2) -> Column:
    rank = hash_rank(F.concat(F.lit("holdout\x00"), sample_id))
    return F.when((role == "benchmark") & (rank < share), "holdout").otherwise("tuning")


def stratum() -> Column:
    return F.coalesce(F.nullif(F.col("sampling_stratum"), F.lit("")), F.when(F.col("rejection_reason") == "keyword_prefilter", "keyword_reject").when(F.col("predicted_accept"), "filter_accept").otherwise("filter_reject"))


def weight(probability: Column) -> Column:
    """One over a probability in (0, 1], else null."""
    return F.when((probability > 0) & (probability <= 1), 1 / probability)


def enriched(rows: DataFrame) -> DataFrame:
    """Defaults of what a sample lacks: schema 2 at least, uncertainty, reason, stratum, role, split, probability and weight."""
    have = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    full = rows.withColumns({c: have(c, k) for c, k in {"schema_version": "int", "selection_reason": "string", "sampling_stratum": "string", "sample_role": "string", "evaluation_split": "string", "sampling_probability": "double", "rejection_reason": "string"}.items()})
    full = full.withColumn("uncertainty_score", uncertainty(F.col("semantic_score"), F.col("narrative_score"))).withColumn("schema_version", F.greatest(F.lit(2), F.coalesce("schema_version", F.lit(1))))
    full = full.withColumn("selection_reason", F.coalesce("selection_reason", F.when(F.col("uncertainty_score") >= 0.5, "decision_boundary").otherwise("coverage")))
    full = full.withColumn("sampling_stratum", stratum()).withColumn("sample_role", F.coalesce("sample_role", F.lit("legacy")))
    return full.withColumn("evaluation_split", F.coalesce("evaluation_split", evaluation_split(F.col("sample_id"), F.col("sample_role")))).withColumn("sample_weight", weight(F.col("sampling_probability")))


def as_tuning(rows: DataFrame) -> DataFrame:
    none = F.lit(None).cast("double")
    return rows.withColumns({"sample_role": F.lit("tuning"), "evaluation_split": F.lit("tuning"), "sampling_probability": none, "sample_weight": none})


def blinded(rows: DataFrame) -> DataFrame:
    """Rows for annotators: blind, and of blind ones nothing that a model said."""
    blind = (F.col("sample_role") == "benchmark") & (F.col("evaluation_split") == "holdout")
    hidden = ("predicted_accept", "semantic_score", "narrative_score", "uncertainty_score", "selection_reason", "concept_match", "matched_keywords", "predicted_content_category")
    out = rows.withColumn("blind", F.coalesce(blind, F.lit(False)))
    return out.select(*[F.when(~F.col("blind"), F.col(c)).alias(c) if c in hidden else F.col(c) for c in out.columns])


# Metrics

def _rates(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return F.round(p, 4), F.round(r, 4), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 4)


def confusion(rows: DataFrame, actual: Column, predicted: Column, weights: Column | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """True and false counts (or weight sums), precision, recall and F1 to four places; with counts also the Wilson intervals of precision and recall.

    Rows whose prediction or weight is null are skipped. Weight sums come with the number of rows and the population they stand for.
    """
    w = weights if weights is not None else F.lit(1)
    kind = "double" if weights is not None else "bigint"
    cells = {"tp": actual & predicted, "fp": ~actual & predicted, "fn": actual & ~predicted, "tn": ~actual & ~predicted}
    sums = [F.coalesce(F.sum(F.when(c, w)), F.lit(0)).cast(kind).alias(n) for n, c in cells.items()]
    extra = [F.count(F.when(predicted.isNotNull(), w)).alias("samples")] if weights is not None else []
    out = rows.groupBy(*by).agg(*extra, *sums)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = _rates(tp, fp, fn)
    out = out.withColumns(dict(zip(("precision", "recall", "f1"), rates)))
    if weights is None:
        intervals = [*wilson(tp, tp + fp), *wilson(tp, tp + fn)]
        return out.withColumns(dict(zip(("precision_low", "precision_high", "recall_low", "recall_high"), intervals)))
    out = out.withColumn("represented_population", F.round(tp + fp + fn + F.col("tn"), 3))
    return out.withColumns({n: F.round(n, 3) for n in cells})


def threshold_grid(spark: SparkSession, rows: DataFrame, actual: Column, scores: Sequence[int] = range(30, 71), narratives: Sequence[int] = range(17), by: tuple[str, ...] = ()) -> DataFrame:
    """Metrics at every pair of thresholds (score step in hundredths, narrative) of the grid.

    Rows are counted once by the highest pair they pass (a few hundred cells a group); all else sums over cells. Rows without both scores are left out.
    """
    cell = lambda x, steps: F.when(x >= steps[-1], len(steps) - 1).otherwise(F.greatest(F.lit(-1), x.cast("int") - steps[0]))
    scored = rows.where(F.col("semantic_score").isNotNull() & F.col("narrative_score").isNotNull())
    steps = F.array(*[F.lit(x / 100) for x in scores])
    s = F.size(F.filter(steps, lambda x: x <= F.col("semantic_score"))) - 1
    cells = scored.groupBy(*by, s.alias("s"), cell(F.col("narrative_score"), list(narratives)).alias("n")).agg(F.count_if(actual).alias("yes"), F.count_if(~actual).alias("no"))
    cells = cells.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(scores) - 1)))).groupBy(*by, "at", "n").agg(*[F.sum(F.when(F.col("s") >= F.col("at"), F.col(c)).otherwise(0)).alias(c) for c in ("yes", "no")], F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    cells = cells.withColumn("over", F.explode(F.sequence(F.lit(0), F.lit(len(narratives) - 1)))).groupBy(*by, "at", "over").agg(*[F.sum(F.when(F.col("n") >= F.col("over"), F.col(c)).otherwise(0)).alias(c) for c in ("yes", "no")], F.sum("all_yes").alias("all_yes"), F.sum("all_no").alias("all_no"))
    tp, fp = F.col("yes"), F.col("no")
    fn, tn = F.col("all_yes") - tp, F.col("all_no") - fp
    out = cells.select(*by, ((F.col("at") + scores[0]) / 100).alias("semantic_threshold"), (F.col("over") + narratives[0]).alias("narrative_threshold"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    return out.withColumns(dict(zip(("precision", "recall", "f1"), _rates(F.col("tp"), F.col("fp"), F.col("fn")))))


def best_threshold(grid: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The grid row of the best rounded F1, then precision, then recall; of equal ones the lowest thresholds."""
    key = F.struct(F.col("f1"), F.col("precision"), F.col("recall"), -F.col("semantic_threshold"), -F.col("narrative_threshold"))
    fields = [c for c in grid.columns if c not in by]
    return grid.groupBy(*by).agg(F.max_by(F.struct(*fields), key).alias("b")).select(*by, *[F.col(f"b.{c}").alias(c) for c in fields])


def calibration(rows: DataFrame, actual: Column, score: str = "semantic_score") -> DataFrame:
    """Ten bins of the score with the observed share of positives and its interval."""
    step = F.least(F.lit(9), F.greatest(F.lit(0), (F.col(score) * 10).cast("int")))
    out = rows.where(F.col(score).isNotNull()).groupBy(step.alias("bin")).agg(F.count("*").alias("samples"), F.count_if(actual).alias("positive"))
    low, high = wilson(F.col("positive"), F.col("samples"))
    return out.select("bin", (F.col("bin") / 10).alias("low_score"), ((F.col("bin") + 1) / 10).alias("high_score"), "samples", "positive", F.round(F.col("positive") / F.col("samples"), 4).alias("rate"), low.alias("rate_low"), high.alias("rate_high"))


# Reservoirs and queues

def sample_rank(key: Column) -> Column:
    """The leading 16 digits of the key's SHA-256: sorts as the number does."""
    return F.substring(F.sha2(key.cast("string"), 256), 1, 16)


def bottom_k(rows: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The k rows of least hash rank of each group, with their probability of inclusion. Spark cuts each task's groups to k before the shuffle."""
    w = Window.partitionBy(by).orderBy("rank", key)
    drawn = rows.withColumn("rank", hash_rank(F.col(key))).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    size = materialize(rows.sparkSession, rows.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("population")), "populations")
    drawn = drawn.join(sized(size, size.count()), F.col(by).eqNullSafe(F.col("__by"))).drop("__by")
    return drawn.withColumn("probability", F.round(F.least(F.lit(1.0), F.lit(float(k)) / F.col("population")), 6))


def round_robin(rows: DataFrame, by: str, order: Sequence[Column], limit: int) -> DataFrame:
    """Buckets interleaved by turn: the first of each, then the second of each, up to the limit. No bucket gives more than limit rows, cut before the shuffle."""
    turn = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("turn", turn).where(F.col("turn") <= limit).orderBy("turn", by).limit(limit)


def active_pick(rows: DataFrame, limit: int) -> DataFrame:
    """Languages in turn, the most uncertain samples first, then by hash rank and id."""
    known = rows.withColumn("language", F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit("unknown")))
    return round_robin(known, "language", [F.desc("uncertainty_score"), sample_rank(F.col("sample_id")), F.col("sample_id")], limit)


def representative_pick(rows: DataFrame, limit: int) -> DataFrame:
    """The limit samples of least hash rank become benchmark rows; their probability is multiplied by the reservoir's."""
    total = rows.count()
    share = min(1.0, min(limit, total) / total) if total else 0.0
    probability = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("sampling_probability", F.lit(1.0)) * share))
    drawn = rows.orderBy(sample_rank(F.col("sample_id")), "sample_id").limit(max(0, limit))
    drawn = drawn.withColumn("sample_role", F.lit("benchmark")).withColumn("evaluation_split", evaluation_split(F.col("sample_id"), F.lit("benchmark")))
    drawn = drawn.withColumn("sampling_probability", F.nullif(probability, F.lit(0.0)))
    return drawn.withColumn("sample_weight", F.round(1 / F.col("sampling_probability"), 6))


def merged(older: DataFrame, newer: DataFrame, key: str = "sample_id") -> DataFrame:
    """Union by key, the newer row of a key wins; rows without a key are left out."""
    from siftstone.operators.state import latest

    both = older.withColumn("__age", F.lit(0)).unionByName(newer.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    return latest(both.where(F.col(key).isNotNull() & (F.col(key) != "")), key, F.col("__age")).drop("__age")


def replay(candidates: DataFrame, kept: DataFrame, most: int) -> DataFrame:
    """The replay reservoir: the benchmark reservoir beside a quarter (at most) reserved for tuning rows, which fill what is left; by id."""
    spark = candidates.sparkSession
    rows = materialize(spark, enriched(merged(kept, candidates)), "replay")
    benchmark, tuning = rows.where("sample_role = 'benchmark'"), rows.where("sample_role <> 'benchmark'")
    reserve = min(tuning.count(), most // 4)
    first = materialize(spark, representative_pick(benchmark, most - reserve), "replay_benchmark")
    rest = active_pick(as_tuning(tuning), most - first.count()).drop("turn")
    return first.unionByName(rest).orderBy("sample_id")


def live_sample(decisions: DataFrame, known: DataFrame, rate: float = 0.002, most: int = 2000, uncertain: float = 0.25, minority: float = 0.02, quota: int = 20, representative: bool = True) -> DataFrame:
    """Samples of live decisions: by coverage, near a decision boundary, and of minority languages.

    decisions: sample_id (64 hex digits), language, semantic_score, narrative_score, predicted_accept, seq. known: sample_id, sample_role. A known
    benchmark row is not drawn again; another one is only raised to benchmark. Tuning rows are limited to `most` in scan order, minority ones to
    `quota` a language; what the caps count are windows over drawn rows only, of which there are few. A minority row past its language's quota does not use up `most`.
    """
    part = lambda k: F.conv(F.substring("sample_id", 16 * k + 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))
    rows = decisions.withColumn("uncertainty_score", uncertainty(F.col("semantic_score"), F.col("narrative_score")))
    rows = rows.withColumn("coverage", part(0) < rate).withColumn("boundary", (F.col("uncertainty_score") >= 0.5) & (part(1) < uncertain)).withColumn("probe", (part(2) < minority) & ~F.col("language").isin("en", "unknown"))
    drawn = rows.where("coverage or boundary or probe").groupBy("sample_id").agg(F.min_by(F.struct(*rows.columns), "seq").alias("r")).select("r.*")
    before = known.groupBy(F.col("sample_id").alias("__id")).agg(F.max((F.col("sample_role") == "benchmark").cast("int")).alias("__benchmark"))
    drawn = drawn.join(before, F.col("sample_id") == F.col("__id"), "left")
    fresh = F.col("__id").isNull() | (F.lit(representative) & F.col("coverage") & (F.col("__benchmark") == 0))
    role = F.when(F.col("coverage") & F.lit(representative), "benchmark").otherwise("tuning")
    reason = F.when(F.col("coverage"), "coverage").when(F.col("boundary"), "decision_boundary").otherwise("minority_language")
    drawn = drawn.where(fresh).withColumn("sample_role", role).withColumn("selection_reason", reason)
    inside = Window.partitionBy("language", "selection_reason").orderBy("seq")
    drawn = drawn.where("selection_reason <> 'minority_language'").unionByName(drawn.where("selection_reason = 'minority_language'").withColumn("__place", F.row_number().over(inside)).where(F.col("__place") <= quota).drop("__place"))
    tuning = drawn.where("sample_role = 'tuning'").orderBy("seq").limit(most)
    out = drawn.where("sample_role = 'benchmark'").unionByName(tuning)
    out = out.withColumn("sampling_probability", F.when(F.col("sample_role") == "benchmark", rate)).withColumn("sampling_stratum", F.when(F.col("predicted_accept"), "filter_accept").otherwise("filter_reject"))
    out = out.withColumn("evaluation_split", evaluation_split(F.col("sample_id"), F.col("sample_role"))).withColumn("sample_weight", F.round(1 / F.col("sampling_probability"), 6))
    return out.drop("coverage", "boundary", "probe", "__id", "__benchmark")


def shadow_member(path: Column, rate: float) -> Column:
    """Whether a source takes part in the shadow sample of rejected paragraphs."""
    return hash_rank(F.concat(F.lit("shadow-source\x00"), path)) < rate


def shadow_sample(rejected: DataFrame, rate: float = 0.002, k: int = 2) -> DataFrame:
    """Of each member source the k rejected paragraphs of least sample_id, with the probability of both draws."""
    member = rejected.where(shadow_member(F.col("source_file"), rate))
    place = F.row_number().over(Window.partitionBy("source_file").orderBy("sample_id"))
    sizes = member.groupBy(F.col("source_file").alias("__s")).agg(F.count("*").alias("population"))
    drawn = member.withColumn("place", place).where(F.col("place") <= k).join(sizes, F.col("source_file") == F.col("__s")).drop("__s")
    return drawn.withColumn("sampling_probability", F.lit(rate) * F.least(F.lit(1.0), F.least(F.lit(k), F.col("population")) / F.col("population"))).withColumn("sampling_stratum", F.lit("keyword_reject")).withColumn("sample_role", F.lit("benchmark")).withColumn("evaluation_split", evaluation_split(F.col("sample_id"), F.lit("benchmark"))).withColumn("sample_weight", F.round(1 / F.col("sampling_probability"), 6))


def from_output(records: DataFrame) -> DataFrame:
    """Committed records as positive samples to annotate."""
    return enriched(records.select(F.col("record_id").alias("sample_id"), "language", "semantic_score", F.coalesce("narrative_score", F.lit(8)).alias("narrative_score")).withColumns({"predicted_accept": F.lit(True), "sampling_stratum": F.lit("accepted_output"), "sample_origin": F.lit("committed_output")}))


def annotation_sample(output: DataFrame, candidates: DataFrame, existing: DataFrame, size: int) -> DataFrame:
    """A balanced sample of `size`: half of it accepted output (a reservoir), then rejected benchmark rows (a reservoir), rejected tuning rows, other candidates and
    more output by active pick. Labels of existing rows stay; labelled rows that were not drawn are added and unlabelled ones dropped from the end for them; by
    language and hash rank.

    output and candidates are enriched samples; existing: sample_id, label, content_label, notes. Each draw is written, and what is left to draw is counted.
    """
    spark = output.sparkSession
    parts, names = [], ("sample_id", "language", "semantic_score", "narrative_score", "predicted_accept", "sample_role", "evaluation_split", "sampling_stratum", "sampling_probability", "sample_weight", "uncertainty_score", "sample_origin")
    output = output.select(*names)
    candidates = candidates.withColumn("sample_origin", F.lit("live_candidate")).select(*names)
    drawn, count = None, 0

    def take(rows: DataFrame) -> None:
        nonlocal drawn, count
        part = materialize(spark, rows.select(*names, F.lit(len(parts)).alias("__part")), "annotation_part")
        parts.append(part)
        drawn = part if drawn is None else drawn.union(part)
        count += part.count()

    new = lambda rows: rows.join(drawn.select("sample_id"), "sample_id", "left_anti").select(*names)
    rejected = candidates.where("not predicted_accept")
    take(representative_pick(output, size // 2))
    target = size - count
    take(representative_pick(rejected.where("sample_role = 'benchmark'"), target))
    after = count
    if after < size:
        take(active_pick(new(rejected), size - count))
    if count < size:
        own = F.col("sample_role") == "benchmark"
        extras = new(candidates).withColumn("evaluation_split", F.when(own, F.col("evaluation_split")).otherwise("tuning")).withColumn("sample_role", F.when(own, "benchmark").otherwise("tuning"))
        take(active_pick(extras, size - count))
    if count < size:
        take(active_pick(as_tuning(new(output)), size - count))
    old = existing.select(F.col("sample_id").alias("__id"), "label", "content_label", "notes")
    rows = drawn.join(old, F.col("sample_id") == F.col("__id"), "left").drop("__id")
    kept = existing.where(labeled()).join(drawn.select("sample_id"), "sample_id", "left_anti")
    lacking = [F.col(c) if c in kept.columns else F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in names if c != "sample_id"]
    rows = rows.unionByName(kept.select("sample_id", *lacking, F.lit(len(parts)).alias("__part"), "label", "content_label", "notes"))
    rows = materialize(spark, rows, "annotation_rows")
    over = rows.count() - size
    if over > 0:
        gone = rows.where(~labeled()).orderBy(F.desc("__part"), F.desc(sample_rank(F.col("sample_id")))).limit(over).select("sample_id")
        rows = rows.join(gone, "sample_id", "left_anti")
    return rows.drop("__part").orderBy(F.coalesce("language", F.lit("")), sample_rank(F.col("sample_id")))


def label_queue(rows: DataFrame, language: str | None = None, accepted: bool | None = None, split: str | None = None, relabel: bool = False) -> DataFrame:
    """Samples to label: filtered, the most uncertain first, languages in turn; position is the order."""
    if split not in (None, "all", "tuning", "holdout"):
        raise ValueError("split is tuning, holdout or all")
    out = enriched(rows)
    for value, condition in ((relabel, ~labeled()), (language is None, F.col("language") == language), (accepted is None, F.coalesce("predicted_accept", F.lit(False)) == bool(accepted)), (split in (None, "all"), F.col("evaluation_split") == split)):
        out = out if value else out.where(condition)
    out = out.withColumn("language", F.coalesce("language", F.lit("unknown")))
    turn = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("uncertainty_score"), sample_rank(F.col("sample_id")), "sample_id"))
    return out.withColumn("turn", turn).orderBy("turn", "language")


HISTORY = "array<struct<label:string,content_label:string,annotator:string,labeled_at:string,changed_at:string>>"
CONTENT = ("personal_prose", "lyrics", "poetry", "commercial", "genealogy", "adult_content", "unknown")


def relabel(rows: DataFrame, sample: str, label: str, now: str, content: str | None = None, notes: str | None = None, annotator: str | None = None, expected: str | None = None, check: bool = False) -> DataFrame:
    """One sample labelled: its former label goes into the history (the last 20). With check, raises if it was labelled since `expected`."""
    if label not in ("positive", "negative") or (content is not None and content not in CONTENT):
        raise ValueError("unknown label")
    found = rows.where(F.col("sample_id") == sample).select("labeled_at").head(1)
    if not found:
        raise ValueError(f"unknown sample id: {sample}")
    if check and found[0][0] != expected:
        raise RuntimeError("annotation changed since it was loaded")
    entry = F.struct("label", "content_label", "annotator", "labeled_at", F.lit(now).alias("changed_at"))
    past = F.concat(F.coalesce("label_history", F.array().cast(HISTORY)), F.array(entry))
    new = {"label_history": F.slice(past, F.greatest(F.size(past) - 19, F.lit(1)), 20), "label": F.lit(label), "content_label": F.coalesce(F.lit(content), "content_label", "predicted_content_category", F.lit("unknown")), "annotator": F.lit((annotator or "local-workbench").strip()[:120]), "labeled_at": F.lit(now)}
    if notes is not None:
        new["notes"] = F.lit(notes.strip()[:4000])
    own = F.col("sample_id") == sample
    return rows.select(*[F.when(own, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def undo(rows: DataFrame, sample: str | None = None) -> DataFrame:
    """The latest label (of one sample, if asked) replaced by what its history held before."""
    last = rows.where(labeled()).where(F.lit(True) if sample is None else F.col("sample_id") == sample)
    found = last.agg(F.max_by("sample_id", F.struct(F.coalesce("labeled_at", F.lit("")), F.coalesce("sample_id", F.lit("")))).alias("i")).first()["i"]
    if found is None:
        raise ValueError("no labelled sample to undo")
    own = F.col("sample_id") == found
    past = F.try_element_at("label_history", F.lit(-1))
    size = F.size("label_history")
    rest = F.when(size > 1, F.slice("label_history", 1, F.greatest(size - 1, F.lit(1))))
    new = {c: past[c] for c in ("label", "content_label", "annotator", "labeled_at")} | {"label_history": rest}
    return rows.select(*[F.when(own, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


# Status and reports

def funnel(rows: DataFrame) -> DataFrame:
    """Samples by language and stage, and the weights of benchmark rows by stage."""
    stage = F.when(F.col("sampling_stratum") == "keyword_reject", "keyword_rejected").when(F.col("predicted_accept"), "accepted").otherwise("filter_rejected")
    rows = rows.withColumn("stage", stage).withColumn("language", F.coalesce("language", F.lit("unknown")))
    names = ("keyword_rejected", "accepted", "filter_rejected")
    weighed = F.when(F.col("sample_role") == "benchmark", F.col("sample_weight"))
    return rows.groupBy("language").agg(F.count("*").alias("samples"), *[F.count_if(F.col("stage") == s).alias(s) for s in names], *[F.round(F.coalesce(F.sum(F.when(F.col("stage") == s, weighed)), F.lit(0.0)), 3).alias(f"weighted_{s}") for s in names])


def status(annotations: DataFrame, least: int = 100, least_holdout: int = 20) -> DataFrame:
    """One row: labels by kind, predictions, and whether baseline and holdout are ready."""
    is_ = lambda v: labeled() & (F.col("label") == v)
    holdout = labeled() & (F.col("sample_role") == "benchmark") & (F.col("evaluation_split") == "holdout")
    counts = {"samples": F.lit(True), "labeled": labeled(), "positive": is_("positive"), "negative": is_("negative"), "accepted": F.coalesce("predicted_accept", F.lit(False)), "holdout_labels": holdout, "holdout_positive": holdout & is_("positive")}
    out = annotations.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    ready = (F.col("labeled") >= least) & (F.col("positive") > 0) & (F.col("negative") > 0)
    held = (F.col("holdout_labels") >= least_holdout) & (F.col("holdout_positive") > 0) & (F.col("holdout_positive") < F.col("holdout_labels"))
    return out.withColumn("unlabeled", F.col("samples") - F.col("labeled")).withColumn("rejected", F.col("samples") - F.col("accepted")).withColumn("baseline_ready", ready).withColumn("holdout_ready", held)


def plan(annotations: DataFrame, least: int = 100, least_holdout: int = 20) -> DataFrame:
    """What to label: for each split and prediction its target, labelled, available and planned samples."""
    each = max(1, least_holdout // 2)
    total = max(0, least - 2 * each)
    targets = annotations.sparkSession.createDataFrame([("holdout", False, each), ("holdout", True, each), ("tuning", False, total // 2), ("tuning", True, total - total // 2)], "split string, accepted boolean, target int")
    rows = annotations.select(F.coalesce("evaluation_split", F.lit("tuning")).alias("split"), F.coalesce("predicted_accept", F.lit(False)).alias("accepted"), labeled().alias("done"))
    have = rows.groupBy("split", "accepted").agg(F.count_if("done").alias("labeled"), F.count_if(~F.col("done")).alias("available"))
    out = targets.join(have, ["split", "accepted"], "left").na.fill(0)
    missing = F.greatest(F.lit(0), F.col("target") - F.col("labeled"))
    return out.withColumn("remaining", missing).withColumn("planned", F.least("remaining", "available")).withColumn("insufficient", F.col("available") < F.col("remaining"))


def recall_by_language(configured: DataFrame, annotations: DataFrame, candidates: DataFrame, least: int = 20) -> DataFrame:
    """Every configured (language, keyword_terms, native_anchors) or observed language with its candidates, labels and positives that keywords missed."""
    tell = lambda rows: rows.withColumn("language", F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit("unknown")))
    a = tell(annotations).groupBy("language").agg(F.count("*").alias("annotation_samples"), F.count_if(labeled()).alias("labeled"), F.count_if(labeled() & (F.col("label") == "positive")).alias("positive"), F.count_if((F.col("label") == "positive") & (F.col("sampling_stratum") == "keyword_reject")).alias("keyword_miss_positives"))
    c = tell(candidates).groupBy("language").agg(F.count("*").alias("candidate_samples"), F.count_if(F.col("sampling_stratum") == "keyword_reject").alias("keyword_shadow"))
    out = configured.join(a, "language", "full_outer").join(c, "language", "full_outer").na.fill(0)
    return out.withColumn("negative", F.col("labeled") - F.col("positive")).withColumn("ready", (F.col("labeled") >= least) & (F.col("positive") > 0) & (F.col("positive") < F.col("labeled")))


def scope(benchmark: DataFrame) -> DataFrame:
    """What metrics of labelled benchmark rows stand for, by the strata they hold."""
    seen = benchmark.agg(F.collect_set("sampling_stratum").alias("s"))
    has = lambda *names: F.size(F.array_except(F.array(*map(F.lit, names)), F.col("s"))) == 0
    return seen.select(F.when(has("accepted_output", "filter_reject", "keyword_reject"), "end_to_end_weighted").when(has("accepted_output", "filter_reject"), "downstream_filter_weighted").otherwise("descriptive_active_sample").alias("metric_scope"))


def agreement(rows: DataFrame) -> DataFrame:
    """How many labelled samples have a human content label, and the share that the prediction agrees with."""
    own = F.col("content_label").isNotNull() & (F.col("content_label") != "")
    same = own & (F.col("content_label") == F.col("predicted_content_category"))
    return rows.agg(F.count_if(own).alias("categorized"), F.round(F.count_if(same) / F.nullif(F.count_if(own), F.lit(0)), 4).alias("agreement"))


def report(spark: SparkSession, annotations: DataFrame, least: int = 100, least_holdout: int = 20, least_language: int = 20) -> dict[str, DataFrame]:
    """The tables of the evaluation report, over one written table of labelled samples."""
    every = enriched(annotations)
    rows = materialize(spark, every.where(labeled()), "labelled")
    actual, predicted = F.col("label") == "positive", F.coalesce("predicted_accept", F.lit(False))
    held = (F.col("sample_role") == "benchmark") & (F.col("evaluation_split") == "holdout")
    benchmark = rows.where("sample_role = 'benchmark' and sample_weight is not null")
    best = best_threshold(threshold_grid(spark, rows.where(~held), actual))
    chosen = best.first()
    over = (F.col("semantic_score") >= chosen["semantic_threshold"]) & (F.col("narrative_score") >= chosen["narrative_threshold"]) if chosen else predicted
    ready = rows.groupBy(F.coalesce("language", F.lit("unknown")).alias("language")).agg(F.count("*").alias("samples"), ((F.count("*") >= least_language) & (F.count_if(actual) > 0) & (F.count_if(actual) < F.count("*"))).alias("ready"))
    by_language = best_threshold(threshold_grid(spark, rows.where(~held), actual, by=("language",)), ("language",))
    return {
        "status": status(every, least, least_holdout),
        "overall": confusion(rows, actual, predicted),
        "weighted": confusion(benchmark, actual, predicted, F.col("sample_weight")),
        "scope": scope(benchmark),
        "tuning": confusion(rows.where(~held), actual, predicted),
        "holdout": confusion(rows.where(held), actual, predicted),
        "validation": confusion(rows.where(held), actual, over),
        "by_language": confusion(rows.withColumn("language", F.coalesce("language", F.lit("unknown"))), actual, predicted, by=("language",)).join(ready, "language"),
        "language_thresholds": by_language.join(ready.where("ready"), "language"),
        "calibration": calibration(rows, actual),
        "recommended": best,
        "categories": rows.groupBy("content_label", "predicted_content_category").count(),
        "agreement": agreement(rows),
        "false_positives": rows.where(predicted & ~actual).select("sample_id"),
        "false_negatives": rows.where(~predicted & actual).select("sample_id"),
    }


# Models and snapshots

def anchor_match(rows: DataFrame, anchors: list[tuple[int, list[float]]], vector: str) -> DataFrame:
    """score and anchor of the most similar anchor (the first of equal ones), by one matrix product an Arrow batch; null or zero vectors score null. Any number of anchors travels with the function."""
    from collections.abc import Iterator

    import numpy as np
    import pyarrow as pa

    names = np.array([i for i, _ in anchors], np.int64)
    table = np.array([v for _, v in anchors], np.float64)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    size = table.shape[1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(batch.schema.get_field_index("__v")).to_pylist()
            good = np.array([v is not None and len(v) == size and None not in v for v in cells], bool)
            x = np.array([v for v, g in zip(cells, good) if g], np.float64).reshape(-1, size)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            cosine = x @ table.T / np.where(length > 0, length, np.nan)
            best = np.where(np.isnan(cosine).all(1), 0, np.nanargmax(np.nan_to_num(cosine, nan=-9), axis=1)) if len(x) else np.zeros(0, int)
            score, which = np.full(len(cells), np.nan), np.zeros(len(cells), np.int64)
            score[good], which[good] = cosine[np.arange(len(x)), best], names[best]
            none = np.isnan(score)
            yield pa.record_batch({f.name: batch.column(k) for k, f in enumerate(batch.schema) if f.name != "__v"} | {"score": pa.array(score, mask=none), "anchor": pa.array(which, mask=none)})

    kept = [c for c in rows.columns if c not in ("score", "anchor")]
    schema = rows.select(*kept).schema.add("score", "double").add("anchor", "long")
    return rows.select(*kept, F.col(vector).alias("__v")).mapInArrow(scored, schema)


def drift(baseline: DataFrame, candidate: DataFrame, threshold: float = 0.45, most: float = 0.005, concepts: float = 0.99, decisions: float = 1.0) -> DataFrame:
    """One row: shared, missing and added samples of two snapshots (sample_id, semantic_score, concept_match), their drift, agreements, and whether the candidate is safe."""
    b = baseline.select("sample_id", F.col("semantic_score").alias("b"), F.col("concept_match").alias("bc"), F.lit(True).alias("in_b"))
    c = candidate.select("sample_id", F.col("semantic_score").alias("c"), F.col("concept_match").alias("cc"), F.lit(True).alias("in_c"))
    both = b.join(c, "sample_id", "full_outer")
    shared = F.coalesce("in_b", F.lit(False)) & F.coalesce("in_c", F.lit(False))
    gap = F.when(shared, F.abs(F.col("b") - F.col("c")))
    share = lambda x: F.avg(F.when(shared, x.cast("int")))
    agree = [share(F.col("bc").eqNullSafe(F.col("cc"))), share((F.col("b") >= threshold) == (F.col("c") >= threshold))]
    out = both.agg(F.count_if(shared).alias("shared"), F.count_if(F.col("in_c").isNull()).alias("missing"), F.count_if(F.col("in_b").isNull()).alias("added"), F.avg(gap).alias("mean"), F.max(gap).alias("max"), agree[0].alias("concept"), agree[1].alias("decision"))
    safe = (F.col("missing") == 0) & (F.col("added") == 0) & (F.col("max") <= most) & (F.col("concept") >= concepts) & (F.col("decision") >= decisions)
    return out.select("shared", "missing", "added", F.round("mean", 8).alias("mean_absolute_score_drift"), F.round("max", 8).alias("max_absolute_score_drift"), F.round("concept", 6).alias("concept_agreement"), F.round("decision", 6).alias("threshold_decision_agreement"), F.coalesce(safe, F.lit(False)).alias("safe"))


def capture(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Samples that can be scored, by id, at most limit; raises if there is none."""
    out = rows.where("sample_id is not null and sample_id <> '' and paragraph is not null and paragraph <> ''").orderBy("sample_id")
    out = out if limit is None else out.limit(limit)
    if out.isEmpty():
        raise ValueError("no sample to score")
    return out
