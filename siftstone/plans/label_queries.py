"""Samples, labels, metrics, thresholds and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftstone.functions.columns import hash_rank
from siftstone.operators import evaluation
from siftstone.plans.registry import query
from siftstone.plans.views import SAMPLES, rank_sql, samples
from siftstone.runtime import materialize, table

Z = 1.959963984540054


def wilson_sql(hits: str, total: str, low: bool) -> str:
    p, n = f"({hits} / {total}::double)", f"({total})::double"
    inner = f"({p} + {Z} * {Z} / (2 * {n}) {'-' if low else '+'} {Z} * sqrt({p} * (1 - {p}) / {n} + {Z} * {Z} / (4 * {n} * {n}))) / (1 + {Z} * {Z} / {n})"
    return f"case when {total} > 0 then round(least(1.0, greatest(0.0, {inner})), 4) end"


RATES = "case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r"
F1 = "round(p, 4) as precision, round(r, 4) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end, 4) as f1"
CELLS = "count_if(y and q)::bigint as tp, count_if(not y and q)::bigint as fp, count_if(y and not q)::bigint as fn, count_if(not y and not q)::bigint as tn"
INTERVALS = ", ".join(f"{wilson_sql('tp', t, low)} as {n}_{'low' if low else 'high'}" for n, t in (("precision", "(tp + fp)"), ("recall", "(tp + fn)")) for low in (True, False))
LABELED = f"{SAMPLES}, lab as (select *, label = 'positive' as y, predicted_accept as q from smp where label is not null)"


def labelled(spark, sf_dir):
    return evaluation.enriched(samples(spark, sf_dir)).where("label is not null")


Y, Q = "label = 'positive'", "predicted_accept"


@query(f"with {SAMPLES} select n, sample_role, sampling_stratum, uncertainty_score, selection_reason, evaluation_split, sampling_probability::double as sampling_probability, sample_weight::double as sample_weight, 2 as schema_version from smp")
def sample_defaults(spark, sf_dir):
    return evaluation.enriched(samples(spark, sf_dir)).select("n", "sample_role", "sampling_stratum", "uncertainty_score", "selection_reason", "evaluation_split", "sampling_probability", "sample_weight", "schema_version")


@query(f"with {SAMPLES}, b as (select *, sample_role = 'benchmark' and evaluation_split = 'holdout' as blind from smp) select n, blind, case when not blind then predicted_accept end as predicted_accept, case when not blind then semantic_score end as semantic_score, case when not blind then selection_reason end as selection_reason, label from b")
def blind_rows(spark, sf_dir):
    return evaluation.blinded(evaluation.enriched(samples(spark, sf_dir))).select("n", "blind", "predicted_accept", "semantic_score", "selection_reason", "label")


@query(f"with {LABELED}, c as (select language, {CELLS} from lab group by language), m as (select *, {RATES} from c) select language, tp, fp, fn, tn, {F1}, {INTERVALS} from m")
def confusion_wilson(spark, sf_dir):
    return evaluation.confusion(labelled(spark, sf_dir), F.expr(Y), F.expr(Q), by=("language",))


_W = "coalesce(sum(case when {c} then sample_weight end), 0)::double"
_SUMS = ", ".join(f"{_W.format(c=c)} as {n}" for n, c in (("tp", "y and q"), ("fp", "not y and q"), ("fn", "y and not q"), ("tn", "not y and not q")))


@query(f"with {LABELED}, c as (select count(*)::bigint as samples, {_SUMS} from lab where sample_role = 'benchmark' and sample_weight is not null), m as (select *, {RATES} from c) select samples, round(tp, 3) as tp, round(fp, 3) as fp, round(fn, 3) as fn, round(tn, 3) as tn, {F1}, round(tp + fp + fn + tn, 3) as represented_population from m")
def weighted_confusion(spark, sf_dir):
    rows = labelled(spark, sf_dir).where("sample_role = 'benchmark' and sample_weight is not null")
    return evaluation.confusion(rows, F.expr(Y), F.expr(Q), F.col("sample_weight"))


@query(f"with {LABELED}, b as (select least(9, greatest(0, trunc(semantic_score * 10)::int)) as bin, count(*) as n, count_if(y) as p from lab where semantic_score is not null group by 1) select bin, bin / 10.0::double as low_score, (bin + 1) / 10.0::double as high_score, n::bigint as samples, p::bigint as positive, round(p / n, 4) as rate, {wilson_sql('p', 'n', True)} as rate_low, {wilson_sql('p', 'n', False)} as rate_high from b")
def calibration_bins(spark, sf_dir):
    return evaluation.calibration(labelled(spark, sf_dir), F.expr(Y))


_GRID = f"{LABELED}, g as (select a as lo, b as hi from range(30, 71) t(a), range(17) u(b)), c as (select lo / 100.0::double as semantic_threshold, hi::int as narrative_threshold, count_if(y and k)::bigint as tp, count_if(not y and k)::bigint as fp, count_if(y and not k)::bigint as fn, count_if(not y and not k)::bigint as tn from (select g.lo, g.hi, y, semantic_score >= g.lo / 100.0::double and narrative_score >= g.hi as k from g, lab where semantic_score is not null and narrative_score is not null) group by 1, 2), m as (select *, {RATES} from c), o as (select semantic_threshold, narrative_threshold, tp, fp, fn, tn, {F1} from m)"


@query(f"with {_GRID} select * from o")
def threshold_grid(spark, sf_dir):
    return evaluation.threshold_grid(spark, labelled(spark, sf_dir), F.expr(Y))


@query(f"with {_GRID} select * from o order by f1 desc, precision desc, recall desc, semantic_threshold, narrative_threshold limit 1")
def best_threshold(spark, sf_dir):
    return evaluation.best_threshold(evaluation.threshold_grid(spark, labelled(spark, sf_dir), F.expr(Y)))


@query(f"select doc_id, round({rank_sql('doc_id::varchar')}, 9) as rank from documents where {rank_sql('doc_id::varchar')} < 0.1")
def hash_rank_sample(spark, sf_dir):
    rank = hash_rank(F.col("doc_id"))
    return table(spark, sf_dir, "documents").where(rank < 0.1).select("doc_id", F.round(rank, 9).alias("rank"))


HOLD = rank_sql("'holdout' || chr(0) || doc_id::varchar")


@query(f"select lang, case when doc_id % 2 = 0 and {HOLD} < 0.2 then 'holdout' else 'tuning' end as split, count(*)::bigint as n from documents group by all")
def holdout_split(spark, sf_dir):
    role = F.when(F.col("doc_id") % 2 == 0, "benchmark").otherwise("tuning")
    return table(spark, sf_dir, "documents").groupBy("lang", evaluation.evaluation_split(F.col("doc_id").cast("string"), role).alias("split")).agg(F.count("*").alias("n"))


@query(f"with r as (select source, doc_id, row_number() over (partition by source order by {rank_sql('doc_id::varchar')}, doc_id) as place, count(*) over (partition by source) as population from documents) select source, doc_id, place::int as place, population::bigint as population, round(least(1.0, 2.0 / population), 6)::double as probability from r where place <= 2")
def bottom_k_reservoir(spark, sf_dir):
    return evaluation.bottom_k(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 2).select("source", "doc_id", "place", "population", "probability")


@query(f"with r as (select lang, doc_id, row_number() over (partition by lang order by {rank_sql('doc_id::varchar')}, doc_id) as turn from documents) select lang, doc_id, turn::int as turn from r order by turn, lang limit 30")
def round_robin_queue(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id")
    return evaluation.round_robin(rows, "lang", [hash_rank(F.col("doc_id")), F.col("doc_id")], 30).select("lang", "doc_id", "turn")


_RANK = "substr(sha256(sample_id), 1, 16)"


@query(f"with {SAMPLES}, r as (select *, row_number() over (partition by language order by uncertainty_score desc, {_RANK}, sample_id) as turn from smp) select n, language, turn::int as turn from r order by turn, language limit 60")
def active_pick(spark, sf_dir):
    return evaluation.active_pick(evaluation.enriched(samples(spark, sf_dir)), 60).select("n", "language", "turn")


_REP = "{p} as (select *, least(1.0, greatest(0.0, coalesce(sampling_probability, 1.0) * least(1.0, {k} / count(*) over ()::double))) as prob from {t} order by " + _RANK + ", sample_id limit {k})"


@query(f"with {SAMPLES}, {_REP.format(p='rp', t='smp', k=50)} select n, 'benchmark' as sample_role, case when {rank_sql(repr('holdout') + ' || chr(0) || sample_id')} < 0.2 then 'holdout' else 'tuning' end as evaluation_split, round(prob, 12)::double as probability, round(1 / prob, 4)::double as weight from rp")
def representative_pick(spark, sf_dir):
    out = evaluation.representative_pick(materialize(spark, evaluation.enriched(samples(spark, sf_dir)), "samples"), 50)
    return out.select("n", "sample_role", "evaluation_split", F.round("sampling_probability", 12).alias("probability"), F.round(1 / F.col("sampling_probability"), 4).alias("weight"))


@query(f"""with {SAMPLES}, bm as (select * from smp where sample_role = 'benchmark'), tn as (select * from smp where sample_role <> 'benchmark'), c as (select count(*) as b, (select count(*) from tn) as t from bm),
 one as (select n, 'benchmark' as role from bm order by {_RANK}, sample_id limit (select 40 - least(t, 10) from c)), two as (select n, 'tuning' as role from (select n, language, row_number() over (partition by language order by uncertainty_score desc, {_RANK}, sample_id) as turn from tn) order by turn, language limit (select 40 - count(*) from one)) select * from one union all select * from two""")
def replay_reservoir(spark, sf_dir):
    rows = samples(spark, sf_dir)
    older = rows.where("n % 2 = 0").withColumn("language", F.lit("old"))
    return evaluation.replay(rows, older, 40).select("n", F.col("sample_role").alias("role"))


@query(f"""with {SAMPLES}, o as (select n, language, {_RANK} as r, sample_id, 0 as part from smp where n % 2 = 0 order by {_RANK}, sample_id limit 40), rej as (select * from smp where not predicted_accept),
 b as (select n, language, {_RANK} as r, sample_id, 1 as part from rej where sample_role = 'benchmark' order by {_RANK}, sample_id limit (select 80 - count(*) from o)), t as (select n, language, r, sample_id, 2 as part from (select *, {_RANK} as r, row_number() over (partition by language order by uncertainty_score desc, {_RANK}, sample_id) as turn from rej where n not in (select n from o) and n not in (select n from b)) order by turn, language limit (select greatest(0, 80 - (select count(*) from o) - (select count(*) from b)))),
 e as (select n, language, r, sample_id, 3 as part from (select *, {_RANK} as r, row_number() over (partition by language order by uncertainty_score desc, {_RANK}, sample_id) as turn from smp where n not in (select n from o) and n not in (select n from b) and n not in (select n from t)) order by turn, language limit (select greatest(0, 80 - (select count(*) from o) - (select count(*) from b) - (select count(*) from t)))),
 u as (select * from o union all select * from b union all select * from t union all select * from e), k as (select n, language, {_RANK} as r, sample_id, 9 as part from smp where label is not null and n % 10 = 1 and n not in (select n from u)), a as (select u.*, label is not null and n % 10 = 1 as labelled from u join smp using (n, sample_id) union all by name select *, true as labelled from k),
 d as (select n from a where not labelled order by part desc, r desc limit (select greatest(0, count(*) - 80) from a)) select n, labelled from a where n not in (select n from d)""")
def annotation_sample(spark, sf_dir):
    rows = materialize(spark, evaluation.enriched(samples(spark, sf_dir)), "samples")
    output = rows.where("n % 2 = 0").withColumn("sample_origin", F.lit("committed_output"))
    existing = rows.where("n % 10 = 1").select("sample_id", "label", "content_label", F.lit("note").alias("notes"), "language")
    out = evaluation.annotation_sample(output, rows, existing, 80)
    return out.join(rows.select("sample_id", "n"), "sample_id").select("n", evaluation.labeled().alias("labelled"))


@query(f"""with {SAMPLES}, q as (select *, row_number() over (partition by language order by uncertainty_score desc, {_RANK}, sample_id) as turn from smp where label is null and predicted_accept = false and evaluation_split = 'tuning') select n, turn::int as turn from q""")
def label_queue(spark, sf_dir):
    return evaluation.label_queue(samples(spark, sf_dir), accepted=False, split="tuning").select("n", "turn")


def annotated(spark, sf_dir):
    rows = evaluation.enriched(samples(spark, sf_dir))
    entry = F.struct(F.lit("negative").alias("label"), F.lit("poetry").alias("content_label"), F.lit("first").alias("annotator"), F.lit("2024-01-01").alias("labeled_at"), F.lit("2024-01-02").alias("changed_at"))
    day = F.concat(F.lit("2024-02-"), F.lpad((F.col("n") % 28 + 1).cast("string"), 2, "0"))
    return rows.withColumns({"annotator": F.lit("second"), "labeled_at": F.when(F.col("label").isNotNull(), day), "label_history": F.when(F.col("n") % 2 == 0, F.array_repeat(entry, 20)).cast(evaluation.HISTORY), "notes": F.lit("")})


@query(f"with {SAMPLES}, x as (select n as t from smp order by n desc limit 1) select n, case when n = t then 'positive' else label end as label, case when n = t then 20 - (n % 2) * 19 when n % 2 = 0 then 20 end::int as history, case when n = t then 'me' else 'second' end as annotator, case when n = t then 'a note' else '' end as notes from smp, x")
def relabelled(spark, sf_dir):
    rows = materialize(spark, annotated(spark, sf_dir), "annotated")
    last = rows.agg(F.max_by("sample_id", "n")).first()[0]
    out = evaluation.relabel(rows, last, "positive", "2024-03-01", notes=" a note ", annotator=" me ")
    return out.select("n", "label", F.when(F.col("label_history").isNotNull(), F.size("label_history")).alias("history"), "annotator", "notes")


@query(f"with {SAMPLES}, x as (select n as t from smp where label is not null order by '2024-02-' || lpad((n % 28 + 1)::varchar, 2, '0') desc, sample_id desc limit 1) select n, case when n = t then case when n % 2 = 0 then 'negative' end else label end as label, case when n = t then case when n % 2 = 0 then 19 end when n % 2 = 0 then 20 end::int as history from smp, x")
def undone(spark, sf_dir):
    rows = materialize(spark, annotated(spark, sf_dir), "annotated")
    return evaluation.undo(rows).select("n", "label", F.when(F.col("label_history").isNotNull(), F.size("label_history")).alias("history"))


_STAGE = "case when sampling_stratum = 'keyword_reject' then 'keyword_rejected' when predicted_accept then 'accepted' else 'filter_rejected' end"
_STAGES = ", ".join(f"count_if(g = '{s}')::bigint as {s}, round(coalesce(sum(case when g = '{s}' and sample_role = 'benchmark' then sample_weight end), 0), 3)::double as weighted_{s}" for s in ("keyword_rejected", "accepted", "filter_rejected"))


@query(f"with {SAMPLES} select language, count(*)::bigint as samples, {_STAGES} from (select *, {_STAGE} as g from smp) group by language")
def sampled_funnel(spark, sf_dir):
    return evaluation.funnel(evaluation.enriched(samples(spark, sf_dir)))


_HELD = "label is not null and sample_role = 'benchmark' and evaluation_split = 'holdout'"


@query(f"with {SAMPLES} select count(*)::bigint as samples, count(label)::bigint as labeled, count_if(label = 'positive')::bigint as positive, count_if(label = 'negative')::bigint as negative, count_if(predicted_accept)::bigint as accepted, count_if({_HELD})::bigint as holdout_labels, count_if(not predicted_accept)::bigint as rejected, count(label) >= 100 and count_if(label = 'positive') > 0 and count_if(label = 'negative') > 0 as baseline_ready from smp")
def evaluation_status(spark, sf_dir):
    return evaluation.status(evaluation.enriched(samples(spark, sf_dir))).select("samples", "labeled", "positive", "negative", "accepted", "holdout_labels", "rejected", "baseline_ready")


@query(f"with {SAMPLES}, t as (select * from (values ('holdout', false, 10), ('holdout', true, 10), ('tuning', false, 40), ('tuning', true, 40)) t(split, accepted, target)), h as (select evaluation_split as split, predicted_accept as accepted, count(label) as l, count(*) - count(label) as a from smp group by all) select split, accepted, target::int as target, coalesce(l, 0)::bigint as labeled, coalesce(a, 0)::bigint as available, least(greatest(0, target - coalesce(l, 0)), coalesce(a, 0))::bigint as planned from t left join h using (split, accepted)")
def evaluation_plan(spark, sf_dir):
    return evaluation.plan(evaluation.enriched(samples(spark, sf_dir))).select("split", "accepted", "target", "labeled", "available", "planned")


@query(f"with {SAMPLES}, a as (select language, count(*) as n, count(label) as l, count_if(label = 'positive') as p, count_if(label = 'positive' and sampling_stratum = 'keyword_reject') as m, count_if(sampling_stratum = 'keyword_reject') as k from smp group by 1), g as (select * from (values ('en', 7), ('xx', 3)) t(language, t)) select language, coalesce(t, 0)::int as keyword_terms, coalesce(n, 0)::bigint as annotation_samples, coalesce(l, 0)::bigint as labeled, coalesce(p, 0)::bigint as positive, coalesce(m, 0)::bigint as keyword_miss_positives, coalesce(n, 0)::bigint as candidate_samples, coalesce(k, 0)::bigint as keyword_shadow, coalesce(l >= 20 and p > 0 and p < l, false) as ready from g full join a using (language)")
def recall_by_language(spark, sf_dir):
    rows = evaluation.enriched(samples(spark, sf_dir))
    configured = spark.createDataFrame([("en", 7), ("xx", 3)], "language string, keyword_terms int")
    return evaluation.recall_by_language(configured, rows, rows).select("language", "keyword_terms", "annotation_samples", "labeled", "positive", "keyword_miss_positives", "candidate_samples", "keyword_shadow", "ready")


@query(f"with {LABELED}, s as (select distinct sampling_stratum as s from lab where sample_role = 'benchmark' and sample_weight is not null) select case when (select count(*) from s where s in ('accepted_output', 'filter_reject', 'keyword_reject')) = 3 then 'end_to_end_weighted' when (select count(*) from s where s in ('accepted_output', 'filter_reject')) = 2 then 'downstream_filter_weighted' else 'descriptive_active_sample' end as metric_scope")
def metric_scope(spark, sf_dir):
    return evaluation.scope(labelled(spark, sf_dir).where("sample_role = 'benchmark' and sample_weight is not null"))


@query(f"with {LABELED} select count(content_label)::bigint as categorized, round(count_if(content_label = predicted_content_category) / count(content_label), 4) as agreement from lab")
def content_agreement(spark, sf_dir):
    return evaluation.agreement(labelled(spark, sf_dir))


@query(f"""with {_GRID}, h as (select * from lab where sample_role = 'benchmark' and evaluation_split = 'holdout'), parts as (select 'overall' as part, y, q from lab union all select 'holdout', y, q from h union all select 'tuning', y, q from lab where not (sample_role = 'benchmark' and evaluation_split = 'holdout')), c2 as (select part, {CELLS} from parts group by part), m2 as (select *, {RATES} from c2) select part, tp, fp, fn, tn, {F1} from m2""")
def evaluation_report(spark, sf_dir):
    """Metrics of the whole report by part."""
    out = evaluation.report(spark, samples(spark, sf_dir))
    rows = None
    for part in ("overall", "holdout", "tuning"):
        one = out[part].select(F.lit(part).alias("part"), "tp", "fp", "fn", "tn", "precision", "recall", "f1")
        rows = one if rows is None else rows.unionByName(one)
    return rows


_U = "floor(greatest(coalesce(greatest(0.0, 1 - abs(semantic_score - 0.45) / 0.08), 0.0), coalesce(greatest(0.0, 1 - abs(narrative_score - 8.0) / 4.0), 0.0)) * 10000 + 0.5) / 10000"
_P = "(('0x' || substr(sample_id, {a}, 16))::ubigint::double / 18446744073709551616.0)"


@query(f"""with d as (select sha256(doc_id::varchar) as sample_id, doc_id as seq, lang as language, round({rank_sql("'s' || doc_id")}, 4) as semantic_score, (doc_id % 17)::int as narrative_score, doc_id % 2 = 0 as predicted_accept from documents), u as (select *, {_U} as u, {_P.format(a=1)} < 0.2 as coverage, {_U} >= 0.5 and {_P.format(a=17)} < 0.5 as boundary, {_P.format(a=33)} < 0.5 and language not in ('en', 'unknown') as probe from d),
 k as (select * from (select sample_id, case when doc_id % 2 = 0 then 'benchmark' else 'tuning' end as role from (select doc_id, sha256(doc_id::varchar) as sample_id from documents where doc_id % 5 = 0))), r as (select u.*, case when coverage then 'benchmark' else 'tuning' end as role, case when coverage then 'coverage' when boundary then 'decision_boundary' else 'minority_language' end as reason from u left join k using (sample_id) where (coverage or boundary or probe) and (k.role is null or (coverage and k.role = 'tuning'))),
 m as (select *, row_number() over (partition by language, reason order by seq) as place from r), o as (select * from m where reason <> 'minority_language' or place <= 5), t as (select seq from o where role = 'tuning' order by seq limit 100) select seq, role as sample_role, reason as selection_reason, u as uncertainty_score from o where role = 'benchmark' or seq in (select seq from t)""")
def live_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    rows = docs.select(F.sha2(d.cast("string"), 256).alias("sample_id"), d.alias("seq"), F.col("lang").alias("language"), F.round(hash_rank(d, "s"), 4).alias("semantic_score"), (d % 17).cast("int").alias("narrative_score"), (d % 2 == 0).alias("predicted_accept"))
    known = docs.where("doc_id % 5 = 0").select(F.sha2(d.cast("string"), 256).alias("sample_id"), F.when(d % 2 == 0, "benchmark").otherwise("tuning").alias("sample_role"))
    out = evaluation.live_sample(rows, known, rate=0.2, most=100, uncertain=0.5, minority=0.5, quota=5)
    return out.select("seq", "sample_role", "selection_reason", "uncertainty_score")


@query(f"""with m as (select 'f' || source as s, sha256(doc_id::varchar) as sample_id, doc_id from documents where {rank_sql("'shadow-source' || chr(0) || 'f' || source")} < 0.5), r as (select *, row_number() over (partition by s order by sample_id) as place, count(*) over (partition by s) as population from m) select s as source_file, doc_id, population::bigint as population, round(0.5 * least(1.0, least(2, population) / population), 9)::double as probability from r where place <= 2""")
def shadow_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("f"), "source").alias("source_file"), F.sha2(F.col("doc_id").cast("string"), 256).alias("sample_id"), "doc_id")
    return evaluation.shadow_sample(rows, 0.5, 2).select("source_file", "doc_id", "population", F.round("sampling_probability", 9).alias("probability"))


@query("""with a as (select vec_id as i, embedding::double[] as v from embeddings where vec_id < 8), s as (select e.vec_id, i, list_cosine_similarity(e.embedding::double[], a.v) as s from embeddings e, a)
 select vec_id, round(max(s), 6) as score, arg_max(i, round(s, 12) - i * 1e-15) as anchor from s group by vec_id""")
def anchor_match(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    anchors = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in rows.where("vec_id < 8").orderBy("vec_id").collect()]
    return evaluation.anchor_match(rows, anchors, "embedding").select("vec_id", F.round("score", 6).alias("score"), "anchor")


@query("select doc_id, lang from documents where text <> '' order by doc_id::varchar limit 400")
def model_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").cast("string").alias("sample_id"), F.col("text").alias("paragraph"))
    return evaluation.capture(rows, 400).select("doc_id", "lang")


