"""Documents to paragraphs and candidates, exact and near dedupe, ranks within a domain, passages."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.functions import text as T
from siftstone.functions.python import repair_text, simhash64, unescape, unescape_closed
from siftstone.operators.ranks import ranked
from siftstone.runtime import discard, materialize, sized


def paragraphs(docs: DataFrame, delimiter: str = "\n\n", text: str = "text") -> DataFrame:
    """Non-empty trimmed parts with their 0-based index among the non-empty ones; ineligible parts count too."""
    outer = f"^{T.SPACE}+|{T.SPACE}+$"
    parts = F.filter(F.transform(F.split(text, delimiter), lambda p: F.regexp_replace(p, outer, "")), lambda p: p != "")
    return docs.select("*", F.posexplode(parts).alias("paragraph_index", "paragraph"))


def cleaned(parts: DataFrame, paragraph: str = "paragraph") -> DataFrame:
    """source_paragraph as it stands, raw_paragraph with single blanks, and paragraph repaired (entities, encoding damage, ligatures, NFC)."""
    rows = parts.withColumn("source_paragraph", F.col(paragraph)).withColumn("raw_paragraph", T.squash(F.col(paragraph)))
    return rows.withColumn(paragraph, T.squash(repair_text("raw_paragraph")))


def raw_if_changed(raw: Column, text: Column) -> Column:
    return F.when(raw != text, raw).otherwise("")


def eligible(text: Column, least: int = 150, most: int = 5000) -> Column:
    return F.length(text).between(least, most)


def with_neighbours(parts: DataFrame, size: int = 600) -> DataFrame:
    """The end of the paragraph before and the beginning of the one after, over all paragraphs of a document."""
    w = Window.partitionBy("doc_id").orderBy("paragraph_index")
    before, after = F.lag("paragraph").over(w), F.lead("paragraph").over(w)
    return parts.withColumn("context_before", F.coalesce(F.right(before, F.lit(size)), F.lit(""))).withColumn("context_after", F.coalesce(F.left(after, F.lit(size)), F.lit("")))


def html_to_text(html: Column, closed: bool = False) -> Column:
    """Drops blocks without text, turns breaks and block ends into new lines and other tags into blanks, decodes all references, collapses blanks and empty lines.

    closed: only references with their semicolon are decoded; else those few that HTML knows without one (&amp, &copy) too, as the reference does.
    """
    out = F.regexp_replace(html, r"(?is)<(script|style|noscript|iframe|svg|head)[^>]*>.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(?:p|div|li|h[1-6]|tr|blockquote)>", "\n")
    out = (unescape_closed if closed else unescape)(F.regexp_replace(out, "<[^>]+>", " "))
    out = F.regexp_replace(F.regexp_replace(out, "[ \t]+", " "), "\n{3,}", "\n\n")
    return F.regexp_replace(out, f"^{T.SPACE}+|{T.SPACE}+$", "")


def exact_dedupe(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """canonical (least seq of the key) and kind of every row. Only keys of several rows are joined, of which there are few; null keys are one group.

    Least seqs are aggregated before the shuffle, so a key with a third of all rows costs a row a task; the rows themselves shuffle only if those
    keys are too many to broadcast.
    """
    first = rows.groupBy(F.col(key).alias("__key")).agg(F.min(seq).alias("__first"), F.count("*").alias("__n")).where(F.col("__n") > 1).drop("__n")
    spark = rows.sparkSession
    first = materialize(spark, first, "repeated")
    out = rows.join(sized(first, first.count()), F.col(key).eqNullSafe(F.col("__key")), "left").withColumn("canonical", F.coalesce("__first", F.col(seq)))
    return out.drop("__key", "__first").withColumn("kind", F.when(F.col("canonical") == F.col(seq), "canonical").otherwise("exact"))


def close_pairs(hashed: DataFrame, distance: int) -> DataFrame:
    """(seq_a, seq_b, band, distance), seq_a < seq_b, of 64-bit hashes within the distance that share one of four 16-bit bands; band is the first shared.

    For a distance of at most 3, at least three of six blocks are equal: pairs meet on the 20 choices of three blocks (about 32 bits, so unrelated hashes
    rarely meet) and are kept where the choice is their first. Larger distances keep the bands' own rule.
    """
    bits = lambda h, at, size: F.shiftrightunsigned(h, at).bitwiseAND((1 << size) - 1)
    away = F.bit_count(F.col("h_a").bitwiseXOR(F.col("h_b")))
    shared = F.coalesce(*[F.when(bits(F.col("h_a"), 16 * i, 16) == bits(F.col("h_b"), 16 * i, 16), i) for i in range(4)])
    if distance <= 3:
        blocks = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
        choices = list(combinations(range(6), 3))
        keys = F.posexplode(F.array(*[F.xxhash64(*[bits(F.col("h"), *blocks[b]) for b in c]) for c in choices]))
        equal = F.filter(F.array(*[F.when(bits(F.col("h_a"), *b) == bits(F.col("h_b"), *b), F.lit(k)) for k, b in enumerate(blocks)]), lambda k: k.isNotNull())
        names = F.array(*[F.lit("".join(map(str, c))) for c in choices])
        own = F.get(names, F.col("choice")) == F.array_join(F.transform(F.slice(equal, 1, 3), lambda k: k.cast("string")), "")
    else:
        keys = F.posexplode(F.array(*[bits(F.col("h"), 16 * i, 16) for i in range(4)]))
        own = F.col("choice") == shared
    placed = hashed.select("seq", "h", keys.alias("choice", "value"))
    a, b = (placed.select("choice", "value", F.col("seq").alias(f"seq_{x}"), F.col("h").alias(f"h_{x}")) for x in "ab")
    near = a.join(b, ["choice", "value"]).where((F.col("seq_a") < F.col("seq_b")) & (away <= distance) & own)
    return near.select("seq_a", "seq_b", shared.alias("band"), away.alias("distance"))


def near_dedupe(spark: SparkSession, rows: DataFrame, key: str, seq: str, text: str, distance: int = 3) -> DataFrame:
    """seq, canonical, kind, distance: greedy first-seen near dedupe over SimHash bands.

    A row joins the earliest matching canonical (least band, then seq); a row with none becomes canonical; an exact copy of a near duplicate is near too.
    Solved on distinct keys by rounds over edges between undecided keys: a key without an earlier undecided one is canonical, those close to it are near,
    and edges of both go. The least undecided seq is always decided, so rounds go on until no edge is left.
    """
    firsts = rows.groupBy(key).agg(F.min(seq).alias("seq"), F.min_by(text, seq).alias("text"))
    hashed = materialize(spark, firsts.select(F.col(key).alias("key"), "seq", simhash64("text").alias("h")), "simhash")
    edges = materialize(spark, close_pairs(hashed, distance), "near_edges")
    open_ = materialize(spark, edges.select("seq_a", "seq_b"), "near_open")
    found = [edges.select(F.col("seq_b").alias("seq")).where("false")]
    while not open_.isEmpty():
        lead = materialize(spark, open_.select(F.col("seq_a").alias("seq")).join(open_.select(F.col("seq_b").alias("seq")), "seq", "left_anti").distinct(), "near_lead")
        near = materialize(spark, open_.join(lead.withColumnRenamed("seq", "seq_a"), "seq_a", "left_semi").select(F.col("seq_b").alias("seq")).distinct(), "near_gone")
        gone = lead.union(near)
        left = open_.join(gone.withColumnRenamed("seq", "seq_a"), "seq_a", "left_anti").join(near.withColumnRenamed("seq", "seq_b"), "seq_b", "left_anti")
        after = materialize(spark, left.select("seq_a", "seq_b"), "near_open")
        discard(spark, open_, lead)
        found.append(near)
        open_ = after
    near_all = found[0]
    for part in found[1:]:
        near_all = near_all.union(part)
    near_all = materialize(spark, near_all.select("seq"), "near_all")
    pick = edges.join(near_all.withColumnRenamed("seq", "seq_a"), "seq_a", "left_anti").groupBy("seq_b").agg(F.min(F.struct("band", "seq_a", "distance")).alias("pick"))
    pick = pick.join(near_all.withColumnRenamed("seq", "seq_b"), "seq_b", "left_semi")
    facts = hashed.join(pick, F.col("seq") == F.col("seq_b"), "left").select(F.col("key").alias("__key"), F.col("seq").alias("first"), F.col("pick.seq_a").alias("to"), F.col("pick.distance").alias("d"))
    out = rows.select(F.col(key).alias("key"), F.col(seq).alias("seq")).join(facts, F.col("key").eqNullSafe(F.col("__key")))
    canonical = F.coalesce("to", "first")
    kind = F.when(F.col("seq") == canonical, "canonical").when(F.col("to").isNull(), "exact").otherwise("near")
    return out.select("seq", canonical.alias("canonical"), kind.alias("kind"), F.coalesce("d", F.lit(0)).alias("distance"))


def domain_rank(spark: SparkSession, stories: DataFrame, domain: str = "domain", seq: str = "seq", cap: int = 100) -> DataFrame:
    """domain_story_rank (running count of the domain in scan order) and within_domain_cap. A domain of any share of the rows is ranked in parts."""
    out = ranked(spark, stories, [domain], [F.col(seq)], "domain_story_rank")
    return out.withColumn("within_domain_cap", F.col("domain_story_rank") <= cap)


def passage_of(rows: DataFrame, document: str, language: str | None, index: str, text: str, most: int = 12, chars: int = 12_000, seq: str | None = None) -> DataFrame:
    """rows with first_index, the index at which their passage begins.

    A passage is a run of neighbouring paragraphs of one document and language, cut greedily at `most` paragraphs or `chars` characters (joins not
    counted). A row without a document is a passage of its own. The budgeted cut folds over one run, which is part of one document.
    """
    keys = [document, *([language] if language else [])]
    w = Window.partitionBy(document).orderBy(index, *([seq] if seq else []))
    follows = (F.col(index) == F.lag(index).over(w) + 1) & (F.lag(language).over(w) == F.col(language) if language else F.lit(True)) & (F.coalesce(F.col(document).cast("string"), F.lit("")) != "")
    marked = rows.withColumn("__island", F.sum(F.when(follows, 0).otherwise(1)).over(w))
    items = F.sort_array(F.collect_list(F.struct(F.col(index).cast("long").alias("i"), F.length(text).cast("long").alias("n"))))
    runs = marked.groupBy(*keys, "__island").agg(items.alias("items"))
    none = F.array().cast("array<struct<i:bigint,first:bigint>>")
    start = F.struct(none.alias("out"), F.lit(None).cast("bigint").alias("first"), F.lit(0).cast("bigint").alias("parts"), F.lit(0).cast("bigint").alias("chars"))

    def step(s: Column, x: Column) -> Column:
        fits = s["first"].isNotNull() & (s["parts"] < most) & (s["chars"] + x["n"] <= chars)
        first = F.when(fits, s["first"]).otherwise(x["i"])
        return F.struct(F.concat(s["out"], F.array(F.struct(x["i"].alias("i"), first.alias("first")))).alias("out"), first.alias("first"), (F.when(fits, s["parts"]).otherwise(0) + 1).cast("bigint").alias("parts"), (F.when(fits, s["chars"]).otherwise(0) + x["n"]).cast("bigint").alias("chars"))

    names = [*keys, "__island"]
    cuts = runs.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(names)], F.explode(F.aggregate("items", start, step)["out"]).alias("c"))
    cuts = cuts.select(*[f"__k{n}" for n in range(len(names))], F.col("c.i").alias("__i"), F.col("c.first").alias("first_index"))
    match = [F.col(k).eqNullSafe(F.col(f"__k{n}")) for n, k in enumerate(names)] + [F.col(index).cast("long") == F.col("__i")]
    return marked.join(cuts, match).drop("__i", *names[-1:], *[f"__k{n}" for n in range(len(names))])


def passages(rows: DataFrame, document: str, index: str, text: str, most: int = 12, chars: int = 12_000, language: str | None = None) -> DataFrame:
    """document, first, last, parts and chars of every passage."""
    cut = passage_of(rows, document, language, index, text, most, chars)
    return cut.groupBy(document, F.col("first_index").alias("first"), *([language] if language else [])).agg(F.max(F.col(index).cast("long")).alias("last"), F.count("*").cast("int").alias("parts"), F.sum(F.length(text)).cast("int").alias("chars"))
