"""N-gram Jaccard join by token-combination prefixes, with DataFrame functions only."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.components import components
from siftstone.runtime import discard, materialize, sized, table

SPACE = "[\\x20\\x09-\\x0D]+"


def shingle_set(text: Column, n: int = 5) -> Column:
    """Sorted distinct 64-bit hashes of the n-word shingles of the whole text; fewer words are one shingle, none give []."""
    lowered = F.btrim(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(" \t\n\x0b\f\r"))
    words = F.transform(F.split(lowered, SPACE, -1), lambda w: F.xxhash64(w))
    # split() is bound once as the argument of a one-element transform; naming it twice would evaluate it twice.
    hashes = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) < n, F.array(F.xxhash64(w))).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))),
    )[0]
    none = F.array().cast("array<bigint>")
    return F.when(F.coalesce(F.length(lowered), F.lit(0)) == 0, none).otherwise(F.sort_array(F.array_distinct(hashes)))


def jaccard_join(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 80, n: int = 5, rare: int = 64, region: float = 0.35, most_rows: int = 2000) -> DataFrame:
    """One row per input row: doc_id, n_shingles, n_similar, component_id.

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets (exact).
    1. Equal sets are one representative (its smallest doc_id) with a number of copies; groups of any size cost one row.
    2. A set of n shingles misses at most e = floor(n * (100 - percent) / 100) of them in any partner. Shingles in one
       fixed region of the hash space that no other set has are counted by two plain aggregations, with the hash of a set as its name, so copies
       need not be told apart first; sets with more than e of them are out.
    3. Of the others every shingle gets its document frequency. Sorted from rare to frequent, partners share a shingle
       among the first e + 1, and two among the first e + 2. The index holds single shingles where they are rare and, for
       documents whose prefix reaches the frequent class, the 2-combinations of the frequent ones in the extended prefix.
       If the first shared shingle is rare both index it alone; otherwise the first two shared ones are both frequent.
       A key of more than most_rows documents is joined in parts: a document goes to one part as first end and to all as second.
    4. Candidates of fitting sizes are verified on the whole sets.

    Null, empty or blank text: n_shingles 0, linked with nothing. Rows with a null doc_id link with nothing and have a null
    component. Repeated rows of one doc_id and set count as one document and are all returned; rows of one doc_id with different sets count as
    documents of their own. Other columns are ignored.
    """
    slack = lambda size: F.floor(size * (100 - percent) / 100).cast("int")
    cut = int(-(2**63) + region * 2**64)
    sets = docs.select(F.col(doc_id).alias("doc_id"), shingle_set(F.col(text), n).alias("s"))
    wide = materialize(spark, sets.select("doc_id", F.xxhash64("s").alias("k1"), F.xxhash64(F.lit("second"), "s").alias("k2"), F.size("s").alias("n"), F.filter("s", lambda t: t < cut).alias("part")), "jaccard_base")
    counted = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    alive = wide.where(counted).select("doc_id", "k1", "k2", "n").distinct()
    groups = materialize(spark, alive.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard_groups")
    tokens = wide.where(counted).select("k1", F.explode("part").alias("t"))
    alone = tokens.groupBy("t").agg(F.min("k1").alias("first"), F.max("k1").alias("last")).where("first = last").groupBy("first").agg(F.count("*").alias("alone"))
    left = groups.join(alone, F.col("k1") == F.col("first"), "left").where(F.coalesce("alone", F.lit(0)) <= slack(F.col("n")))
    documents, rows_alive = groups.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0], wide.where(counted).count()
    several = rows_alive > wide.where(counted).select("doc_id").distinct().count()  # some doc_id has several rows
    node = F.col("k1") if several and documents > wide.where(counted).select("doc_id").distinct().count() else F.col("rep")
    survivors = materialize(spark, left.select(F.col("rep").alias("doc_id"), node.alias("node"), "k1", "n"), "jaccard_survivors")
    base = materialize(spark, wide.select("doc_id", "k1", "k2", "n"), "jaccard_documents")
    discard(spark, wide)

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sized(survivors, survivors.count()), "doc_id")
    if several:
        kept = kept.where(F.xxhash64(shingle_set(F.col("text"), n)) == F.col("k1")).dropDuplicates(["node"])
    shingles = kept.select(F.col("node").alias("doc_id"), "n", F.explode(shingle_set(F.col("text"), n)).alias("t"))
    frequency = shingles.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    known = shingles.join(frequency, "t").groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("shared"))
    known = materialize(spark, known.withColumn("left", slack(F.col("n")) - (F.col("n") - F.size("shared"))).where("left >= 0"), "jaccard_sets")

    prefix = known.select("doc_id", "n", "left", F.slice("shared", 1, F.col("left") + 2).alias("p"))
    common = F.filter("p", lambda x: x.df > rare)
    split = prefix.select("doc_id", "n", F.filter(F.slice("p", 1, F.col("left") + 1), lambda x: x.df <= rare).alias("singles"), common.alias("common"), (F.size(F.slice("p", 1, F.col("left") + 1)) - F.size(F.filter("p", lambda x: x.df <= rare))).alias("heads"))
    single = split.select("doc_id", "n", F.explode("singles.t").alias("key"))
    heads = split.where("heads > 0 and size(common) > 1").select("doc_id", "n", "common", F.explode(F.sequence(F.lit(1), F.least(F.col("heads"), F.size("common") - 1))).alias("i"))
    pairs = heads.select("doc_id", "n", "common", "i", F.explode(F.sequence(F.col("i") + 1, F.size("common"))).alias("j"))
    index = single.union(pairs.select("doc_id", "n", F.xxhash64(F.lit("pair"), F.element_at("common", F.col("i")).t, F.element_at("common", F.col("j")).t).alias("key")))
    index = materialize(spark, index, "jaccard_index")
    heavy = index.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > most_rows).select("key", F.ceil(F.col("many") / most_rows).cast("int").alias("parts"))
    heavy = materialize(spark, heavy, "jaccard_heavy")
    spread = index.join(sized(heavy, heavy.count()), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    left = spread.select("key", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"), F.col("doc_id").alias("a"), F.col("n").alias("na"))
    right = spread.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
    candidates = left.join(right, ["key", "part"]).where(fits).select("a", "b").distinct()
    candidates = materialize(spark, candidates, "jaccard_candidates")
    links = verified(spark, candidates, known.select("doc_id", "n", F.col("shared.t").alias("s")), percent)
    discard(spark, candidates)
    discard(spark, index, heavy, known)

    label = components(spark, links)
    named = groups.select(node.alias("node"), "rep", "k1", "k2", "copies")
    ends = links.union(links.select("b", "a")).toDF("node", "other")
    degree = ends.join(named.select(F.col("node").alias("other"), F.col("copies").alias("there")), "other").groupBy("node").agg(F.sum("there").alias("linked"))
    first = label.join(named.select(F.col("node").alias("id"), "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    reached = label.join(first, "component").select(F.col("id").alias("node"), "component_id")
    facts = named.join(degree, "node", "left").join(reached, "node", "left")
    facts = facts.select("k1", "k2", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_similar"), F.coalesce("component_id", "rep").alias("component_id"))
    whole = base.select("doc_id", "k1", "k2", F.col("n").cast("bigint").alias("n_shingles")).join(facts, ["k1", "k2"], "left")
    inside = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return whole.select("doc_id", "n_shingles", F.when(inside, F.col("n_similar")).otherwise(F.lit(0)).cast("bigint").alias("n_similar"), F.when(inside, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def verified(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int, most_pairs: int = 50_000) -> DataFrame:
    """The pairs (a, b) whose whole sets link.

    A set travels to blocks of pairs, not to pairs. Sets of one family mostly share one of three min-hashes, and their pairs meet in its
    block; a block of more than most_pairs is cut into g * g by the hashes of both ends, so a set goes there g times for each side. The
    few pairs without a common min-hash go to a grid of about as many blocks as there are shuffle partitions.
    In a block both joins find their sets in place.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    side = max(4, math.isqrt(parts))
    least = sets.select("doc_id", F.array(F.array_min("s"), *[F.array_min(F.transform("s", lambda t, j=j: F.xxhash64(t, F.lit(j)))) for j in (1, 2)]).alias("m"))
    least = materialize(spark, least, "jaccard_least")
    ends = pairs.join(least.toDF("a", "ma"), "a").join(least.toDF("b", "mb"), "b")
    meet = F.coalesce(*[F.when(F.get("ma", F.lit(j)) == F.get("mb", F.lit(j)), F.get("ma", F.lit(j))) for j in range(3)])
    met = materialize(spark, ends.select("a", "b", meet.alias("meet")), "jaccard_met")
    large = met.where("meet is not null").groupBy("meet").agg(F.count("*").alias("pairs")).where(F.col("pairs") > most_pairs).select("meet", F.ceil(F.sqrt(F.col("pairs") / most_pairs)).alias("g"))
    cell = lambda x, salt, g: F.pmod(F.xxhash64(F.lit(salt), x), g)
    g = F.when(F.col("meet").isNull(), F.lit(side)).otherwise(F.coalesce("g", F.lit(1))).cast("bigint")
    block = F.xxhash64("meet", cell(F.col("a"), "a", g), cell(F.col("b"), "b", g))
    placed = materialize(spark, met.join(large, "meet", "left").select("a", "b", block.alias("block")), "jaccard_placed")
    asked = placed.select(F.col("a").alias("doc_id"), "block").union(placed.select("b", "block")).distinct()
    here = asked.join(sets, "doc_id").repartition(parts, "block")
    first = here.select("block", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    second = here.select("block", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = placed.repartition(parts, "block").join(first.hint("merge"), ["block", "a"]).join(second.hint("merge"), ["block", "b"])
    counted = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("both"))
    out = counted.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # blocks are where both ends meet: no second shuffle by the ends
    try:
        linked = materialize(spark, out, "jaccard_verified")
    finally:
        spark.conf.set(name, before)
    discard(spark, least, met, placed)
    return linked


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark, table(spark, sf_dir, "documents"))
