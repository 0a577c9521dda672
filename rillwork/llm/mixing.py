"""Mixing sources to target weights by Pareto order sampling.

Sources share all words by their weights, but none takes more than ``MOST``
times its own words; what that leaves over is shared again. A source's target is made of
whole copies of everything it has, and of a sample for the rest: documents are
ranked by random odds divided by inclusion odds (Pareto order sampling), and the
first ones that fill the word budget are taken. The one document on the edge of
the budget is taken in part (its first words), so a source meets its target to the word.

The chance to be taken, lambda, is min(1, c * x) with x the square root of a document's words in thousandths; c makes the
words expected equal the budget, and is solved from the histogram of sizes: from the greatest size down, sizes are certain as long as what
is left of the budget would give them a chance of 1. Certain documents are taken first; the others are ranked by the odds of a
random number divided by the odds of lambda. The random number is a hash of the doc_id, so reruns agree.

Nothing is ranked per source in one place: ranks are cut into ``BINS`` bins, word
counts per (source, bin) give each bin its start, and only the rows of one bin are put in order. Documents that are certain or
have no words need no order and are dealt by hash. What is windowed per source are its distinct sizes and its bins.

Defined results: a null text has size 0 and is never taken; a null source is a source
of its own, the last; a null doc_id counts as an empty one; rows with equal doc_ids
are separate documents, in order of their size. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, numbered

WEIGHTS = (5, 2, 1)
MOST = 3
BINS = 65536
WORD = "[^\\x20\\x09-\\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size): weights by rank of the source, capped and shared again.

    In the order of size by weight, the sources before the first that stays below its limit are at theirs; what they leave
    is shared by the others.
    """
    sources = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod("pos", F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources = kept(sources.withColumn("weight", weight.cast("long")).drop("pos"))
    # one row per source, and one task
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("source_size").cast("double") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("spare").cast("double") * F.col("weight") / F.col("weights").cast("double")
    limit = (F.col("source_size") * MOST).cast("double")
    level = sources.select(
        "source_size", "weight", (F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0))).alias("spare"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"))
    first = level.where(share <= limit).orderBy(F.col("weights").desc()).select("spare", "weights").first()
    if first is None:
        return sources.select("source", "source_size", limit.alias("target"))
    shared = F.lit(float(first["spare"])) * F.col("weight") / F.lit(float(first["weights"]))
    return sources.select("source", "source_size", F.least(shared, limit).alias("target"))


def odds_weight(size: Column) -> Column:
    """What the chance to be taken is proportional to: the square root of the words, in whole thousandths."""
    return F.floor(F.sqrt(size.cast("double")) * 1000).cast("long")


def chances(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, budget, c, certain_from) from (source, size, n) and the sources' goals.

    Sums are exact decimals, so c does not depend on the order they are added in.
    """
    x = odds_weight(F.col("size")).cast("decimal(10,0)")
    steps = sizes.where("size > 0").join(goals.select(F.col("source").alias("s"), "budget"), F.col("source").eqNullSafe(F.col("s")))
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    greater = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    words = (F.col("n") * F.col("size")).cast("decimal(20,0)")
    steps = steps.select("source", "size", F.sum(words * x).over(smaller).alias("rest"),
                         (F.col("budget").cast("decimal(20,0)") - F.coalesce(F.sum(words).over(greater), F.lit(0))).cast("decimal(20,0)").alias("left"))
    certain = F.col("left") * x >= F.col("rest")
    found = steps.groupBy("source").agg(F.max(F.when(~certain, F.col("left").cast("double") / F.col("rest").cast("double"))).alias("c"),
                                        F.min(F.when(certain, F.col("size"))).alias("certain_from"))
    return goals.join(found.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mixed(docs: DataFrame, seed: str = "") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source)."""
    # a uniform number from 52 bits of a hash, never 0 or 1
    name = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    sizes = kept(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size")))
    histogram = kept(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = targets(histogram.select("source", (F.col("size") * F.col("n")).alias("size")))
    # floor(target / source_size) whole copies and a budget of words for the sample
    goals = goals.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("budget", F.floor(F.col("target") - F.col("copies") * F.col("source_size") + 0.5).cast("long"))
    goals = kept(chances(histogram, goals))
    chance = F.col("c") * odds_weight(F.col("size"))
    rank = (u / (1 - u)) / F.when(chance > 0, chance / (1 - chance)).otherwise(1.0)
    ordered = (F.col("size") > 0) & (F.col("certain_from").isNull() | (F.col("size") < F.col("certain_from")))
    ranked = sizes.join(goals.select(F.col("source").alias("s"), "c", "certain_from"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ranked = ranked.withColumn("rank", F.when(ordered, rank))
    # the bin grows with the rank, evenly enough for chances of any size: its fourth root; certain documents come first, those without words last
    root = F.sqrt(F.sqrt("rank"))
    ranked = kept(ranked.select("doc_id", "source", "size", "rank", F.when(F.col("size") == 0, BINS).when(~ordered, -1).otherwise(
        F.floor(root / (1 + root) * BINS)).cast("int").alias("bin")))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    starts = bins.withColumn("before", before).join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), "before", "source_size", "target", "copies", "budget")
    placed = ranked.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    # rows that need no order are spread
    placed = placed.withColumn("deal", F.when(F.col("rank").isNull(), F.pmod(F.hash("doc_id", "size"), F.lit(BINS))).otherwise(0))
    inside = Window.partitionBy("source", "bin", "deal").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    used = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    sampled = F.when(F.col("rank").isNull(), F.when(F.col("bin") < 0, F.col("size")).otherwise(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - used)))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("copies") * F.col("size") + sampled).cast("long").alias("taken"))


def copies_of(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, a part of it as its first words.

    Columns stay as they are, but ``n_chars``, if there is one, follows a text that was cut.
    Rows that share a doc_id share what is taken of that id, and rows with a null
    doc_id too.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    taken = mixed(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("sizes"))
    one = docs.select([F.col(c).alias(n) for c, n in names.items()]).withColumn("key", F.col(names["doc_id"]))
    one = one.join(taken, F.col("key").eqNullSafe(F.col("doc_id"))).where("taken > 0")
    old = F.col(names["text"]).cast("string")
    # of rows with one id, each gives the same share of its words
    part = F.ceil(F.col("taken") % F.col("sizes") * size_of(old) / F.col("sizes")).cast("int")
    one = one.withColumn("part", part).withColumn("cut", F.explode(F.concat(
        F.array_repeat(F.lit(False), F.expr("int(taken div sizes)")),
        F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))))
    words = F.regexp_extract_all(old, F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    text = F.when(F.col("cut"), F.array_join(F.slice(words, F.lit(1), F.col("part")), "")).otherwise(old)
    new = {c: F.col(n) for c, n in names.items()} | {"text": text}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("cut"), F.length(text)).otherwise(new["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return one.select([new[c].alias(c) for c in docs.columns])
