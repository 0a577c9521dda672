"""Rates at which documents of different lengths are taken, against the chances the budget implies."""

from pyspark.sql import functions as F

from rillwork.llm import mixing


def corpus(spark, sizes, other, first=0):
    """Source a with documents of the given (words, number), and a source b of ``other`` words."""
    rows = [(w, n) for w, n in sizes]
    parts = [spark.range(n).select((F.col("id") * 7 + first + 10_000_019 * i).alias("doc_id"), F.repeat(F.lit("w "), w).alias("text"), F.lit("a").alias("source"))
             for i, (w, n) in enumerate(rows)]
    rest = spark.range(100).select((-1 - F.col("id")).alias("doc_id"), F.repeat(F.lit("w "), other // 100).alias("text"), F.lit("b").alias("source"))
    out = rest
    for p in parts:
        out = out.union(p)
    return out


def rates(found, copies):
    extra = found.where("source = 'a'").select("size", ((F.col("taken") - copies * F.col("size")) / F.col("size")).alias("share"))
    return {r["size"]: r["rate"] for r in extra.groupBy("size").agg(F.avg("share").alias("rate")).collect()}


def test_chances_fit_the_budget(spark):
    """4000 documents of 100 words and 4000 of 10 000, a budget of nine tenths: chances by the square root of the size, 0.0908 and 0.908."""
    words = 4000 * 10_100
    for first in (0, 3):
        docs = corpus(spark, [(100, 4000), (10_000, 4000)], int(words * (1.9 * 7 / 5 - 1)), first)
        found = mixing.mixed(docs, str(first)).cache()
        got = rates(found, 1)
        assert abs(got[100] - 0.0908) < 0.02 and abs(got[10_000] - 0.908) < 0.01
        taken = found.where("source = 'a'").agg(F.sum("taken"), F.first("target")).first()
        assert abs(taken[0] - taken[1]) <= 1


def test_certain_documents_are_all_taken(spark):
    """Long documents whose chance would be above 1 are taken for certain, and the others share what is left."""
    docs = corpus(spark, [(100, 3000), (400, 1000), (40_000, 10)], int(1_100_000 * (1.95 * 7 / 5 - 1)))
    found = mixing.mixed(docs).cache()
    got = rates(found, 1)
    # of 1 045 000 words the ten long ones take 400 000; the middle ones would have a chance of 1.17, so they are certain too; 245 000 of 300 000 are left
    assert got[40_000] == got[400] == 1.0 and abs(got[100] - 0.817) < 0.03
    assert found.where("taken > 3 * size").count() == 0


def test_chances_by_hand(spark):
    sizes = spark.createDataFrame([("a", 100, 4000), ("a", 10_000, 4000), (None, 4, 2), ("b", 0, 5)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 36_360_000), (None, 8), ("b", 0)], "source string, budget long")
    found = {r["source"]: r for r in mixing.chances(sizes, goals).collect()}
    assert abs(found["a"]["c"] * 100_000 - 0.90809) < 1e-4 and found["a"]["certain_from"] is None
    assert found[None]["certain_from"] == 4 and found[None]["c"] is None and found["b"]["c"] is None
