"""Text files that queries write for themselves."""

from pyspark.sql import functions as F

from rillwork.plans.analyses import document_lines


def test_text_files_grow_in_number_and_not_in_size(spark, tmp_path):
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(10)])
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 > 0, text).alias("text"))
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "200KB")
    try:
        lines = spark.read.text(document_lines(spark, str(tmp_path)))
    finally:
        spark.conf.set(name, before)
    assert len(lines.inputFiles()) > 8
    assert lines.count() == 3600 and lines.exceptAll(docs.select("text")).count() == 0
