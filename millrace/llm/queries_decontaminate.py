"""op3: benchmark items found in the documents table."""

from pyspark.sql import functions as F

from .common import read
from .decontaminate import leaks


def op3_benchmark_decontamination(spark, sf_dir):
    found = leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    each = found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")
    return each.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("question").alias("question_overlap"), F.max("answer").alias("answer_overlap"),
        F.sum("passages").alias("n_passages"),
    )
