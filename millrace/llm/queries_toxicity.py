"""op7: toxicity of the documents table."""

from pyspark.sql import functions as F

from .common import fold, read
from .toxicity import score, train


def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    return score(rows, model, hide=("text",)).select("doc_id", "held_out", "score", "predicted")
