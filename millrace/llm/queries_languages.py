"""op13: language of the documents table."""

from pyspark.sql import functions as F

from .common import fold, read
from .languages import identify, train


def op13_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    found = identify(rows, train(docs), hide=("text",))
    return found.select("doc_id", "held_out", "lang_pred", "score", "n_labelled", "n_switches")
