"""op4: SimHash near-duplicates of the documents table."""

from pyspark.sql import functions as F

from .common import read
from .simhash import groups


def op4_simhash_near_dedup(spark, sf_dir):
    rows = groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
