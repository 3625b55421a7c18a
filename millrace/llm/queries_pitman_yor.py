"""op2: language-model scores of the documents table."""

from .common import read
from .pitman_yor import score


def op2_pitman_yor_score(spark, sf_dir):
    return score(read(spark, sf_dir, "documents"))
