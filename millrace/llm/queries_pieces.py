"""op1: n-best SentencePiece segmentation of the documents table."""

import public_tokenizers

from .common import read
from .pieces import segment

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece_nbest(spark, sf_dir):
    return segment(read(spark, sf_dir, "documents").select("doc_id", "text"), MODEL, hide=("text",))
