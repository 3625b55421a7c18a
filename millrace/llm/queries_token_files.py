"""op10: token-id files of the documents table, written and read back."""

import public_tokenizers

from .common import read, scratch
from .token_files import digests, write

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op10_token_files(spark, sf_dir):
    folder = scratch(spark, "tokens")
    return digests(write(read(spark, sf_dir, "documents"), folder, TOKENIZER), folder)
