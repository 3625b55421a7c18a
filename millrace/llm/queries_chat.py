"""op5: repaired and rendered conversations."""

from .chat import format_chat
from .common import read


def op5_chat_format(spark, sf_dir):
    return format_chat(read(spark, sf_dir, "conversations"))
