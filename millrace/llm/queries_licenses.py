"""op9: licence labels of the documents table."""

from .common import read
from .licenses import scan


def op9_license_scan(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text"), hide=("text",))
