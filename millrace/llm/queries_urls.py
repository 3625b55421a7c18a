"""op8: verdicts for the pages table."""

from .common import read
from .urls import HostRule, judge

RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)


def op8_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rows = judge(pages, RULES, read(spark, sf_dir, "labels"))
    return rows.select("page_id", "host", "path", "rule", "verdict", "mined_rule", "confidence")
