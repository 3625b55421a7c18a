"""URL filters: fixed host/path rules first, then association rules mined from labelled URLs.

URLs become token sets: scheme, every host suffix, path segments with their depth (numbers as one token), file
extension, query keys and fragment. Labelled URLs carry a verdict token; Spark's FP-growth finds frequent token sets, and
sets that imply a verdict with enough confidence and support are kept if no smaller kept rule of that verdict is at
least as sure. Rules are matched through an inverted index on their rarest token. All of it is DataFrame code.

A null URL, or one without ``://``, has an empty host and path, no tokens, no rule, and the default verdict. Repeated rows
are judged alike. Columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, without

VERDICT = "verdict="
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("__url"))).otherwise("")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(authority, UPPER, LOWER), path


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    rows = without(pages, ["host", "path"]).withColumn("__url", F.coalesce(F.col(url).cast("string"), F.lit("")))
    host, path = host_path(F.col("__url"))
    return rows.withColumns({"host": host, "path": path})


def fixed_rule(rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits ``host`` and ``path``; null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def tokens() -> Column:
    """The token set of a row that has ``__url``, ``host`` and ``path``."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    steps = F.filter(F.split("path", "/"), lambda s: s != "")
    segments = F.transform(steps, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), F.regexp_replace(s, r"[0-9]+", "0")))
    query = F.regexp_extract("__url", r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("query="), F.substring_index(s, "=", 1)))
    scheme = F.array(F.concat(F.lit("scheme="), F.substring_index("__url", "://", 1)))
    fragment = F.when(F.contains("__url", F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    found = F.array_sort(F.array_distinct(F.concat(scheme, suffixes, segments, keys, fragment)))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(found)


def mine(labelled: DataFrame, support: float = 0.005, confidence: float = 0.9) -> DataFrame:
    """Rules ``(rule_id, items, verdict, confidence, support, pivot)`` from rows ``(tokens, label)``. ``support`` is the
    least share of the labelled rows that hold the tokens together with the verdict. ``pivot`` is the rarest item."""
    baskets = labelled.where("label is not null").select(F.concat("tokens", F.array(F.concat(F.lit(VERDICT), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")), "itemsets")
    names = F.filter("items", lambda x: ~x.startswith(VERDICT))
    label = F.element_at(F.filter("items", lambda x: x.startswith(VERDICT)), 1)
    joint = sets.where(F.exists("items", lambda x: x.startswith(VERDICT)) & (F.size("items") > 1)).select(
        names.alias("items"), F.substring(label, len(VERDICT) + 1, 1000).alias("verdict"), F.col("n").alias("hits")
    )
    total = baskets.count()
    rules = joint.join(sets, "items").select(
        "items", "verdict", (F.col("hits") / F.col("n")).alias("confidence"), (F.col("hits") / F.lit(max(total, 1))).alias("support")
    ).where(F.col("confidence") >= confidence)
    rules = stored(rules.withColumn("rule_id", F.xxhash64("items", "verdict")), "rules")
    subsets = rules.select("rule_id", "items", "verdict", "confidence", F.explode("items").alias("gone"))
    subsets = subsets.select("rule_id", "verdict", "confidence", F.array_remove("items", F.col("gone")).alias("items"))
    better = rules.select("items", "verdict", F.col("confidence").alias("less"))
    beaten = subsets.join(better, ["items", "verdict"]).where("less >= confidence").select("rule_id").distinct()
    kept = rules.join(beaten, "rule_id", "left_anti")
    single = sets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("item"), "n")
    rarest = kept.select("rule_id", F.explode("items").alias("item")).join(single, "item").groupBy("rule_id").agg(F.min(F.struct("n", "item")).alias("m"))
    return stored(kept.join(rarest, "rule_id").select("rule_id", "items", "verdict", "confidence", "support", F.col("m.item").alias("pivot")), "index")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Per token set ``(set_id, tokens)`` with a matching rule: the surest one's ``verdict``, ``rule_id`` and
    ``confidence`` (ties: larger support, then least id)."""
    index = rules.select("rule_id", "items", "verdict", "confidence", "support", F.col("pivot").alias("token"))
    found = sets.select("set_id", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fits = found.where(F.size(F.array_except("items", "tokens")) == 0)
    best = fits.groupBy("set_id").agg(F.max(F.struct("confidence", "support", (-F.col("rule_id")).alias("back"), "rule_id", "verdict")).alias("b"))
    return best.select("set_id", F.col("b.verdict").alias("mined"), F.col("b.rule_id").alias("mined_rule"), F.col("b.confidence").alias("confidence"))


def judge(
    pages: DataFrame, rules: tuple[HostRule, ...], labels: DataFrame | None = None, url: str = "url", key: str = "page_id",
    support: float = 0.005, confidence: float = 0.9,
) -> DataFrame:
    """Add host, path, rule (the fixed rule's text or null), verdict, mined_rule and confidence.

    Labelled URLs are those that a fixed rule decides and those whose ``key`` has a row in ``labels(doc_id, toxic)``
    (toxic is block, else allow; of several rows any toxic one counts). URLs that neither a fixed nor a mined rule
    covers are allowed. Token sets, not rows, are matched: equal ones once."""
    parts = with_parts(without(pages, ["rule", "verdict", "mined_rule", "confidence"]), url)
    text, verdict = fixed_rule(rules)
    rows = parts.withColumns({"rule": text, "__fixed": verdict, "__tokens": tokens()}).drop("__url")
    rows = rows.withColumn("__set", F.xxhash64("__tokens"))
    train = rows.select(F.col("__tokens").alias("tokens"), "__fixed", F.col(key).alias("__key"))
    if labels is not None:
        marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__key")).agg(F.max("toxic").alias("__toxic"))
        train = train.join(marks, "__key", "left")
        mark = F.when(F.col("__toxic") == 1, "block").when(F.col("__toxic") == 0, "allow")
    else:
        mark = F.lit(None).cast("string")
    train = train.select("tokens", F.coalesce("__fixed", mark).alias("label"))
    mined = mine(train, support, confidence)
    sets = rows.groupBy(F.col("__set").alias("set_id")).agg(F.first("__tokens").alias("tokens"))
    found = match(sets, mined).withColumnRenamed("set_id", "__set")
    out = rows.join(found, "__set", "left").withColumn("verdict", F.coalesce("__fixed", "mined", F.lit(DEFAULT)))
    return out.drop("__set", "__fixed", "__tokens", "mined")
