"""Source divergence audit: how far the sources of a language are from each other and from the language as a whole.

Counting is a pipeline of Arrow kernels inside ``mapInArrow``: ``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode`` and hash ``group_by``, first by (row, term), so that documents of a term are counted, then by
(group, term). What leaves a task are partial counts; Spark merges them by (language, term), where the terms that enough
documents hold are kept, and writes them as columnar shards.

Divergence of a group (a source in a language) from another distribution: over all kept terms the sum of
``floor((p - q)^2 / q)``, with p and q add-one smoothed shares of a billion. All arithmetic is on whole numbers: shares
come from long division in three steps of a thousand, so counts may reach 9 * 10^15 without leaving 64 bits.

Pairs of sources are compared shard by shard: a task holds a block of at most ``BLOCK`` sources against another one,
and a matrix of ``TERMS`` terms at a time; what leaves it is one partial sum a pair. The result has a row for each
ordered pair of sources of a language; no more pairs than that are made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.spread import spread_join
from .common import stored, text_of

#: What separates terms: every ASCII character that is no letter.
BREAKS = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SHARE = 1_000_000_000
MIN_DOCS, TOP = 3, 200
#: Characters tokenised at once, partial counts held by a task, sources and terms of a matrix, rows of a shard.
CHARS, HELD, BLOCK, TERMS, SHARD = 8_000_000, 1_000_000, 256, 2048, 200_000

COUNTS = "lang string, source string, term string, n long, docs long"


def _merged(parts: list[pa.Table], keys: list[str]) -> pa.Table:
    table = pa.concat_tables(parts).combine_chunks()
    out = table.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns([*keys, "n", "docs"])


def term_counts(texts: pa.Array, groups: pa.Array) -> pa.Table:
    """Occurrences ``n`` and documents ``docs`` of each (group, term); every text is a document."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BREAKS)
    row, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    row, flat = row.filter(full), flat.filter(full)
    coded = flat.dictionary_encode()
    each = pa.table({"row": row, "t": coded.indices, "n": pa.repeat(pa.scalar(1, pa.int64()), len(row))})
    each = each.group_by(["row", "t"], use_threads=False).aggregate([("n", "sum")])
    each = pa.table({"g": groups.take(each["row"].combine_chunks()), "t": each["t"], "n": each["n_sum"],
                     "docs": pa.repeat(pa.scalar(1, pa.int64()), len(each))})
    each = _merged([each], ["g", "t"])
    term = coded.dictionary.take(each["t"].combine_chunks())
    return pa.table({"g": each["g"], "term": term, "n": each["n"], "docs": each["docs"]})


def _slices(batch: pa.RecordBatch):
    """Pieces of a batch of at most about ``CHARS`` bytes of text, a row at least."""
    size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, base + CHARS, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _partial(batches):
    """Rows (lang, source, text) to partial counts. At most about ``HELD`` of them are held by a task."""
    codes: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def out(table):
        names = list(codes)
        for at in range(0, table.num_rows, 100_000):
            part = table.slice(at, 100_000)
            g = part["g"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in names], pa.string()).take(g) for k in (0, 1)]
                + [part[c].combine_chunks().cast(t) for c, t in (("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()))],
                names=["lang", "source", "term", "n", "docs"])

    for whole in batches:
        for b in _slices(whole):
            pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            groups = pa.array([codes.setdefault(p, len(codes)) for p in pairs], pa.int32())
            held.append(term_counts(b.column(2), groups))
            if sum(t.num_rows for t in held) > HELD:
                held = [_merged(held, ["g", "term"])]
                if held[0].num_rows > HELD // 2:
                    yield from out(held[0])
                    held = []
    if held:
        yield from out(_merged(held, ["g", "term"]))


def counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, source, term, n, total, first): the occurrences of each kept term in a group and in its language;
    ``first`` is true once for each kept term.

    One shuffle, by (language, term): a busy source is spread over all terms, and a term has at most one merged row a
    source."""
    rows = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").alias("text"))
    partial = rows.mapInArrow(_partial, COUNTS).repartition("lang", "term")
    merged = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    merged = merged.withColumns({
        "in_docs": F.sum("docs").over(term), "total": F.sum("n").over(term), "first": F.col("source") == F.min("source").over(term)})
    return merged.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total", "first")


def shares(count: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """``1 + floor(10^9 * (count + 1) / whole)``, exact for counts below ``whole``: three digits to the base of 1000."""
    rest, out = count + 1, 0
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _tasks(batches):
    """Sorted rows, cut by their first four columns: (lang, shard, bi, bj) and the table of their rows."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        keys = list(zip(*(b.column(k).to_pylist() for k in range(4))))
        at = 0
        while at < len(keys):
            if keys[at] != now:
                if held:
                    yield now, pa.Table.from_batches(held)
                held, now = [], keys[at]
            stop = at + 1
            while stop < len(keys) and keys[stop] == now:
                stop += 1
            held.append(b.slice(at, stop - at))
            at = stop
    if held:
        yield now, pa.Table.from_batches(held)


def _compared(top: int):
    """The rows of each (lang, shard, block, block) to partial sums of the pairs of sources and to leading terms.

    Head rows (kind 0) name the sources of either side; count rows (kind 1) come in the order of their terms."""

    def one(lang, bi, bj, table):
        col = lambda t, name: t[name].combine_chunks().to_numpy(zero_copy_only=False)
        head, data = (table.filter(pc.equal(table["kind"], k)) for k in (0, 1))
        v, whole, here = (int(head[c][0].as_py()) for c in ("v", "lang_n", "shard_v"))
        sides = []
        for side in (0, 1) if bi != bj else (0, 0):
            mine = head.filter(pc.equal(head["side"], side)).sort_by("src")
            sides.append((col(mine, "src"), mine["source"].to_pylist(), col(mine, "n") + v))
        (a_src, a_names, a_whole), (b_src, b_names, b_whole) = sides
        acc, terms = np.zeros((len(a_src), len(b_src)), np.int64), []
        if v:
            coded = data["term"].combine_chunks().dictionary_encode()
            t, src, side, n = coded.indices.to_numpy(zero_copy_only=False), col(data, "src"), col(data, "side"), col(data, "n")
            n_terms = len(coded.dictionary)
            total = np.zeros(n_terms, np.int64)
            total[t] = col(data, "total")
            left = side == 0
            right = left if bi == bj else ~left
            for at in range(0, n_terms, TERMS):
                width = min(TERMS, n_terms - at)
                lo, hi = np.searchsorted(t, [at, at + width])
                p = []
                for pick, (ids, _, size) in ((left, sides[0]), (right, sides[1])):
                    k = np.flatnonzero(pick[lo:hi]) + lo
                    m = np.zeros((len(ids), width), np.int64)
                    m[src[k] - ids[0], t[k] - at] = n[k]
                    p.append(shares(m, size[:, None]))
                for a in range(len(a_src)):
                    acc[a] += distances(p[0][a], p[1]).sum(1)
            if here > n_terms:  # terms of the shard that neither block has
                none = [shares(np.zeros(len(x), np.int64), x) for x in (a_whole, b_whole)]
                acc += (here - n_terms) * distances(none[0][:, None], none[1][None, :])
            if bj == 0:
                k = np.flatnonzero(left)
                p, q = shares(n[k], a_whole[src[k] - a_src[0]]), shares(total[t[k]], whole + v)
                more = p > q
                k, f = k[more], distances(p[more], q[more])
                order = np.lexsort((k, -f, src[k]))
                k, f = k[order], f[order]
                starts = np.flatnonzero(np.r_[True, np.diff(src[k]) != 0]) if len(k) else np.zeros(0, int)
                rank = np.arange(len(k)) - np.repeat(starts, np.diff(np.r_[starts, len(k)]))
                k, f = k[rank < top], f[rank < top]
                terms = [([a_names[i] for i in src[k] - a_src[0]], "term", coded.dictionary.take(pa.array(t[k])), f)]
        differ = a_src[:, None] != b_src[None, :]
        i, j = np.nonzero(differ)
        for names, part, items, values in [([a_names[x] for x in i], "pair", pa.array([b_names[x] for x in j], pa.string()), acc[i, j]), *terms]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names), pa.string()), pa.array(names, pa.string()), pa.array([part] * len(names), pa.string()),
                 items.cast(pa.string()), pa.array(values, pa.int64())],
                names=["lang", "source", "part", "item", "value"])

    def run(batches):
        for (lang, _, bi, bj), table in _tasks(batches):
            yield from one(lang, bi, bj, table)

    return run


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Each row of a source once for every block its own one meets: as side 0 of (own, other), as side 1 of (other, own)."""
    own, other = F.floor(F.col("src") / block).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = rows.withColumn("own", own).withColumn("other", other)
    left = met.select("*", F.col("own").alias("bi"), F.col("other").alias("bj"), F.lit(0).alias("side"))
    right = met.where("own <> other").select("*", F.col("other").alias("bi"), F.col("own").alias("bj"), F.lit(1).alias("side"))
    return left.unionByName(right)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of ``docs(text, lang, source, ...)``.

    Part ``pair``: the divergence of the source from each other source of its language. Part ``term``: the ``top`` terms
    that the source holds more of than its language, by their share of the divergence from the language. Ranks go from 1
    by value descending, then item ascending (UTF-8).

    Null text, lang and source are ''; a language with one source has no pair. A group whose documents hold no kept term
    still takes part in pairs (value 0 where its language has no kept term at all). Repeated rows count as so many
    documents. Other columns are not read; an empty table has an empty result.
    """
    kept = stored(counts(docs, min_docs), "kept")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("first").alias("v"), F.count("*").alias("rows"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    named = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    by_lang = Window.partitionBy("lang")
    groups = named.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", zero("n"), zero("lang_n"), zero("v"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / shard)).cast("int").alias("shards"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).alias("src"))
    groups = stored(groups.withColumn("blocks", (F.floor(F.max("src").over(by_lang) / block) + 1).cast("int")), "groups")

    place = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")
    data = spread_join(kept, groups.select("lang", "source", "src", "shards", "blocks"), ["lang", "source"], "inner")
    data = data.withColumn("shard", place)
    sizes = data.groupBy("lang", "shard").agg(F.count_if("first").alias("shard_v"))
    heads = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    heads = heads.join(sizes, ["lang", "shard"], "left").withColumn("shard_v", zero("shard_v"))

    none = F.lit(None)
    cols = ["lang", "shard", "bi", "bj", "kind", "term", "src", "side", "source", "n", "total", "v", "lang_n", "shard_v"]
    heads = _blocks(heads, block).withColumns({"kind": F.lit(0), "term": none.cast("string"), "total": none.cast("long")})
    data = _blocks(data, block).withColumns({"kind": F.lit(1), "v": none.cast("long"), "lang_n": none.cast("long"), "shard_v": none.cast("long"),
                                             "source": none.cast("string")})
    dealt = heads.select(*cols).unionByName(data.select(*cols)).repartition("lang", "shard", "bi", "bj")
    found = dealt.sortWithinPartitions(*cols[:6]).mapInArrow(_compared(top), "lang string, source string, part string, item string, value long")
    found = stored(found, "divergence")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)
