"""Materialized tables: merge-on-read deltas, compaction and partition rewrites."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.transforms import partition_fields, partition_path, with_partitions
from millrace.operators import mor
from millrace.operators.apply import apply, touched_partitions
from millrace.operators.evolve import stamp_ids
from millrace.operators.mor import COMMIT
from millrace.sinks import commits
from millrace.sinks.commits import SLOT, Log, Part
from millrace.spec import TableSpec


def data_name(spec: TableSpec) -> str:
    return f"{spec.lake_name}/data"


def deletes_name(spec: TableSpec) -> str:
    return f"{spec.lake_name}/deletes"


def touched_name(spec: TableSpec) -> str:
    return f"{spec.lake_name}/touched"


def index_name(spec: TableSpec) -> str:
    return f"{spec.lake_name}/index"


def key_spec(spec: TableSpec) -> TableSpec:
    """The key columns alone, with their field ids: the shape of equality deletes."""
    return TableSpec(spec.name, T.StructType([spec.schema[c] for c in spec.pk]), spec.pk)


def ensure_tables(spark: SparkSession, root: str, specs: Sequence[TableSpec]) -> list[str]:
    """Create missing tables as an empty first commit; returns the names created."""
    log = commits.load(spark, root)
    new = [s for s in specs if not log.entries(data_name(s))]
    if new:
        writes, parts = {}, {}
        for s in new:
            fields = partition_fields(s.partition, s)
            writes[data_name(s)] = with_partitions(stamp_ids(spark.createDataFrame([], s.schema), s), fields)
            parts |= partition_map(s)
        commits.commit_tables(spark, root, None, writes, kind="base", partition_by=parts, log=log)
    return [s.name for s in new]


# -- where a key lies --------------------------------------------------------

#: Rows of a hash slot, keys that are looked up through slots and index, keys of an index file.
SLOT_ROWS, FEW_KEYS, INDEX_KEYS = 1_000_000, 10_000, 10_000_000
KEY_HASH = "_key_hash"
INDEX = T.StructType([T.StructField(KEY_HASH, T.IntegerType())])


def key_hash(spec: TableSpec) -> Column:
    """32 bits of a key's hash; the same before and after a key column is widened."""
    def plain(c: str) -> Column:
        kind = spec.schema[c].dataType
        if isinstance(kind, T.IntegralType):
            return F.col(c).cast("bigint")
        if isinstance(kind, T.FloatType):
            return F.col(c).cast("double")
        return F.col(c).cast("decimal(38,10)") if isinstance(kind, T.DecimalType) else F.col(c)

    return F.shiftright(F.xxhash64(*[plain(c) for c in spec.pk]), 32).cast("int")


def slots_for(rows: int) -> int:
    return max(1, -(-rows // SLOT_ROWS))


def slot_of(hashed: int, slots: int) -> int:
    """The slot of a key: the hash range is cut evenly."""
    return (hashed + (1 << 31)) * slots >> 32


def with_slot(df: DataFrame, spec: TableSpec, slots: int) -> DataFrame:
    """Rows with their slot; a single slot has no folder of its own."""
    if slots < 2:
        return df
    place = F.shiftright((key_hash(spec).cast("bigint") + F.lit(1 << 31)) * slots, 32)
    return df.withColumn(SLOT, place.cast("int"))


def lookup_parts(spark: SparkSession, root: str, spec: TableSpec, log: Log, hashes: Sequence[int]) -> list[Part]:
    """Parts of the table that may hold keys of these hashes.

    A base says by its number of slots where a key lies. Of the deltas after it, the key indexes say which have it: only
    their pages with a wanted hash are read. Shares without an index are always among them.
    """
    start = log.base(data_name(spec)) - 1
    indexed = {r["_commit"] for r in log.entries(index_name(spec), start)}
    listed = log.parts(index_name(spec), start)
    hit = {}
    if listed:
        rows = commits.read_parts(spark, root, index_name(spec), INDEX, listed).filter(F.col(KEY_HASH).isin(list(hashes)))
        for r in rows.select(COMMIT, KEY_HASH).distinct().collect():
            hit.setdefault(r[COMMIT], set()).add(r[KEY_HASH])
    out = []
    for r in log.entries(data_name(spec), start):
        wanted = hit.get(r[COMMIT], set()) if r[COMMIT] in indexed else set(hashes)
        if (r["slots"] or 1) < 2:  # one folder
            out += [Part(r[COMMIT], r["attempt"])] if wanted else []
        else:
            out += [Part(r[COMMIT], r["attempt"], k) for k in sorted({slot_of(h, r["slots"]) for h in wanted})]
    return out


def read_keys(spark: SparkSession, root: str, spec: TableSpec, keys: DataFrame, log: Log) -> tuple[DataFrame, DataFrame]:
    """Data and deletes that may hold ``keys`` (rows of the key columns, a few or many): whole parts, cut down to the
    keys by the caller. Up to ``FEW_KEYS`` keys open only the parts that may have them; more read the table."""
    found = keys.select(key_hash(spec).alias(KEY_HASH)).distinct().limit(FEW_KEYS + 1).collect()
    if len(found) > FEW_KEYS:
        return read_parts(spark, root, spec, log=log)
    parts = lookup_parts(spark, root, spec, log, [r[0] for r in found])
    deletes = {(r[COMMIT], r["attempt"]): r["slots"] or 1 for r in log.entries(deletes_name(spec))}
    there = [p for p in parts if (p.commit, p.attempt) in deletes]
    # Empty slots have no folder.
    return (commits.read_parts(spark, root, data_name(spec), spec.schema, _present(spark, root, data_name(spec), parts)),
            commits.read_parts(spark, root, deletes_name(spec), key_spec(spec).schema,
                               _present(spark, root, deletes_name(spec), there)))


def _present(spark: SparkSession, root: str, table: str, parts: Sequence[Part]) -> list[Part]:
    """Parts whose folder is there: a commit's slot without a row was never written."""
    held: dict[tuple[int, str | None], set[str]] = {}
    out = []
    for p in parts:
        if p.slot is not None:
            whole = Part(p.commit, p.attempt)
            if (p.commit, p.attempt) not in held:
                held[p.commit, p.attempt] = set(commits.files.names(spark, whole.path(f"{root}/{table}")))
            if f"{SLOT}={p.slot}" not in held[p.commit, p.attempt]:
                continue
        out.append(p)
    return out


# -- merge-on-read -----------------------------------------------------------


def delta_writes(ready: DataFrame, spec: TableSpec, folded: DataFrame | None = None,
                 slots: int | None = None) -> dict[str, DataFrame]:
    """Data rows of resolved changes and the deletes of their keys, by target folder.

    The deletes need keys only: pass the unresolved ``folded`` (persisted, like
    ``ready`` when both are one) and their write skips the lookups. With ``slots`` rows are dealt by key hash, and the
    key hashes are written as the commit's index, in order.
    """
    changed = ready if folded is None else folded
    deletes, _ = mor.split(changed, spec)
    _, data = mor.split(ready, spec)
    fields = partition_fields(spec.partition, spec)
    out = {
        data_name(spec): with_partitions(stamp_ids(data, spec), fields),
        deletes_name(spec): stamp_ids(deletes, key_spec(spec)),
    }
    if slots is None:
        return out
    # One file is gathered by a shuffle: a coalesced task would run, and hold the memory of, every task before it.
    if slots < 2:  # at most SLOT_ROWS rows: one file, unless partitions deal them anyway
        out = {name: df if fields and name == data_name(spec) else df.repartition(1) for name, df in out.items()}
    else:
        out = {name: with_slot(df, spec, slots) for name, df in out.items()}
    hashes = changed.select(key_hash(spec).alias(KEY_HASH))
    files = -(-slots * SLOT_ROWS // INDEX_KEYS)
    hashes = hashes.repartition(1) if files < 2 else hashes.repartitionByRange(files, KEY_HASH)
    return out | {index_name(spec): hashes.sortWithinPartitions(KEY_HASH)}


def delta_kinds(spec: TableSpec) -> dict[str, str]:
    return {data_name(spec): "delta", deletes_name(spec): "delta", index_name(spec): "index"}


def partition_map(spec: TableSpec, slots: int | None = None) -> dict[str, list[str]]:
    parts = [f.name for f in partition_fields(spec.partition, spec)]
    if (slots or 1) > 1:
        return {data_name(spec): [SLOT, *parts], deletes_name(spec): [SLOT]}
    return {data_name(spec): parts} if parts else {}


def read_parts(spark: SparkSession, root: str, spec: TableSpec, as_of: int | None = None,
               log: Log | None = None) -> tuple[DataFrame, DataFrame]:
    """Visible data and delete rows since the last compaction at or before ``as_of``."""
    log = (log or commits.load(spark, root)).upto(as_of)
    start = log.base(data_name(spec)) - 1
    data = commits.read_table(spark, root, data_name(spec), spec.schema, after=start, log=log)
    deletes = commits.read_table(spark, root, deletes_name(spec), key_spec(spec).schema, after=start, log=log)
    return data, deletes


def read_state(spark: SparkSession, root: str, spec: TableSpec, as_of: int | None = None) -> DataFrame:
    """Current rows, or the rows as of a commit."""
    data, deletes = read_parts(spark, root, spec, as_of)
    return mor.scan(data, deletes, spec.pk, nullable=spec.nullable_keys).select(*spec.columns)


def compact(spark: SparkSession, root: str, spec: TableSpec, rows_per_file: int | None = None,
            slots: int | None = None) -> int:
    """Rewrite a table's live rows as a new base, dealt by key hash; readers need no deletes before it."""
    log = commits.load(spark, root)
    data, deletes = read_parts(spark, root, spec, log=log)
    live = mor.scan(data, deletes, spec.pk, nullable=spec.nullable_keys).select(*spec.columns)
    slots = slots or slots_for(data.count())  # a bound of the live rows, from the files' footers
    rows = with_slot(with_partitions(stamp_ids(live, spec), partition_fields(spec.partition, spec)), spec, slots)
    return commits.commit_tables(
        spark, root, None, {data_name(spec): rows}, kind="base", partition_by=partition_map(spec, slots),
        mark=max(log.mark, 0), cluster=True, log=log, details={data_name(spec): {"slots": slots}},
        rows_per_file={data_name(spec): rows_per_file} if rows_per_file else None,
    )


# -- copy-on-write -----------------------------------------------------------

PART = "_part"  # partition path: one never-null text per partition


def merge_table(folded: DataFrame, spec: TableSpec, root: str, commit: int, source: str | None = None) -> None:
    """Rewrite only the partitions a change set touches, as a new version of each.

    The log entry names the partitions it rewrites, so a reader picks the folders of each partition's latest version by
    itself. The list of touched partitions is stored with the commit, so a partition that became empty is known to be
    empty. Unpartitioned tables are rewritten whole. A ``source`` that is there already is left as it is; the number of
    another commit is refused before anything is written. ``folded`` is read three times; callers persist or write it
    first.
    """
    spark = folded.sparkSession
    log = commits.load(spark, root)
    if source is not None and log.find(source) is not None:
        return
    if any(r[COMMIT] == commit for r in log.rows):
        raise commits.Published(f"commit {commit} of {root} is published already")
    fields = partition_fields(spec.partition, spec)
    parts = [f.name for f in fields]
    if not parts:
        rows = stamp_ids(apply(read_state(spark, root, spec), folded, spec), spec)
        commits.commit_tables(spark, root, commit, {data_name(spec): rows}, kind="base", source=source, log=log)
        return
    current = _stored_versions(spark, root, spec, log)
    placed = with_partitions(folded, fields).withColumn(PART, partition_path(fields))
    attempt = commits.new_attempt()
    if log.entries(touched_name(spec)):
        touched = touched_partitions(current.select(*spec.pk, PART), placed, spec, [PART])
    else:  # nothing is stored yet
        touched = placed.filter(F.col("op") != "D").select(PART).distinct()
    part = commits.write_part(touched, root, touched_name(spec), commit, attempt=attempt)
    listed = commits.read_parts(spark, root, touched_name(spec), _TOUCHED, [part]).select(PART)
    names = [r[0] for r in listed.limit(NAMED + 1).collect()]
    # The path is made of partition columns alone, so this prunes folders at run time.
    inside = current.filter(F.col(PART).isin(names)) if len(names) <= NAMED else current.join(listed, PART, "left_semi")
    rows = with_partitions(stamp_ids(apply(inside, folded, spec), spec), fields)
    commits.write_part(rows, root, data_name(spec), commit, parts, cluster=True, attempt=attempt)
    note = json.dumps(names) if len(names) <= NAMED else None
    commits.publish(spark, root, commit, {data_name(spec): "rewrite", touched_name(spec): "touched"}, source=source,
                    attempt=attempt, details={touched_name(spec): {"note": note}})


_TOUCHED = T.StructType([T.StructField(PART, T.StringType())])

#: Partitions that a log entry names, and that a read picks by name; longer lists are read from the commits' own folders.
NAMED = 1000


def _stored_versions(spark: SparkSession, root: str, spec: TableSpec, log: Log) -> DataFrame:
    """Visible rows with their partition path, each partition at its latest version."""
    fields = partition_fields(spec.partition, spec)
    derived = [T.StructField(f.name, f.result_type) for f in fields if f.transform != "identity"]
    schema = T.StructType(list(spec.schema.fields) + derived)
    touched = log.entries(touched_name(spec))
    latest = {p: r[COMMIT] for r in touched for p in json.loads(r["note"] or "[]")}
    if touched and all(r["note"] for r in touched) and len(latest) <= NAMED:
        by_commit: dict[int, list[str]] = {}
        for p, c in latest.items():
            by_commit.setdefault(c, []).append(p)
        parts = [p for p in log.parts(data_name(spec)) if p.commit in by_commit]
        data = commits.read_parts(spark, root, data_name(spec), schema, parts).withColumn(PART, partition_path(fields))
        # Older commits give the partitions that no later one rewrote; these are conditions on folder names.
        wanted = F.lit(False)
        for c, names in by_commit.items():
            wanted = wanted | ((F.col(COMMIT) == c) & F.col(PART).isin(names))
        return data.filter(wanted)
    latest = commits.read_table(spark, root, touched_name(spec), _TOUCHED, log=log).groupBy(PART).agg(
        F.max(COMMIT).alias(COMMIT))
    data = commits.read_table(spark, root, data_name(spec), schema, log=log).withColumn(PART, partition_path(fields))
    return data.join(latest, [PART, COMMIT], "left_semi")


def read_versions(spark: SparkSession, root: str, spec: TableSpec, as_of: int | None = None) -> DataFrame:
    """Rows of a partition-rewritten table, now or as of a commit."""
    return _stored_versions(spark, root, spec, commits.load(spark, root).upto(as_of)).select(*spec.columns)
