"""Types, validation, hashes, casts, parsing."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import casts as C, names as N, transforms as X
from millrace.functions.hashing import murmur3_bytes, murmur3_fixed, murmur3_text
from millrace.operators.envelope import to_events
from millrace.sources.relational import columns_query, discover, snapshot_options
from millrace.spec import SchemaChange, TableSpec, lake_type, spark_type, validate
from tests.feeds import dml, feed


def murmur(data: bytes) -> int:
    """Textbook Murmur3 x86 32, seed 0."""
    m, h, n = 0xFFFFFFFF, 0, len(data)

    def rot(x, r):
        return (x << r | x >> 32 - r) & m

    def mix(k):
        return rot(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m

    for i in range(0, n - n % 4, 4):
        h = (rot(h ^ mix(int.from_bytes(data[i:i + 4], "little")), 13) * 5 + 0xE6546B64) & m
    if n % 4:
        h ^= mix(int.from_bytes(data[n - n % 4:], "little"))
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def test_text_hash(spark):
    rnd = random.Random(3)
    texts = ["", "a", "ab", "abc", "abcd", "héllo", "日本語x", "\0\0\0"]
    texts += ["".join(chr(rnd.choice([65, 233, 0x4E00, 0x1F600, 7])) for _ in range(rnd.randrange(60))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", murmur3_text(F.col("t")).alias("h")).collect():
        assert r["h"] == murmur(r["t"].encode())


def test_long_and_binary_hash(spark):
    blobs = [bytes(range(256)) * 40 + b"\xff" * k for k in range(5)]
    df = spark.createDataFrame([(b,) for b in blobs], "b binary")
    assert [r[0] for r in df.select(murmur3_bytes(F.col("b"))).collect()] == [murmur(b) for b in blobs]
    values = [0, 1, -1, 34, 2**40, -(2**62)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] & 0xFFFFFFFF for r in df.select(murmur3_fixed(F.col("v"))).collect()]
    assert got == [murmur(v.to_bytes(8, "little", signed=True)) for v in values]


@pytest.mark.parametrize("precision, scale", [(12, 2), (18, 0), (38, 2), (30, 10)])
@pytest.mark.parametrize("standard", [False, True])
def test_decimal_bucket(spark, precision, scale, standard):
    top = 10 ** min(precision, 36) - 1
    unscaled = [0, 1, 127, 128, 255, 256, 1065, -1, -128, -129, -1065, top, -top, 10**9]
    sql = [f"cast('{'-' if u < 0 else ''}{str(abs(u)).zfill(scale + 1)[:-scale or None]}"
           f"{'.' + str(abs(u)).zfill(scale + 1)[-scale:] if scale else ''}' as decimal({precision},{scale}))" for u in unscaled]
    df = spark.sql(f"select inline(array({', '.join(f'struct({i} as i, {s} as d)' for i, s in enumerate(sql))}))")
    got = df.orderBy("i").select(X.bucket(1000, F.col("d"), T.DecimalType(precision, scale), spec=standard).alias("b")).collect()

    def raw(u):
        if standard:
            size = 1
            while not -(1 << 8 * size - 1) <= u < 1 << 8 * size - 1:
                size += 1
            return u.to_bytes(size, "big", signed=True)
        return abs(u).to_bytes((abs(u).bit_length() + 7) // 8, "big")

    assert [r[0] for r in got] == [(murmur(raw(u)) & 0x7FFFFFFF) % 1000 for u in unscaled]


def test_null_partitions(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    spec = TableSpec.from_df(df, "t")
    fields = X.partition_fields(["bucket[4](a)", "truncate[2](b)", "b"], spec)
    path = X.with_partitions(df, fields).select(X.partition_path(fields).alias("p")).first()[0]
    assert path == "a_bucket=__null__/b_truncate=__null__/b=__null__"


@pytest.mark.parametrize("source, lake", [
    ("int2", "int"), ("SERIAL", "int"), ("bigserial", "long"), ("real", "float"), ("numeric", "decimal(38,18)"),
    ("jsonb", "string"), ("interval", "string"), ("Timestamp With Time Zone", "timestamptz"), ("uuid", "uuid")])
def test_lake_types(source, lake):
    assert lake_type(source) == lake


def test_stored_types():
    assert spark_type("numeric") == T.StringType()
    assert spark_type("numeric(10,2)") == T.DecimalType(10, 2)
    assert spark_type("timestamp") == T.TimestampNTZType()
    assert spark_type("bytea") == T.BinaryType()


@pytest.mark.parametrize("expr", [
    "", "day(", "day()", "bucket[0](id)", "bucket[x](id)", "bucket(id)", "truncate(name)", "week(at)", "day(name)",
    "bucket[4](score)", "bucket[4](doc)", "truncate[4](at)", "truncate[4](key)", "nope", "truncate[2](score)", "bucket[4](flag)"])
def test_bad_partition_expressions(expr):
    spec = TableSpec.of("t", [("id", "integer"), ("name", "text"), ("at", "timestamptz"), ("score", "real"),
                              ("doc", "jsonb"), ("key", "uuid"), ("flag", "boolean")])
    with pytest.raises(ValueError):
        X.partition_fields([expr], spec)


def test_partition_names_and_types():
    spec = TableSpec.of("t", [("id", "integer"), ("at", "timestamptz"), ("price", "numeric(10,2)"), ("raw", "bytea")])
    fields = X.partition_fields(["id", "Day(at)", "truncate[50]( price )", "truncate[3](raw)", "bucket[2](raw)"], spec)
    assert [f.name for f in fields] == ["id", "at_day", "price_truncate", "raw_truncate", "raw_bucket"]
    assert [f.result_type.simpleString() for f in fields] == ["int", "int", "decimal(11,2)", "string", "int"]
    assert [f.source_id for f in fields] == [1, 2, 3, 4, 4]


def test_validation():
    a = TableSpec.of("orders", [("id", "integer"), ("at", "timestamptz")], pk=["id"])
    assert a.name == "public.orders" and a.events_name == "orders_events"
    validate([a])
    for specs, mode, text in (([], "logical", "at least one"), ([a, a], "logical", "duplicate"), ([a], "stream", "mode"),
                              ([a], "query", "watermark"),
                              ([TableSpec.of("x", [("at", "timestamptz")], watermark="at")], "query", "primary key")):
        with pytest.raises(ValueError, match=text):
            validate(specs, mode)
    with pytest.raises(ValueError):
        TableSpec.of("x", [("id", "integer")], pk=["nope"])


def test_evolution_rules():
    spec = TableSpec.of("t", [("id", "integer"), ("a", "text"), ("n", "bigint")], pk=["id"])
    two = spec.evolve(SchemaChange(added=(("z", "text"),))).evolve(SchemaChange(dropped=("z",)))
    assert two.evolve(SchemaChange(added=(("y", "text"),))).field_id("y") == 5  # ids are never reused
    for bad in (SchemaChange(retyped=(("n", "integer"),)), SchemaChange(retyped=(("a", "integer"),)),
                SchemaChange(dropped=("id",)), SchemaChange(added=(("a", "text"),))):
        with pytest.raises(ValueError):
            spec.evolve(bad)
    events = spec.events_schema()
    assert [f.name for f in events][:5] == ["_op", "_lsn", "_ts", "_seq", "_unchanged_cols"]
    assert [f.metadata["parquet.field.id"] for f in events] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert all(f.nullable for f in events.fields[5:])


def test_text_casts(spark):
    texts = ["2025-01-01 10:00:00+00", "2025-01-01 10:00:00.5+05:30", "2025-01-01 10:00:00.1234567-0130",
             "2025-01-01 10:00:00Z", "2025-01-01 10:00:00", "1969-12-31 23:59:59.999999+00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_micros(C.to_ts(F.col("t")))).collect()]
    base = 1735725600000000
    assert got == [base, base - 19800000000 + 500000, base + 5400000000 + 123456, base, base, -1]
    bad = spark.createDataFrame([("1.9",)], "t string")
    with pytest.raises(Exception):
        bad.select(C.to_int(F.col("t"))).collect()


def test_to_text_round_trip(spark):
    row = spark.sql("select timestamp'2025-01-01 10:00:00.120' a, timestamp_ntz'2025-01-01 10:00:00' b, "
                    "cast(100.50 as decimal(10,2)) c, true d, X'01ab' e")
    out = row.select(*[C.to_text(F.col(c), t) for c, t in zip("abcde", (
        "timestamptz", "timestamp", "numeric(10,2)", "boolean", "bytea"))]).first()
    assert tuple(out) == ("2025-01-01 10:00:00.12+00", "2025-01-01 10:00:00", "100.50", "t", "\\x01ab")


def test_names_and_positions(spark):
    row = spark.sql("select 'orders' a, 'Public.orders' b, 'app.x' c, '16/B374D848' p, array('a','b') l, '' e").first
    df = spark.sql("select 'orders' a, 'Public.orders' b, 'app.x' c, '16/B374D848' p, array('a','b') l, '' e")
    out = df.select(N.qualified(F.col("a")), N.qualified(F.col("b")), N.lake_name(F.col("c")), C.lsn(F.col("p")),
                    N.unchanged_csv(F.col("l")), F.size(N.unchanged_array(F.col("e")))).first()
    assert tuple(out) == ("public.orders", "public.orders", "x", (0x16 << 32) + 0xB374D848, "a,b", 0)
    assert df.select(C.lsn_text(C.lsn(F.col("p")))).first()[0] == "16/B374D848"
    assert row()


def test_key_change_emits_delete(spark):
    spec = TableSpec.of("t", [("id", "integer", False), ("v", "text")], pk=["id"])
    rows = [dml(spec, "U", {"id": "2", "v": "x"}, before={"id": "1", "v": "x"}, pos=5),
            dml(spec, "U", {"id": "3", "v": "y"}, before={"id": "3", "v": "x"}, pos=6)]
    got = to_events(feed(spark, rows), spec).select("_op", "_seq", "id", "v").collect()
    assert sorted(map(tuple, got), key=repr) == [("D", 5, 1, None), ("U", 5, 2, "x"), ("U", 6, 3, "y")]


def test_relational_helpers(spark):
    assert snapshot_options("jdbc:x", "orders", "id", 0, 100, 8)["numPartitions"] == "8"
    assert "partitionColumn" not in snapshot_options("jdbc:x", "orders")
    assert "table_schema = 'app'" in columns_query("app.orders")
    cols = spark.createDataFrame(
        [("b", "integer", False, 2, 1), ("a", "text", True, 1, None), ("c", "integer", False, 3, 2)],
        "column_name string, data_type string, nullable boolean, ord int, key_ord int")
    spec = discover(cols, "app.orders")
    assert (spec.name, spec.columns, spec.pk) == ("app.orders", ["a", "b", "c"], ("b", "c"))
    assert discover(cols, "app.orders", pk=["a"]).pk == ("a",)


def test_position_ranges_hold_even_counts_whatever_the_gaps(spark):
    from millrace.operators.spread import with_range

    df = spark.range(100_000).select(F.when(F.col("id") < 10, F.lit(0)).otherwise(F.col("id") + 10**15).cast("bigint").alias("p"))
    cut = with_range(df, df, "p", "r")
    assert cut.groupBy("r").count().agg(F.max("count")).first()[0] < 5_000
    rows = [(r.p, r.r) for r in cut.orderBy("p").collect()]
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]))
    empty = df.limit(0)
    assert with_range(empty, empty, "p").count() == 0
