"""Composite keys as bytes: the order of the bytes is the order of the keys."""

from __future__ import annotations

import random
import struct
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.functions.order import JAVA, SPARK, order_key

NAN = float("nan")
VALUES = {
    "boolean": [True, False],
    "tinyint": [-128, -1, 0, 1, 127],
    "int": [-(1 << 31), -1, 0, 5, (1 << 31) - 1],
    "bigint": [-(1 << 63), -10, -9, 0, 9, 10, 1 << 62, (1 << 63) - 1],
    "float": [-1.5, -0.0, 0.0, 2.0**-140, 3e38, float("inf"), float("-inf"), NAN],
    "double": [-1e308, -2.0, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1e308, float("inf"), float("-inf"), NAN],
    "decimal(38,0)": [Decimal(x) for x in (-(10**38) + 1, -1, 0, 1, 10**38 - 1)],
    "decimal(12,9)": [Decimal(x) for x in ("-999.999999999", "-0.000000001", "0", "0.000000001", "0.1", "999.999999999")],
    "decimal(9,9)": [Decimal(x) for x in ("-0.999999999", "0", "0.000000001", "0.1")],
    "string": ["", "a", "ab", "a\x00", "a\x00b", "a\x01", "Z", "é", "日本", "￮", "😀", "\x00", "\x00\x00", "~"],
    "binary": [bytearray(x) for x in (b"", b"\x00", b"\x00\x00", b"\x00\xff", b"\x7f", b"\x80", b"\x80\x00", b"\xff", b"a", b"a\x80", b"a\x7f")],
    "date": [date(1, 1, 1), date(1969, 12, 31), date(1970, 1, 1), date(2024, 2, 29)],
    "timestamp": [datetime(1960, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 5, 1, 1, 2, 3, 4)],
    "timestamp_ntz": [datetime(1960, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 31, 2, 30, 0, 4)],
}


@pytest.mark.parametrize("kind", VALUES)
def test_bytes_are_in_the_order_of_spark(spark, kind):
    """Among values of one type, and as either column of two."""
    rng = random.Random(2)
    values = [*VALUES[kind], None]
    rows = [(i, a, rng.choice(values)) for i, a in enumerate(values * 3)]
    df = spark.createDataFrame(rows, f"i int, `a.b` {kind}, c {kind}")
    key = order_key(["a.b", "c"], df.schema)
    by_columns = df.select("i", F.dense_rank().over(_window(F.col("`a.b`"), F.col("c"))).alias("n")).collect()
    by_bytes = df.select("i", F.dense_rank().over(_window(key)).alias("n")).collect()
    assert sorted(by_columns) == sorted(by_bytes)


def _window(*terms):
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1)).orderBy(*terms)


def test_keys_of_mixed_columns(spark):
    rng = random.Random(3)
    fields = {"s": "string", "d": "double", "b": "binary", "n": "decimal(12,9)", "t": "boolean", "l": "bigint"}
    rows = [tuple(rng.choice([*rng.sample(VALUES[kind], 2), None]) for kind in fields.values()) for _ in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in fields.items())).withColumn("i", F.monotonically_increasing_id())
    key = order_key(list(fields), df.schema)
    ranked = df.select(F.dense_rank().over(_window(*fields)).alias("x"), F.dense_rank().over(_window(key)).alias("y"))
    assert ranked.where("x <> y").count() == 0


def ranked_by_bytes(spark, values, kind, style, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", order_key(["v"], df.schema, style, **options).alias("k")).collect()
    return [values[r.i] for r in sorted(rows, key=lambda r: bytes(r.k))]


def test_the_order_of_java(spark):
    # Units of UTF-16, so that a pair of surrogates comes before U+FFEE.
    texts = VALUES["string"]
    assert ranked_by_bytes(spark, texts, "string", JAVA) == sorted(texts, key=lambda t: t.encode("utf-16-be"))
    assert ranked_by_bytes(spark, texts, "string", SPARK) == sorted(texts, key=lambda t: t.encode())
    assert ranked_by_bytes(spark, ["😀", "￮"], "string", JAVA) == ["😀", "￮"]
    # Signed bytes.
    every = [bytearray([a, b]) for a in (0, 1, 127, 128, 129, 255) for b in (0, 127, 128, 255)] + [bytearray([x]) for x in (0, 127, 128, 255)]
    signed = lambda v: [b - 256 if b > 127 else b for b in v]
    assert ranked_by_bytes(spark, every, "binary", JAVA) == sorted(every, key=signed)
    # Zeros apart, NaN last.
    numbers = ranked_by_bytes(spark, [NAN, 0.0, 1.0, -0.0, -1.0], "double", JAVA)
    assert [struct.pack(">d", x) for x in numbers[:4]] == [struct.pack(">d", x) for x in (-1.0, -0.0, 0.0, 1.0)]
    assert numbers[4] != numbers[4]
    # Both halves of a UUID as signed numbers.
    rng = random.Random(4)
    ids = [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(60)] + ["FFFFFFFF-0000-0000-8000-000000000000"]
    halves = lambda u: struct.unpack(">qq", uuid.UUID(u).bytes)
    assert ranked_by_bytes(spark, ids, "string", JAVA, uuids=["v"]) == sorted(ids, key=halves)


def test_what_has_no_order(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    with pytest.raises(ValueError, match="map"):
        order_key(["m"], df.schema)
    with pytest.raises(ValueError, match="style"):
        order_key(["k"], df.schema, "other")
    assert isinstance(df.select(order_key([], df.schema).alias("k")).schema["k"].dataType, T.BinaryType)
