"""Slices cost what they hold: their own files, and a token only where it is needed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from keygroup import MD5_60, XXHASH_64, KeyedTable, read_slice, with_token
from keygroup.operators.backfill import Backfill


def test_a_resumed_run_reads_the_files_of_its_slices(spark, tmp_path, monkeypatch):
    lines = spark.range(4_000).select((F.col("id") % 1_500).alias("l_orderkey"), F.col("id").alias("l_partkey"))
    lines = lines.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 100 > 0, F.col("l_orderkey")))
    columns = "l_linestatus string, l_linenumber int, l_suppkey bigint, l_shipdate timestamp, l_quantity double, l_extendedprice double"
    others = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")]
    lines.select("*", *others).write.parquet(str(tmp_path / "lineitem.parquet"))
    read = []
    run = Backfill.run

    def counted(self, work, most=None):
        def kept(index, low, high):
            frame = work(index, low, high)
            scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", frame._jdf.queryExecution().executedPlan().toString())
            read.append((index, [set(map(int, re.findall(r"(?:=|<=|>=|IN) \(?([0-9]+)", scan))) for scan in scans]))
            return frame

        return run(self, kept, most)

    monkeypatch.setattr(Backfill, "run", counted)
    got = {r.slice: tuple(r)[1:] for r in entry.q_slice_resume(spark, str(tmp_path)).collect()}
    keyed = KeyedTable.of(lines.withColumnRenamed("l_orderkey", "orderkey"), "orderkey")
    placed = with_token(keyed, MD5_60).groupBy(MD5_60.slice_of("_token", 16).alias("slice"))
    expected = placed.agg(F.count("*"), F.sum("orderkey"), F.sum("l_partkey")).collect()
    assert got == {r.slice: tuple(r)[1:] for r in expected} and len(read) == 16
    # Every slice has one scan, of its own folder.
    assert read == [(i, [{i}]) for i in range(16)]


@pytest.mark.parametrize("tokenizer", [MD5_60, XXHASH_64])
def test_a_slice_holds_the_tokens_between_its_ends(spark, tokenizer):
    df = spark.range(3_000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), (F.col("id") % 3).alias("j"))
    for key in ("k", ["k", "j"]):
        table = KeyedTable.of(df, key)
        tokens = sorted(r[0] for r in with_token(table, tokenizer).select("_token").collect())
        mid, step = tokens[1_500], 1 << tokenizer.bits - 9
        ends = [*tokenizer.bounds(16)[:2], tokenizer.bounds(7)[3], (mid, mid), (mid, mid + step), (mid + 1, mid)]
        ends += [(tokenizer.low, tokenizer.low), (tokenizer.low, tokenizer.high), (-(1 << 63), (1 << 63) - 1)]
        for low, high in ends:
            found = sorted(r[0] for r in read_slice(table, low, high, tokenizer).select("_token").collect())
            assert found == [t for t in tokens if low <= t <= high]
