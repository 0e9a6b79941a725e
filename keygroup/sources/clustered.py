"""A table stored in buckets of its partition key, to be grouped without a shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from keygroup.names import quoted
from keygroup.sources.tables import KeyedTable, declare_keys


def write_clustered(table: KeyedTable, name: str, buckets: int, path: str | None = None) -> KeyedTable:
    """Save ``table`` as the relation ``name``, bucketed and sorted by its key.

    A job whose tables all have the same number of buckets reads its groups where
    they lie. Rows are brought together by bucket before they are written, so that
    a bucket has few files; one swollen by a hot key is spread over several writers.
    """
    key = [quoted(c) for c in table.partition_key]
    bucketed = table.rows.withColumn("_bucket", F.pmod(F.hash(*key), F.lit(buckets)))
    writer = bucketed.hint("rebalance", F.col("_bucket")).drop("_bucket").write.format("parquet")
    writer = writer.bucketBy(buckets, *table.partition_key).sortBy(*table.partition_key, *table.clustering)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    # The keys go into the catalog, so that other sessions need only the name.
    return declare_keys(
        table.df.sparkSession, name, table.partition_key, table.clustering, table.unique, table.require_keys
    )
