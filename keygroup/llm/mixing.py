"""Mixing sources to target weights by weighted fair queueing.

Every source shuffles its documents by a keyed hash and reads them in that order,
again and again. A document gets a virtual finish time: the words its source has read
when it ends, divided by the source's target. All reads of all sources are sorted by
that time and taken until the total budget is used up, so that at any cut each source
has had its share, to within a document.

Within a source the time grows with the shuffled order, so the outcome is fully told
by one hash per source and pass: the last one taken. Documents are then marked in a
second scan by comparison with these, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keygroup.llm.common import others, picked
from keygroup.names import quoted
from keygroup.workspace import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
# A source is read at most so often; its target is bounded by as many times its size.
PASSES = 2
MAX_SOURCES = 1_000_000
BROADCAST_SOURCES = 20_000
WORD = r"[^\x20\x09-\x0D]+"
# Virtual time is cut into so many buckets a unit; beyond four units there is one.
TIME_BUCKETS = 65_536
ADDED = ("size", "source_size", "target", "copies")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def shuffled(seed: str, doc_id: Column, text: Column) -> Column:
    """The keyed hash by which a source orders its documents."""
    missing = F.lit("")
    return F.md5(
        F.concat(
            F.lit(f"{seed}|"),
            F.coalesce(doc_id.cast("string"), missing),
            F.lit("|"),
            F.coalesce(F.md5(F.encode(text, "utf-8")), missing),
        )
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per ``source`` with its ``source_size``.

    The budget, ``share`` of all sizes, is split by weight; a source keeps no more than
    ``PASSES`` times its size, and the excess goes to the others by weight until none is
    above. That is a common level: a target is the smaller of its bound and the level
    times its weight. Sources that reach their bound are those with the least bound per
    unit of weight, so one pass in that order finds the level.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % n + 1).cast("int")
    )
    bound = F.col("source_size").cast("double") * F.lit(float(PASSES))
    ranked = sizes.withColumn("weight", weight).withColumn("bound", bound)
    order = everything.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything).cast("double") * F.lit(share)
    level = (budget - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    fits = F.when(level * F.col("weight") <= F.col("bound"), level)
    levelled = ranked.withColumn("fits", fits).withColumn("level", F.max("fits").over(everything))
    target = F.least("bound", F.coalesce(F.col("level") * F.col("weight"), F.col("bound")))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def _queued(rows: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """Reads of all documents with words, with their finish times, and the sources."""
    narrow = materialise(
        rows.select("source", n_words(F.col("text")).alias("size"), shuffled(seed, F.col("doc_id"), F.col("text")).alias("h")),
        "mix-sizes",
    )
    by_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    if by_source.count() > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    sources = materialise(targets(by_source), "mix-targets")

    # Running sums in two steps, so that a source with a third of all rows is summed
    # by as many tasks as it has hash buckets.
    sized = narrow.where("size > 0").withColumn("part", F.substring("h", 1, 3))
    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("source").alias("of"), F.col("part").alias("at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    # Rows with one hash are one text under one id; the default frame sums them together.
    inside = Window.partitionBy("source", "part").orderBy("h")
    summed = sized.withColumn("inner", F.sum("size").over(inside))
    read = (
        summed.join(parts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
        .select("source", "size", "h", (F.col("base") + F.col("inner")).alias("until"))
    )
    known = sources.select(F.col("source").alias("of"), "source_size", "target")
    timed = (
        read.join(F.broadcast(known) if known.count() <= BROADCAST_SOURCES else known, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("epoch", F.explode(F.array(*(F.lit(e) for e in range(PASSES)))))
        .withColumn("time", (F.col("epoch") * F.col("source_size") + F.col("until")).cast("double") / F.col("target"))
        .withColumn("slot", F.least(F.floor(F.col("time") * TIME_BUCKETS), F.lit(4 * TIME_BUCKETS).cast("bigint")))
        .select("source", "size", "h", "epoch", "time", "slot")
    )
    return materialise(timed, "mix-times"), sources


def cuts(rows: DataFrame, seed: str = "mix", share: float = SHARE) -> DataFrame:
    """Per source: ``source_size``, ``target`` and, per pass, the last hash that is taken."""
    timed, sources = _queued(rows, seed)
    budget = sources.agg(F.sum("source_size")).first()[0]
    budget = float(budget or 0) * share
    slots = timed.groupBy("slot").agg(F.sum("size").alias("n"))
    running = F.sum("n").over(Window.partitionBy().orderBy("slot"))
    full = slots.select("slot", "n", running.alias("until")).where(F.col("until") > budget)
    last = full.orderBy("slot").select("slot", (F.col("until") - F.col("n")).alias("before")).first()
    if last is None:
        taken = timed
    else:
        # Only the slot in which the budget runs out has to be looked at read by read.
        order = Window.partitionBy().orderBy("time", F.col("source").asc_nulls_last(), "h", "epoch")
        edge = (
            timed.where(F.col("slot") == last["slot"])
            .withColumn("until", F.sum("size").over(order) + last["before"])
            .where(F.col("until") <= budget)
            .drop("until")
        )
        taken = timed.where(F.col("slot") < last["slot"]).unionByName(edge)
    per_pass = taken.groupBy(F.col("source").alias("of")).agg(
        *(F.max(F.when(F.col("epoch") == e, F.col("h"))).alias(f"cut{e}") for e in range(PASSES))
    )
    joined = sources.join(per_pass, F.col("source").eqNullSafe(F.col("of")), "left")
    return materialise(
        joined.select("source", "source_size", "target", *(f"cut{e}" for e in range(PASSES))), "mix-cuts"
    )


def mix(
    df: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", seed: str = "mix"
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``copies``.

    ``size`` counts the words of the text (null: 0), ``copies`` how often the mix takes
    the row. Sources by code point, null last, weigh ``WEIGHTS`` in turn. Rows that agree
    in id, source and text are taken alike; rows without words are taken with the
    documents around them and weigh nothing. A null source is a source. An empty table
    gives no rows, a source without words no copies. Input columns with the names of the
    added ones, in any case, are replaced. The outcome depends on the rows and ``seed`` alone.
    """
    keep = others(df, ADDED)
    wide = df.select(
        *(F.col(quoted(c)) for c in keep),
        F.col(quoted(source_column)).alias("_mix_source"),
        n_words(F.col(quoted(text_column))).alias("size"),
        shuffled(seed, F.col(quoted(id_column)), F.col(quoted(text_column))).alias("_mix_h"),
    )
    found = cuts(picked(df, doc_id=id_column, source=source_column, text=text_column), seed)
    found = found.withColumnRenamed("source", "_mix_of")
    if found.count() <= BROADCAST_SOURCES:
        found = F.broadcast(found)
    joined = wide.join(found, F.col("_mix_source").eqNullSafe(F.col("_mix_of")))
    copies = sum(
        (F.coalesce((F.col("_mix_h") <= F.col(f"cut{e}")).cast("int"), F.lit(0)) for e in range(PASSES)), F.lit(0)
    )
    return joined.select(*(F.col(quoted(c)) for c in keep), "size", "source_size", "target", copies.alias("copies"))


MIX_SQL = r"""
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
               md5(concat('mix|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(md5(text), ''))) AS h
        FROM documents
    ), s AS (
        SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight,
               source_size * 2.0::DOUBLE AS bound
        FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
    ), l AS (
        SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM s WINDOW o AS (ORDER BY bound / weight, source NULLS LAST)
    ), t AS (
        SELECT source, source_size,
               least(bound, coalesce((SELECT max(level) FROM l WHERE level * weight <= bound) * weight, bound)) AS target
        FROM s
    ), r AS (
        SELECT d.doc_id, d.source, d.size, d.h, e.epoch,
               CAST(e.epoch * t.source_size + sum(d.size) OVER (PARTITION BY d.source, e.epoch ORDER BY d.h) AS DOUBLE) / t.target AS time
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS epoch) e
        WHERE d.size > 0
    ), q AS (
        SELECT *, sum(size) OVER (ORDER BY time, source NULLS LAST, h, epoch) AS until FROM r
    ), k AS (
        SELECT source, h, count(*) AS copies FROM q
        WHERE until <= (SELECT sum(size) * 1.5::DOUBLE FROM d)
        GROUP BY source, h
    )
    SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, t.source_size, t.target,
           CAST(d.size * coalesce(k.copies, 0) AS BIGINT) AS taken
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""
