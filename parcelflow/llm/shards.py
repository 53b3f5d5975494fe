"""Sharding by a Feistel permutation with cycle walking over global row numbers.

DataFrame functions only. The texts are read once; only keys, sizes and checksums are moved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import stored

#: Rounds of the permutation; an even number.
ROUNDS = 6


def feistel(number: Column, total: int, seed: int) -> Column:
    """Place of row ``number`` (0 to ``total`` - 1) in a reproducible shuffle of ``total`` rows.

    Two digits of a mixed base just above ``total`` take turns: each is moved by a keyed hash of the other, which
    is a permutation of all digit pairs. A result outside the rows is permuted again until it falls inside (cycle
    walking). Fewer than sqrt(total) pairs lie outside, so a walk of as many steps as there are pairs outside,
    or of 64 steps where those are more, always ends (a longer walk has a chance below 2^-384).
    """
    low = max(1, math.isqrt(max(total - 1, 0)) + 1)
    high = max(1, -(-total // low))
    outside = low * high - total

    def once(x: Column) -> Column:
        pair = F.struct((x % low).alias("a"), F.floor(x / low).cast("long").alias("b"))
        for k in range(0, ROUNDS, 2):
            pair = F.transform(
                F.array(pair),
                lambda p, k=k: F.struct(F.pmod(p.a + F.xxhash64(F.lit(seed), F.lit(k), p.b), F.lit(low)).alias("a"), p.b.alias("b")),
            )[0]
            pair = F.transform(
                F.array(pair),
                lambda p, k=k: F.struct(p.a.alias("a"), F.pmod(p.b + F.xxhash64(F.lit(seed), F.lit(k + 1), p.a), F.lit(high)).alias("b")),
            )[0]
        return F.transform(F.array(pair), lambda p: p.b * low + p.a)[0]

    walk = F.sequence(F.lit(0), F.lit(min(outside, 64)))
    return F.aggregate(walk, number, lambda x, k: F.when((k == 0) | (x >= total), once(x)).otherwise(x))


def numbered(rows: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Add global row numbers 0, 1, ... in the order of the columns, without a window over all rows.

    Range partitions are sorted, then each adds the count of those before it; there is one count per
    partition, so that table stays small. Fully equal rows get numbers in any order.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", 33)
    counts = [(r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect()]  # one row per partition
    before, base = [], 0
    for p, n in sorted(counts):
        before.append((p, base))
        base += n
    starts = spark.createDataFrame(before or [(0, 0)], "_part long, _before long")
    local = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # bounded by the number of partitions
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_place", "_before")
    )


def shard(docs: DataFrame, shards: int = 24, seed: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: size, text_crc32, law, shard, slot and grown_shard.

    The law is ``rows``: the permuted number p of a row gives shard ``p mod shards`` and slot ``p div shards``, so
    counts differ by one at most, slots have no gaps, and both can be computed from the row's number in key
    order. Null text: size 8 and checksum 0. Null keys come first in the order. Repeated rows are rows of their own.
    Empty table: no rows. Other columns are ignored. grown_shard is null, as another shard moves rows everywhere.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = numbered(rows, ["doc_id", "text_crc32", "size"])
    total = rows.count()
    place = feistel(F.col("row_number"), max(total, 1), seed)
    return rows.withColumn("_p", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_p") % shards).cast("int").alias("shard"),
        F.floor(F.col("_p") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard(spark.read.parquet(f"{folder}/documents.parquet"))
