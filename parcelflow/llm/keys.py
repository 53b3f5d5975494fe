"""Joins and components on keys, made for texts too large to move and groups too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.session import stored

#: Bits, at most, of the filter that keeps texts from being moved to a join that would drop them.
FILTER_BITS = 27


def bits_of(hashes: DataFrame, name: str, most: int = FILTER_BITS) -> tuple[DataFrame, int]:
    """Filter over a long column of well-mixed hashes: blocks of 32768 bits (_block, _bits), and the filter's size in bits.

    The top bits of a hash are its place. 16 bits a hash, 2^``most`` bits at most, so the filter's size is bounded.
    """
    bits = min(most, max(16, (16 * max(hashes.count(), 1)).bit_length()))
    place = F.shiftrightunsigned(name, 64 - bits)
    blocks = hashes.select(place.alias("_place")).groupBy(F.shiftright("_place", 15).alias("_block"))
    return blocks.agg(F.bitmap_construct_agg(F.col("_place").bitwiseAND(F.lit(32767))).alias("_bits")), bits


def guessed(rows: DataFrame, keys: DataFrame, key: str, name: str = "_maybe") -> DataFrame:
    """Add whether a row's key may be among ``keys``: never false for one that is, and seldom true for others."""
    blocks, bits = bits_of(keys.select(F.xxhash64(key).alias("_hash")), "_hash")
    marked = rows.withColumn("_place", F.shiftrightunsigned(F.xxhash64(key), 64 - bits)).withColumn("_block", F.shiftright("_place", 15))
    marked = marked.join(F.broadcast(blocks), "_block", "left")  # at most 2^FILTER_BITS / 8 bytes
    byte = "ascii(decode(substring(_bits, cast((_place & 32767) >> 3 as int) + 1, 1), 'ISO-8859-1'))"
    return marked.withColumn(name, F.coalesce(F.expr(f"({byte} >> cast(_place & 7 as int)) & 1 = 1"), F.lit(False))).drop("_block", "_bits", "_place")


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among ``keys``: all that are, and few others. It saves moving rows that a join would drop."""
    return guessed(rows, keys, key).where("_maybe").drop("_maybe")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Root of every node of (a, b) edges: node, root. The root is the smallest node of its component.

    Every node that has a smaller neighbour hooks to its smallest; chains are halved until all point to a root;
    edges move to the roots, and those between different roots go again. Only ids are moved, and each step is a table.
    """
    roots, edges = None, stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), label)
    while not edges.isEmpty():
        parents = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), label)
        while True:
            upper = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            hopped = parents.join(upper, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
            hopped = stored(hopped, label)
            parents = hopped.select("node", "root")
            if hopped.where("moved").isEmpty():
                break
        if roots is None:
            roots = parents
        else:  # nodes below an old root follow it; new roots' own rows are added
            upper = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = roots.join(upper, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            roots = stored(moved.unionByName(parents), label)
        at = parents.select(F.col("node"), F.col("root").alias("r"))
        for side in ("a", "b"):
            edges = edges.join(at.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("r", side)).drop("r")
        edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), label)
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
