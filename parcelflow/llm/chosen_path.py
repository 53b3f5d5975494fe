"""Near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets are one class. Each class walks random trees on its own: at every level a path
goes on with those tokens of the set whose hash together with the path is small, so similar sets reach common
nodes. First each class tries two leaders of some of its nodes, one pair a class, which joins most of a family. Then
small nodes are compared exhaustively (by size and by sketches). Classes of larger nodes are joined by the rare
tokens of their sets, which loses no pair. What remains is confirmed on full sets, best pairs first. Classes that
are connected already are never compared, so the pairs of a large family aren't emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.llm.keys import components, likely
from parcelflow.session import discard, stored

#: Percent of the union that two sets must share.
SIMILAR = 80
#: Independent trees. A pair just at the limit meets in one with chance 0.31 at DEPTH, so all miss it once in 8000.
TREES = 24
#: Levels walked before nodes are compared. Classes of nodes with more than SMALL are joined by rare tokens.
DEPTH = 4
SMALL = 32
#: A token that more than SMALL classes share compares each class with this many before it, in order of set size;
#: once these are linked, all its classes that are still apart are compared, so many at a time.
NEIGHBOURS = 8
BLOCK = 1024
#: Counters of the order of tokens. Any order gives the same pairs; one by frequency compares the fewest.
ORDER_BITS = 18
#: Pairs are confirmed by their sets alone where the smaller has fewer tokens than this: one token then owns many bins.
SKETCH_TOKENS = 200
SKETCH_BITS = 128
#: Bytes of the parity part of a sketch, which stands before the bins.
PARITY = 16
#: Rounds in which classes try the leaders of one in LED of their nodes, before any nodes are compared.
ROUNDS = 2
LED = 8

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_POPCOUNT = np.array([bin(k).count("1") for k in range(256)], dtype=np.uint8)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other, and where each text's begin."""
    starts, ends, firsts = kernel.words(data, offsets)
    hashes = kernel.word_hashes(data, starts, ends, lower=True)
    grams, whole = kernel.shingles(hashes, firsts, width)
    sizes = np.diff(firsts)
    for k in np.flatnonzero((sizes > 0) & (sizes < width)):  # the whole sequence is one shingle
        value = np.uint64(sizes[k])
        for x in hashes[firsts[k] : firsts[k + 1]]:
            value = kernel.mix(np.array([value ^ x]))[0]
        grams[firsts[k]], whole[firsts[k]] = value, True
    text = kernel.text_index(firsts)[whole]
    grams = grams[whole]
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    text, grams = text[fresh], grams[fresh]
    return grams, np.searchsorted(text, np.arange(len(sizes) + 1))


def extend(paths: np.ndarray, tokens: np.ndarray, levels: int) -> np.ndarray:
    """Paths ``levels`` further: each goes on with every token chosen after it, on average 1 / 0.8 of them."""
    limit = np.uint64(min(int(2.0**64 / (SIMILAR / 100 * len(tokens))), 2**64 - 1))
    for _ in range(levels):
        chosen = ((paths[:, None] ^ tokens[None, :]) * _STEP) <= limit
        row, column = np.nonzero(chosen)
        paths = kernel.mix(paths[row] * _ODD + tokens[column])
        if not len(paths):
            break
    return np.unique(paths)


_ROOTS = kernel.mix(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def sketch(tokens: np.ndarray) -> bytes:
    """PARITY bytes of parities, then one bit per bin.

    A parity tells whether an odd number of tokens falls to its place. A bin's bit comes from the smallest token that
    falls into it; an empty bin takes the next filled one's.
    """
    places = (kernel.mix(tokens ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(57)).astype(np.int64)
    odd = np.packbits((np.bincount(places, minlength=8 * PARITY) & 1).astype(np.uint8))
    mixed = kernel.mix(tokens ^ np.uint64(0x1B873593CC9E2D51))
    bins = (mixed >> np.uint64(57)).astype(np.int64)
    least = np.full(SKETCH_BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bins, mixed & np.uint64((1 << 57) - 1))
    filled = np.flatnonzero(least != np.iinfo(np.uint64).max)
    source = filled[np.searchsorted(filled, np.arange(SKETCH_BITS)) % len(filled)]
    value = kernel.mix(least[source] + (np.arange(SKETCH_BITS) - source).astype(np.uint64) * _ODD)
    return odd.tobytes() + np.packbits((value & np.uint64(1)).astype(np.uint8)).tobytes()


def least_by_sketch(n: np.ndarray) -> np.ndarray:
    """Least similarity by sketch where the smaller set has n tokens: six standard deviations under the limit."""
    share = SIMILAR / 100
    spread = np.sqrt((1 - share) * (1 + share) / SKETCH_BITS + 0.12 / np.maximum(n, 1))  # of bins, and of the tokens in them
    return np.where(n < SKETCH_TOKENS, -1.0, share - 6 * spread)


def alike(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Which sets of n and m tokens with sketches x and y (rows of bytes) may be similar, and how similar they look.

    Parities differ in no more places than the sets have tokens that only one of them holds, so they never lose a pair;
    bins may at six standard deviations.
    """
    differ = _POPCOUNT[x ^ y].astype(np.int64)
    odd, bins = differ[:, :PARITY].sum(axis=1), differ[:, PARITY:].sum(axis=1)
    total, smaller, share = n + m, np.minimum(n, m), 1 - 2 * bins / SKETCH_BITS
    may = (odd * (100 + SIMILAR) <= total * (100 - SIMILAR)) & (share >= least_by_sketch(smaller))
    return may, np.where(smaller < SKETCH_TOKENS, (total - odd) / (total + odd), share)


def _bytes(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), -1)


def class_of(tokens: np.ndarray) -> bytes:
    """128-bit name of a set."""
    a, b = kernel.mix(tokens), kernel.mix(tokens + _ODD)
    return b"".join(int(x.sum(dtype=np.uint64)).to_bytes(8, "big") for x in (a, b * np.uint64(len(tokens) * 2 + 1)))


def classed(docs: DataFrame, text: str = "text", width: int = 2) -> DataFrame:
    """Other columns of ``docs`` with n, class (null for an empty set), sketch and nodes (path keys at DEPTH)."""

    def build():
        def work(data: np.ndarray, offsets: np.ndarray) -> list:
            grams, begins = shingle_sets(data, offsets, width)
            names, sketches, nodes = [], [], []
            for x, y in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                own = grams[x:y]
                names.append(class_of(own) if y > x else None)
                sketches.append(sketch(own) if y > x else None)
                nodes.append(extend(_ROOTS, own, DEPTH).view(np.int64) if y > x else None)
            return [np.diff(begins).astype(np.int64), pa.array(names, pa.binary()), pa.array(sketches, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))]

        return work

    return kernel.map_texts(docs, build, "n long, class binary, sketch binary, nodes array<long>", text)


_MET = "node long, a binary, b binary, similarity float, n long, sketch binary, group long"


def _compare(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rows (node, n, class, sketch, group) in order of node and n: pairs of small nodes, and the rows of large ones.

    Classes of one group are connected already. Holds SMALL rows of a node at most. ``last``: rows of large nodes are paired with NEIGHBOURS before them instead.
    """
    types = [pa.int64(), pa.binary(), pa.binary(), pa.float32(), pa.int64(), pa.binary(), pa.int64()]
    names = ["node", "a", "b", "similarity", "n", "sketch", "group"]
    node, held, large = None, [], False
    out: list[tuple] = []

    def pairs(left: list[tuple], right: tuple) -> None:
        fits = [x for x in left if x[3] != right[3] and x[0] * 100 >= SIMILAR * right[0] and right[0] * 100 >= SIMILAR * x[0]]
        if not fits:
            return
        may, similarity = alike(_bytes([x[2] for x in fits]), np.frombuffer(right[2], dtype=np.uint8), np.array([x[0] for x in fits]), right[0])
        for k in np.flatnonzero(may).tolist():
            a, b = sorted((fits[k][1], right[1]))
            out.append((node, a, b, float(similarity[k]), None, None, None))

    def close() -> None:
        if not large:
            for k in range(1, len(held)):
                pairs(held[:k], held[k])

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for key, n, name, bits, group in zip(*columns, strict=True):
            row = (n, name, bits, group)
            if key != node:
                close()
                node, held, large = key, [], False
            if not large and len(held) == SMALL:
                large = True
                if last:
                    for k in range(1, len(held)):
                        pairs(held[max(0, k - NEIGHBOURS) : k], held[k])
                    held = held[-NEIGHBOURS:]
                else:
                    out += [(node, x[1], None, None, x[0], x[2], x[3]) for x in held]
                    held = []
            if not large:
                held.append(row)
            elif last:
                pairs(held, row)
                held = [*held[-NEIGHBOURS + 1 :], row]
            else:
                out.append((node, name, None, None, n, bits, group))
        if len(out) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _meet(nodes: DataFrame, last: bool) -> DataFrame:
    rows = nodes.select("node", "n", "class", "sketch", "group").repartition("node").sortWithinPartitions("node", "n", "class")
    return rows.mapInArrow(lambda batches: _compare(batches, last), _MET)


def _token_counts(sets: DataFrame, width: int = 2) -> np.ndarray:
    """How often tokens of each of 2^ORDER_BITS buckets occur in (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ORDER_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in kernel.chunks(batch.column(0)):
                grams, _ = shingle_sets(data, offsets, width)
                counts += np.bincount((grams >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(counts))
        places = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(counts[places])], names=["place", "n"])

    found = sets.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, dtype=np.int64)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out


def prefixes(sets: DataFrame, width: int = 2) -> DataFrame:
    """(node, n, class, sketch, group, rare): the rarest tokens of each set of (class, n, sketch, group, text).

    A similar pair shares 4/9 of the sum of its sizes at least. In one order of all tokens, a token that both share
    is then among the first n/5 (and one) of the larger set and the first n/9 (and one) of the smaller: ``rare``.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_token_counts(sets, width))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for i, j, data, offsets in kernel.chunks(batch.column(0)):
                grams, begins = shingle_sets(data, offsets, width)
                often = counts[(grams >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                owner = kernel.text_index(begins)
                order = np.lexsort((grams, often, owner))
                grams, n = grams[order], np.diff(begins)[owner]
                place = np.arange(len(grams)) - begins[:-1][owner]
                # least overlaps, rounded up: SIMILAR of the larger set, and of two sets of the smaller one's size
                taken = place <= n - -(-n * SIMILAR // 100)
                rare = place <= n - -(-2 * n * SIMILAR // (100 + SIMILAR))
                take = pa.array(owner[taken] + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[taken].view(np.int64)), *(batch.column(c).take(take) for c in (2, 1, 3, 4)), pa.array(rare[taken])],
                    names=["node", "n", "class", "sketch", "group", "rare"],
                )

    return sets.select("text", "class", "n", "sketch", "group").mapInArrow(run, "node long, n long, class binary, sketch binary, group long, rare boolean")


def candidates(reps: DataFrame, texts_of, width: int = 2) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of classes (a < b) that may be similar, with the sketch's similarity; and rare tokens of classes in large nodes.

    ``reps``: one row per class with n, sketch, group and nodes. ``texts_of`` gives (class, text) for a table of classes.
    """
    first = stored(_meet(reps.select("class", "n", "sketch", "group", F.explode("nodes").alias("node")), False), "met")
    pairs, tokens = first.where("b is not null").select("a", "b", "similarity"), None
    large = first.where("b is null")
    if not large.isEmpty():
        again = stored(large.groupBy(F.col("a").alias("class")).agg(*(F.first(c).alias(c) for c in ("n", "sketch", "group"))), "large")
        tokens = stored(prefixes(stored(texts_of(again.select("class")).join(again, "class"), "texts"), width), "tokens")
        pairs = pairs.unionByName(_meet(tokens, True).select("a", "b", "similarity"))
    return stored(pairs.groupBy("a", "b").agg(F.max("similarity").alias("similarity")), "pairs"), tokens


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows (cell, right, n, class, sketch, root) in order of cell and right: each left row with each right row of its cell.

    Holds the left rows of a cell, about BLOCK; they are not larger than their partners.
    """
    cell, left, ready = None, [], None
    for batch in batches:
        out: list[tuple] = []
        for key, right, n, name, bits, root in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if key != cell:
                cell, left, ready = key, [], None
            if not right:
                left.append((n, name, bits, root))
                continue
            if not left:
                continue
            if ready is None:
                roots = {x[3]: k for k, x in enumerate(left)}
                sizes = np.array([x[0] for x in left])
                sketches = _bytes([x[2] for x in left])
                ready = roots, np.array([roots[x[3]] for x in left]), sizes, sketches
            roots, own, sizes, sketches = ready
            near = np.flatnonzero((sizes <= n) & (sizes * 100 >= SIMILAR * n) & (own != roots.get(root, -1)))
            if len(near):
                may, _ = alike(sketches[near], np.frombuffer(bits, dtype=np.uint8), sizes[near], n)
                for k in near[may].tolist():
                    out.append((min(left[k][1], name), max(left[k][1], name)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*set(out), strict=True)], names=["a", "b"])


def apart(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that share a token of more than SMALL classes and have different roots.

    A token's rare rows and all its rows are dealt into blocks, and each two blocks meet in a cell of their own.
    """
    at = roots.select(F.col("node").alias("class"), "root")
    often = stored(tokens.groupBy("node").agg(F.count("*").alias("rows"), F.count_if("rare").alias("lefts")).where(f"rows > {SMALL} and lefts > 0"), "often")
    placed = likely(tokens, often.select("node"), "node").join(often, "node").join(at, "class", "left").withColumn("root", F.coalesce("root", "class"))
    placed = stored(placed, "placed")
    mixed = placed.groupBy("node").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("node")
    rows = placed.join(mixed, "node")
    lefts, rights = F.ceil(F.col("lefts") / BLOCK), F.ceil(F.col("rows") / (8 * BLOCK))
    salt = F.xxhash64("class", F.lit(3))

    def dealt(rows: DataFrame, right: int, own: Column, others: Column) -> DataFrame:
        both = rows.withColumn("_own", F.pmod(salt, own)).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
        x, y = ("_other", "_own") if right else ("_own", "_other")
        return both.select(F.xxhash64("node", x, y).alias("cell"), F.lit(right).alias("right"), "n", "class", "sketch", "root")

    cells = dealt(rows.where("rare"), 0, lefts, rights).unionByName(dealt(rows, 1, rights, lefts))
    return cells.repartition("cell").sortWithinPartitions("cell", "right").mapInArrow(_across, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("tokens").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared * 100 >= (F.size("x") + F.size("y") - shared) * SIMILAR).select("a", "b")


def set_rows(texts: DataFrame, width: int = 2) -> DataFrame:
    """(class, tokens) of (class, text)."""

    def build():
        def work(data: np.ndarray, offsets: np.ndarray) -> list:
            grams, begins = shingle_sets(data, offsets, width)
            return [pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(grams.view(np.int64)))]

        return work

    return kernel.map_texts(texts, build, "tokens array<long>")


def _grouped(reps: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Add group, a hash of each class's root."""
    if roots is None:
        return reps.withColumn("group", F.xxhash64("class"))
    at = roots.select(F.col("node").alias("class"), "root")
    return reps.join(at, "class", "left").withColumn("group", F.xxhash64(F.coalesce("root", "class"))).drop("root")


def _likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n, m, x, y): those whose sketches x and y are alike, with the similarity."""
    for batch in batches:
        if batch.num_rows:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            may, similarity = alike(*(_bytes(batch.column(k).to_pylist()) for k in (4, 5)), n, m)
            take = pa.array(np.flatnonzero(may))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(similarity[may].astype(np.float32))], names=["a", "b", "similarity"]
            )


def led(reps: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of each class with the most similar leader of its nodes: one pair a class at most.

    A node's leaders are its first and last class by a hash that differs from node to node; round ``number`` takes one in
    LED of the nodes.
    """
    rows = reps.withColumn("node", F.explode("nodes")).where(F.pmod("node", F.lit(LED)) == number).select("node", "class", "n", "sketch", "group")
    one = F.struct(F.xxhash64("node", "class").alias("place"), "class", "n", "sketch", "group")
    leaders = rows.groupBy("node").agg(F.min(one).alias("x"), F.max(one).alias("y")).where("x.class <> y.class")
    tried = rows.join(leaders.select("node", F.explode(F.array("x", "y")).alias("head")), "node")
    fits = (F.col("n") * 100 >= F.col("head.n") * SIMILAR) & (F.col("head.n") * 100 >= F.col("n") * SIMILAR) & (F.col("group") != F.col("head.group"))
    tried = tried.where(fits).select(F.col("class").alias("a"), F.col("head.class").alias("b"), "n", F.col("head.n").alias("m"), F.col("sketch").alias("x"), F.col("head.sketch").alias("y"))
    found = tried.mapInArrow(_likeness, "a binary, b binary, similarity float")
    return found.groupBy("a").agg(F.max(F.struct("similarity", "b")).alias("p")).select(F.least("a", "p.b").alias("a"), F.greatest("a", "p.b").alias("b")).distinct()


def join_classes(reps: DataFrame, texts_of, width: int = 2) -> DataFrame:
    """Root of every class that is linked with another: node, root."""
    links, roots = None, None
    for k in range(ROUNDS):
        pairs = stored(led(_grouped(reps, roots), k), "led")
        ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")
        sets = stored(set_rows(texts_of(ends), width), "sets")
        found = stored(confirmed(pairs, sets), "links")
        discard(sets)
        links = found if links is None else links.unionByName(found)
        roots = components(links)
    pairs, tokens = candidates(_grouped(reps, roots), texts_of, width)
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")
    sets = stored(set_rows(texts_of(ends), width), "sets")
    for final in (False, True):  # pairs that are connected already need no proof
        at, left = roots.select(F.col("node").alias("class"), "root"), pairs
        for side in ("a", "b"):
            left = left.join(at.select(F.col("class").alias(side), F.col("root").alias(f"r{side}")), side, "left").withColumn(f"r{side}", F.coalesce(f"r{side}", side))
        left = left.where("ra <> rb")
        if not final:  # the best pair of each component
            best = F.max(F.struct("similarity", "a", "b")).alias("p")
            left = left.groupBy(F.greatest("ra", "rb").alias("r")).agg(best).select("p.a", "p.b")
        links = links.unionByName(stored(confirmed(left.select("a", "b"), sets), "links"))
        roots = components(links)
    if tokens is not None:
        left = stored(apart(tokens, roots).join(pairs, ["a", "b"], "left_anti"), "apart")
        if not left.isEmpty():
            ends = stored(left.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")
            sets = stored(set_rows(texts_of(ends), width), "sets")
            roots = components(links.unionByName(stored(confirmed(left, sets), "links")))
    return roots


def near_duplicates(docs: DataFrame, width: int = 2) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, n_shingles, component_id, kept. Shingles have ``width`` words.

    Null, empty and word-less texts have an empty set and stay alone. Repeated rows are one class; of rows with
    equal ids all are kept or none. A null doc_id counts as the largest. An empty table gives no rows; other
    columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(classed(docs, width=width), "classed")
    known = rows.where("class is not null")
    firsts = known.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes"))
    reps = stored(firsts, "classes")

    def texts_of(classes: DataFrame) -> DataFrame:
        chosen = reps.select("class", "doc_id").join(classes, "class", "left_semi")
        return likely(docs, chosen, "doc_id").join(chosen, "doc_id").dropDuplicates(["class"]).select("class", "text")

    roots = join_classes(reps.select("class", "n", "sketch", "nodes"), texts_of, width)
    at = roots.select(F.col("node").alias("class"), "root")
    grouped = reps.select("class", "doc_id").join(at, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(least, "root").select("class", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "class").join(named, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def op9_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 2 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS g
  FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared.n >= {SIMILAR} * (x.n + y.n - shared.n)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, edge.b FROM reached JOIN edge ON reached.other = edge.a)
SELECT doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""
