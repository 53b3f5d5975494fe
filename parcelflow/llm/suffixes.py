"""Exact substring dedup by a sparse, range-partitioned suffix array.

Every ``length``-byte string holds one smallest substring of half that length, its anchor, wherever it occurs; so two
equal strings have equal anchors at the same offset. Suffixes start at anchors only, one in about a quarter of the
length. Those whose anchor occurs once can't repeat and are left out. The others are range-partitioned by
sampled splitters over their leading bytes, which keeps equal anchors together, and each partition sorts them by
multikey quicksort, to the right of the anchor and, reversed, to its left. Neighbours' common prefixes then tell, for
every string around an anchor, whether another one is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.llm.keys import bits_of, guessed, likely
from parcelflow.session import stored

LENGTH = 400
#: Leading bytes of a suffix by which partitions are split.
LEADING = 16
#: Suffixes of one anchor that a task sorts; strings around more frequent anchors are counted one by one instead.
LARGEST = 100_000
#: Suffixes sorted together, of however many anchors.
BATCH = 20_000
#: Bits, at most, of the filter of repeated anchors.
ANCHOR_BITS = 28

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = hashlib.sha256(b"").hexdigest()


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor positions, their hashes, the first and last start of the strings they belong to; and repeated spans.

    In periodic text each period has an anchor of its own. Where all strings of an anchor equal those a step before
    them, they are known to repeat: they are given as spans (begin, end), and the anchor is left out, as the one
    before stands for it.
    """
    half, none = length // 2, np.zeros(0, dtype=np.int64)
    nothing = (none, none.astype(np.uint64), none, none, none, none)
    n = len(data) - half + 1
    if n <= length - half:
        return nothing
    sums = kernel.prefix_sums(data)
    _, inverse = kernel._power_tables(len(data))
    hashes = (sums[half:] - sums[:n]) * inverse[:n]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _ODD
    hashes ^= hashes >> np.uint64(29)
    bits = max(int(n).bit_length(), 1)
    low = np.uint64((1 << bits) - 1)
    packed = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    # substrings across the end of a text are never the smallest
    ends = offsets[1:-1]
    if len(ends):
        across = np.zeros(n + 1, dtype=np.int32)
        np.add.at(across, np.clip(ends - half + 1, 0, n), 1)
        np.add.at(across, np.clip(ends, 0, n), -1)
        packed[np.cumsum(across[:-1]) > 0] |= ~low
    wide = length - half + 1
    blocks = -(-n // wide)
    padded = np.full(blocks * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = packed
    grid = padded.reshape(blocks, wide)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - wide + 1  # strings that lie in the data
    at = (np.minimum(backward[:starts], forward[wide - 1 : wide - 1 + starts]) & low).astype(np.int64)
    valid = np.zeros(starts + 1, dtype=np.int32)
    sizes = np.diff(offsets)
    long = sizes >= length
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[:-1][long] + sizes[long] - length + 1, -1)
    inside = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(inside):
        return nothing
    own = at[inside]
    # A run of strings with one anchor; strings of different texts never share one, as it lies in the text.
    head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    tail = np.append(head[1:], len(own)) - 1
    places, first, last = own[head], inside[head], inside[tail]
    # The smallest of many hashes has few leading bits left; mixed again, it can be placed by them.
    found = kernel.mix(hashes[places])
    step = np.diff(places)
    later = np.flatnonzero((found[1:] == found[:-1]) & (first[1:] - step >= offsets[np.searchsorted(offsets, places[1:], "right") - 1]) & (step > 0)) + 1
    step = step[later - 1]
    begin, end = first[later], last[later] + length
    equal = kernel.span_hashes(sums, begin, end) == kernel.span_hashes(sums, begin - step, end - step)
    later, begin, end = later[equal], begin[equal] - step[equal], end[equal]
    keep = np.ones(len(places), dtype=bool)
    keep[later] = False
    # Spans of neighbours overlap: one span for each stretch of one text.
    if len(begin):
        text = np.searchsorted(offsets, begin, "right") - 1
        reach = np.maximum.accumulate(end)
        fresh = np.concatenate(([True], (begin[1:] > reach[:-1]) | (text[1:] != text[:-1])))
        at = np.flatnonzero(fresh)
        begin, end = np.minimum.reduceat(begin, at), np.maximum.reduceat(end, at)
    return places[keep], found[keep], first[keep], last[keep], begin, end


def _long_texts(docs: DataFrame, length: int) -> DataFrame:
    body = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text")).where(F.octet_length("text") >= length)
    return rows.withColumn("content", F.xxhash64("text"))


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """Hashes of anchors at more than one place; copies of a whole text count as one place."""

    def build():
        def work(data: np.ndarray, offsets: np.ndarray) -> list:
            places, hashes, *_ = anchors(data, offsets, length)
            text = np.searchsorted(offsets, places, "right") - 1
            return [text, hashes.view(np.int64), (places - offsets[text]).astype(np.int64)]

        return work

    found = kernel.map_texts(_long_texts(docs, length).select("content", "text"), build, "anchor long, at long")
    place = F.xxhash64("content", "at")
    seen = found.groupBy("anchor").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    return stored(seen.where("least <> most").select("anchor"), "anchors")


_SUFFIX = "lead binary, anchor long, least int, most int, before binary, after binary, at long"


def suffixes(docs: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """Suffixes at anchors that may be repeated, with what the strings around them hold on either side.

    Columns: doc_id, content, lead, anchor, least and most (offsets of the anchor in its strings), before, after, at.
    Rows without lead are spans that are known to repeat already, from ``at`` to ``anchor``.
    """
    half = length // 2
    blocks, bits = bits_of(repeated, "anchor", ANCHOR_BITS)
    flags = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in blocks.collect():  # at most 2^ANCHOR_BITS bits
        part = np.frombuffer(bytes(row["_bits"]), dtype=np.uint8)
        flags[row["_block"] << 12 : (row["_block"] << 12) + len(part)] = part
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def pick(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> pa.Array:
        edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data[kernel.slices_of(begins, sizes)].tobytes())])

    def build():
        known = shared.value

        def work(data: np.ndarray, offsets: np.ndarray) -> list:
            places, hashes, first, last, begin, end = anchors(data, offsets, length)
            spot = hashes >> np.uint64(64 - bits)
            marked = (known[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
            places, hashes, first, last = places[marked], hashes[marked], first[marked], last[marked]
            text = np.searchsorted(offsets, places, "right") - 1
            least, most = places - last, places - first
            owner = np.searchsorted(offsets, begin, "right") - 1
            zeros = np.zeros(len(begin), dtype=np.int32)

            def joined(own, rest):
                return np.concatenate((own.astype(rest.dtype), rest))

            def with_nulls(column: pa.Array) -> pa.Array:
                return pa.concat_arrays([column, pa.nulls(len(begin), pa.binary())])

            return [
                joined(text, owner),
                with_nulls(pick(data, places, np.full(len(places), min(LEADING, half)))),
                joined(hashes.view(np.int64), end - offsets[owner]),
                joined(least, zeros),
                joined(most, zeros),
                with_nulls(pick(data, places - most, most)),
                with_nulls(pick(data, places + half, length - half - least)),
                joined(places - offsets[text], begin - offsets[owner]),
            ]

        return work

    return kernel.map_texts(docs.select("doc_id", "content", "text"), build, _SUFFIX)


def multikey_order(rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows inside their groups, and for each place how many bytes it shares with the place before.

    Multikey quicksort, eight bytes a step: rows are split by the next eight bytes, and only rows that are
    still equal go on to the next step. The first place of a group shares -1.
    """
    n, width = rows.shape
    words = rows.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    shared = np.full(n, width, dtype=np.int64)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = groups[order][1:] != groups[order][:-1]
    shared[fresh] = -1
    segment = np.cumsum(fresh)
    active = np.arange(n)
    for depth in range(words.shape[1]):
        counts = np.bincount(segment[active], minlength=1)
        active = active[counts[segment[active]] > 1]
        if not len(active):
            break
        key = words[order[active], depth]
        by = np.lexsort((key, segment[active]))
        order[active] = order[active][by]
        key = key[by]
        apart = (segment[active][1:] == segment[active][:-1]) & (key[1:] != key[:-1])
        split = active[1:][apart]
        differ = (key[1:] ^ key[:-1])[apart]
        zeros = 63 - np.floor(np.log2(differ.astype(np.float64))).astype(np.int64)
        zeros = np.where((differ >> (np.uint64(63) - zeros.clip(0, 63).astype(np.uint64))) == 0, zeros + 1, zeros)
        shared[split] = depth * 8 + zeros.clip(0, 63) // 8
        marks = np.zeros(n, dtype=np.int64)
        marks[split] = 1
        segment = segment + np.cumsum(marks)
    return order, shared


def _padded(column: pa.Array, width: int, backwards: bool) -> np.ndarray:
    data, offsets = kernel.flat(column)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), dtype=np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if backwards:
        place = sizes[row] - 1 - place
    out[row, place] = data[offsets[0] : offsets[-1]]
    return out


def equal_strings(groups: np.ndarray, before: np.ndarray, after: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset of the anchor) of all strings around the anchors that another one equals."""
    half, n = length // 2, len(groups)
    sides = []
    for rows in (before, after):
        order, shared = multikey_order(rows, groups)
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        sides.append((rank, shared))
    (left, left_shared), (right, right_shared) = sides
    rows, offsets = [], []
    for offset in range(int(least.min()), int(most.max()) + 1):
        own = np.flatnonzero((least <= offset) & (offset <= most))
        if len(own) < 2:
            continue
        a = np.cumsum(left_shared < offset)[left[own]]
        b = np.cumsum(right_shared < length - half - offset)[right[own]]
        key = a * (n + 1) + b
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(own), dtype=bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        found = own[twice]
        rows.append(found)
        offsets.append(np.full(len(found), offset))
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(offsets)


_SPANS = "doc_id long, content long, begin long, end long"


def _string_hashes(table: pa.Table, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(row, start, two hashes) of every string around the anchors of the table's rows."""
    half = length // 2
    for k, row in enumerate(table.select(["least", "most", "before", "after", "at", "anchor"]).to_pylist()):
        text = np.frombuffer(row["before"] + row["after"], dtype=np.uint8)
        sums, other = kernel.prefix_sums(text), kernel.prefix_sums(text[::-1].copy())
        size = len(text)
        for offset in range(row["least"], row["most"] + 1):
            x = np.array([row["most"] - offset])
            y = x + length - half
            a = kernel.span_hashes(sums, x, y)[0] ^ np.uint64(row["anchor"] & 0xFFFFFFFFFFFFFFFF)
            b = kernel.span_hashes(other, size - y, size - x)[0] + np.uint64(offset)
            yield k, row["at"] - offset, int(a.view(np.int64)), int(np.uint64(b).view(np.int64))


def spans(found: DataFrame, length: int, largest: int = LARGEST) -> DataFrame:
    """Byte spans (doc_id, content, begin, end) of strings that occur elsewhere too, from all suffixes."""
    width = -(-length // 16) * 8 + 8
    known = found.where("lead is null").select("doc_id", "content", F.col("at").alias("begin"), F.col("anchor").alias("end"))
    found = found.where("lead is not null")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def work(table: pa.Table) -> pa.RecordBatch | None:
            table = table.combine_chunks()
            anchor = table["anchor"].to_numpy()
            _, groups, counts = np.unique(anchor, return_inverse=True, return_counts=True)
            keep = counts[groups] > 1
            if not keep.any():
                return None
            table, groups = table.filter(pa.array(keep)).combine_chunks(), groups[keep]
            least, most, at = (table[c].to_numpy().astype(np.int64) for c in ("least", "most", "at"))
            before, after = (_padded(table[c].combine_chunks(), width, c == "before") for c in ("before", "after"))
            row, offset = equal_strings(groups, before, after, least, most, length)
            if not len(row):
                return None
            start = at[row] - offset
            by = np.lexsort((start, row))
            row, start = row[by], start[by]
            head = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
            first = np.flatnonzero(head)
            last = np.append(first[1:], len(row)) - 1
            own = pa.array(row[first])
            columns = [table["doc_id"].combine_chunks().take(own), table["content"].combine_chunks().take(own), pa.array(start[first]), pa.array(start[last] + length)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "content", "begin", "end"])

        def settled() -> Iterator[pa.RecordBatch]:
            """Work on all held suffixes but those of the last anchor."""
            nonlocal held, rows
            table = pa.Table.from_batches(held).combine_chunks()
            anchor = table["anchor"].to_numpy()
            cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
            if cut:
                out = work(table.slice(0, cut))
                if out is not None:
                    yield out
                held, rows = table.slice(cut).combine_chunks().to_batches(), len(anchor) - cut

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
                if rows > BATCH:
                    yield from settled()
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None:
                yield out

    frequent = found.groupBy("anchor").count().where(F.col("count") > largest).select("anchor")
    frequent = stored(frequent, "frequent")  # a handful: each stands for LARGEST suffixes
    few, many = found, None
    if not frequent.isEmpty():
        few = found.join(frequent, "anchor", "left_anti").select(found.columns)
        many = found.join(frequent, "anchor", "left_semi").select(found.columns)
    ordered = few.repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor")
    out = ordered.mapInArrow(sort, _SPANS).unionByName(known)
    if many is None:
        return out

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                table = pa.Table.from_batches([batch]).slice(k, 1000)
                columns = list(zip(*_string_hashes(table, length), strict=True))
                own = pa.array(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [table["doc_id"].combine_chunks().take(own), table["content"].combine_chunks().take(own), *(pa.array(c, pa.int64()) for c in columns[1:])],
                    names=["doc_id", "content", "begin", "p", "q"],
                )

    strings = many.mapInArrow(each, "doc_id long, content long, begin long, p long, q long")
    twice = strings.groupBy("p", "q").count().where("count > 1").select("p", "q")
    more = strings.join(twice, ["p", "q"], "left_semi").select("doc_id", "content", "begin", (F.col("begin") + length).alias("end"))
    return out.unionByName(more)


def repeated_spans(docs: DataFrame, length: int = LENGTH, largest: int = LARGEST) -> tuple[DataFrame, DataFrame]:
    """Spans of strings that occur elsewhere, and one row per document: doc_id, sha256, n_bytes, copied.

    A text that other rows have as a whole is ``copied``: all its strings occur elsewhere, so its spans aren't
    listed unless it stands for its copies. The spans (doc_id, content, begin, end) may overlap.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(body, 256).alias("sha256"), F.octet_length(body).cast("long").alias("n_bytes"))
    rows = stored(rows, "contents")
    copies = rows.groupBy("sha256").agg(F.count("*").alias("n"), F.min("doc_id").alias("stands")).where("n > 1")
    rows = rows.join(copies, "sha256", "left").select("doc_id", "sha256", "n_bytes", "stands", F.col("n").isNotNull().alias("copied"))
    rows = stored(rows, "copies")
    repeated = repeated_anchors(docs, length)
    # Only one of equal texts goes on. Others are guessed first, so few texts are moved to be told for sure.
    others = rows.where((F.col("n_bytes") >= length) & (F.col("doc_id") > F.col("stands"))).select("doc_id", F.col("sha256").alias("_sha"))
    marked = guessed(_long_texts(docs, length), others, "doc_id")
    unsure = marked.where("_maybe").drop("_maybe").withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256))
    sure = marked.where("not _maybe").drop("_maybe")
    standing = sure.unionByName(unsure.join(others, ["doc_id", "_sha"], "left_anti").drop("_sha"))
    found = stored(suffixes(standing, repeated, length), "suffixes")
    return spans(found, length, largest), rows.drop("stands")


def without_repeats(docs: DataFrame, length: int = LENGTH, largest: int = LARGEST) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte in a ``length``-byte string that also starts elsewhere, in the same text or another, is removed;
    strings never cross texts. Null text: empty. Texts shorter than ``length`` stay whole. Repeated rows of long
    texts are removed as a whole, all of them. Null doc_ids are kept. An empty table gives no rows; other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, rows = repeated_spans(docs, length, largest)
    listed = found.groupBy("doc_id", "content").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # of one text
    listed = stored(listed, "spans")
    texts = likely(_long_texts(docs, length), listed, "doc_id")
    mine = listed.select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"), "spans")
    both = texts.join(mine, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            data, offsets = kernel.flat(batch.column(1))
            for k in range(batch.num_rows):
                raw = data[offsets[k] : offsets[k + 1]].tobytes()
                merged: list[list[int]] = []
                for span in sorted((s["begin"], s["end"]) for s in batch.column(2)[k].as_py()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                kept, at = [], 0
                for x, y in merged:
                    kept.append(raw[at:x])
                    at = y
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((hashlib.sha256(raw).hexdigest(), len(raw) - len(rest), len(merged), hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "sha256", "removed", "cuts", "kept"])

    cut = both.mapInArrow(run, "doc_id long, sha256 string, removed long, cuts long, kept string").dropDuplicates(["doc_id", "sha256"])
    cut = cut.select(F.col("doc_id").alias("_id"), F.col("sha256").alias("_sha"), "removed", "cuts", "kept")
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha256") == F.col("_sha")), "left")
    whole = F.col("copied") & (F.col("n_bytes") >= length)
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("cuts", none)).alias("n_spans"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )


def op2_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.withColumn("has_repeats", F.col("n_removed") > 0)
