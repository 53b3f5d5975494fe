"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

The benchmark is the query set: it goes over all documents in slices of bounded size. A document's window has as
many words as the item. A window can only be similar if shingles of the slice make up most of its weight, which
running sums tell for every window; fingerprints are computed for those windows alone.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.llm.words import bare_spans

#: Words of a shingle, and the weighted Jaccard similarity from which a window counts as a leak.
WIDTH = 5
SIMILARITY = 0.8
#: Bits of a fingerprint, in blocks of BLOCK_BITS. Two fingerprints that differ in fewer bits than there are
#: blocks agree in a block, so RADIUS is found for certain.
BITS = 128
BLOCK_BITS = 4
BLOCKS = BITS // BLOCK_BITS
RADIUS = BLOCKS - 1
#: Benchmark words in one slice; this bounds what is sent to the tasks (about 100 bytes a word).
SLICE_WORDS = 500_000

_FOUND = "item_id long, start_word long, n_words long, start_byte long, end_byte long, similarity double"


@dataclass(frozen=True)
class Shingled:
    """Shingles and their weights (letters in their words) by word position, for many texts."""

    hashes: np.ndarray
    weights: np.ndarray
    begins: np.ndarray  # of each text
    ends: np.ndarray


def shingled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, words: np.ndarray) -> Shingled:
    """All shingles of all texts; a text of fewer words than a shingle has one, of all its words."""
    sizes = np.diff(firsts)
    grams, whole = kernel.shingles(words, firsts, WIDTH)
    letters = np.concatenate(([0], np.cumsum(ends - starts)))
    place = np.arange(len(words))
    weights = letters[np.minimum(place + WIDTH, len(words))] - letters[place]
    begins, counts = firsts[:-1].copy(), np.maximum(sizes - WIDTH + 1, 0)
    for k in np.flatnonzero((sizes > 0) & (sizes < WIDTH)):  # short texts only
        a, b = firsts[k], firsts[k + 1]
        value = np.uint64(sizes[k])
        for x in words[a:b]:
            value = kernel.mix(np.array([value ^ x]))[0]
        grams[a], weights[a], counts[k] = value, letters[b] - letters[a], 1
    return Shingled(grams, weights, begins, begins + counts)


def bit_sums(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums over positions of each bit's weight, plus or minus."""
    raw = np.column_stack((kernel.mix(hashes), kernel.mix(hashes ^ np.uint64(0xABCDEF0123456789)))).astype("<u8")
    bits = np.unpackbits(raw.view(np.uint8).reshape(len(hashes), BITS // 8), axis=1).astype(np.int64)
    out = np.zeros((len(hashes) + 1, BITS), dtype=np.int64)
    np.cumsum((2 * bits - 1) * weights[:, None], axis=0, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of position ranges, one block per column."""
    bits = (sums[ends] - sums[begins] > 0).reshape(len(begins), BLOCKS, BLOCK_BITS)
    return (bits * (1 << np.arange(BLOCK_BITS))).sum(axis=2).astype(np.uint8)


class BlockIndex:
    """Fingerprints of items by the value of each block, all blocks one after the other."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks
        orders = np.argsort(blocks, axis=0, kind="stable")
        values = np.arange((1 << BLOCK_BITS) + 1)
        edges = [np.searchsorted(blocks[orders[:, b], b], values, "left") + b * len(blocks) for b in range(BLOCKS)]
        self.orders, self.edges = orders.T.ravel(), np.array(edges)

    def near(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (window, item) with fingerprints within RADIUS."""
        n, block = len(self.blocks), np.arange(BLOCKS)
        begin, end = self.edges[block, windows], self.edges[block, windows.astype(np.int64) + 1]
        counts = (end - begin).ravel()
        items = self.orders[kernel.slices_of(begin.ravel(), counts)]
        pairs = np.unique(np.repeat(np.repeat(np.arange(len(windows)), BLOCKS), counts) * n + items)
        window, item = pairs // n, pairs % n
        apart = _ONES[windows[window] ^ self.blocks[item]].sum(axis=1)
        close = apart <= RADIUS
        return window[close], item[close]


_ONES = np.array([bin(k).count("1") for k in range(1 << BLOCK_BITS)])


def weighted_similarity(a: Counter, b: Counter, weight: dict[int, int]) -> float:
    """Jaccard similarity of two multisets of weighted shingles."""
    both = sum(weight[x] * min(n, b[x]) for x, n in a.items() if x in b)
    total = sum(weight[x] * n for x, n in a.items()) + sum(weight[x] * n for x, n in b.items())
    return both / (total - both) if total else 0.0


@dataclass(frozen=True)
class Slice:
    """Part of the benchmark, ready to be looked up."""

    ids: list
    n_words: np.ndarray
    shingles: list[np.ndarray]
    weights: list[np.ndarray]
    blocks: np.ndarray
    known: np.ndarray  # all shingles, sorted


def _bare(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words without punctuation around them; their spans in the text are those of the whole words."""
    starts, ends, firsts = kernel.words(data, offsets)
    a, b = bare_spans(data, starts, ends)
    return starts, ends, firsts, a, b, kernel.word_hashes(data, a, b, lower=True)


def prepare(items: list[tuple]) -> Slice:
    texts = [(t or "").encode() for _, t in items]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    _, _, firsts, a, b, words = _bare(data, offsets)
    grams = shingled(data, a, b, firsts, words)
    filled = np.flatnonzero(np.diff(firsts) > 0)
    sums = bit_sums(grams.hashes, grams.weights)
    begins, ends = grams.begins[filled], grams.ends[filled]
    return Slice(
        [items[k][0] for k in filled],
        np.diff(firsts)[filled],
        [grams.hashes[x:y] for x, y in zip(begins, ends, strict=True)],
        [grams.weights[x:y] for x, y in zip(begins, ends, strict=True)],
        fingerprints(sums, begins, ends),
        np.unique(np.concatenate([grams.hashes[x:y] for x, y in zip(begins, ends, strict=True)] or [np.zeros(0, np.uint64)])),
    )


class Scanner:
    """Looks up one slice of the benchmark in texts."""

    def __init__(self, part: Slice):
        self.part = part
        self.rough = np.zeros(1 << 22, dtype=bool)
        self.rough[(part.known >> np.uint64(42)).astype(np.int64)] = True
        self.by_size = {}
        for size in np.unique(part.n_words).tolist():
            of = np.flatnonzero(part.n_words == size)
            self.by_size[size] = (of, BlockIndex(part.blocks[of]))
        self.bags = [Counter(s.tolist()) for s in part.shingles]
        self.weight = {h: w for s, ws in zip(part.shingles, part.weights, strict=True) for h, w in zip(s.tolist(), ws.tolist(), strict=True)}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list:
        starts, ends, firsts, a, b, words = _bare(data, offsets)
        grams = shingled(data, a, b, firsts, words)
        hit = self.rough[(grams.hashes >> np.uint64(42)).astype(np.int64)]
        places = np.flatnonzero(hit)
        at = np.searchsorted(self.part.known, grams.hashes[places])
        hit[places] = self.part.known[np.minimum(at, max(len(self.part.known) - 1, 0))] == grams.hashes[places] if len(self.part.known) else False
        places = np.flatnonzero(hit)
        out = []
        for text in np.unique(np.searchsorted(firsts, places, "right") - 1).tolist():
            x, y = int(grams.begins[text]), int(grams.ends[text])
            if hit[x:y].any():
                for item, i, n, similarity in self.leaks(grams.hashes[x:y], grams.weights[x:y], hit[x:y], int(firsts[text + 1] - firsts[text])):
                    first = int(firsts[text]) + i
                    base = offsets[text]
                    out.append((text, item, i, n, int(starts[first] - base), int(ends[first + n - 1] - base), similarity))
        columns = list(zip(*out, strict=True)) or [[] for _ in range(7)]
        return [np.array(columns[0], dtype=np.int64), *columns[1:]]

    def leaks(self, hashes: np.ndarray, weights: np.ndarray, hit: np.ndarray, n_words: int):
        """(item, first word, words, similarity) of the text's leaks, the best first where windows of an item overlap."""
        all_weight = np.concatenate(([0], np.cumsum(weights)))
        hit_weight = np.concatenate(([0], np.cumsum(weights * hit)))
        sums, found = None, []
        for size, (items, index) in self.by_size.items():
            wide = min(max(size - WIDTH + 1, 1), len(hashes))
            begins = np.arange(len(hashes) - wide + 1)
            inside = (hit_weight[begins + wide] - hit_weight[begins]) >= SIMILARITY * (all_weight[begins + wide] - all_weight[begins]) - 1e-9
            begins = begins[inside]
            if not len(begins):
                continue
            if sums is None:
                sums = bit_sums(hashes, weights)
            for k in range(0, len(begins), 512):
                part = begins[k : k + 512]
                windows, near = index.near(fingerprints(sums, part, part + wide))
                for i, item in zip(part[windows].tolist(), items[near].tolist(), strict=True):
                    own = hashes[i : i + wide].tolist()
                    weight = self.weight | dict(zip(own, weights[i : i + wide].tolist(), strict=True)) if not all(h in self.weight for h in own) else self.weight
                    similarity = weighted_similarity(Counter(own), self.bags[item], weight)
                    if similarity >= SIMILARITY:
                        found.append((-similarity, i, item, min(size, n_words)))
        taken: dict[int, list[tuple[int, int]]] = {}
        for minus, i, item, n in sorted(found):
            spans = taken.setdefault(item, [])
            if all(i + n <= x or y <= i for x, y in spans):
                spans.append((i, i + n))
                yield self.part.ids[item], i, n, -minus


def find_leaks(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", text: str = "text") -> DataFrame:
    """Leaks of benchmark items: the other columns of ``docs``, then item_id, start_word, n_words, start_byte, end_byte, similarity.

    Windows of a document that is shorter than an item are the whole document. An item of fewer words than a
    shingle is one shingle of all its words, so only a text of just these words is as similar. Null, empty and word-less texts and
    items have no leaks. Overlapping windows of one item are one leak, the most similar (the first of equal
    ones). Repeated documents and items are looked up each. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    n_words = F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+"))
    total = items.agg(F.sum(n_words)).first()[0] or 0
    slices = max(1, -(-2 * total // SLICE_WORDS))
    out = None
    for k in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).collect()  # about SLICE_WORDS / 2 words
        shared = spark.sparkContext.broadcast(prepare([(r.item_id, r.text) for r in rows]))
        found = kernel.map_texts(docs, lambda shared=shared: Scanner(shared.value), _FOUND, text)
        out = found if out is None else out.unionByName(found)
    return out


def op6_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
