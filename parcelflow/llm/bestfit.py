"""Best-fit packing with certified bin counts.

Texts become token ids in Arrow batches; only piece lengths and checksums travel on. Pieces are dealt over
partitions of bounded size, each packed best-fit decreasing and compared with a dual-feasible-function lower
bound. Partitions that can't certify their count, or that have gaps, give the documents of bins with gaps to larger common
groups, which are packed again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.session import stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Pieces packed by one task; the number of partitions follows from it.
PER_GROUP = 50_000
#: Times that documents of bins with gaps are exchanged.
EXCHANGES = 3

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, gap long, spare long"


#: Words that the vocabulary's normaliser only lower-cases: printable ASCII but the apostrophe, and Latin-1 letters.
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: What it then cuts such words into: letters, single digits, and the rest.
_RUNS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Runs of letters remembered by one task.
_REMEMBERED = 200_000
#: Words whose ids one task remembers: some 50 MB. With fewer, tasks tokenise the same words again and again.
_WORDS = 500_000


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if visible, else one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def word_encoder(path: str):
    """Function from words as bytes to id lists, by the lower-case vocabulary whose pieces never cross white space.

    Plain words go to the vocabulary's merges at once; all others take the tokenizer's own way.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merges, letters, known = tokenizer.model, _byte_letters(), {}
    numbers = list(range(tokenizer.get_vocab_size()))  # remembered ids share these objects

    def run_ids(run: str) -> list[int]:
        ids = known.get(run)
        if ids is None:
            if len(known) >= _REMEMBERED:
                known.clear()
            shown = run if run.isascii() else "".join(letters[b] for b in run.encode())
            ids = known[run] = tuple(numbers[t.id] for t in merges.tokenize(shown))
        return ids

    def encode(found: list[bytes]) -> list[list[int]]:
        words = [w.decode("utf-8", "replace") for w in found]
        out: list = [None] * len(words)
        other = []
        for k, word in enumerate(words):
            if len(word) < 1000 and "<|" not in word and _PLAIN.fullmatch(word):
                out[k] = [i for run in _RUNS.findall(word.lower()) for i in run_ids(run)]
            else:
                other.append(k)
        for k, e in zip(other, tokenizer.encode_batch_fast([words[k] for k in other], add_special_tokens=False), strict=True):
            out[k] = e.ids
        return out

    return encode


def pieces(docs: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Token pieces of all documents: doc_id, piece, start, length, ids_crc32, and with ``with_ids`` the ids.

    A document's ids are those of its text, then ``end_id``. Longer documents are cut every ``capacity`` ids.
    Null and empty texts give one piece with the end id alone.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel.release_memory()
        table = kernel.WordTable(word_encoder(vocabulary), _WORDS)
        for batch in batches:
            for i, j, data, offsets in kernel.chunks(batch.column(1)):
                starts, ends, firsts = kernel.words(data, offsets)
                hashes = kernel.word_hashes(data, starts, ends)
                begin, size = table.lookup(data, starts, ends, hashes)
                ids = table.ids[kernel.slices_of(begin, size)].astype("<u4")
                totals = kernel.per_text(size, firsts)
                stops = np.cumsum(totals)
                out: list[tuple] = []
                for row in range(j - i):
                    own = np.append(ids[stops[row] - totals[row] : stops[row]], np.uint32(end_id)).astype("<u4")
                    for k in range(0, len(own), capacity):
                        part = own[k : k + capacity]
                        out.append((row, k // capacity, k, len(part), zlib.crc32(part), part))
                cols = list(zip(*out, strict=True))
                arrays = [
                    batch.column(0).take(pa.array(np.array(cols[0], dtype=np.int64) + i)),
                    pa.array(cols[1], pa.int32()),
                    pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.int64()),
                    pa.array(cols[4], pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int64) for x in cols[5]], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, _PIECES + ", ids array<long>" * with_ids)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual feasible functions of the lengths.

    Two families: items above ``capacity - e`` count whole and those below ``e`` nothing, for every e up to half; and
    sizes rounded down to multiples of 1 / k except where (k + 1) * size is whole, for k up to 30.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    value = np.arange(capacity + 1)
    total, many = np.cumsum(counts * value), np.cumsum(counts)
    e = np.arange(0, capacity // 2 + 1)
    big = many[-1] - many[capacity - e]
    below = np.where(e > 0, total[np.maximum(e - 1, 0)], 0)
    middle = total[capacity - e] - below
    best = int((big + -(-middle // capacity)).max())
    for k in range(1, 31):
        scaled = (k + 1) * value
        whole = scaled % capacity == 0
        # times k * capacity, so that all stays in whole numbers
        score = np.where(whole, value * k, (scaled // capacity) * capacity)
        best = max(best, int(-(-int((counts * score).sum()) // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the gap of each bin; ties in length go by position."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    gaps: list[int] = []
    open_bins: dict[int, list[int]] = {}
    mask = 0  # bit g is set while a bin with gap g is open
    for place, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = mask >> length
        if fitting:
            gap = length + (fitting & -fitting).bit_length() - 1
            mine = open_bins[gap].pop()
            if not open_bins[gap]:
                mask &= ~(1 << gap)
        else:
            gap, mine = capacity, len(gaps)
            gaps.append(capacity)
        bins[place], offsets[place] = mine, capacity - gap
        gaps[mine] = rest = gap - length
        if rest:
            open_bins.setdefault(rest, []).append(mine)
            mask |= 1 << rest
    return bins, offsets, np.array(gaps, dtype=np.int64)


def _packer(capacity: int, again: bool):
    """Pack one group. ``again``: the pieces come from earlier bins, which stand if the new ones aren't fewer."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        lengths = group["length"].to_numpy()
        bins, offsets, gaps = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        if again:
            old = group["bin"].to_numpy()
            kinds, local = np.unique(old, return_inverse=True)
            if len(kinds) <= len(gaps):
                bins, offsets = local, group["offset"].to_numpy()
                gaps = capacity - np.bincount(local, weights=lengths, minlength=len(kinds)).astype(np.int64)
        out = group[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        out["bin"] = bins + (int(key[0]) << 32)
        out["offset"] = offsets
        out["gap"] = gaps[bins]
        out["spare"] = len(gaps) - bound
        return out

    return pack


def pack(docs: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary: str = VOCABULARY) -> DataFrame:
    """Place every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap, round, spare.

    ``spare`` is the bins of the piece's group beyond the group's certified lower bound; 0 proves it optimal.
    Repeated rows are documents of their own; null doc_ids are kept; an empty table gives no rows. Other
    columns are ignored.
    """
    cut = stored(pieces(docs, capacity, end_id, vocabulary).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    full = cut.where(whole).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.col("_row").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("gap"),
        F.lit(0).alias("round"), F.lit(0).cast("long").alias("spare"),
    )
    rest, done = cut.where(~whole), [full]
    many = rest.count()
    for k in range(1, EXCHANGES + 2):
        groups = max(1, -(-many // PER_GROUP))
        if k == 1:
            dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
        else:  # bins of different partitions meet; a bin stays together
            dealt = rest.withColumn("_group", F.pmod(F.xxhash64("bin", F.lit(k)), F.lit(groups)))
        packed = dealt.groupBy("_group").applyInPandas(_packer(capacity, k > 1), _PACKED)
        packed = stored(packed, f"packed-{k}")
        last = k == EXCHANGES + 1 or groups == 1
        # A bin that is full is final; so is all of a single group whose count is certified.
        final = packed if last else packed.where("gap = 0")
        done.append(
            final.select(
                "doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("bin") + F.lit(k << 58)).alias("sequence_id"), "offset", "gap", F.lit(k).alias("round"), "spare",
            )
        )
        if last:
            break
        rest = packed.where("gap > 0")
        many = rest.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def op7_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"))
