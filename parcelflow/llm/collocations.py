"""Phrases that hang together, mined by set-oriented relations.

Occurrences of words are a table in order of text and position. Occurrences of a phrase one word longer come from
merging that table with itself at adjacent positions of one piece; they are counted by group, and only occurrences of
frequent phrases (a semi-join) go on to the next length. Within a task a text's occurrences lie side by side, so the merge
is a shift of arrays; counts meet in shuffles.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.llm.keys import bits_of
from parcelflow.session import discard, stored

#: Words of a phrase at most, occurrences of a candidate at least, percent of them that a longer candidate must have to replace it.
LONGEST = 3
LEAST = 10
COVERED = 50
#: Phrases reported for each language.
TOP = 2000
#: Occurrences that a task counts at once.
COUNTED = 1 << 18
#: The semi-join's filter has this many bits at most (a power of two); beyond, more phrases pass it that later counts drop.
FILTER_BITS = 27

_SIGNS = np.arange(256, dtype=np.uint8)
_SIGNS[[ord(c) for c in ".,;:!?"]] = 0x20
_BREAK = np.zeros(256, dtype=np.int64)
_BREAK[[*(ord(c) for c in ".,;:!?"), *range(0x0A, 0x0E)]] = 1
_MIX = np.uint64(0xA0761D6478BD642F)


def piece_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, the first word of each text, and which words begin a piece."""
    starts, ends, firsts = kernel.words(_SIGNS[data], offsets)
    breaks = np.concatenate(([0], np.cumsum(_BREAK[data])))
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = breaks[starts[1:]] != breaks[ends[:-1]]
    opens[firsts[:-1][firsts[:-1] < len(starts)]] = True
    return starts, ends, firsts, opens


def _salt(lang: str, salt: int) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little"))


def occurrences(docs: DataFrame, salt: int = 0) -> DataFrame:
    """Two tables in one. ``ids`` not null: a text's words in order, 0 before each new piece. Else: a word of some texts, its id and count.

    An id is a 64-bit hash of word and language. ``ids`` holds 8 bytes for each, which Spark moves as they are.
    """
    fields = "lang string, ids binary, word binary, id long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "ids", "word", "id", "n"]
        kernel.release_memory()
        salts: dict[str, np.uint64] = {}
        for batch in batches:
            for i, j, data, offsets in kernel.chunks(batch.column(0)):
                starts, ends, firsts, opens = piece_words(data, offsets)
                langs = batch.column(1).slice(i, j - i).to_pylist()
                own = np.array([salts.get(x) or salts.setdefault(x, _salt(x, salt)) for x in langs], dtype=np.uint64)
                text = kernel.text_index(firsts)
                ids = kernel.mix(kernel.word_hashes(data, starts, ends, lower=True) * _MIX ^ own[text])
                ids[ids == 0] = 1
                ids = ids.view(np.int64)
                # a 0 in front of every piece
                at = np.arange(len(ids)) + np.cumsum(opens)
                row = np.zeros(len(ids) + int(opens.sum()), dtype=np.int64)
                row[at] = ids
                zeros = np.concatenate(([0], np.cumsum(opens)))
                begins = firsts + zeros[firsts]
                lists = _packed(row, begins)
                n = j - i
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), lists, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
                kinds, first, count = np.unique(ids, return_index=True, return_counts=True)
                raw = kernel._LOWER[data].tobytes()
                found = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                n = len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[k] for k in text[first].tolist()], pa.string()), pa.nulls(n, pa.binary()), pa.array(found, pa.binary()), pa.array(kinds), pa.array(count, pa.int64())], names=names
                )

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(F.col("text").cast("string").alias("text"), lang.alias("lang")).mapInArrow(run, fields)


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases, given as one array per word."""
    value = columns[0].view(np.uint64)
    for c in columns[1:]:
        value = kernel.mix(value) * _MIX + c.view(np.uint64)
    return kernel.mix(value)


def _bitmap(grams: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """Filter of phrases (w1 .. wn) for :func:`_among`: FILTER_BITS bits at most, as bytes, and its number of bits."""
    names = [f"w{k + 1}" for k in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(gram_hash([c.to_numpy() for c in batch.columns]).view(np.int64))], names=["hash"])

    blocks, bits = bits_of(grams.select(*names).mapInArrow(run, "hash long"), "hash", FILTER_BITS)
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for block in blocks.collect():  # 2 ** (FILTER_BITS - 15) rows of 4 KB at most
        part = np.frombuffer(block["_bits"], dtype=np.uint8)[: 1 << 12]
        out[block["_block"] << 12 : (block["_block"] << 12) + len(part)] = part[: len(out)]
    return out, bits


def _among(hashes: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _windows(row: np.ndarray, length: int) -> np.ndarray:
    """Positions of ``length`` words without a 0 among them."""
    zeros = np.concatenate(([0], np.cumsum(row == 0)))
    n = len(row) - length + 1
    return np.flatnonzero(zeros[length : length + n] == zeros[:n]) if n > 0 else np.zeros(0, dtype=np.int64)


def _packed(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Ids of many texts as one byte string each."""
    offsets = (begins * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of many texts, one 0 in front of each, about COUNTED at a time, and where each text's begin."""
    for _, _, data, offsets in kernel.chunks(batch.column(0), 8 * COUNTED):
        yield np.frombuffer(data.tobytes(), dtype=np.int64), offsets // 8


def kept(relation: DataFrame, grams: DataFrame, length: int) -> DataFrame:
    """Semi-join: occurrences (ids) that lie in a frequent phrase of ``length`` words; others become breaks.

    Every ``length`` words in a row without a 0 are then a frequent phrase, but for the few that the filter lets through by chance.
    """
    shared = relation.sparkSession.sparkContext.broadcast(_bitmap(grams, length))  # FILTER_BITS bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel.release_memory()
        bitmap, bits = shared.value
        for batch in batches:
            for row, texts in _rows(batch):
                at = _windows(row, length)
                at = at[_among(gram_hash([row[at + k] for k in range(length)]), bitmap, bits)]
                if not len(at):
                    continue
                # Runs of phrases that begin side by side share their words; before each run goes a 0.
                new = np.concatenate(([True], np.diff(at) > 1))
                run_start, run_end = at[new], at[np.concatenate((new[1:], [True]))] + length
                sizes = run_end - run_start + 1
                begins = np.cumsum(sizes) - sizes
                out = np.zeros(int(sizes.sum()), dtype=np.int64)
                inside = np.ones(len(out), dtype=bool)
                inside[begins] = False
                out[inside] = row[kernel.slices_of(run_start, run_end - run_start)]
                first = np.unique(np.searchsorted(texts, run_start, "right"), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([_packed(out, np.append(begins[first], len(out)))], names=["ids"])

    return stored(relation.select("ids").mapInArrow(run, "ids binary"), f"relation-{length}")


def frequent(relation: DataFrame, length: int, least: int = LEAST) -> DataFrame:
    """(w1 .. wn, a): phrases of ``length`` words and their occurrences in ``relation``, where there are ``least`` or more."""
    names = [f"w{k + 1}" for k in range(length)]
    fields = ", ".join(f"{n} long" for n in names) + ", n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel.release_memory()
        for batch in batches:
            for row, _ in _rows(batch):
                at = _windows(row, length)
                if not len(at):
                    continue
                kinds, place = np.unique(row, return_inverse=True)
                place = place.astype(np.int64)
                group = place[at]  # phrases so far are numbered within these rows, so a phrase and a word make one whole number
                for k in range(1, length):
                    _, first, group, count = np.unique(group * len(kinds) + place[at + k], return_index=True, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(row[at[first] + k]) for k in range(length)), pa.array(count, pa.int64())], names=[*names, "n"])

    counted = relation.select("ids").mapInArrow(run, fields).groupBy(*names).agg(F.sum("n").alias("a"))
    return stored(counted.where(F.col("a") >= least), f"frequent-{length}")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    top = wide[0] * wide[0] * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", top, wide[1] * wide[2])


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language of (text, lang): lang, rank, phrase, a, l, r, n, score.

    Words and pieces are those of whole texts; a null lang is ``und``. Null and empty texts have no words, repeated rows count each, and
    a table without words gives no rows. Other columns are ignored. Counts are exact: should two words ever share a 64-bit
    id, all is counted again with other ids.
    """
    for salt in itertools.count():
        table = stored(occurrences(docs, salt), "occurrences")
        words = stored(table.where("ids is null").groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            break
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    singles = stored(words.where(F.col("n") >= least).select(F.col("id").alias("w1"), F.col("n").alias("a"), "lang", "word"), "singles")
    relation, counts = kept(table.where("ids is not null"), singles, 1), {1: singles.select("w1", "a")}
    discard(table)  # each relation replaces the one before
    for length in range(2, longest + 1):
        counts[length] = frequent(relation, length, least)
        if length < longest:
            before, relation = relation, kept(relation, counts[length], length)
            discard(before)

    found = None
    for length in range(2, longest + 1):
        names = [f"w{k + 1}" for k in range(length)]
        rows = counts[length]
        for k in range(1, length):
            first = counts[k].withColumnRenamed("a", f"l{k}")
            rest = counts[length - k].select(*[F.col(f"w{i + 1}").alias(names[k + i]) for i in range(length - k)], F.col("a").alias(f"r{k}"))
            rows = rows.join(first, names[:k]).join(rest, names[k:])
        cuts = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, length)]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        longer = None
        for more in range(length + 1, longest + 1):
            for k in range(more - length + 1):
                inner = counts[more].select(*[F.col(f"w{k + i + 1}").alias(names[i]) for i in range(length)], F.col("a").alias("longer"))
                longer = inner if longer is None else longer.unionByName(inner)
        if longer is not None:
            rows = rows.join(longer.groupBy(*names).agg(F.max("longer").alias("longer")), names, "left")
            rows = rows.where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered))
        rows = rows.select(F.array(*names).alias("ids"), "a", "cut.l", "cut.r", "cut.score")
        found = rows if found is None else found.unionByName(rows)
    named = singles.select(F.col("w1").alias("id"), "lang", "word")
    found = stored(found, "phrases")
    tongue = found.withColumn("id", F.element_at("ids", 1)).join(named.select("id", "lang"), "id").drop("id")
    tied = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    leading = stored(tongue.withColumn("tied", tied).where(F.col("tied") <= top).drop("tied").withColumn("nth", F.monotonically_increasing_id()), "leading")
    spelled = leading.select("nth", F.posexplode("ids").alias("pos", "id")).join(named.select("id", "word"), "id")
    spelled = spelled.groupBy("nth").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("parts"))
    phrase = F.array_join(F.transform("parts", lambda p: p.word.cast("string")), " ")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = leading.join(spelled.select("nth", phrase.alias("phrase")), "nth").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    out = ranked.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_setm_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
word AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM piece),
gram AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i : i + k - 1], ' '))) AS phrase
  FROM word, (VALUES (1), (2), (3)) AS size(k) WHERE len(words) >= k),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {LEAST}),
parts AS (
  SELECT lang, phrase, k, a, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 :], ' ') AS tail
  FROM candidate, (VALUES (1), (2)) AS cuts(cut) WHERE cut < k),
scored AS (
  SELECT p.lang, p.phrase, p.k, p.a, h.a AS l, t.a AS r, (1000000::HUGEINT * p.a * p.a // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM parts p JOIN f h ON h.lang = p.lang AND h.phrase = p.head JOIN f t ON t.lang = p.lang AND t.phrase = p.tail
  QUALIFY row_number() OVER (PARTITION BY p.lang, p.phrase ORDER BY (1000000::HUGEINT * p.a * p.a // (h.a::HUGEINT * t.a)), cut) = 1),
inner_part AS (
  SELECT lang, array_to_string(w[x : x + 1], ' ') AS phrase, max(a) AS longer FROM candidate, (VALUES (1), (2)) AS places(x)
  WHERE k = 3 GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, encode(s.phrase)) AS rank, s.phrase, s.a, l, r, n, score
FROM scored s JOIN total USING (lang) LEFT JOIN inner_part i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE i.longer IS NULL OR 100 * i.longer < {COVERED} * s.a
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, encode(s.phrase)) <= {TOP}
"""
