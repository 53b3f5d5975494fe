"""Toxicity by class-conditional Kneser-Ney models over words.

Two bigram models, of toxic and of ordinary texts, interpolate discounted counts with continuation counts, and
those with continuation counts that both classes share, so that an expression rare in both says nothing. A
text's features are length-normalised log-likelihood ratios; a logistic curve turns them into a score.
Counts cover all training rows. Words and word pairs are hashed to tables of fixed size, so the model that is
sent to the tasks has the same size whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.llm.keys import likely
from parcelflow.llm.words import bare_words
from parcelflow.session import stored

#: Buckets of words, and of word pairs (a prime); together they bound the model to about 12 MB.
WORD_BITS = 18
PAIR_BUCKETS = 524_287
#: Taken off each count of kinds. Pairs lose a whole count, so one seen once speaks through its words alone.
DISCOUNT = 0.75
PAIR_DISCOUNT = 1.0
#: The curve is fitted on at most about so many training rows, each scored by counts of the half it isn't in.
CURVE_ROWS = 20_000
#: Words of the spans whose best mean ratio is a feature, beside the means over the text.
SPANS = (1, 4, 16)
FEATURES = 2 + len(SPANS)
_WORD_MASK = (1 << WORD_BITS) - 1

_START = np.uint64(0x5EED)


def pair_ids(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word and of the word before it (a text starts after a marker)."""
    word = hashes >> np.uint64(64 - WORD_BITS)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    heads = firsts[:-1]
    before[heads[heads < len(before)]] = _START & np.uint64((1 << WORD_BITS) - 1)
    return before, word


def pair_bucket(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return ((before << np.uint64(WORD_BITS) | word) % np.uint64(PAIR_BUCKETS)).astype(np.int64)


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def pair_counts(rows: DataFrame) -> DataFrame:
    """Counts of word pairs over all rows of (half, toxic, text): context, word, and n0 and n1 of the two halves.

    A context is a word's bucket with the class above it. Pairs are counted in each chunk, then moved by context, so
    all pairs of a context meet, those of both halves too; they are as many as there are word buckets at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(1).to_numpy().astype(np.uint64)
            for i, j, data, offsets in kernel.chunks(batch.column(0)):
                hashes, firsts = bare_words(data, offsets)
                before, word = pair_ids(hashes, firsts)
                own = group[i:j][kernel.text_index(firsts)]
                context, place = (own & np.uint64(1)) << np.uint64(WORD_BITS) | before, (own >> np.uint64(1)) << np.uint64(WORD_BITS) | word
                pairs, n = np.unique(context << np.uint64(32) | place, return_counts=True)
                columns = (pairs >> np.uint64(32)).astype(np.int32), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32), n.astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["context", "word", "n"])

    grouped = rows.select("text", (F.col("half") * 2 + F.col("toxic")).cast("int").alias("group"))
    found = grouped.mapInArrow(count, "context int, word int, n int")
    half, word = F.shiftright("word", WORD_BITS), F.col("word").bitwiseAND(F.lit(_WORD_MASK))
    sides = (F.when(half == k, F.col("n")).otherwise(0).alias(f"n{k}") for k in (0, 1))
    moved = found.repartition("context").select("context", word.alias("word"), *sides)
    return moved.groupBy("context", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass(frozen=True)
class Model:
    """Log-ready tables of both classes (row 0 ordinary, row 1 toxic) and the weights of the curve.

    pair_counts are already less the discount of each pair, so that a context's pairs and its kinds add up to its count.
    """

    pair_counts: np.ndarray
    context_counts: np.ndarray
    context_kinds: np.ndarray
    unigram: np.ndarray
    word_ratio: np.ndarray
    weights: np.ndarray

    def ratios(self, hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic over ordinary log-likelihood of each word: after the word before it, and by continuation alone."""
        before, word = pair_ids(hashes, firsts)
        bucket = pair_bucket(before, word)
        before, word = before.astype(np.int64), word.astype(np.int64)
        logs = []
        for c in (0, 1):
            total = np.maximum(self.context_counts[c][before], 1)
            own = self.pair_counts[c][bucket]
            back = np.where(self.context_counts[c][before] > 0, PAIR_DISCOUNT * self.context_kinds[c][before] / total, 1.0)
            logs.append(np.log(own / total + np.minimum(back, 1) * self.unigram[c][word]))
        return logs[1] - logs[0], self.word_ratio[word]


def features(ratios: tuple[np.ndarray, np.ndarray], firsts: np.ndarray) -> np.ndarray:
    """Per text: mean ratio of pairs and of words, and the best mean over spans of each width; zeros without words."""
    pairs, own = ratios
    sums = np.concatenate(([0.0], np.cumsum(own, dtype=np.float64)))
    sizes = np.diff(firsts)
    out = np.zeros((len(sizes), FEATURES))
    least = np.maximum(sizes, 1)
    out[:, 0] = kernel.per_text(pairs, firsts) / least
    out[:, 1] = (sums[firsts[1:]] - sums[firsts[:-1]]) / least
    filled = np.flatnonzero(sizes)
    if len(filled):
        last = np.repeat(firsts[1:], sizes)
        place = np.arange(len(own))
        for k, width in enumerate(SPANS):
            # a span cut short by the end of its text is filled up with words that say nothing
            value = (sums[np.minimum(place + width, last)] - sums[place]) / width
            out[filled, k + 2] = np.maximum.reduceat(value, firsts[:-1][filled])
    return np.clip(out, -20, 20)


def tables(counts: DataFrame) -> list[dict[str, np.ndarray]]:
    """Count tables of the first half, the second half and both, of both classes, from pair_counts.

    A pair that both halves have is one kind, and its sightings in both add up before the discount is taken. Contexts,
    words and pairs are summed in one aggregation, so the pairs are moved once. The result has at most one row
    for each bucket of each table.
    """
    context, word = F.col("context").cast("long"), F.col("word").cast("long")
    toxic, before = F.shiftright(context, WORD_BITS), context.bitwiseAND(F.lit(_WORD_MASK))
    pair = F.pmod(F.shiftleft(before, WORD_BITS).bitwiseOR(word), F.lit(PAIR_BUCKETS))
    n = [F.col("n0"), F.col("n1")]
    seen = [(x > 0).cast("long") for x in n]
    beyond = [F.greatest(x - int(PAIR_DISCOUNT), F.lit(0)) for x in n]
    shared = seen[0] * seen[1]  # where both halves have a pair, its discount is taken once

    def entry(kind: int, key: Column, *values: Column) -> Column:
        place = F.shiftleft(toxic + kind * 2, 20).bitwiseOR(key).alias("place")
        return F.struct(place, *(v.cast("long").alias(name) for v, name in zip(values, "abcd", strict=True)))

    none = F.lit(0)
    entries = F.array(entry(0, before, *n, *seen), entry(1, word, *seen, none, none), F.when(n[0] + n[1] > 1, entry(2, pair, *beyond, shared, none)))
    rows = counts.select(F.explode(F.array_compact(entries)).alias("e")).select("e.*")
    found = rows.groupBy("place").agg(*(F.sum(c).alias(c) for c in "abcd"), F.count("*").alias("kinds")).toArrow()
    place, a, b, c, d, kinds = (found[name].to_numpy() for name in ("place", "a", "b", "c", "d", "kinds"))
    group, key = place >> 20, place & ((1 << 20) - 1)
    columns = (
        ("context_counts", 0, 1 << WORD_BITS, (a, b, a + b)),
        ("context_kinds", 0, 1 << WORD_BITS, (c, d, kinds)),
        ("continuations", 1, 1 << WORD_BITS, (a, b, kinds)),
        ("pair_counts", 2, PAIR_BUCKETS, (a, b, a + b + int(PAIR_DISCOUNT) * c)),
    )
    out = []
    for part in range(3):
        arrays = {}
        for name, kind, size, values in columns:
            arrays[name] = np.zeros((2, size), dtype=np.float32)
            for toxic_class in (0, 1):
                own = group == kind * 2 + toxic_class
                arrays[name][toxic_class, key[own]] = values[part][own]
        out.append(arrays)
    return out


def model_of(found: dict[str, np.ndarray]) -> Model:
    """Kneser-Ney unigrams of each class over the continuation counts shared by both classes."""
    kinds = found["continuations"].astype(np.float64)
    both = kinds.sum(axis=0)
    shared = (both + 1) / (both.sum() + len(both))
    total = np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    seen = (kinds > 0).sum(axis=1, keepdims=True)
    back = np.where(kinds.sum(axis=1, keepdims=True) > 0, DISCOUNT * seen / total, 1.0)
    unigram = np.maximum(kinds - DISCOUNT, 0) / total + back * shared
    return Model(
        found["pair_counts"],
        found["context_counts"],
        found["context_kinds"],
        unigram.astype(np.float32),
        np.log(unigram[1] / unigram[0]).astype(np.float32),
        np.zeros(1 + FEATURES),
    )


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps: intercept first. Without both classes the score is the class share.

    Features are measured by their spread, so that the ridge weighs the same on all of them.
    """
    spread = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0) if len(x) else np.ones(x.shape[1])
    x = np.column_stack((np.ones(len(x)), x / spread))
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else 0.0
        return w
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w / np.append(1.0, spread)


def _featured(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)  # fixed size, see WORD_BITS and PAIR_BITS

    def build():
        known = shared.value

        def work(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
            hashes, firsts = bare_words(data, offsets)
            x = features(known.ratios(hashes, firsts), firsts)
            return [*x.T.copy(), np.diff(firsts).astype(np.int64)]

        return work

    return kernel.map_texts(rows, build, ", ".join(f"f{k} double" for k in range(FEATURES)) + ", n_words long")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of the labelled rows that aren't held out. Several labels of one document count as toxic if any is."""
    fit = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = fit.groupBy("doc_id").agg(F.when(F.max("toxic") > 0, 1).otherwise(0).alias("toxic"))
    known = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")  # copies stay together
    # Labels grow with the data, so they are never sent to all tasks, not even where they are few.
    rows = likely(known, marks, "doc_id").join(marks.hint("merge"), "doc_id").select("text", "toxic", half.alias("half"))
    first, second, both = tables(pair_counts(rows))
    keep = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < -(-1_000_000 * CURVE_ROWS // max(marks.count(), CURVE_ROWS))
    few = marks.where(keep)  # about CURVE_ROWS labels
    sample = stored(likely(known, few, "doc_id").join(few.hint("merge"), "doc_id").select("text", "toxic", half.alias("half")), "curve")
    found = []
    for k, other in ((0, second), (1, first)):
        found.append(_featured(sample.where(F.col("half") == k), model_of(other)).toPandas())
    sample = pd.concat(found)
    weights = fit_curve(sample[[f"f{k}" for k in range(FEATURES)]].to_numpy(), sample["toxic"].to_numpy())
    return replace(model_of(both), weights=weights)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_words.

    Null and empty texts have no words and get the curve's value at zero ratios. Repeated rows are scored each;
    null doc_ids are kept; an empty table gives no rows; other columns are ignored.
    """
    w = model.weights
    rows = _featured(docs.select("doc_id", "text"), model)
    z = F.lit(float(w[0]))
    for k in range(FEATURES):
        z = z + F.col(f"f{k}") * F.lit(float(w[k + 1]))
    rows = rows.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "n_words"
    )


def op1_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return score(docs, train(docs, spark.read.parquet(f"{folder}/labels.parquet")))
