"""Quality rules with tokeniser fertility: how well a public vocabulary fits a text, against bands per language."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import kernel
from parcelflow.session import stored

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Width of the rejection bands: quartiles widened by this many interquartile ranges, and by a share of the median.
FENCE = 3.0
SLACK = 0.03
#: Short texts vary more: a band is this much wider, divided by the square root of the text's tokens. The entropy's floor
#: isn't, since the share of the possible entropy rises as texts get shorter.
SHORT_CHARS = 1.5
SHORT_BYTES = 0.5
LANES = 64

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")
_MEASURED = ", ".join(f"{c} long" for c in _COUNTS) + ", chars_per_token double, byte_share double, token_entropy double"


def repeated_words(hashes: np.ndarray, firsts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a ``width``-word window found twice or more in that text."""
    n = len(hashes)
    windows, whole = kernel.shingles(hashes, firsts, width)
    places = np.flatnonzero(whole)
    if not len(places):
        return np.zeros(len(firsts) - 1, dtype=np.int64)
    keys = kernel.mix(windows[places] + kernel.text_index(firsts)[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, places[twice], 1)
    np.add.at(edges, places[twice] + width, -1)
    return kernel.per_text((np.cumsum(edges[:-1]) > 0).astype(np.int64), firsts)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, for each text."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    begin = begin[begin < len(data)]
    if not len(begin):
        return np.zeros(n, dtype=np.int64)
    stop = np.append(begin[1:], len(data))
    text = np.searchsorted(offsets, begin, "right") - 1
    end = stop - (data[stop - 1] == 10)
    filled = np.searchsorted(starts, end, "left") > np.searchsorted(starts, begin, "left")
    begin, end, text = begin[filled], end[filled], text[filled]
    keys = kernel.span_hashes(sums, begin, end)
    order = np.lexsort((keys, text))
    again = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][1:][again], minlength=n)


def measure(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts and fertility in place of whole texts; the other columns of ``docs`` stay.

    Fertility takes the words only. An empty text has 0 characters per token, share 0 and entropy 0.
    token_entropy is that of the text's token distribution in bits, divided by the most that so many tokens
    could have; texts of one token have 0.
    """

    def build():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        is_byte = np.array([model.is_byte(k) for k in range(model.get_piece_size())])
        table = kernel.WordTable(lambda found: model.encode([w.decode("utf-8", "replace") for w in found], num_threads=1))

        def work(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
            n = len(offsets) - 1
            starts, ends, firsts = kernel.words(data, offsets)
            sums = kernel.prefix_sums(data)
            hashes = kernel.span_hashes(sums, starts, ends)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            chars = kernel.per_text(points[ends] - points[starts], firsts)
            symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[data])))

            begin, size = table.lookup(data, starts, ends, hashes)
            ids = table.ids[kernel.slices_of(begin, size)]
            tokens = kernel.per_text(size, firsts)
            text = np.repeat(np.arange(n), tokens)
            byte_tokens = np.bincount(text[is_byte[ids]], minlength=n)
            pairs, times = np.unique(text.astype(np.uint64) << np.uint64(20) | ids.astype(np.uint64), return_counts=True)
            owner = (pairs >> np.uint64(20)).astype(np.int64)
            share = times / np.maximum(tokens[owner], 1)
            entropy = np.bincount(owner, weights=-share * np.log2(share), minlength=n)
            counts = (
                np.diff(firsts),
                chars,
                symbols[offsets[1:]] - symbols[offsets[:-1]],
                duplicate_lines(data, offsets, starts, sums),
                repeated_words(hashes, firsts),
                tokens,
                byte_tokens,
            )
            least = np.maximum(tokens, 1)
            return [*(c.astype(np.int64) for c in counts), chars / least, byte_tokens / least, entropy / np.log2(np.maximum(tokens, 2))]

        return work

    return kernel.map_texts(docs, build, _MEASURED)


def bands(measured: DataFrame) -> DataFrame:
    """Rejection bands per language, from all documents that pass the base rules: one row per language.

    Characters per token have a floor and a ceiling, the byte-fallback share a ceiling, the entropy a floor.
    """

    def quartile(c: str, q: float):
        return F.percentile_approx(c, F.lit(q), F.lit(2000))

    found = measured.where(~F.col("base_failed")).groupBy("_lang").agg(
        *(quartile(c, q).alias(f"{c}_{k}") for c in ("chars_per_token", "byte_share", "token_entropy") for k, q in (("low", 0.25), ("mid", 0.5), ("high", 0.75)))
    )

    def fence(c: str, up: bool):
        spread = F.col(f"{c}_high") - F.col(f"{c}_low")
        room = spread * FENCE + F.col(f"{c}_mid") * SLACK
        return F.col(f"{c}_high") + room if up else F.col(f"{c}_low") - room

    return found.select(
        "_lang",
        fence("chars_per_token", False).alias("least_chars"),
        fence("chars_per_token", True).alias("most_chars"),
        (fence("byte_share", True) + F.lit(0.02)).alias("most_bytes"),
        fence("token_entropy", False).alias("least_entropy"),
    )


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: its key, the counts, the fertility measures, base_failed and kept.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT of the words in repeated windows.
    kept: not base_failed and inside the bands of its language. Null or empty text: all counts 0, base_failed. A
    null language is a language of its own; bands come from all its documents that pass the base rules. Repeated
    rows are judged each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang")
    )
    few, repeats = F.col("n_words") < MIN_WORDS, F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    measured = stored(measure(rows).withColumn("base_failed", few | repeats), "measured")
    root = F.sqrt(F.greatest("n_tokens", F.lit(1)))
    inside = (
        (F.col("chars_per_token") >= F.col("least_chars") - F.lit(SHORT_CHARS) / root)
        & (F.col("chars_per_token") <= F.col("most_chars") + F.lit(SHORT_CHARS) / root)
        & (F.col("byte_share") <= F.col("most_bytes") + F.lit(SHORT_BYTES) / root)
        & (F.col("token_entropy") >= F.col("least_entropy"))
    )
    # Most documents may share one language: each band is there LANES times, and documents take turns.
    wide = bands(measured).withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    measured = measured.withColumn("_lane", F.pmod(F.xxhash64("doc_id", "n_tokens", "word_chars"), F.lit(LANES)).cast("int"))
    judged = measured.join(wide, ["_lang", "_lane"], "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        "n_tokens", "chars_per_token", "byte_share", "token_entropy",
    )


def op8_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return judge(spark.read.parquet(f"{folder}/documents.parquet"))
