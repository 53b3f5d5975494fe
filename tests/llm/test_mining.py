"""Mixing, hard negatives and phrases: odd inputs and plain versions."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import collocations, kernel, mixing, negatives

ODD = [
    (1, "a b c", "x"),
    (2, "a b c", None),
    (3, None, "x"),
    (4, "", None),
    (5, " \n\t ", "é"),
    (6, "one", "y"),
    (6, "one", "y"),
    (None, "p q", "y"),
    (None, None, None),
    (7, "w " * 30_000, "z"),
    (8, "x" * 50_000, "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string").repartition(3)
    clashing = "size place target copies taken _u _level _order _extra rank phrase a l r n score id ids word anchor slot w1 nth".split()
    return rows.withColumn("lang", F.when(F.col("doc_id") > 3, "xx")).withColumns({c: F.lit("clash") for c in clashing})


# Mixing


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(fixed.values())
        aim = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if aim[s] > most * sizes[s]}
        if not over:
            return {**fixed, **aim}
        fixed |= {s: most * sizes[s] for s in over}
        free -= over
    return fixed


def test_mix_of_odd_rows(spark, odd):
    rows = mixing.mix(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted((d is None, d or 0, len((t or "").split())) for d, t, _ in ODD)
    sizes = collections.Counter()
    for _, text, source in ODD:
        sizes[source] += len((text or "").split())
    want = shares(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    assert mixing.mix(odd.limit(0)).count() == 0


@pytest.fixture(scope="module")
def many(spark):
    pick = random.Random(5)
    rows = [(k, "w " * int(pick.paretovariate(0.8) % 3000), f"s{min(int(pick.expovariate(1)), 4)}", pick.choice([0.5, 1.0, 2.0, 4.0])) for k in range(6000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, preference double").cache()


def test_sources_come_near_their_targets(many):
    for weight in (None, "preference"):
        mixed = mixing.mix(many, weight=weight).cache()
        for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect():
            assert abs(r.taken - r.target) <= 0.005 * r.target + 20 and r.most <= 3
        again = mixing.mix(many.repartition(7), weight=weight)
        assert mixed.exceptAll(again).isEmpty() and again.exceptAll(mixed).isEmpty()


def test_copies_follow_the_chances(many):
    """Documents of one chance have the certain copies, or one more."""
    few = many.where("doc_id < 300")
    rows = mixing.mix(few, weight="preference").collect()
    by = collections.defaultdict(set)
    for r in rows:
        by[(r.source, round(r.inclusion, 9))].add(r.copies)
    assert all(max(c) - min(c) <= 1 for c in by.values())


def test_greater_odds_come_first(spark):
    rows = spark.createDataFrame([(k, "w", "s", 3.0 if k % 2 else 1.0) for k in range(4000)], "doc_id long, text string, source string, preference double")
    mixed = mixing.mix(rows, share=0.25, weight="preference")
    taken = {r.odd: r.n for r in mixed.groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).collect()}
    assert taken[0] + taken[1] == 1000 and 690 <= taken[1] <= 810  # 750 are expected


# Hard negatives


def mined(rows):
    usable = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, label, v in usable:
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), math.inf if b is None else b, m == label) for b, m, w in usable]
        for p, b, _ in sorted(x for x in scored if x[2] and x[1] != a)[:5]:
            fits = sorted((s, n) for s, n, same in scored if not same and 30 * -p <= 100 * -s <= 90 * -p)[:10]
            out += [(a, b, k + 1, n, -p, -s) for k, (s, n) in enumerate(fits)]
    return sorted(out)


def vectors(n, seed, spread=1.0):
    pick = random.Random(seed)
    rows = [(k, pick.randrange(3), [float(np.float32(abs(pick.gauss(0.3, spread)))) for _ in range(6)]) for k in range(n)]
    rows += [(n + k, 1, [1.0] * 6) for k in range(40)]  # ties
    return rows


def plain(df):
    return sorted(tuple(math.inf if x is None else x for x in r) for r in df.collect())


SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("slice_anchors", [10_000, 2])
def test_negatives_of_odd_rows(spark, monkeypatch, slice_anchors):
    monkeypatch.setattr(negatives, "SLICE_ANCHORS", slice_anchors)
    rows = vectors(500, 1) + [(1000, 1, [0.5] * 6), (1100, None, [1.0] * 6), (1200, 1, None), (1300, 1, []), (1400, 2, [float("nan")] * 6), (1500, 2, [1.0, None])]
    rows += [(None, 0, [1.0] * 6), (1600, 2, [float("inf")] * 6), (1700, 0, [2.0] * 9), (1800, 1, [1.0, 2.0]), (1900, 1, [-1.0] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit("clash") for c in ("anchor", "vector", "slice", "slot", "score", "nth", "w")})
    assert plain(negatives.hard_negatives(df)) == mined(rows)
    assert negatives.hard_negatives(df.limit(0)).count() == 0


def test_repeated_rows_and_large_components(spark):
    rows = vectors(150, 2) + vectors(150, 2)[:30]
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))
    assert plain(got) == mined(rows)
    large = [(k, k % 2, [float(1 << 16) * (k + 1) + 0.25, 3.0]) for k in range(101)]
    double = spark.createDataFrame(large, "vec_id long, label int, embedding array<double>")
    assert plain(negatives.hard_negatives(double)) == mined(large)
    beyond = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300]), (2, 0, [1e300])], "vec_id long, label int, embedding array<double>")
    assert negatives.hard_negatives(beyond).count() == 0


def test_products_are_exact():
    pick = np.random.default_rng(3)
    for top in (200, 1 << 20, 1 << 30):
        a, b = (np.floor(pick.uniform(-top, top, (5, 7))) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
        assert negatives.products(a, b).astype(np.int64).tolist() == want


# Phrases


def phrases(rows, longest=3, least=10, covered=50, top=2000):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    dropped = set()
    for (lang, g), f in candidates.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                if 100 * f >= covered * counts[lang, g[i : i + k]]:
                    dropped.add((lang, g[i : i + k]))
    out = collections.defaultdict(list)
    for (lang, g), a in candidates.items():
        if (lang, g) not in dropped:
            cuts = [(10**6 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted((lang, k + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, found in out.items() for k, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def wordy(seed, n=120):
    pick = random.Random(seed)
    words = "Ab ab cd EF ef, gh. ij; é 中文 x1\tk:l m!n o?p\nq\x0br".split(" ")
    return [(" ".join(pick.choices(words, weights=range(1, len(words) + 1), k=pick.randrange(60))), pick.choice(["en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize(("longest", "least"), [(3, 10), (2, 3), (4, 4)])
def test_phrases_equal_the_plain_version(spark, longest, least, monkeypatch):
    monkeypatch.setattr(collocations, "COUNTED", 300)  # several counts a batch
    rows = wordy(longest) + [(None, "en"), ("", "en"), (" . \n", None), ("A b " * 3000, "long"), ("z" * 40_000, "en")] + wordy(9, 20) * 2
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns({c: F.lit("clash") for c in ("id", "ids", "word", "n", "a", "rank", "w1", "cut", "nth")})
    got = sorted(tuple(r) for r in collocations.collocations(df, longest, least, top=40).collect())
    assert got == phrases(rows, longest, least, top=40) and len(got) > 10
    assert collocations.collocations(df.limit(0)).count() == 0


def test_pieces_and_words():
    column = pa.array(["a b.c", "d", None, "e,,f\x0bg\th", "."])
    (_, _, data, offsets), *_ = kernel.chunks(column)
    starts, ends, firsts, opens = collocations.piece_words(data, offsets)
    assert [bytes(data[s:e]).decode() for s, e in zip(starts, ends, strict=True)] == list("abcdefgh")
    assert opens.tolist() == [True, False, True, True, True, True, True, False] and firsts.tolist() == [0, 3, 4, 4, 8, 8]


def test_words_with_one_id_are_counted_again(spark, monkeypatch):
    """Should two words share an id, other ids are used."""
    true = collocations._salt
    monkeypatch.setattr(collocations, "occurrences", lambda docs, salt, own=collocations.occurrences: _collided(own(docs, salt)) if salt == 0 else own(docs, salt))
    rows = [("a b c d", "en")] * 12
    got = sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "text string, lang string")).collect())
    assert got == phrases(rows) and collocations._salt is true


def _collided(table):
    return table.withColumn("id", F.when(F.col("id").isNotNull(), F.lit(7)))


def test_scores_beyond_64_bits(spark):
    row = spark.range(1).select(collocations._score(F.lit(9 * 10**12), F.lit(9 * 10**12 + 1), F.lit(10**13)).alias("s")).first()
    assert row.s == 10**6 * (9 * 10**12) ** 2 // ((9 * 10**12 + 1) * 10**13)
