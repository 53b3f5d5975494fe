"""Registered queries on the given tables: against SQL where there is one, else against brute force."""

import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from parcelflow.llm import chosen_path, queries
from tests.compare import database, difference
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_all_are_registered():
    assert {int(q[2:].split("_")[0]) for q in queries.QUERIES} == set(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries()) and set(queries.SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert difference(spark, database(SMALL), SMALL, name) is None


def test_suffix_array(spark, texts):
    rows = sorted(contract.queries()["op2_suffix_array"](spark, SMALL).collect())
    want = brute.without_repeats([(texts[d] or "").encode() for d in sorted(texts)], 400)
    assert [r.doc_id for r in rows] == sorted(texts) and [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
    assert all(r.has_repeats == (r.n_removed > 0) for r in rows)


def test_chosen_path(spark, texts):
    rows = contract.queries()["op9_chosen_path"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.near_components(texts)


def test_quality(spark, texts):
    rows = contract.queries()["op8_fertility"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(texts[r.doc_id])


@pytest.mark.parametrize("name", ["op1_kneser_ney", "op5_warc", "op7_best_fit", "op10_feistel_shards"])
def test_one_row_per_input(spark, texts, name):
    rows = contract.queries()[name](spark, SMALL).collect()
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").count()
    if name == "op7_best_fit":
        assert {r.doc_id for r in rows} == set(texts)
    else:
        assert len(rows) == (pages if name == "op5_warc" else len(texts))


def test_leaks_are_found(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    rows = contract.queries()["op6_simhash_windows"](spark, SMALL).collect()
    planted = {(d, i) for d, t in texts.items() for i, item in items.items() if item in (t or "")}
    assert planted <= {(r.doc_id, r.item_id) for r in rows} and all(r.similarity >= 0.8 for r in rows)


def test_pipeline_stage_by_stage(spark, texts, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns
    kept = {r.doc_id: r.text for r in left["quality_rules"].collect()}
    assert all(not brute.base_rules(t)[-1] for t in kept.values())
    wanted = {d for d, (_, root) in brute.near_components(kept, corpus_pipeline.SHINGLE_WORDS).items() if d == root}
    once = {r.doc_id: r.text for r in left["near_dedup"].collect()}
    assert set(once) == wanted
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {r.doc_id: r for r in left["benchmark_decontamination"].collect()}
    assert all(item not in r.text for r in clean.values() for item in items)
    assert all(r.n_chars == len(r.text) or texts[r.doc_id] == r.text for r in clean.values())
    assert {r.doc_id for r in left["best_fit_packing"].collect()} == set(clean)


def test_pipeline_of_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (None, "word " * 5, None, None, None), (2, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{len(table)}-{name}")
            stage(spark, docs, SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() == 0


def test_each_stage_takes_odd_rows(spark, texts, tmp_path):
    """Nulls, repeated ids with equal and other texts, a long text and the operators' own column names reach every stage."""
    own = [t for t in texts.values() if t and not brute.base_rules(t)[-1]][:12]
    rows = [(k, t) for k, t in enumerate(own)] + [(0, own[0]), (0, own[1] + " and more"), (None, own[2]), (None, own[3]), (50, " ".join(own) * 3), (51, None), (52, "")]
    names = ["_row", "_id", "_spans", "_maybe", "_place", "_block", "_bits", "begin", "end", "key", "node", "class", "rest"]
    table = spark.createDataFrame([(k, t, "en", "s", len(t or ""), *names) for k, t in rows], ["doc_id", "text", "lang", "source", "n_chars", *names])
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            got = out.collect()
            assert all([r[n] for n in names] == names for r in got), name
            assert docs is not table or len(got) >= 6, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
        assert len(packed) >= (len(rows) if docs is table else 0)


def test_texts_with_one_id_are_cut_by_their_own_spans(spark):
    """Two texts of one id share a passage with an earlier document at different places; neither is cut at the other's."""
    pick = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    passage, one, two, three = (" ".join(pick.choice(words) for _ in range(n)) for n in (80, 40, 90, 60))
    rows = [(1, f"{one} {passage}"), (7, f"é {two} {passage} tail"), (7, f"{three} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.text for r in corpus_pipeline.substring_dedup(spark, docs, SMALL).collect()}
    assert f"{one} {passage}" in got
    assert any(t.startswith(f"é {two}") and t.endswith("tail") and passage not in t for t in got)
    assert any(t.startswith(three) and passage not in t for t in got)


def test_root_is_the_smallest_id(spark):
    docs = spark.createDataFrame([(9, "a b c d"), (4, "a b c d"), (7, "a b c d")], "doc_id long, text string")
    assert {tuple(r)[2:] for r in chosen_path.near_duplicates(docs).collect()} == {(4, False), (4, True)}
