"""Loads by identity: nothing is lost, nothing comes twice."""

import os

from pyspark.sql import functions as F

from parcelflow.sources import ledger, sinks, tables

SCHEMA = "id string, finished_at string, note string, visits map<string,int>, half string"


def rows_of(spark, path):
    return sorted((tuple(r) for r in tables.read_table(spark, path, schema=SCHEMA).select("id", "finished_at", "note", "half").collect()), key=repr)


def loaded(spark, path, *rows):
    ledger.load(spark.createDataFrame([(i, at, note, {"b": 1, "a": 2}, half) for i, at, note, half in rows], SCHEMA), path, "half")
    return rows_of(spark, path)


def test_loads_keep_add_and_correct(spark, tmp_path):
    path = str(tmp_path / "answers")
    one, two = ("1", "t1", "x", "h1"), ("2", "t1", "y", "h1")
    assert loaded(spark, path, one) == [one]
    assert loaded(spark, path, two, one) == [one, two]  # the half hour keeps its first answer
    files = {f for _, _, names in os.walk(path) for f in names}
    assert loaded(spark, path, one, two, two) == [one, two]
    assert files == {f for _, _, names in os.walk(path) for f in names}  # a repeated load writes nothing
    better = ("1", "t2", "z", "h2")
    assert loaded(spark, path, better, one) == sorted([better, two], key=repr)
    assert loaded(spark, path, one) == sorted([better, two], key=repr)  # the old content was seen
    assert loaded(spark, path, ("1", "t0", "stale", "h1")) == sorted([better, two], key=repr)
    moved = ("1", "t3", "z", None)
    assert loaded(spark, path, moved) == sorted([moved, two], key=repr)
    assert not os.path.exists(f"{path}/half=h2")  # its last row has gone
    assert loaded(spark, path, ("2", "t1", "same time, later load", "h1"), ("3", "t1", "n", "a b:c")) == sorted(
        [moved, ("2", "t1", "same time, later load", "h1"), ("3", "t1", "n", "a b:c")], key=repr
    )
    assert ("3", "t2", "n", "h1") in loaded(spark, path, ("3", "t2", "n", "h1"))
    assert not os.path.exists(f"{path}/half=a b%3Ac")


def test_rows_without_identity_count_by_content(spark, tmp_path):
    path = str(tmp_path / "answers")
    a, b = (None, None, "x", "h1"), (None, "t1", "x", "h1")
    assert loaded(spark, path, a, a, b) == sorted([a, b], key=repr)
    assert loaded(spark, path, b, a) == sorted([a, b], key=repr)
    assert loaded(spark, path) == sorted([a, b], key=repr)


def test_of_several_contents_the_newest_counts(spark, tmp_path):
    path = str(tmp_path / "answers")
    assert loaded(spark, path, ("1", "t1", "x", "h1"), ("1", "t2", "y", "h2"), ("1", None, "w", "h1")) == [("1", "t2", "y", "h2")]
    assert loaded(spark, path, ("1", "t1", "x", "h1")) == [("1", "t2", "y", "h2")]


def test_a_broken_load_is_taken_up(spark, tmp_path, monkeypatch):
    """The executor writes the table, then the driver dies before the ledger follows."""
    path = str(tmp_path / "answers")
    one, two = ("1", "t1", "x", "h1"), ("2", "t1", "y", "h1")
    loaded(spark, path, one)
    monkeypatch.setattr(ledger, "_add", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        loaded(spark, path, two)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert rows_of(spark, path) == [one, two]
    assert loaded(spark, path, two, one) == [one, two]
    assert not os.path.exists(f"{path}-ledger-open")


def test_a_table_without_ledger_gets_one(spark, tmp_path):
    path = str(tmp_path / "answers")
    one = ("1", "t1", "x", "h1")
    sinks.append(spark.createDataFrame([("1", "t1", "x", {"b": 1, "a": 2}, "h1")], SCHEMA), path, ["half"])
    assert loaded(spark, path, one, ("2", "t1", "y", "h1")) == [one, ("2", "t1", "y", "h1")]


def test_many_touched_partitions_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "NAMED_PARTITIONS", 1)
    path = str(tmp_path / "answers")
    loaded(spark, path, *[(str(k), "t1", "x", f"h{k % 3}") for k in range(9)])
    got = loaded(spark, path, *[(str(k), "t2", "y", f"h{(k + 1) % 3}") for k in range(4)])
    assert got == sorted([(str(k), "t2", "y", f"h{(k + 1) % 3}") for k in range(4)] + [(str(k), "t1", "x", f"h{k % 3}") for k in range(4, 9)], key=repr)


def test_many_folders_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(150).select(F.concat(F.lit("run-"), "id").alias("id"), F.lit("2024").alias("finished_at"), F.concat(F.lit("d"), "id").alias("place"))
    later = rows.withColumn("finished_at", F.lit("2025")).withColumn("place", F.concat(F.lit("e"), "id"))
    for arrived, first in ((rows, "d"), (later, "e")):  # the second load empties all folders and fills new ones
        ledger.load(arrived, f"{tmp_path}/lines", "place")
        files = list((tmp_path / "lines").glob("place=*/part-*"))
        assert len(files) == 150 and all(f.parent.name.startswith(f"place={first}") for f in files)
        assert len({f.name.split("-")[1] for f in files}) > 1
    assert spark.read.parquet(f"{tmp_path}/lines").where("finished_at = '2025'").count() == 150
