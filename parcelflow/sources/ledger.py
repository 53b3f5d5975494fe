"""Loads that lose nothing: rows with an identity go to a partitioned table once, and a corrected row replaces its older self.

A ledger beside the table lists, for every load, the contents that came with each identity and where they went. A load reads the
ledger, not the table: contents seen before are left out, new identities are appended, and only partitions that hold an
older self of a corrected row are written anew. A marker stands while a load writes; a load that finds one
first adds to the ledger what the broken load had brought into the table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import stored
from parcelflow.sources import sinks
from parcelflow.sources.tables import read_table, table_exists

#: Partitions named one by one in a filter; more of them are joined, with the same rows.
NAMED_PARTITIONS = 10_000
#: Folders deleted at once.
DELETES = 16


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}-ledger"


def _content(names: list[str]) -> Column:
    """Hash of all columns; JSON also covers maps, which hash functions don't take."""
    return F.xxhash64(F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"}))


def _identified(rows: DataFrame, key: str) -> DataFrame:
    """Add _content and _key. A row without key is its own content."""
    marked = rows.withColumn("_content", _content(rows.columns))
    return marked.withColumn("_key", F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), F.concat(F.lit("content:"), F.col("_content").cast("string"))))


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)) if ":" in uri else spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _facts(identified: DataFrame, version: str, by: str, *more: str) -> DataFrame:
    return identified.select("_key", "_content", F.col(version).cast("string").alias("_version"), F.col(by).alias("_place"), *more)


def entries(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger of a table: _key, _content, _version, _place, _applied, _load."""
    return read_table(spark, ledger_path(path)) if table_exists(spark, ledger_path(path)) else None


def _add(facts: DataFrame, path: str, load: int) -> None:
    sinks.append(facts.withColumn("_load", F.lit(load).cast("long")), ledger_path(path))


def _recovered(spark: SparkSession, rows: DataFrame, path: str, by: str, key: str, version: str) -> None:
    """Add to the ledger the rows of the table that it doesn't list."""
    table = read_table(spark, path, schema=rows.schema)
    here = _facts(_identified(table, key), version, by).withColumn("_applied", F.lit(True))
    known = entries(spark, path)
    if known is not None:
        here = here.join(known.select("_key", "_content").distinct(), ["_key", "_content"], "left_anti")
    _add(here, path, _next_load(known))


def _next_load(known: DataFrame | None) -> int:
    last = known.agg(F.max("_load")).first()[0] if known is not None else None
    return 0 if last is None else last + 1


def _in_places(rows: DataFrame, by: str, places: DataFrame) -> DataFrame:
    """Rows of some partitions; only their files are read."""
    named = [r[0] for r in places.limit(NAMED_PARTITIONS + 1).collect()]
    if len(named) > NAMED_PARTITIONS:
        return rows.join(places, F.col(by).eqNullSafe(F.col("_place")), "left_semi")
    test = F.col(by).isin([x for x in named if x is not None])
    return rows.where(test | F.col(by).isNull() if None in named else test)


def load(rows: DataFrame, path: str, by: str, key: str = "id", version: str = "finished_at") -> None:
    """Bring ``rows`` into the table at ``path``, partitioned by ``by``: each ``key`` once, in its newest content.

    Content that an earlier load brought is left out. Other content of a known key replaces the row if its ``version`` isn't
    lower; of several in one load the highest counts, ties by content. Rows without key are told apart by content.
    """
    spark = rows.sparkSession
    files, marker = _path(spark, f"{ledger_path(path)}-open")
    if table_exists(spark, path) and (files.exists(marker) or entries(spark, path) is None):
        _recovered(spark, rows, path, by, key, version)
        files.delete(marker, True)
    arrived = stored(_identified(rows, key).withColumn("_row", F.monotonically_increasing_id()), "arrived")
    known = entries(spark, path)
    facts = _facts(arrived, version, by, "_row")
    if known is not None:
        facts = facts.join(known.select("_key", "_content").distinct(), ["_key", "_content"], "left_anti")
    facts = stored(facts, "new-content")
    if facts.isEmpty():
        return

    best = F.max(F.struct("_version", "_content", (-F.col("_row")).alias("_last"), "_place")).alias("b")
    chosen = facts.groupBy("_key").agg(best).select("_key", "b._version", "b._content", (-F.col("b._last")).alias("_row"), "b._place")
    if known is None:
        chosen = chosen.withColumn("_changed", F.lit(False)).withColumn("_old", F.lit(None).cast(chosen.schema["_place"].dataType))
    else:
        now = known.where("_applied").groupBy("_key").agg(F.max(F.struct("_load", "_version", "_place")).alias("c"))
        chosen = chosen.join(now, "_key", "left")
        newer = F.coalesce(F.col("_version"), F.lit("")) >= F.coalesce(F.col("c._version"), F.lit(""))
        chosen = chosen.where(F.col("c").isNull() | newer)
        chosen = chosen.select("_key", "_version", "_content", "_row", "_place", F.col("c").isNotNull().alias("_changed"), F.col("c._place").alias("_old"))
    chosen = stored(chosen, "chosen")
    brought = arrived.join(chosen.select("_row", "_changed"), "_row")
    changed = chosen.where("_changed")

    files.mkdirs(marker)
    if changed.isEmpty():
        with sinks.spread(spark, chosen.select("_place").distinct().count()):
            sinks.append(brought.select(rows.columns), path, [by])
    else:
        touched = stored(changed.select(F.explode(F.array("_old", "_place")).alias("_place")).distinct(), "touched")
        table = read_table(spark, path, schema=rows.schema).select("*", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_folder"))
        before = _in_places(table, by, touched)
        replaced = changed.select(F.substring("_key", 5, 1 << 30).alias("_replaced"))  # these have keys
        kept = before.join(replaced, F.col(key).cast("string") == F.col("_replaced"), "left_anti")
        staged = stored(kept.select(rows.columns).unionByName(_in_places(brought, by, touched).select(rows.columns)), "partitions")
        left = staged.select(F.col(by).alias("_left")).distinct()
        emptied = before.join(left, F.col(by).eqNullSafe(F.col("_left")), "left_anti").select("_folder").distinct()

        def delete(folder: str) -> None:
            store, at = _path(spark, folder)
            store.delete(at, True)

        # Partitions that lose their last row can't be overwritten.
        names = (row["_folder"] for row in emptied.toLocalIterator())
        with ThreadPoolExecutor(DELETES) as pool:
            while some := list(islice(names, NAMED_PARTITIONS)):
                list(pool.map(delete, some))
        with sinks.spread(spark, left.count()):
            sinks.overwrite_partitions(staged, path, [by])
        elsewhere = stored(brought.join(touched, F.col(by).eqNullSafe(F.col("_place")), "left_anti").select(rows.columns), "elsewhere")
        if not elsewhere.isEmpty():
            with sinks.spread(spark, elsewhere.select(by).distinct().count()):
                sinks.append(elsewhere, path, [by])
    applied = chosen.select("_row", F.lit(True).alias("_applied"))
    listed = facts.join(applied, "_row", "left").withColumn("_applied", F.coalesce("_applied", F.lit(False))).drop("_row")
    _add(listed.groupBy("_key", "_content", "_version", "_place").agg(F.max("_applied").alias("_applied")), path, _next_load(known))
    files.delete(marker, True)
