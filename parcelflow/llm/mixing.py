"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies. Its whole part is certain; for the rest documents are ranked by
random odds divided by inclusion odds, and the first of the ranking are taken until the words they bring are as near
as possible to those expected. Large documents are ranked before small ones, and what they miss or exceed is passed
on, so that a source ends within half a small document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.operators.slices import running_totals
from parcelflow.session import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, over and over.
WEIGHTS = (5, 2, 1)
#: Copies of a document at most, and of a source's words.
MOST = 3
#: Documents above these shares of their source's target are ranked first, one size after the other.
STEPS = (1 / 32, 1 / 1024)
#: Rows of a slice of the ranking, about; a ranking has LEAST_SLICES at least.
SLICE_ROWS = 100_000
LEAST_SLICES = 16
#: Names the random numbers; another one gives another sample.
SEED = 1


def levels(rows: DataFrame, total: Column, cap: str, rate: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_level``: the height at which ``rate * _level``, never above ``cap``, adds up to ``total`` in each group.

    What capped rows leave over is shared again by rate among the others. In order of cap / rate the height that
    results if all rows before are capped rises up to the first row that isn't, and falls after it; so the greatest is it.
    """
    order = Window.partitionBy(*by).orderBy(F.col(cap) / F.col(rate), rate, cap)
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(rate).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    found = rows.where(F.col(rate) > 0).withColumn("_height", (total - before) / left)
    return found.withColumn("_level", F.max("_height").over(Window.partitionBy(*by))).drop("_height")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """One row per source: source, place (from 0, by code point, null last), source_size, target.

    All but the sums is work on one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ready = placed.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most)
    total = F.sum("source_size").over(Window.partitionBy()) * share
    leveled = levels(ready.withColumn("_total", total), F.col("_total"), "_cap", "_weight")
    target = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight"))
    return leveled.select("source", "place", "source_size", target.alias("target"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with _so_far: the words up to each in the Pareto order of its source and step."""
    u, p = F.col("_u"), F.col("inclusion")
    keyed = rows.withColumn("_order", (u / (1 - u)) / (p / (1 - p)))
    slices = max(LEAST_SLICES, -(-rows.count() // SLICE_ROWS))
    summed = running_totals(keyed, ["place", "_step"], ["_order", "_u", "doc_id", "size"], {"_so_far": "size"}, slices=slices)
    return stored(summed.withColumn("_so_far", F.col("_so_far").cast("double")), "ranked")


def _cuts(ranked: DataFrame) -> DataFrame:
    """(place, _step, _cut): where each ranking ends. It is the place nearest to the words expected of the step, and to what steps before missed."""
    words = ranked.groupBy("place", "_step", "inclusion").agg(F.sum("size").alias("_words"))  # whole numbers first, so sums don't depend on order
    expected = stored(words.groupBy("place", "_step").agg(F.sum(F.col("_words") * F.col("inclusion")).alias("_expects")), "expected")
    cuts, missing = None, None
    for k in range(len(STEPS) + 1):
        here = expected.where(F.col("_step") == k).drop("_step")
        want = here.withColumn("_missing", F.lit(0.0)) if missing is None else here.join(missing, "place", "full")
        want = want.select("place", (F.coalesce("_expects", F.lit(0.0)) + F.coalesce("_missing", F.lit(0.0))).alias("_wanted"))
        low, high = (F.when(test, F.col("_so_far")) for test in (F.col("_so_far") <= F.col("_wanted"), F.col("_so_far") > F.col("_wanted")))
        near = ranked.where(F.col("_step") == k).join(want, "place").groupBy("place").agg(F.max(low).alias("_low"), F.min(high).alias("_high"))
        low = F.coalesce("_low", F.lit(0.0))
        cut = F.when(F.col("_high") - F.col("_wanted") < F.col("_wanted") - low, F.col("_high")).otherwise(low)
        found = stored(want.join(near, "place", "left").select("place", F.lit(k).alias("_step"), "_wanted", cut.alias("_cut")), "cuts")
        missing = found.select("place", (F.col("_wanted") - F.col("_cut")).alias("_missing"))
        cuts = found if cuts is None else cuts.unionByName(found)
    return cuts.drop("_wanted")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    most: int = MOST,
    weight: str | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per document of (doc_id, text, source): doc_id, source, size, source_size, target, inclusion, copies, taken.

    ``size`` counts words, ``copies`` is how often the mix holds the document, ``taken`` the words of all copies.
    ``weight`` names a column of preferences within a source: documents are expected in proportion to it, up to
    ``most`` copies (it is used to three digits; null and not positive: never taken); without it all documents of a source
    are expected equally often. ``inclusion`` is the chance of a copy beyond the certain ones, were sizes continuous.

    A null text has no words, a null source is a source of its own and the last. Documents without words take no
    words. Repeated rows are documents of their own; equal ones share their random number, which a null doc_id takes
    from the text. An empty table gives no rows; other columns are ignored. The same rows give the same mix.
    """
    identity = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.md5(identity), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    given = F.lit(1.0)
    if weight is not None:
        digits = F.floor(F.log10(F.col(weight).cast("double"))) - 2
        exact = F.round(F.col(weight).cast("double") / F.pow(F.lit(10.0), digits)) * F.pow(F.lit(10.0), digits)
        given = F.when(F.col(weight).cast("double") > 0, exact).otherwise(F.lit(0.0))
    sized = stored(docs.select("doc_id", "source", size.alias("size"), uniform.alias("_u"), given.alias("_given")), "sized")

    sources = stored(source_targets(sized, weights, share, most), "sources")
    classes = sized.groupBy("source", "_given").agg(F.sum("size").alias("_words"))
    classes = classes.join(sources, classes["source"].eqNullSafe(sources["source"])).drop(classes["source"])
    classes = classes.withColumn("_cap", F.col("_words") * F.lit(float(most))).withColumn("_rate", F.col("_words") * F.col("_given"))
    leveled = levels(classes, F.col("target"), "_cap", "_rate", ["place"])
    expected = F.least(F.lit(float(most)), F.col("_level") * F.col("_given"))
    leveled = stored(leveled.select("source", "place", "_given", "source_size", "target", expected.alias("_expected")), "expected")
    # Classes without words or weight have no level; their documents belong to their source all the same.
    facts = sources.select(F.col("source").alias("_source"), "place", "source_size", "target")
    rows = sized.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.join(leveled.select("place", "_given", "_expected"), ["place", "_given"], "left")
    rows = rows.withColumn("_expected", F.coalesce("_expected", F.lit(0.0))).withColumn("_certain", F.floor("_expected"))
    rows = rows.withColumn("inclusion", F.col("_expected") - F.col("_certain"))
    step = sum((F.col("size") <= F.col("target") * s).cast("int") for s in STEPS)
    rows = stored(rows.withColumn("_step", step), "chances")

    chance = F.col("inclusion") > 0
    ranked = _ranked(rows.where(chance & (F.col("size") > 0)))
    drawn = ranked.join(_cuts(ranked), ["place", "_step"]).withColumn("_extra", (F.col("_so_far") <= F.col("_cut")).cast("int"))
    out = drawn.unionByName(rows.where(~chance | (F.col("size") == 0)).withColumn("_extra", F.lit(0)), allowMissingColumns=True)
    copies = (F.col("_certain") + F.col("_extra")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "inclusion", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op11_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def _steps_sql() -> str:
    parts = []
    for k in range(len(STEPS) + 1):
        carry = f"LEFT JOIN missing{k - 1} m USING (place)" if k else ""
        plus = "+ coalesce(any_value(m.missing), 0)" if k else ""
        parts.append(f"""
want{k} AS (
  SELECT place, sum(words * inclusion) {plus} AS wanted
  FROM (SELECT place, inclusion, sum(size)::BIGINT AS words FROM chance WHERE step = {k} GROUP BY ALL) {carry} GROUP BY place),
so_far{k} AS (
  SELECT chance.*, wanted, sum(size) OVER (PARTITION BY place ORDER BY key, u, doc_id, size ROWS UNBOUNDED PRECEDING)::DOUBLE AS after
  FROM chance JOIN want{k} USING (place) WHERE step = {k}),
pick{k} AS (
  SELECT *, after <= wanted OR (after - size < wanted AND after - wanted < wanted - (after - size)) AS extra FROM so_far{k}),
missing{k} AS (
  SELECT place, any_value(wanted) - sum(CASE WHEN extra THEN size ELSE 0 END)::DOUBLE AS missing FROM pick{k} GROUP BY place
  {f"UNION ALL SELECT * FROM missing{k - 1} WHERE place NOT IN (SELECT place FROM want{k})" if k else ""})""")
    return ",".join(parts)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE AS u
  FROM documents),
source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, {list(WEIGHTS)}[place % {len(WEIGHTS)} + 1] AS weight, {MOST} * source_size AS cap FROM source),
height AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, weight, cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap / weight, weight, cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS height
  FROM weighed),
aim AS (SELECT place, source, source_size, least(cap::DOUBLE, max(height) OVER () * weight) AS target FROM height),
expected AS (
  SELECT sized.*, place, source_size, target, CASE WHEN source_size > 0 THEN least({float(MOST)}::DOUBLE, target / source_size::DOUBLE) ELSE 0 END AS mean
  FROM sized JOIN aim ON sized.source IS NOT DISTINCT FROM aim.source),
drawn AS (
  SELECT *, floor(mean)::BIGINT AS certain, mean - floor(mean) AS inclusion,
    {" + ".join(f"(size <= target * {s}::DOUBLE)::INT" for s in STEPS)} AS step FROM expected),
chance AS (SELECT *, (u / (1 - u)) / (inclusion / (1 - inclusion)) AS key FROM drawn WHERE inclusion > 0 AND size > 0),
{_steps_sql().lstrip()},
chosen AS (
  {" UNION ALL ".join(f"SELECT doc_id, size, source_size, target, certain + extra::BIGINT AS copies FROM pick{k}" for k in range(len(STEPS) + 1))}
  UNION ALL SELECT doc_id, size, source_size, target, certain FROM drawn WHERE NOT (inclusion > 0 AND size > 0))
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM chosen
"""
