"""Hard negatives by slot-decomposed selection.

An anchor's positives set windows of scores that overlap. Their upper limits cut the scores into disjoint slots, and
every task keeps the first few rows of each slot of each anchor, whatever the number of windows. A window's answer is
then read off the slots from its own upper limit downwards.

All anchors are scored against all rows: anchors go to the tasks in slices of bounded size, rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.session import stored

#: Components are scaled by this and rounded down.
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of its positive's.
LOWEST, HIGHEST = 30, 90
#: Anchors that a task works for at once, and bytes of their components.
SLICE_ANCHORS = 10_000
SLICE_BYTES = 16 << 20
#: Scores held at once.
BLOCK = 1 << 21

_NO_ID = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of whole-number components, zero beyond a vector's end, and which vectors take part."""
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    width = int(lengths.max(initial=0))
    out = np.zeros((len(column), width))
    owner = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, place] = values
    usable = np.isfinite(out).all(axis=1) & ~column.is_null().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.floor(out * SCALE)
    return out, usable & np.isfinite(out).all(axis=1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; the number type is the smallest that holds all partial sums. Beyond 64 bits they saturate."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(width, 1)
    if bound < 1 << 24:
        return left.astype(np.float32) @ right.astype(np.float32).T
    if bound < 1 << 53:
        return left @ right.T
    whole = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(len(side), width) for side in (left, right)]
    return np.clip(whole[0] @ whole[1].T, _LEAST + 1, _NO_ID).astype(np.int64)


def _limits(values: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Limits in the number type of the scores; those beyond it are beyond all scores."""
    most = {"float32": 1 << 24, "float64": 1 << 53}.get(scores.dtype.name)
    return values if most is None else np.clip(values, -most, most).astype(scores.dtype)


class Best:
    """The first ``k`` (score, id) of each group: higher scores first, ties by smaller id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.enough = np.full(groups, _LEAST, dtype=np.int64)  # lower scores can't get in any more

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.enough[group]
        if not fits.any():
            return
        group, score, ids = (np.concatenate(x) for x in ((self.group, group[fits]), (self.score, score[fits]), (self.id, ids[fits])))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        keep = rank < self.k
        self.group, self.score, self.id = group[keep], score[keep], ids[keep]
        last = rank[keep] == self.k - 1
        self.enough[self.group[last]] = self.score[last]


def _scan(rows: DataFrame, search: Callable[[], Callable], result: Callable, fields: str) -> DataFrame:
    """Run over all rows (vec_id, label, vector) once; each task gives the best that it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offer, best, block = search()
        for batch in batches:
            vectors, usable = whole_vectors(batch.column(2))
            usable &= ~batch.column(1).is_null().to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(usable)
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            labels = batch.column(1).fill_null(0).to_numpy()
            for k in range(0, len(chosen), block):
                part = chosen[k : k + block]
                offer(ids[part], labels[part], vectors[part])
        yield result(best)

    return rows.mapInArrow(run, fields)


def prepared(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector), with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"), F.col(vector).alias("vector"))


def anchor_slices(rows: DataFrame) -> tuple[DataFrame, int]:
    """Anchors (anchor, vec_id, label, vector, slice), stored, and the number of slices. ``anchor`` numbers them."""
    usable = (F.col("vec_id") % 100 == 0) & F.col("label").isNotNull() & F.col("vector").isNotNull()
    usable &= F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    found = stored(rows.where(usable).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    count, width = found.agg(F.count("*"), F.max(F.size("vector"))).first()
    slices = max(1, -(-count // SLICE_ANCHORS), -(-count * 8 * (width or 1) // SLICE_BYTES))
    return found.withColumn("slice", F.pmod(F.xxhash64("anchor"), F.lit(slices))), slices


def _block(anchors: int) -> int:
    return max(64, BLOCK // max(anchors, 1))


def positives(rows: DataFrame, anchors: pa.Table) -> DataFrame:
    """(anchor, score, id): rows of an anchor's label that are among the task's first of the anchor."""
    own, _ = whole_vectors(anchors["vector"].combine_chunks())
    shared = rows.sparkSession.sparkContext.broadcast((anchors["anchor"].to_numpy(), anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), own))  # one slice

    def search():
        _, anchor_ids, anchor_labels, vectors = shared.value
        best = Best(len(anchor_ids), POSITIVES)

        def offer(ids: np.ndarray, labels: np.ndarray, found: np.ndarray) -> None:
            for label in np.unique(labels):
                mine, theirs = np.flatnonzero(anchor_labels == label), np.flatnonzero(labels == label)
                if not len(mine):
                    continue
                scores = products(vectors[mine], found[theirs])
                fits = (scores >= _limits(best.enough[mine], scores)[:, None]) & (anchor_ids[mine][:, None] != ids[theirs][None, :])
                a, b = np.nonzero(fits)
                best.offer(mine[a], scores[a, b].astype(np.int64), ids[theirs][b])

        return offer, best, _block(len(anchor_ids))

    def result(best: Best) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(shared.value[0][best.group]), pa.array(best.score), pa.array(best.id)], names=["anchor", "score", "id"])

    return _scan(rows, search, result, "anchor long, score long, id long")


def windows(firsts: DataFrame) -> DataFrame:
    """(anchor, tops, bottom, windows) of positives (anchor, score, id): the slots' upper limits, falling; the lowest limit of any window;
    and each window as positive's rank, id, score, first slot and lower limit. A negative positive allows no score."""
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = firsts.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= POSITIVES).where("score >= 0")
    # floor and ceiling without passing 64 bits
    whole, rest = F.expr("score div 100"), F.col("score") % 100
    high = whole * HIGHEST + F.expr(f"(score % 100) * {HIGHEST} div 100")
    low = whole * LOWEST + F.floor((rest * LOWEST + 99) / 100)
    one = ranked.withColumn("high", high.cast("long")).withColumn("low", low.cast("long"))
    listed = one.groupBy("anchor").agg(
        F.reverse(F.array_sort(F.collect_set("high"))).alias("tops"),
        F.min("low").alias("bottom"),
        F.collect_list(F.struct("nth", "id", "score", "high", "low")).alias("windows"),
    )  # POSITIVES entries at most
    first = F.transform("windows", lambda w: F.struct(w.nth, w.id, w.score, (F.array_position("tops", w.high) - 1).alias("slot"), w.low))
    return listed.withColumn("windows", first)


def slotted(rows: DataFrame, anchors: pa.Table) -> DataFrame:
    """(anchor, slot, score, id): rows of other labels that are among the task's first of a slot.

    ``anchors`` has anchor, label, vector, tops and bottom. Slot s holds scores up to tops[s] and above tops[s + 1].
    """
    own, _ = whole_vectors(anchors["vector"].combine_chunks())
    tops = np.full((len(anchors), POSITIVES), _LEAST, dtype=np.int64)
    for k, listed in enumerate(anchors["tops"].to_pylist()):
        tops[k, : len(listed)] = listed
    shared = rows.sparkSession.sparkContext.broadcast((anchors["anchor"].to_numpy(), anchors["label"].to_numpy(), own, tops, anchors["bottom"].to_numpy()))  # one slice

    def search():
        _, anchor_labels, vectors, tops, bottom = shared.value
        best = Best(tops.size, NEGATIVES)

        def offer(ids: np.ndarray, labels: np.ndarray, found: np.ndarray) -> None:
            scores = products(vectors, found)
            fits = (scores <= _limits(tops[:, 0], scores)[:, None]) & (scores >= _limits(bottom, scores)[:, None])
            fits &= anchor_labels[:, None] != labels[None, :]
            a, b = np.nonzero(fits)
            score = scores[a, b].astype(np.int64)
            slot = (score[:, None] <= tops[a]).sum(axis=1) - 1
            best.offer(a * POSITIVES + slot, score, ids[b])

        return offer, best, _block(len(vectors))

    def result(best: Best) -> pa.RecordBatch:
        group = best.group
        return pa.RecordBatch.from_arrays(
            [pa.array(shared.value[0][group // POSITIVES]), pa.array((group % POSITIVES).astype(np.int32)), pa.array(best.score), pa.array(best.id)],
            names=["anchor", "slot", "score", "id"],
        )

    return _scan(rows, search, result, "anchor long, slot int, score long, id long")


def hard_negatives(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """For each anchor and positive the first negatives of the positive's window: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    ``rows`` has vec_id, label and ``vector``. Rows without label or vector, or with a null or non-finite component, take no part.
    Vectors of different lengths are compared over their common components. A row without vec_id is no anchor and counts as the
    largest id; rows that share an anchor's vec_id are not its positives; otherwise repeated rows count each, and each repeated anchor
    has its own answer. Scores saturate at 64 bits. An anchor without positives, or whose positives have negative scores, has no rows; nor
    has an empty table. Other columns are ignored.
    """
    spark = rows.sparkSession
    ready = prepared(rows, vector)
    anchors, slices = anchor_slices(ready)
    answers = None
    for k in range(slices):  # one slice after the other: a task and the driver hold one
        own = anchors.where(F.col("slice") == k)
        seen = stored(positives(ready, own.select("anchor", "vec_id", "label", "vector").toArrow()), "positives")
        limits = stored(windows(seen), "windows")
        asked = own.join(limits, "anchor").select("anchor", "label", "vector", "tops", "bottom").toArrow()
        seen = stored(slotted(ready, asked), "slots")
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
        firsts = seen.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= NEGATIVES)
        # Slots follow each other downwards, so the sorted list from a window's first slot on is the window's order.
        merged = firsts.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("less"), "id"))).alias("found"))
        both = merged.join(limits.select("anchor", F.explode("windows").alias("w")), "anchor").join(own.select("anchor", "vec_id"), "anchor")
        inside = F.filter("found", lambda x: (x.slot >= F.col("w.slot")) & (-x.less >= F.col("w.low")))
        named = both.select("vec_id", "w", F.posexplode(F.slice(inside, 1, NEGATIVES)).alias("pos", "x"))
        known = [F.when(c != F.lit(int(_NO_ID)), c) for c in (F.col("w.id"), F.col("x.id"))]
        answer = stored(
            named.select(
                F.col("vec_id").alias("anchor_id"), known[0].alias("positive_id"), (F.col("pos") + 1).alias("rank"), known[1].alias("negative_id"),
                F.col("w.score").alias("positive_score"), (-F.col("x.less")).alias("negative_score"),
            ),
            "negatives",
        )
        answers = answer if answers is None else answers.unionByName(answer)
    return answers


def op12_slot_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


SQL = f"""
WITH vector AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vector a JOIN vector b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor AS anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
  AND {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) <= {NEGATIVES}
"""
