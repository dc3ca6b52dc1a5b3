"""Hard negatives by a vertical scan of columnar blocks (branch and bound on dimensions).

A block of candidates is kept column by column. For an anchor the columns are read in
descending order of the anchor's own magnitude there, a few at a time. What the unread
columns can still add lies between sums of the columns' least and largest products, so each
candidate has a lower and an upper bound; those that cannot be wanted leave the bitmap, and
the scan goes on over the rest until their scores are exact.

Two scans use this. The first keeps the best rows of the anchor's own label, its positives.
Each positive's score opens a window for negatives; the second keeps the rows of other
labels that may be among the first of some window.

Anchors meet candidates in blocks: a key of both block numbers joins one block of each, so a
task holds two blocks, a candidate is shuffled once per ``ANCHOR_BLOCK`` anchors, and a block
hands on no more rows than are asked for. A label that holds a third of all rows is spread
over all blocks like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored

POSITIVES, NEGATIVES = 5, 10
# A negative scores from so many to so many hundredths of the positive's score.
LOW, HIGH = 30, 90
ANCHOR_BLOCK, CANDIDATE_BLOCK = 8192, 8192
# Columns read between two tests of the bounds.
STEP = 8

_NO_ID = np.iinfo(np.int64).max
Survivors = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Block:
    """Candidates column by column, with the least and largest value of each column."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)

    def scan(self, anchor: np.ndarray, alive: np.ndarray,
             survivors: Survivors) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``alive`` that outlive every test, and their exact scores.

        ``survivors`` sees each row's lower and upper bound and says which rows stay.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(axis=0), ends.max(axis=0)))
        partial = np.zeros(len(alive), anchor.dtype)
        for at in range(0, len(order), STEP):
            if not len(alive):
                break
            read = order[at:at + STEP]
            columns = self.columns[read]
            if len(alive) < columns.shape[1]:
                columns = columns[:, alive]
            partial += anchor[read] @ columns
            done = min(at + STEP, len(order))
            kept = survivors(partial + least[done], partial + most[done])
            if not kept.all():
                alive, partial = alive[kept], partial[kept]
        return alive, partial


def _kth_largest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best_of_label(k: int) -> Survivors:
    """Rows whose upper bound reaches the k-th best lower bound."""
    return lambda lower, upper: upper >= _kth_largest(lower, k)


def in_windows(lows: list[int], highs: list[int], k: int) -> Survivors:
    """Rows that may be among the first ``k`` of a window. Rows known to lie in a window set
    its floor: what cannot reach the k-th best of them is not wanted there."""
    def survivors(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(lower), bool)
        for low, high in zip(lows, highs, strict=True):
            sure = (lower >= low) & (upper <= high)
            floor = max(low, _kth_largest(lower[sure], k))
            kept |= (upper >= floor) & (lower <= high)
        return kept

    return survivors


def _matrices(*sides: pa.Table) -> list[np.ndarray]:
    """Both sides' vectors in the quickest type in which every inner product is exact."""
    found = []
    for side in sides:
        flat = side.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        found.append(flat.reshape(side.num_rows, -1))
    most = float(found[0].shape[1])
    for matrix in found:
        most *= float(np.abs(matrix.astype(np.float64)).max(initial=0))
    return [m.astype(np.float64 if most < 1 << 53 else np.int64) for m in found]


def _labels(*sides: pa.Table) -> list[np.ndarray]:
    """Numbers that are equal where labels are."""
    chunks = [c for side in sides for c in side.column("label").chunks]
    codes = pa.chunked_array(chunks).combine_chunks().dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([side.num_rows for side in sides])[:-1])


class _Pair:
    """One block of anchors and one of candidates."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table) -> None:
        self.anchors, self.candidates = _matrices(anchors, candidates)
        self.anchor_labels, self.labels = _labels(anchors, candidates)
        self.anchor_rows, self.rows = (t.column("row").to_numpy() for t in (anchors, candidates))
        ids = candidates.column("vec_id")
        self.ids = ids.fill_null(_NO_ID).to_numpy()
        self.block = Block(self.candidates)
        self._given, self._found = ids, []

    def keep(self, anchor: int, place: int, rows: np.ndarray, scores: np.ndarray, k: int) -> None:
        scores = scores.astype(np.int64)
        best = np.lexsort((self.rows[rows], self.ids[rows], -scores))[:k]
        self._found += [(self.anchor_rows[anchor], place, int(rows[i]), int(scores[i])) for i in best]

    def table(self) -> pa.Table:
        anchor, place, at, score = zip(*self._found, strict=True) if self._found else ((),) * 4
        at = pa.array(at, pa.int64())
        return pa.table({
            "anchor": pa.array(anchor, pa.int64()), "place": pa.array(place, pa.int64()),
            "row": pa.array(self.rows).take(at), "vec_id": self._given.take(at),
            "score": pa.array(score, pa.int64())})


def _block_positives(anchors: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    pair = _Pair(anchors, candidates)
    for i, anchor in enumerate(pair.anchors):
        own = np.flatnonzero((pair.labels == pair.anchor_labels[i]) & (pair.rows != pair.anchor_rows[i]))
        rows, scores = pair.block.scan(anchor, own, best_of_label(k))
        pair.keep(i, 0, rows, scores, k)
    return pair.table()


def _block_negatives(anchors: pa.Table, candidates: pa.Table, k: int, low: int, high: int) -> pa.Table:
    pair = _Pair(anchors, candidates)
    positives = anchors.column("scores").to_pylist()
    for i, anchor in enumerate(pair.anchors):
        # 100 * n >= low * p and 100 * n <= high * p, for whole n
        lows, highs = [-(-low * p // 100) for p in positives[i]], [high * p // 100 for p in positives[i]]
        other = np.flatnonzero(pair.labels != pair.anchor_labels[i])
        rows, scores = pair.block.scan(anchor, other, in_windows(lows, highs, k))
        for place, (least, most) in enumerate(zip(lows, highs, strict=True), start=1):
            inside = (scores >= least) & (scores <= most)
            pair.keep(i, place, rows[inside], scores[inside], k)
    return pair.table()


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id",
              vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label (as text), vector (floor of ``scale`` times each component), its length
    and a number for each row that takes part."""
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return stored(rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        whole.alias("vector"), F.size(vector_col).alias("dim"),
        F.monotonically_increasing_id().alias("row")), "labelled-vectors")


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, is_anchor: Column | None = None,
                   **columns) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows of ``is_anchor`` (over vec_id), by default those whose vec_id is
    divisible by 100; a null vec_id is none. For each of an anchor's best ``positives`` rows of
    its own label, the best ``negatives`` rows of other labels whose score lies from ``low`` to
    ``high`` hundredths of the positive's. A positive score below zero leaves that empty, and a
    pair without negatives gives no row.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Vectors meet those of equal length only; empty ones score 0. Ties go to the smaller
    vec_id, nulls last. Repeated rows are rows of their own, as candidates and as anchors.
    Other columns are not read. Scores have to fit a long.
    """
    rows = quantised(vectors, **columns)
    wanted = rows.where(F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor)
    anchor_blocks = max(1, -(-wanted.count() // ANCHOR_BLOCK))
    blocks = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    keys, spread = ["dim", "block", "anchor_block"], F.xxhash64("row")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    candidates = rows.withColumn("block", F.pmod(spread, F.lit(blocks))).withColumn(
        "anchor_block", every(anchor_blocks))
    names = ["anchor", "place", "row", "vec_id", "score"]
    schema = ", ".join(f"{n} long" for n in names)

    def together(anchors: DataFrame, work: Callable, k: int, *window: int) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({n: pa.array([], pa.int64()) for n in names})
            return work(left, right, k, *window)

        placed = anchors.withColumn("anchor_block", F.pmod(spread, F.lit(anchor_blocks))).withColumn(
            "block", every(blocks))
        found = placed.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, schema)
        best = Window.partitionBy("anchor", "place").orderBy(
            F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    # At most ``positives`` rows an anchor, so the lists are short.
    positive = F.struct("rank", "vec_id", "score")
    found = together(wanted.drop("vec_id"), _block_positives, positives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(positive)).alias("positives"))
    anchors = stored(wanted.join(found.withColumnRenamed("anchor", "row"), "row").withColumn(
        "scores", F.col("positives.score")), "anchors")
    ranked = together(anchors.drop("vec_id", "positives"), _block_negatives, negatives, low, high)
    told = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives")
    chosen = F.element_at("positives", F.col("place").cast("int"))
    return ranked.withColumnRenamed("vec_id", "negative_id").join(told, "anchor").select(
        "anchor_id", chosen["vec_id"].alias("positive_id"), F.col("rank"), "negative_id",
        chosen["score"].alias("positive_score"), F.col("score").alias("negative_score"))
