"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into slices that act as the nodes of the threshold algorithm: each
holds one list of partial scores per query. Phase 1 gathers the first k of every list,
resolves those rows and gives each query a cutoff that k rows reach. Phase 2 takes the
entries of which some partial score reaches the cutoff divided by the number of lists; no
other row can reach it, since its partial scores add up to less. Phase 3 forms the totals of
those entries alone and keeps the exact best. Partial scores are formed for every query and
row, in both passes; totals only for the heads of the lists and the entries sent.

Queries meet candidates in blocks: a key of both block numbers joins one block of each, so
no task holds more than two blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import stored

LISTS = 2  # the cutoff is shared by the lists, so fewer send fewer entries
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
QUERIES_AT_ONCE = 256


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              scale: int = 64) -> DataFrame:
    """vec_id, vector (floor of ``scale`` times each component) and a number for each row.

    Null vectors and those with a null or non-finite component are left out.
    """
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
        .alias("vector"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "quantised")


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vector").combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(table.num_rows, -1)


def _exact_type(q: np.ndarray, c: np.ndarray) -> type:
    """The quickest type in which every inner product is exact."""
    most = float(q.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _partial_scores(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    cuts = np.linspace(0, q.shape[1], min(LISTS, max(1, q.shape[1])) + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)]


def _local_cutoffs(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Phase 1: per query the k-th best exact score among the heads of the local lists."""
    q, c = _matrix(queries), _matrix(candidates)
    kind = _exact_type(q, c)
    q, c = q.astype(kind), c.astype(kind)
    q_row, c_row = (t.column("row").to_numpy() for t in (queries, candidates))
    bounds = np.full(len(q), None, object)
    take = min(k + 1, len(c))  # one more, as the query's own row may be among them
    for at in range(0, len(q), QUERIES_AT_ONCE):
        block = q[at:at + QUERIES_AT_ONCE]
        lists = _partial_scores(block, c)
        heads = np.sort(np.concatenate(
            [np.argpartition(-scores, take - 1, axis=1)[:, :take] for scores in lists], axis=1), axis=1)
        fresh = c_row[heads] != q_row[at:at + len(block), None]
        fresh[:, 1:] &= heads[:, 1:] != heads[:, :-1]
        total = sum(np.take_along_axis(scores, heads, axis=1) for scores in lists)
        for i in range(len(block)):
            found = total[i, fresh[i]]
            if len(found) >= k:
                bounds[at + i] = int(np.partition(found, len(found) - k)[len(found) - k])
    return pa.table({"row": queries.column("row"), "bound": pa.array(bounds.tolist(), pa.int64())})


def _sent(lists: list[np.ndarray], cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase 2: the entries (query, candidate) that some list alone sends.

    A total that reaches the cutoff has a partial score of at least the cutoff's share. The
    share is taken a little lower, as a cutoff above 2**53 is rounded.
    """
    share = (cutoff - np.where(np.isfinite(cutoff), np.abs(cutoff), 0) * 1e-12)[:, None] / len(lists)
    sent = np.zeros(lists[0].shape, bool)
    for partial in lists:
        sent |= partial >= share
    return np.divmod(np.flatnonzero(sent), sent.shape[1])


def _resolved(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Phases 2 and 3: entries that reach the cutoff in some list, then their exact scores."""
    q, c = _matrix(queries), _matrix(candidates)
    kind = _exact_type(q, c)
    q, c = q.astype(kind), c.astype(kind)
    q_row, c_row = (t.column("row").to_numpy() for t in (queries, candidates))
    ids = np.array([np.iinfo(np.int64).max if x is None else x for x in candidates.column("vec_id").to_pylist()], np.int64)
    cutoffs = queries.column("cutoff").to_pylist()
    cut = np.array([-np.inf if x is None else x for x in cutoffs], np.float64)
    rows, found, scores = [], [], []
    for at in range(0, len(q), QUERIES_AT_ONCE):
        block = q[at:at + QUERIES_AT_ONCE]
        lists = _partial_scores(block, c)
        i, j = _sent(lists, cut[at:at + len(block)])
        other = c_row[j] != q_row[at + i]
        i, j = i[other], j[other]
        score = sum(partial[i, j] for partial in lists).astype(np.int64)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        best = rank < k
        rows.append(q_row[at + i[best]])
        found.append(j[best])
        scores.append(score[best])
    at = np.concatenate(found) if found else np.array([], np.int64)
    return pa.table({
        "row": pa.array(np.concatenate(rows) if rows else [], pa.int64()),
        "vec_id": candidates.column("vec_id").take(pa.array(at, pa.int64())),
        "score": pa.array(np.concatenate(scores) if scores else [], pa.int64())})


def top_k(vectors: DataFrame, k: int = 20, is_query: Column | None = None, **columns: str) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best other rows of each query row.

    By default rows whose vec_id is divisible by 20 are queries; a null vec_id is none.
    Ties go to the smaller vec_id, nulls last. Vectors meet those of equal length only.
    Repeated rows are rows of their own. A query without partners gives no row.
    """
    rows = quantised(vectors, **columns).withColumn("dim", F.size("vector")).where("dim > 0")
    wanted = rows.where(F.col("vec_id") % 20 == 0 if is_query is None else is_query)
    query_blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    candidate_blocks = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    spread = F.xxhash64("row")
    candidates = rows.select(
        "dim", "row", "vec_id", "vector", F.pmod(spread, F.lit(candidate_blocks)).alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))

    def per_block(queries: DataFrame) -> DataFrame:
        return queries.withColumn("qb", F.pmod(spread, F.lit(query_blocks)).cast("int")).withColumn(
            "cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(candidate_blocks - 1).cast("long"))))

    def together(queries: DataFrame, work, schema: str) -> DataFrame:
        keys = ["dim", "cb", "qb"]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({f.name: pa.array([], f.type) for f in empty})
            return work(left, right, k)

        empty = pa.schema([(n, pa.int64()) for n in schema.replace(" long", "").split(", ")])
        return per_block(queries).groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(run, schema)

    cutoffs = together(wanted.select("dim", "row", "vector"), _local_cutoffs, "row long, bound long")
    cutoffs = cutoffs.groupBy("row").agg(F.max("bound").alias("cutoff"))
    queries = stored(wanted.join(cutoffs, "row", "left").select("dim", "row", "vector", "cutoff"), "cutoffs")
    found = together(queries, _resolved, "row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = wanted.select("row", F.col("vec_id").alias("query_id"))
    return best.join(names, "row").select("query_id", "rank", "vec_id", "score")
