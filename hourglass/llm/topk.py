"""Exact top-k inner-product search by the threshold algorithm.

Vectors are dealt into blocks, and so are the queries; each pair of a query block and a
vector block is one bounded group. Inside a group every dimension has a list of the
block's rows sorted by value. A query walks the lists of its non-zero dimensions from
the end that raises its score, a step deeper at a time, scoring each row it meets for
the first time; it stops once the sum of the list values at the current depth (the best
score an unmet row can have) is below its k-th score, or once it has met every row.
The step in which a query meets a row is the least of the row's places in its lists, and
the bounds of all steps are one small product of a chunk of queries, so steps are taken
several at a time: up to the first whose bound is below the score to beat, and without one
up to twice as deep each time. The queries of a chunk that have met every row by then are
scored together; the others score the rows they have met.
A query searches the block of its own hash first; the k-th score found there is carried
into all its other blocks as the score to beat. A last step keeps the k best of a query's
results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import import_path
from hourglass.session import materialize

K = 20
SCALE = 64
QUERY_STRIDE = 20
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048
STEP_SHARE = 256           # the lists are walked in steps of block rows / STEP_SHARE
FIRST_STEPS = 4            # scored together at first by a walk without a score to beat, then twice as many
CHUNK_QUERIES = 128        # queries that a block's lists take at once
SCHEMA = "query_id long, vec_id long, score long, scored long"


def quantize(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<double> of whole numbers); null ids and vectors that are null or
    hold null or non-finite components are left out, a repeated row counts once."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"))
            .distinct())


class Lists:
    """Per-dimension sorted lists of one block: the list values at the end of every step, from the top and
    from the bottom, and the step in which either walk of a list meets a row."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        n, step = len(rows), max(1, len(rows) // STEP_SHARE)
        depth = np.minimum(np.arange(step, n + step, step), n)
        kind = np.uint8 if len(depth) <= 256 else np.uint16 if len(depth) <= 1 << 16 else np.int64
        places = np.arange(n) // step
        order = np.argsort(rows, axis=0, kind="stable").T                   # dimension x rank, ascending
        values = np.take_along_axis(rows, order.T, axis=0).T
        self.top, self.bottom = values[:, n - depth].copy(), values[:, depth - 1].copy()  # dimension x step
        self.met = np.empty((2, *order.shape), kind)                        # from the top or bottom x dimension x row
        np.put_along_axis(self.met[0], order, places[::-1].astype(kind)[None], axis=1)
        np.put_along_axis(self.met[1], order, places.astype(kind)[None], axis=1)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int,
               floor: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """(ids, scores, rows met when the walk stopped) of the k best rows of each query, ties to the smaller id.

        Rows below ``floor`` (a score that k rows elsewhere reach) may be missing.
        """
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        out = []
        for lo in range(0, len(queries), CHUNK_QUERIES):
            part = slice(lo, lo + CHUNK_QUERIES)
            out += self._walks(queries[part], own[part], k, floor[part])
        return out

    def _walks(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray):
        n, out = len(self.rows), [None] * len(queries)
        # the best score a row that was not met by the end of a step can have
        bounds = np.maximum(queries, 0) @ self.top + np.minimum(queries, 0) @ self.bottom
        open_, whole = [], []
        for i, q in enumerate(queries):
            lists = np.concatenate([np.flatnonzero(q > 0), len(q) + np.flatnonzero(q < 0)])
            if not len(lists) or not n:  # every row scores 0
                out[i] = (*best(self.ids, np.zeros(n), own[i], k), n)
                continue
            met = self.met.reshape(-1, n)[lists].min(axis=0)
            below = bounds[i] < floor[i]
            last = int(met.max())
            end = min(last, int(below.argmax()) if below.any() else last)
            (whole if end == last and floor[i] > -np.inf else open_).append((i, met, end))
        # walks that meet every row before the bound falls below the score to beat: all their rows at once
        scores = queries[[i for i, _, _ in whole]] @ self.rows.T if whole else ()
        for (i, met, end), all_scores in zip(whole, scores):
            out[i] = self._stopped(bounds[i], met, end, np.arange(n), all_scores, own[i], k, floor[i])
        for i, met, end in open_:
            out[i] = self._deeper(queries[i], bounds[i], met, end, own[i], k, floor[i])
        return out

    def _deeper(self, q: np.ndarray, bound: np.ndarray, met: np.ndarray, end: int, own: int, k: int, floor: float):
        """A walk whose rows are scored as they are met: up to ``end`` or until the bound stops it."""
        at, scores = np.zeros(0, np.int64), np.zeros(0, q.dtype)
        done, upto = -1, end if floor > -np.inf else min(end, FIRST_STEPS - 1)
        while True:
            new = np.flatnonzero((met > done) & (met <= upto) if done >= 0 else met <= upto)
            at = np.concatenate([at, new])
            scores = np.concatenate([scores, self.rows[new] @ q])
            if upto == end or np.count_nonzero((scores > bound[upto]) & (self.ids[at] != own)) >= k:
                return self._stopped(bound, met, upto, at, scores, own, k, floor)
            done, upto = upto, min(end, 2 * upto + 1)

    def _stopped(self, bound: np.ndarray, met: np.ndarray, upto: int, at: np.ndarray, scores: np.ndarray,
                 own: int, k: int, floor: float):
        """The result of a walk at its first step of those up to ``upto`` whose bound is below the score to
        beat or the k-th score met; all rows met by then are among ``at``."""
        high = np.flatnonzero(scores > bound[upto])
        high = high[self.ids[at[high]] != own]
        if len(high) >= k and upto:
            # by step, the rows above its bound that were met: a row counts from its meeting and once the bound is below it
            first = np.maximum(met[at[high]], np.searchsorted(-bound[:upto + 1], -scores[high], side="right"))
            upto = min(upto, int(np.partition(first, k - 1)[k - 1]))
        kept = np.flatnonzero(scores >= floor)
        kept = kept[met[at[kept]] <= upto]
        return (*best(self.ids[at[kept]], scores[kept], own, k), int(np.count_nonzero(met <= upto)))


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    other = ids != own
    if len(scores) > 4 * k:
        cut = np.partition(np.where(other, scores, -np.inf), len(scores) - k)[len(scores) - k]
        other &= scores >= cut
    ids, scores = ids[other], scores[other]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column; shorter vectors are filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = flat
    return out


def pair_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Same width, in float32 where every score is exact in it."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 1 << 24:
        return a.astype(np.float32), b.astype(np.float32)
    return a, b


def top_k(vectors: DataFrame, k: int = K, stride: int = QUERY_STRIDE, block_rows: int = BLOCK_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score, scored: each query's k best other rows of ``vectors``
    (vec_id, v), ties to the smaller vec_id. Queries are the rows with vec_id divisible by
    ``stride``. A query without another row gives no row; an empty table gives none.
    Scores are exact while they stay below 2**53.
    """
    import_path(vectors.sparkSession)
    counts = vectors.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % stride == 0)).first()
    n_cells = max(1, -(-counts[0] // block_rows))
    n_query = max(1, -(-counts[1] // block_queries))
    spread = F.xxhash64("vec_id")
    own_cell = F.pmod(spread, F.lit(n_cells))

    def every(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    # names differ between the sides: both come from one table, and cogroup resolves columns by identity
    queries = vectors.filter(F.col("vec_id") % stride == 0).select(
        F.pmod(spread, F.lit(n_query)).alias("qb"), own_cell.alias("home"),
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    rows = vectors.select(own_cell.alias("cb"), F.col("vec_id").alias("row_id"), F.col("v").alias("row"))

    start = queries.select(F.lit(0).cast("long").alias("qb"), F.col("home").alias("cb"), "query_id", "q",
                           F.lit(None).cast("long").alias("beat"))
    found = _search(start, rows.withColumn("qb", F.lit(0).cast("long")), k)
    if n_cells > 1:
        found = materialize(found, "topk-home")
        beat = _ranked(found).filter(F.col("rank") == k).select("query_id", F.col("score").alias("beat"))
        others = F.explode(F.filter(every(n_cells), lambda c: c != F.col("home")))
        rest = queries.join(beat, "query_id", "left").select("qb", others.alias("cb"), "query_id", "q", "beat")
        found = found.unionByName(_search(rest, rows.withColumn("qb", F.explode(every(n_query))), k))
    return _ranked(found).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "scored")


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order))


def _search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best of each (qb, cb) group: ``queries`` (query_id, q, beat) against ``rows`` (row_id, row)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            q, v = pair_up(matrix(left["q"]), matrix(right["row"]))
            own = left["query_id"].to_numpy()
            floor = left["beat"].cast(pa.float64()).fill_null(-np.inf).to_numpy()
            lists = Lists(right["row_id"].to_numpy(), v)
            for query_id, (ids, scores, scored) in zip(own, lists.search(q, own, k, floor)):
                out[0].append(np.full(len(ids), query_id))
                out[1].append(ids)
                out[2].append(scores.astype(np.int64))
                out[3].append(np.full(len(ids), scored))
        cols = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(cols, ["query_id", "vec_id", "score", "scored"])

    return queries.groupBy("qb", "cb").cogroup(rows.groupBy("qb", "cb")).applyInArrow(run, SCHEMA)
