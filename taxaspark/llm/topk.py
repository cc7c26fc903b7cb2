"""Exact top-k search by inner product: block-at-a-time pruning.

Candidates are put in order by their dominant component (its place and sign, then its size), so that neighbours are alike, and
written once as blocks: consecutive ranges of up to ``block_rows`` rows with a forward index (their matrix) and the largest and
smallest value of each term (component). For a query, a block's bound is the sum over terms of the larger of weight times maximum
and weight times minimum: no vector of the block scores more.

Queries are packed, too, and go to the executors by broadcasts of ``QUERY_BYTES`` at most, in the fewest bytes that hold them (two a
component, mostly); each is one pass over the blocks, which stay where they are. Some ``FIRST_BLOCKS`` blocks are searched first: the k-th score there is a bound that every task starts with.
A task takes its blocks in order of falling bounds and scores them whole until the next bound is below the query's k-th score so
far; it hands on k results a query at most, of those that reach the first bound, and one window ranks them. Nothing but results
and, once, the candidates is shuffled.

Arithmetic is exact: on floating-point matrices where every sum stays below 2^53, else on Python's integers, and a
score beyond 64 bits is the nearest of 64 bits. A component whose integer leaves 64 bits is the nearest of 64 bits, too.

Cases: null vectors and those with a null or non-finite component take no part, as queries or candidates; empty vectors score
0. Of vectors of different lengths the shorter counts as followed by zeros. Fewer than k candidates: all. Equal scores: the
smaller id first, null ids last. Null ids: such rows are candidates and ask nothing. A repeated id: each row is a candidate of its
own; as a query the id's smallest vector asks, once, and none of the id's rows is its candidate. Empty tables: no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.llm.common import materialize, table

EXACT = float(1 << 53)
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Bytes of queries in one broadcast, and of blocks that a task holds at once.
QUERY_BYTES = 8 << 20
HELD_BYTES = 16 << 20
#: Queries that are scored at once, and blocks that all queries see first.
QUERY_ROWS = 1024
FIRST_BLOCKS = 64
#: Passes over the blocks in one plan.
PASSES = 16


def quantize(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double, an array of long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


PACKED = "block long, n long, width long, kind string, ids binary, nulls binary, data binary"


def pack_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """id, v -> PACKED: blocks of neighbours in their partition, numbers in the fewest bytes that hold them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, len(batch), block_rows):
                part = batch.slice(a, block_rows)
                ids, vectors = part.column(0), part.column(1)
                sizes = vectors.value_lengths().to_numpy()
                values = vectors.flatten().to_numpy()
                matrix = np.zeros((len(part), int(sizes.max(initial=0))), np.int64)
                matrix[np.repeat(np.arange(len(part)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
                kind = next(k for k in ("i2", "i4", "i8") if not len(values) or (np.iinfo(k).min <= values.min() and values.max() <= np.iinfo(k).max))
                bare = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
                columns = [[made], [len(part)], [matrix.shape[1]], [kind], [bare[0].tobytes()], [bare[1].tobytes()], [matrix.astype(kind).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
                made += 1

    names = [x.split()[0] for x in PACKED.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in PACKED.split(", ")]
    return rows.select(F.col("id").cast("long").alias("id"), "v").mapInArrow(run, PACKED)


class Block:
    """Up to a few hundred neighbours: ids, which of them are null, forward index, and the extremes of each term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nulls: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.nulls = np.zeros(len(ids), bool) if nulls is None else nulls
        self.high, self.low = vectors.max(0).astype(np.float64), vectors.min(0).astype(np.float64)

    @classmethod
    def opened(cls, n: int, width: int, kind: str, ids: bytes, nulls: bytes, data: bytes) -> Block:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(data, kind).reshape(n, width).astype(np.int64), np.frombuffer(nulls, bool))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        q = queries[:, : len(self.high)].astype(np.float64)
        n = q.shape[1]
        out = np.maximum(q, 0) @ self.high[:n] + np.minimum(q, 0) @ self.low[:n]
        return out + 1 + 1e-9 * np.abs(out)  # rounding never hides a block

    def score(self, queries: np.ndarray) -> np.ndarray:
        n = min(queries.shape[1], self.vectors.shape[1])
        q, v = queries[:, :n], self.vectors[:, :n]
        most = np.abs(q.astype(np.float64)).max(initial=0) * np.abs(v.astype(np.float64)).max(initial=0)
        if most * max(1, n) < EXACT:
            return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
        return np.clip(q.astype(object) @ v.T.astype(object), LEAST, MOST).astype(np.int64)


class Best:
    """The k best of each query so far: score, id and kind (0: an id, 1: a null id, 2: nothing yet), and the score to reach."""

    def __init__(self, n: int, k: int, reach: np.ndarray | None = None):
        self.score, self.id, self.kind = np.full((n, k), LEAST), np.zeros((n, k), np.int64), np.full((n, k), 2, np.int8)
        self.reach = np.full(n, LEAST) if reach is None else reach.copy()

    def offer(self, rows: np.ndarray, scores: np.ndarray, block: Block, allowed: np.ndarray) -> None:
        """``scores``: a row for each of ``rows``, a column for each of the block's vectors; those not ``allowed`` don't count."""
        k = self.score.shape[1]
        score = np.concatenate([self.score[rows], scores], 1)
        ids = np.concatenate([self.id[rows], np.broadcast_to(block.ids, scores.shape)], 1)
        kind = np.concatenate([self.kind[rows], np.where(allowed, block.nulls.astype(np.int8), np.int8(2))], 1)
        order = np.lexsort((ids, kind, ~score, kind == 2))[:, :k]
        self.score[rows], self.id[rows], self.kind[rows] = (np.take_along_axis(x, order, 1) for x in (score, ids, kind))
        full = self.kind[rows, k - 1] != 2
        self.reach[rows[full]] = np.maximum(self.reach[rows[full]], self.score[rows[full], k - 1])


def search(blocks: list[Block], query_ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Put what these blocks hold into ``best``, without the queries' own ids."""
    bounds = np.stack([b.bounds(queries) for b in blocks], 1)
    order = np.argsort(-bounds, axis=1, kind="stable")
    live = np.arange(len(queries))
    for step in range(len(blocks)):
        at = order[live, step]
        reaches = bounds[live, at] >= best.reach[live]
        live, at = live[reaches], at[reaches]
        if not len(live):
            break
        for j in np.unique(at):
            mine, block = live[at == j], blocks[j]
            scores = block.score(queries[mine])
            allowed = (scores >= best.reach[mine][:, None]) & (block.nulls | (block.ids != query_ids[mine][:, None]))
            some = allowed.any(1)
            if some.any():
                best.offer(mine[some], scores[some], block, allowed[some])


def _query_groups(packed: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of at most QUERY_BYTES of queries (one block at least), in the fewest bytes that hold their numbers.

    The driver holds a group at a time.
    """
    held, size = [], 0
    for _, n, width, kind, ids, _, data in packed.toLocalIterator():
        matrix = np.frombuffer(data, kind).reshape(n, width)
        if held and size + matrix.nbytes > QUERY_BYTES:
            yield _joined(held)
            held, size = [], 0
        held.append((np.frombuffer(ids, np.int64), matrix))
        size += matrix.nbytes
    if held:
        yield _joined(held)


def _joined(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    width = max(m.shape[1] for _, m in blocks)
    return np.concatenate([i for i, _ in blocks]), np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in blocks])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", block_rows: int = 256) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score: each query's k candidates of the highest inner product.

    ``vectors`` and ``queries`` have an id and an array of long. A task's memory doesn't grow with them.
    """
    spark = vectors.sparkSession
    both = [df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())) for df in (vectors, queries)]
    size = F.transform("v", lambda x: F.abs(x.cast("double")))
    at = F.array_position(size, F.array_max(size))
    # the id's hash deals out equal vectors, however many there are
    order = {"a": F.coalesce(at * F.signum(F.get("v", (at - 1).cast("int")).cast("double")), F.lit(0.0)), "b": F.coalesce(F.array_max(size), F.lit(0.0)), "c": F.xxhash64("id")}
    ranged = both[0].withColumns(order).repartitionByRange("a", "b", "c").sortWithinPartitions("a", "b", "c")
    blocks = materialize(pack_blocks(ranged, block_rows), "blocks")
    asked = materialize(pack_blocks(both[1].where("id is not null").groupBy("id").agg(F.min("v").alias("v")), QUERY_ROWS), "queries")
    n_blocks = blocks.count()
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("id")))

    def found(source: DataFrame, held) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, matrix, reach = held.value
            parts = range(0, len(ids), QUERY_ROWS)
            best = [Best(len(ids[a : a + QUERY_ROWS]), k, reach[a : a + QUERY_ROWS]) for a in parts]
            blocks, size = [], 0

            def meet() -> None:
                for a, b in zip(parts, best, strict=True):
                    search(blocks, ids[a : a + QUERY_ROWS], matrix[a : a + QUERY_ROWS].astype(np.int64), b)
                blocks.clear()

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                    blocks.append(Block.opened(*row))
                    size += blocks[-1].vectors.nbytes
                    if size >= HELD_BYTES:
                        meet()
                        size = 0
            if blocks:
                meet()
            for a, b in zip(parts, best, strict=True):
                q, c = np.nonzero(b.kind != 2)
                columns = [ids[a + q], pa.array(b.id[q, c], mask=b.kind[q, c] == 1), b.score[q, c]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "id", "score"])

        return source.mapInArrow(run, "query_id long, id long, score long")

    parts, results, sent = [], [], []
    for ids, matrix in _query_groups(asked):
        reach = np.full(len(ids), LEAST)
        if n_blocks > 2 * FIRST_BLOCKS:
            some = blocks.where(F.pmod(F.xxhash64("block"), F.lit(n_blocks)) < FIRST_BLOCKS)
            held = spark.sparkContext.broadcast((ids, matrix, reach))
            first = found(some, held).withColumn("rank", ranked).where(F.col("rank") == k).select("query_id", "score").toArrow()  # a row a query of the group
            order_of = np.argsort(ids)
            reach[order_of[np.searchsorted(ids, first.column(0).to_numpy(), sorter=order_of)]] = first.column(1).to_numpy()
            held.destroy()
        sent.append(spark.sparkContext.broadcast((ids, matrix, reach)))  # QUERY_BYTES at most
        parts.append(found(blocks, sent[-1]))
        if len(parts) == PASSES:
            results.append(materialize(reduce(DataFrame.unionAll, parts), "found"))
            for x in sent:
                x.destroy()
            parts, sent = [], []
    whole = reduce(DataFrame.unionAll, [*results, *parts]) if results or parts else spark.createDataFrame([], "query_id long, id long, score long")
    return whole.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = rows.where(F.col("embedding").isNotNull() & finite).select("vec_id", quantize(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), t AS (
  SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM t q JOIN t c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
