"""Exact top-k search by integer inner product over norm-sorted vectors.

Method.  Candidates are cut into ranges by descending length.  The longest
vectors of all (SEED_ROWS, the only ones that are broadcast) give every query a
k-th best score to begin with; the query goes to those ranges alone whose
greatest length times its own can reach it (Cauchy-Schwarz).  Queries meet
candidates where both are rows: a task holds one range of candidates and
streams the queries past it, in tiles of queries dealt by their ids.  It works
in blocks, longest candidates first.  For a block it drops every query whose
length times the block's greatest length is below the query's k-th best score.
For the others it takes partial sums over the leading coordinates of an SVD
rotation and adds the product of the residual lengths; a pair whose bound is
below that score is dropped.  What is left gets its exact integer product.

Nothing that grows with the queries or the candidates reaches the driver but
one number for each range and each tile.

Defined results: vectors that are null, or hold a null or a non-finite
component, and rows without id take no part.  Vectors are compared with those
of equal dimension.  A query never meets rows of its own id.  Exact repeats of
a row count once.  Equal scores rank by the smaller id.  Products are exact
while they fit 64 bits.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Longest vectors that give the first bounds, and rows that fit the rotation.
SEED_ROWS = 4096
ROTATION_ROWS = 4096
#: Candidates of a range at most (fewer while there are fewer ranges than tasks), and at least; queries of a tile on average.
RANGE_ROWS, LEAST_RANGE_ROWS, TILE_ROWS = 65536, 2048, 1 << 18
#: Candidates and queries scored at once, and leading rotated coordinates of the partial sums.
BLOCK_ROWS, QUERY_ROWS = 1024, 2048
LEADING = 16
#: Share of surviving pairs from which a block is multiplied whole.
DENSE = 0.02


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, v (array of floor(scale * x)) and n2 (squared length) of the rows that take part."""
    parts: Column = F.col(vec_col)
    fit = F.col(id_col).isNotNull() & parts.isNotNull() & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(parts, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = df.filter(fit).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
    return rows.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of an array column, by dimension."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, flat[(ends[rows] - d)[:, None] + np.arange(d)[None, :]]))
    return out


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; through floating point where every sum fits its 53 bits."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1]
    if most < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors of the sample, by descending singular value."""
    d = sample.shape[1]
    if not len(sample) or not d:
        return np.eye(d)
    x = sample.astype(np.float64)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, k: int, bound: np.ndarray) -> None:
        self.k, self.bound = k, bound.copy()
        self.q = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        q, score, ids = (np.concatenate(x) for x in ((self.q, q), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        q, score, ids = q[new], score[new], ids[new]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        last = rank == self.k - 1
        self.bound[q[last]] = np.maximum(self.bound[q[last]], score[last])
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]


class _Blocks:
    """Candidates of one dimension, longest first, in blocks with their partial sums."""

    def __init__(self, ids: np.ndarray, c: np.ndarray, basis: np.ndarray) -> None:
        self.basis = basis[:, : min(LEADING, c.shape[1])]
        self.blocks = []
        norm, rot, rest = _measured(c, self.basis)
        for i in range(0, len(ids), BLOCK_ROWS):
            part = slice(i, i + BLOCK_ROWS)
            self.blocks.append((ids[part], c[part], norm[part], rot[part], rest[part]))

    def search(self, q_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> _Best:
        """The k best of each query; bounds are widened by the rounding of their sums."""
        best = _Best(k, bound)
        q_norm, q_rot, q_rest = _measured(q, self.basis)
        for ids, c, norm, rot, rest in self.blocks:
            near = np.flatnonzero(q_norm * norm.max() * (1 + 1e-9) + 1e-6 >= best.bound)
            if not len(near):
                continue
            most = q_rot[near] @ rot.T + q_rest[near][:, None] * rest[None, :]
            most += 1e-9 * q_norm[near][:, None] * norm[None, :] + 1e-6
            rows, cols = np.nonzero(most >= best.bound[near][:, None])
            if not len(rows):
                continue
            if len(rows) >= DENSE * most.size:
                scores = _products(q[near], c)[rows, cols]
            else:
                scores = np.concatenate([(q[near[rows[i : i + 65536]]] * c[cols[i : i + 65536]]).sum(1) for i in range(0, len(rows), 65536)])
            hit = near[rows]
            keep = (scores >= best.bound[hit]) & (q_ids[hit] != ids[cols])
            best.add(hit[keep], scores[keep], ids[cols[keep]])
        return best


def _measured(x: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, leading rotated coordinates, and lengths of what they leave out (rounded up)."""
    x = x.astype(np.float64)
    norm, rot = np.sqrt((x * x).sum(1)), x @ basis
    return norm, rot, np.sqrt(np.maximum(norm**2 - (rot**2).sum(1), 0.0)) + 1e-6 * (1 + norm)


def _kth_best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that at least k distinct candidates reach."""
    bound = np.full(len(q), np.iinfo(np.int64).min, np.int64)
    ids, first = np.unique(ids, return_index=True)
    c = c[first]
    if len(ids) <= k:
        return bound
    for i in range(0, len(q), 512):
        s = _products(q[i : i + 512], c)
        s[q_ids[i : i + 512][:, None] == ids[None, :]] = np.iinfo(np.int64).min
        bound[i : i + 512] = np.partition(s, -k, axis=1)[:, -k]
    return bound


def _ranges(spark, vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """The candidates with their range, written, and the greatest length in each range that has any."""
    n = vectors.count()
    ranges = max(1, -(-n // RANGE_ROWS), min(-(-n // LEAST_RANGE_ROWS), spark.sparkContext.defaultParallelism))
    dealt = vectors.repartitionByRange(ranges, F.desc("n2"), F.asc("vec_id")).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "ranged-vectors")
    longest = {r.range: float(r.n2) ** 0.5 for r in dealt.groupBy("range").agg(F.max("n2").alias("n2")).collect()}
    for i in range(max(longest, default=-1), -1, -1):  # a range without rows is as long as the next one
        longest[i] = max(longest.get(i, 0.0), longest.get(i + 1, 0.0))
    return dealt, [longest[i] for i in range(len(longest))]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of vectors for each row of queries.

    Both come from quantised().
    """
    spark = vectors.sparkSession
    candidates, longest = _ranges(spark, vectors)
    fit = candidates.select("v").orderBy(F.xxhash64("v")).limit(ROTATION_ROWS).toArrow()
    bases = {m.shape[1]: _rotation(m) for _, m in _matrix(fit["v"])} if fit.num_rows else {}
    top = candidates.select("vec_id", "v", "n2").orderBy(F.desc("n2"), "vec_id").limit(SEED_ROWS).toArrow()
    top_ids = top["vec_id"].to_numpy()
    seeds = {m.shape[1]: (top_ids[rows], m) for rows, m in _matrix(top["v"])} if top.num_rows else {}
    held = spark.sparkContext.broadcast((bases, seeds, np.array(longest)))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds each query's first bound and the last range that can reach it."""
        _, seeds, longest = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, norm = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 2))
            bound = np.full(len(ids), np.iinfo(np.int64).min, np.int64)
            for rows, q in _matrix(batch.column(1)):
                if (seed := seeds.get(q.shape[1])) is not None:
                    bound[rows] = _kth_best(ids[rows], q, *seed, k)
            need = np.where(bound > 0, bound / np.maximum(np.sqrt(norm), 1e-9) * (1 - 1e-9) - 1e-6, 0.0)
            last = np.searchsorted(-longest, -need, "right") - 1  # ranges stand by descending length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound), pa.array(last.astype(np.int32))], ["vec_id", "v", "n2", "bound", "last"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = held.value[0]
        mark, held_rows, blocks = None, [], {}

        def met(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, bound = (np.asarray(part.column(i).to_numpy(zero_copy_only=False)) for i in (3, 5))
            for rows, q in _matrix(part.column(4)):
                if (own := blocks.get(q.shape[1])) is None:
                    continue
                for i in range(0, len(rows), QUERY_ROWS):
                    r = rows[i : i + QUERY_ROWS]
                    b = own.search(ids[r], q[i : i + QUERY_ROWS], bound[r].astype(np.int64), k)
                    if len(b.q):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[r][b.q]), pa.array(b.id), pa.array(b.score)], ["query_id", "vec_id", "score"])

        for batch in batches:
            names = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 1, 2)]
            cuts = [0, *(np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                own, part = (int(names[0][a]), int(names[1][a])), batch.slice(a, b - a)
                if own != mark:
                    mark, held_rows, blocks = own, [], {}
                if not names[2][a]:  # candidates stand before the queries
                    held_rows.append(part.select([3, 4]))
                    continue
                if held_rows:
                    whole = pa.Table.from_batches(held_rows).combine_chunks()
                    ids = whole.column(0).to_numpy()
                    blocks = {m.shape[1]: _Blocks(ids[rows], m, bases.get(m.shape[1], np.eye(m.shape[1]))) for rows, m in _matrix(whole.column(1))}
                    held_rows = []
                yield from met(part)

    tiles = max(1, -(-queries.count() // TILE_ROWS))
    asked = queries.select("vec_id", "v", "n2").mapInArrow(bounded, "vec_id long, v array<long>, n2 double, bound long, last int")
    asked = written(asked.filter("last >= 0").withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int")), "bounded-queries")
    reach = {r.tile: r.last for r in asked.groupBy("tile").agg(F.max("last").alias("last")).collect()}
    if not reach:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    wanted = F.array(*[F.struct(F.lit(t).alias("tile"), F.lit(x).alias("last")) for t, x in sorted(reach.items())])
    left = candidates.select("*", F.explode(wanted).alias("for")).filter("range <= for.last")
    left = left.select("range", "for.tile", F.lit(False).alias("asks"), "vec_id", "v", F.lit(None).cast("long").alias("bound"), "n2")
    right = asked.select(F.explode(F.sequence(F.lit(0), F.col("last"))).alias("range"), "tile", F.lit(True).alias("asks"), "vec_id", "v", "bound", "n2")
    met = left.unionByName(right).repartition("range", "tile").sortWithinPartitions("range", "tile", "asks", F.desc("n2"), "vec_id").drop("n2")
    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256::DOUBLE * x::DOUBLE) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
