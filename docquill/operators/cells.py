"""A written index of vectors: k-means cells with radii, searched exactly by the triangle inequality.

Centres are fitted by numpy on a bounded sample (SAMPLE vectors, in the order of a hash of their ids); every vector is then
assigned to its nearest centre. A row of the index has the packed vectors of a cell, or of a part of a large one. For each cell the
number of vectors and their smallest and largest distance from the centre are known; there are at most CELLS of them, so this
table is held by tasks whatever the corpus' size is.

A question's distance d from a centre says that a vector of the cell is at least d - high or low - d away, and at most d + high.
The nearest cells that hold k vectors are searched first; their k-th distance is the bound for the others, and cells that can't hold
a hit are never read. Questions are taken in groups of bounded size; only (cell, question) pairs that remain are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .lexical import _numpy, arrow_schema, best_columns, dense_scores, merged, no_hits, question_groups

#: Vectors that centres are fitted on, cells at most, vectors of a packed row, rounds of k-means.
SAMPLE, CELLS, PART_ROWS, ROUNDS = 20_000, 4096, 2048, 8
_SLACK = 1e-8


@dataclass(frozen=True)
class VectorIndex:
    """The folder of an index; centres and, per cell, its number of vectors and least and largest distance."""

    spark: SparkSession
    path: str
    cid: str
    id_type: str
    centres: np.ndarray
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def packed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(d2, 0.0))


def fit_centres(x: np.ndarray, cells: int) -> np.ndarray:
    rng = np.random.default_rng(0)
    x = np.unique(x, axis=0)
    centres = x[rng.permutation(len(x))[:cells]]
    for _ in range(ROUNDS):
        own = _distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _stacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(float) if len(values) else np.zeros((0, 0))


def build_vector_index(corpus: DataFrame, cid: str = "chunk_id", vector: str = "embedding", cells: int | None = None) -> VectorIndex:
    """Write the index of all vectors that aren't null."""
    spark = corpus.sparkSession
    path = work_path(spark, "vector-index")
    rows = corpus.where(F.col(vector).isNotNull()).select(F.col(cid).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    # The vectors are counted while the sample is taken.
    counted = Observation()
    sampled = rows.observe(counted, F.count(F.lit(1)).alias("n")).orderBy(F.xxhash64("id")).limit(SAMPLE)
    sample = _stacked(sampled.select("v").toArrow().column("v"))
    n = counted.get["n"]
    cells = cells or min(CELLS, max(1, int(np.sqrt(n))))
    centres = fit_centres(sample, cells) if n else np.zeros((1, 1))
    id_type = corpus.schema[cid].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _distances(_stacked(batch.column("v")), centres)
                own = far.argmin(1).astype(np.int32)
                columns = [batch.column("id"), batch.column("v"), pa.array(own), pa.array(far[np.arange(len(own)), own])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "cell", "far"])

    rows.mapInArrow(assign, f"id {id_type}, v array<double>, cell int, far double").write.parquet(f"{path}/assigned")
    assigned = spark.read.parquet(f"{path}/assigned")
    told = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
    # At most CELLS rows.
    stats = {r.cell: r for r in told.collect()}
    sizes, low, high = (np.array([getattr(stats[c], name) if c in stats else 0 for c in range(len(centres))], float) for name in ("n", "low", "high"))
    parts = F.broadcast(spark.createDataFrame([(c, -(-r.n // PART_ROWS)) for c, r in stats.items()], "cell int, parts int"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    packed = assigned.join(parts, "cell").select("cell", part, F.struct("id", "v").alias("x"))
    packed = packed.groupBy("cell", "part").agg(F.collect_list("x").alias("x"))
    packed = packed.select("cell", "part", F.col("x.id").alias("ids"), F.flatten("x.v").alias("flat"))
    packed.sortWithinPartitions("cell").write.parquet(f"{path}/cells")
    return VectorIndex(spark, path, cid, id_type, centres, sizes, low, high)


def dense_index_topk(index: VectorIndex, queries: DataFrame, k: int, qid: str = "query_id", vector: str = "embedding") -> DataFrame:
    """(qid, cid, score, rank): the k nearest vectors per question; score is 1 / (1 + squared distance)."""
    known = queries.where(F.col(vector).isNotNull()).select(qid, F.col(vector).cast("array<double>").alias("v"))
    out = None
    for group in question_groups(known, qid, F.size("v") * 8):
        hits = _group(index, group, k, qid)[0]
        out = hits if out is None else out.unionByName(hits)
    return no_hits(known, qid, index.cid, index.id_type) if out is None else out


def cells_read(index: VectorIndex, queries: DataFrame, k: int, qid: str = "query_id", vector: str = "embedding") -> tuple[int, int]:
    """(question, cell) pairs that a search reads, and all there are."""
    known = queries.where(F.col(vector).isNotNull()).select(qid, F.col(vector).cast("array<double>").alias("v"))
    read = sum(_group(index, group, k, qid)[1] for group in question_groups(known, qid, F.size("v") * 8))
    return read, known.count() * int((index.sizes > 0).sum())


def _group(index: VectorIndex, queries: DataFrame, k: int, qid: str) -> tuple[DataFrame, int]:
    asked = queries.toArrow()
    ids, q = asked.column(qid).to_pylist(), _stacked(asked.column("v"))
    q_type = queries.schema[qid].dataType.simpleString()
    schema = f"{qid} {q_type}, {index.cid} {index.id_type}, score double, block int"
    full = index.sizes > 0
    if not len(ids) or not full.any():
        return no_hits(queries, qid, index.cid, index.id_type), 0
    d = _distances(q, index.centres)
    d[:, ~full] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    held = np.cumsum(index.sizes[order], axis=1)
    # The nearest cells up to the one with which they hold k vectors.
    need = np.argmax(held >= min(k, int(index.sizes.sum())), axis=1)
    chosen = np.zeros(d.shape, bool)
    np.put_along_axis(chosen, order, np.arange(d.shape[1])[None, :] <= need[:, None], 1)
    chosen &= full[None, :]
    names, kinds = [qid, index.cid], arrow_schema(schema)

    def search(pairs: np.ndarray) -> DataFrame:
        where: dict[int, np.ndarray] = {int(c): np.flatnonzero(pairs[:, c]) for c in np.flatnonzero(pairs.any(0))}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    mine = where[batch.column("cell")[i].as_py()]
                    own = _numpy(batch.column("ids")[i].values)
                    sort = np.argsort(own, kind="stable")
                    c = batch.column("flat")[i].values.to_numpy().reshape(len(own), -1)[sort]
                    values = dense_scores(q[mine], c)
                    best = best_columns(values, k)
                    row = np.repeat(np.arange(len(mine)), best.shape[1])
                    found = pa.table({names[0]: [ids[mine[r]] for r in row], names[1]: own[sort][best.ravel()], "score": np.take_along_axis(values, best, 1).ravel(), "block": np.full(len(row), batch.column("cell")[i].as_py(), np.int32)})
                    yield from found.cast(kinds).to_batches()

        # The needed cells only; the rows of the index are sorted by cell.
        return index.packed.where(F.col("cell").isin(list(where))).mapInArrow(run, schema)

    first = search(chosen).checkpoint()
    floors = {r[qid]: r.floor for r in merged(first, k, qid, index.cid).groupBy(qid).agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k).collect()}
    floor = np.array([floors.get(x, -1.0) for x in ids])
    least = np.maximum(np.maximum(d - index.high[None, :], index.low[None, :] - d), 0.0)
    more = (1.0 / (1.0 + least * least) >= floor[:, None] - _SLACK) & ~chosen & full[None, :]
    hits = first.unionByName(search(more)) if more.any() else first
    return merged(hits, k, qid, index.cid).select(qid, index.cid, "score", "rank"), int(chosen.sum() + more.sum())
