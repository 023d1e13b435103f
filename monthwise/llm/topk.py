"""Exact top-k inner products with a pivot-distance index.

Index.  ``PIVOTS`` vectors, chosen by hash, are the pivots.  Every vector is
keyed by its nearest pivot and its distance r to it, and the distances of a
pivot are cut in ``RINGS`` annuli of equal width; (pivot, annulus) is a cell.
A cell's summary is its row count, smallest and largest r, and largest norm
N: at most ``PIVOTS * RINGS`` rows, whatever the data.

Search.  For a query q at distance d from the pivot p, the triangle
inequality says |q - v| >= max(0, d - r_max, r_min - d) for every v of the
cell.  As <q, v> = (|q|^2 + |v|^2 - |q - v|^2) / 2, that bounds the score from
above; so do |q| N and <q, p> + |q| r_max.  A query expands its cells in
descending bound: first the fewest cells with k + 1 vectors, then
``SECOND`` more, then all others whose bound reaches its k-th score so far.
The rest is never read for it.  Bounds have a margin for rounding and scores
are integers, so the result is exact.

Scan.  Vectors of a cell are dealt in chunks of about ``BLOCK`` rows and the
queries that read it likewise; a task multiplies one pair of chunks and
keeps k rows a query.  A cell that holds a third of all rows is many chunks.

Cases.  A null vector or one with a null or non-finite component takes no
part, nor does a null id.  Shorter vectors count as followed by zeros.  Rows
of equal id are candidates each; equal vectors rank by id.  Fewer than k
candidates: all.  Scores beyond 64 bits are clamped.  An empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import read_table, record_batch, staged

PIVOTS = 64
RINGS = 32
SECOND = 16
BLOCK = 4096
SCALE = 1024


def _valid(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.expr(
        f"forall({vector}, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))"
    )


def _matrix(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


class Cells:
    """Pivots and cell summaries (bounded by the parameters)."""

    def __init__(self, pivots: np.ndarray, summary: pd.DataFrame):
        self.pivots = pivots
        self.cell = summary["cell"].to_numpy()
        self.pivot = self.cell // RINGS
        self.count = summary["n"].to_numpy()
        self.low, self.high, self.norm = (summary[c].to_numpy() for c in ("low", "high", "norm"))

    def order(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query, the cells (as positions) by descending bound, and the bounds."""
        q = queries.astype(np.float64)
        norm2 = (q * q).sum(axis=1)[:, None]
        p = self.pivots.astype(np.float64)
        dots = q @ p.T
        d = np.sqrt(np.maximum(0, norm2 + (p * p).sum(axis=1)[None, :] - 2 * dots))[:, self.pivot]
        apart = np.maximum(0, np.maximum(d - self.high, self.low - d))
        by_distance = (norm2 + self.norm**2 - apart**2) / 2
        length = np.sqrt(norm2)
        bound = np.minimum(np.minimum(by_distance, length * self.norm), dots[:, self.pivot] + length * self.high)
        bound = bound + 1e-6 * (norm2 + self.norm**2) + 1  # rounding of distances and products
        ranked = np.argsort(-bound, axis=1, kind="stable")
        return ranked, np.take_along_axis(bound, ranked, axis=1)

    def round_cells(self, queries: np.ndarray, kth: np.ndarray, k: int, stage: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, cell) to read in round ``stage``, given each query's
        k-th score so far (-inf if it has fewer)."""
        ranked, bound = self.order(queries)
        seen = np.cumsum(self.count[ranked], axis=1)
        first = (seen < k + 1).sum(axis=1) + 1  # fewest cells with k + 1 vectors
        place = np.arange(ranked.shape[1])[None, :]
        ends = [np.zeros_like(first), first, first + SECOND, np.full_like(first, ranked.shape[1])]
        take = (place >= ends[stage][:, None]) & (place < ends[stage + 1][:, None]) & (bound >= kth[:, None])
        row, at = np.nonzero(take)
        return row, self.cell[ranked[row, at]]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if largest < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    if largest < 2**62:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one query, by score, then id (``ids`` ascend)."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def top_k(vectors: DataFrame, is_query: Column, k: int, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best other rows of every row
    where ``is_query`` holds."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = vectors.where(_valid(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("_id"),
        F.coalesce(is_query, F.lit(False)).alias("_query"),
        F.monotonically_increasing_id().alias("_uid"),
        F.expr(f"transform({vector}, x -> floor({SCALE} * cast(x as double)))").alias("_v"),
    )
    rows = staged(rows, "topk/rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_v")).alias("dim"), F.max(F.expr("array_max(transform(_v, x -> abs(x)))")).alias("most")).first()
    if not size["n"] or not size["dim"]:
        dim, kind = 1, "<i4"
    else:
        dim, kind = size["dim"], "<i4" if (size["most"] or 0) < 2**31 else "<i8"
    if not size["n"]:
        return empty

    # pivots: distinct vectors of the smallest hashes, found under a hash bound
    h = F.shiftrightunsigned(F.xxhash64("_v", F.lit("pivot")), 33)
    bound = int(min(1.0, 16 * PIVOTS / size["n"]) * (1 << 31))
    chosen = rows.where(h <= bound).groupBy(h.alias("_h")).agg(F.first("_v").alias("_v")).orderBy("_h").limit(PIVOTS).collect()
    if not chosen:  # all under the bound are copies that hash above it
        chosen = rows.select("_v").limit(1).collect()
    pivots = np.zeros((len(chosen), dim), dtype=np.int64)
    for i, r in enumerate(chosen):
        pivots[i, : len(r["_v"])] = r["_v"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.astype(np.float64)
        p2 = (p * p).sum(axis=1)
        schema = pa.schema([("_id", pa.int64()), ("_query", pa.bool_()), ("_uid", pa.int64()), ("_pivot", pa.int32()), ("_r", pa.float64()), ("_norm", pa.float64()), ("_vec", pa.binary())])
        for batch in batches:
            column = batch.column(3)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(column.offsets.to_numpy())
            v = np.zeros((batch.num_rows, dim), dtype=np.int64)
            v[np.arange(dim)[None, :] < lengths[:, None]] = flat
            x = v.astype(np.float64)
            d2 = np.maximum(0, (x * x).sum(axis=1)[:, None] + p2[None, :] - 2 * (x @ p.T))
            near = d2.argmin(axis=1)
            packed = v.astype(kind)
            yield record_batch(
                schema,
                [batch.column(0), batch.column(1), batch.column(2), near.astype(np.int32), np.sqrt(d2[np.arange(len(v)), near]), np.sqrt((x * x).sum(axis=1)), [row.tobytes() for row in packed]],
            )

    index = rows.mapInArrow(assign, "_id long, _query boolean, _uid long, _pivot int, _r double, _norm double, _vec binary")
    index = staged(index, "topk/index")
    widest = index.groupBy("_pivot").agg(F.max("_r").alias("_far"))  # PIVOTS rows
    ring = F.least(F.lit(RINGS - 1), F.floor(F.col("_r") * RINGS / F.greatest(F.col("_far"), F.lit(1e-9))))
    index = index.join(F.broadcast(widest), "_pivot").withColumn("_cell", (F.col("_pivot") * RINGS + ring).cast("int"))
    summary = index.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("_r").alias("low"), F.max("_r").alias("high"), F.max("_norm").alias("norm")
    )
    facts = sorted(summary.collect(), key=lambda r: r["_cell"])
    cells = Cells(pivots, pd.DataFrame([(r["_cell"], r["n"], r["low"], r["high"], r["norm"]) for r in facts], columns=["cell", "n", "low", "high", "norm"]))
    chunks = spark.createDataFrame([(r["_cell"], -(-r["n"] // BLOCK)) for r in facts], "_cell int, _n int")
    index = index.join(F.broadcast(chunks), "_cell").withColumn("_chunk", F.pmod(F.xxhash64("_uid"), F.col("_n")).cast("int"))
    queries = index.where("_query").select(F.col("_uid").alias("_q"), F.col("_id").alias("query_id"), F.col("_vec").alias("_qvec"))

    def plan(stage: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("_q", pa.int64()), ("query_id", pa.int64()), ("_qvec", pa.binary()), ("_cell", pa.int32())])
            for whole in batches:
                for lo in range(0, whole.num_rows, 1024):
                    batch = whole.slice(lo, 1024)
                    kth = batch.column(3).to_numpy(zero_copy_only=False)
                    row, cell = cells.round_cells(_matrix(batch.column(2), kind, dim), kth, k, stage)
                    at = pa.array(row)
                    yield record_batch(schema, [*[batch.column(i).take(at) for i in range(3)], cell.astype(np.int32)])

        return run

    def scan(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"_q": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            ids, uids = right["_id"].to_numpy(), right["_uid"].to_numpy()
            order = np.lexsort((uids, ids))
            v = _matrix(right["_vec"], kind, dim)[order]
            ids, uids = ids[order], uids[order]
            qs, qids = left["_q"].to_numpy(), left["query_id"].to_numpy()
            q = _matrix(left["_qvec"], kind, dim)
            for lo in range(0, len(q), 256):
                scores = _products(q[lo : lo + 256], v)
                for i, line in enumerate(scores):
                    other = uids != qs[lo + i]
                    best = _best(line[other], ids[other], k)
                    out["_q"] += [int(qs[lo + i])] * len(best)
                    out["query_id"] += [int(qids[lo + i])] * len(best)
                    out["vec_id"] += ids[other][best].tolist()
                    out["score"] += line[other][best].tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    found = None
    rank = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
    for stage in range(3):
        if found is None:
            ready = queries.withColumn("_kth", F.lit(float("-inf")))
        else:
            kth = found.where(F.col("_rank") == k).select("_q", F.col("score").cast("double").alias("_kth"))
            ready = queries.join(kth, "_q", "left").fillna(float("-inf"), ["_kth"])
        probes = ready.select("_q", "query_id", "_qvec", "_kth").mapInArrow(plan(stage), "_q long, query_id long, _qvec binary, _cell int")
        probes = staged(probes, f"topk/probes{stage}")
        readers = probes.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_nq"))
        sides = F.broadcast(readers.join(F.broadcast(chunks), "_cell"))  # a row a cell
        left = (
            probes.join(sides, "_cell")
            .withColumn("_part", F.pmod(F.xxhash64("_q"), F.col("_nq")).cast("int"))
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
            .select("_cell", "_chunk", "_part", "_q", "query_id", "_qvec")
        )
        right = (
            index.drop("_n")
            .join(sides, "_cell")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_nq") - 1)))
            .select("_cell", "_chunk", "_part", "_id", "_uid", "_vec")
        )
        keys = ["_cell", "_chunk", "_part"]
        part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(scan, "_q long, query_id long, vec_id long, score long")
        # cells of different rounds differ, so no pair comes twice
        part = part if found is None else part.union(found.select("_q", "query_id", "vec_id", "score"))
        found = staged(part.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k), f"topk/found{stage}")
    return found.select("query_id", F.col("_rank").alias("rank"), "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other vectors of every vec_id divisible by 100."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
