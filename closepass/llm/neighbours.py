"""Nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised on their own, so `codes` centroids each name codes x codes cells.  A
query goes over the cells in the order of the summed distance of its halves to their centroids, with a heap over
centroid pairs, until the cells hold the share of all rows that finds `RECALL` of the neighbours; the rows of
these cells are reranked by their exact distance.

The centroids are fitted on about `FIT_ROWS` vectors, or 32 for each centroid; every row is indexed.  The share is measured on the
whole index: about `FIT_QUERIES` of the fitted vectors are compared with all rows, once, and the share is what holds
`RECALL` of the neighbours that they have.  So it falls as the table grows and neighbours come closer.  The number of
centroids grows with the square root of the rows, up to `MOST_CODES`, which 4 million rows reach.

Equal vectors are indexed as one, with their `k` + 1 least ids: no result can name more of them.  Cells are put
together in regions, of `REGION_CODES` first centroids each, so a query travels once to a region, with the cells it
wants there, and returns `k` rows from it, however many cells there are.  Rows of a region are dealt in blocks, and
so are its queries, so neither a full region nor a popular one is one task's.

Defined cases: vectors that are null, zero or hold null or non-finite components, and those of another
dimension than most (the smaller one if two are as frequent), take no part; with fewer than `k` other rows all are
returned; equal distances are ordered by vec_id; repeated rows of one vec_id and vector are one row; other
columns are ignored.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closepass.llm.store import mapped, stored

K = 10
FIT_ROWS = 12_000
FIT_QUERIES = 200
FIT_ROUNDS = 10
RECALL = 0.97
MOST_CODES = 512
REGION_CODES = 4
BLOCK_NUMBERS = 1 << 20  # vector components in a block of rows: 8 MB
BLOCK_QUERIES = 2048


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1), 0)


def centroids(rows: np.ndarray, codes: int, rounds: int = FIT_ROUNDS, seed: int = 5) -> np.ndarray:
    distinct = np.unique(rows, axis=0)
    random = np.random.default_rng(seed)
    found = distinct[random.permutation(len(distinct))[:codes]].copy()
    for _ in range(rounds):
        nearest = _squared(rows, found).argmin(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, rows)
        n = np.bincount(nearest, minlength=len(found))
        found[n > 0] = sums[n > 0] / n[n > 0, None]
    return found


class MultiIndex:
    """Centroids of both halves, how many rows each cell holds, and how many a query needs."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.half = max(1, sample.shape[1] // 2)
        self.first = centroids(sample[:, : self.half], codes)
        self.second = centroids(sample[:, self.half :], codes)
        self.counts = np.zeros(len(self.first) * len(self.second), dtype=np.int64)
        self.share = 1.0

    def cells(self, rows: np.ndarray) -> np.ndarray:
        first = _squared(rows[:, : self.half], self.first).argmin(axis=1)
        return first * len(self.second) + _squared(rows[:, self.half :], self.second).argmin(axis=1)

    def region(self, cell):
        return cell // len(self.second) // REGION_CODES

    def traversal(self, row: np.ndarray):
        """Cells by summed distance.  The heap holds the best pair not yet taken of each row of the sorted grid;
        a row opens when the one before it has given its first pair."""
        d1 = _squared(row[None, : self.half], self.first)[0]
        d2 = _squared(row[None, self.half :], self.second)[0]
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        o1, o2, width = o1.tolist(), o2.tolist(), len(self.second)
        heap = [(s1[0] + s2[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield o1[i] * width + o2[j]
            if j + 1 < len(s2):
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(s1):
                heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))

    def probed(self, row: np.ndarray, least: int) -> list[int]:
        """The cells that hold the wanted share of the rows, `least` of them at least; empty ones left out."""
        want = max(least, self.share * self.counts.sum())
        out, held = [], 0
        for cell in self.traversal(row):
            if held >= want:
                break
            n = int(self.counts[cell])
            if n:
                out.append(cell)
                held += n
        return out

    def measure(self, queries: np.ndarray, near: dict[int, list[int]], recall: float) -> None:
        """Sets the share of rows to go over so that `recall` of the neighbours of some queries are met.

        near: the cells of the neighbours of each query.
        """
        total, needed = max(int(self.counts.sum()), 1), []
        for q, cells in near.items():
            missing, held = set(cells), 0
            before = {}
            for cell in self.traversal(queries[q]):
                held += int(self.counts[cell])
                if cell in missing:
                    before[cell] = held
                    missing.remove(cell)
                    if not missing:
                        break
            needed += [before[c] / total for c in cells]
        self.share = float(np.quantile(needed, recall)) if needed else 1.0


def _closest(queries: np.ndarray, k: int):
    """The `k` nearest entries of a task to each query, other than those equal to it: query, score, cell."""

    def run(batches):
        score = np.full((len(queries), k), np.inf)
        cell = np.full((len(queries), k), -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _squared(queries, _matrix(batch.column("vector")))
            own[own <= 1e-12 * (queries**2).sum(axis=1)[:, None]] = np.inf
            every = np.append(score, own, axis=1)
            cells = np.append(cell, np.broadcast_to(batch.column("cell").to_numpy(), own.shape), axis=1)
            best = np.argpartition(every, k - 1, axis=1)[:, :k]
            score, cell = np.take_along_axis(every, best, axis=1), np.take_along_axis(cells, best, axis=1)
        query, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(score[query, at]), pa.array(cell[query, at])], ["query", "score", "cell"]
        )

    return run


VECTOR = "vec_id long, vector array<double>"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, vector (double) of the rows that take part."""
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = vectors.where("vec_id is not null and vector is not null and size(vector) > 0").where(
        finite & F.exists("vector", lambda x: x != 0)
    )
    frequent = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return vectors.where(F.size("vector") == (frequent[0].d if frequent else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _assign(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            if batch.num_rows:
                cells = index.cells(_matrix(batch.column("vector")))
                batch = batch.append_column("cell", pa.array(cells, pa.int64()))
                yield batch.append_column("region", pa.array(index.region(cells), pa.int64()))

    return run


VISITS = pa.list_(pa.struct([("region", pa.int64()), ("cells", pa.list_(pa.int64()))]))


def _probe(shared, least: int):
    def run(batches):
        index = shared.value
        for batch in batches:
            if batch.num_rows:
                visits = []
                for row in _matrix(batch.column("vector")):
                    cells = np.sort(index.probed(row, least))
                    regions, begin = np.unique(index.region(cells), return_index=True)
                    parts = np.split(cells, begin[1:])
                    visits.append([{"region": r, "cells": c} for r, c in zip(regions.tolist(), parts)])
                yield batch.append_column("visits", pa.array(visits, VISITS))

    return run


def _rerank(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and rows.num_rows:
            q, v = (_matrix(t["vector"].combine_chunks()) for t in (queries, rows))
            cell_of = rows["cell"].to_numpy()
            wanted = np.zeros(cell_of.max() + 1, dtype=bool)
            ids = rows["vec_ids"].combine_chunks()
            ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            flat = ids.flatten().to_numpy()
            for query, row, cells in zip(queries["vec_id"].to_pylist(), q, queries["cells"]):
                cells = cells.values.to_numpy()
                wanted[:] = False
                wanted[cells[cells < len(wanted)]] = True
                near = np.flatnonzero(wanted[cell_of])
                score = np.sqrt(((v[near] - row) ** 2).sum(axis=1))
                if len(near) > k + 1:  # one of the k + 1 nearest can be the query's own row
                    close = score <= np.partition(score, k)[k]
                    near, score = near[close], score[close]
                found = [(d, i) for r, d in zip(near, score.tolist()) for i in flat[ends[r] : ends[r + 1]].tolist() if i != query]
                found = sorted(found)[:k]
                out["query_id"] += [query] * len(found)
                out["vec_id"] += [i for _, i in found]
                out["score"] += [d for d, _ in found]
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return run


def nearest(rows: DataFrame, is_query, k: int = K, recall: float = RECALL, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per query (rows where `is_query` holds): query_id, rank, vec_id, score of its `k` nearest other rows."""
    spark = rows.sparkSession
    vectors = stored(usable(rows).distinct())
    total = vectors.count()
    bucket = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000))
    codes = int(np.clip(round((total / 16) ** 0.5), 2, MOST_CODES))
    share = min(1_000_000, -(-max(fit_rows, 32 * codes) * 1_000_000 // max(total, 1)))
    fitted = vectors.where(bucket < share).orderBy("vec_id").select("vector").toArrow()["vector"].combine_chunks()
    if not len(fitted):
        fitted = vectors.limit(1).select("vector").toArrow()["vector"].combine_chunks()
    if not len(fitted):
        empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return empty
    sample = _matrix(fitted)
    index = MultiIndex(sample, codes)
    placing = spark.sparkContext.broadcast(index)
    # equal vectors are one entry with their least ids
    first = Window.partitionBy("vector").orderBy("vec_id")
    entries = vectors.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    entries = entries.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))
    schema = "vec_ids array<long>, vector array<double>, cell long, region long"
    entries = stored(entries.select("vec_ids", "vector").transform(mapped, _assign(placing), schema))
    held = entries.groupBy("region", "cell").agg(F.sum(F.size("vec_ids")).alias("n"), F.count("*").alias("rows"))
    rows_of = np.zeros(index.region(len(index.counts) - 1) + 1, dtype=np.int64)
    for region, cell, n, m in held.collect():  # at most codes x codes rows
        index.counts[cell] = n
        rows_of[region] += m
    # sampled queries against all entries, in blocks
    probes = sample[:: max(1, len(sample) // FIT_QUERIES)]
    near = entries.select("vector", "cell").transform(mapped, _closest(probes, k), "query long, score double, cell long")
    nearer = F.row_number().over(Window.partitionBy("query").orderBy("score", "cell"))
    cells_of: dict[int, list[int]] = {}
    for q, cell in near.withColumn("r", nearer).where(F.col("r") <= k).select("query", "cell").collect():  # k a query
        cells_of.setdefault(q, []).append(cell)
    index.measure(probes, cells_of, recall)
    probing = spark.sparkContext.broadcast(index)
    schema = f"{VECTOR}, visits array<struct<region: long, cells: array<long>>>"
    queries = vectors.where(is_query).transform(mapped, _probe(probing, k + 1), schema)
    queries = stored(queries.select("vec_id", "vector", F.explode("visits").alias("visit")).select("vec_id", "vector", "visit.*"))
    # a block is a part of the rows of a region with a part of its queries; one row for each region
    asked = dict(queries.groupBy("region").count().collect())
    block_rows = max(256, BLOCK_NUMBERS // len(fitted[0]))
    blocks = [(r, -(-int(rows_of[r]) // block_rows), -(-asked[r] // BLOCK_QUERIES)) for r in sorted(asked)]
    blocks = F.broadcast(spark.createDataFrame(blocks, "region long, row_parts int, query_parts int"))
    parts = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = queries.join(blocks, "region").withColumn("query_part", F.pmod(F.xxhash64("vec_id"), F.col("query_parts")).cast("int"))
    left = left.withColumn("row_part", parts("row_parts")).select("region", "row_part", "query_part", "vec_id", "vector", "cells")
    right = entries.join(blocks, "region").withColumn("row_part", F.pmod(F.xxhash64("vector"), F.col("row_parts")).cast("int"))
    right = right.withColumn("query_part", parts("query_parts"))
    right = right.select("region", "row_part", "query_part", "vec_ids", "vector", "cell")
    key = ["region", "row_part", "query_part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_rerank(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_inverted_multi_index(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
