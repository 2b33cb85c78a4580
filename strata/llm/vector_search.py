"""Approximate nearest neighbours over balanced posting lists.

* ``fit`` cuts a bounded sample of the vectors in two, again and again, at the
  quantile of the direction between two means, until there are as many leaves
  as lists; so lists hold about as many vectors each. The leaves' means are
  the centroids, and a graph of near centroids is searched best-first, many
  vectors at a time, in every worker's memory.
* Every vector is indexed: in its nearest list, and, if it lies near a border,
  in up to ``REPLICAS`` further ones whose centroids are at most ``BORDER``
  times as far and not behind a list that already has it.
* A query reads the lists of the nearest centroids, up to a number and up to a
  ratio to the distance of the nearest one. Both are calibrated: a bounded
  sample of the queries reads every list, and from the lists in which their
  true neighbours are, ``calibrated`` takes the least reading that finds
  ``RECALL`` of them.
* Shelves of neighbouring lists meet their queries in bounded blocks by a
  cogroup; distances are worked out again in double precision from the
  original vectors.

Equal vectors are indexed once, with the smallest ids that any query can need
(one more than ``k``, since they tie in distance and the smaller ids win), so
a vector that makes up a third of the table costs as much as any other.
A query that finds fewer than ``k`` rows though there are more reads every list.

Defined results: vectors that are null, zero, hold a null or non-finite
component, or are not of the most common length take no part, nor do rows with
a null id; rows equal in id and vector count once; with fewer than ``k``
candidates all are given; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import salted_join
from strata.sources.checkpoint import materialize

LIST_SIZE = 128  # vectors of a list, about, while there are no more than MAX_LISTS
MAX_LISTS = 16_384  # centroids that every worker holds, at most
LEAF = 8  # vectors of the sample in a leaf, at least
SAMPLE = LEAF * MAX_LISTS  # vectors that the centroids are fitted on, at most
REPLICAS, BORDER = 4, 1.25
RECALL = 0.97  # of the calibration queries' neighbours that reading up to the limits must find
CALIBRATION = 128  # queries that the limits are calibrated on, at most
DEGREE = 24
SHELF = 8  # neighbouring lists that are read together, each query only in those that it wants
BLOCK = 2048  # vectors of a shelf that meet queries at once, about


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray  # one row a list
    near: np.ndarray  # ids of each centroid's neighbours

    def search(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the (about) n nearest centroids of each row of x, nearest first, and squared distances."""
        k = len(self.points)
        if k <= 2 * n:
            d = ((x[:, None, :] - self.points[None]) ** 2).sum(axis=2) if k * x.size < 1 << 24 else (
                (x**2).sum(axis=1)[:, None] - 2 * x @ self.points.T + (self.points**2).sum(axis=1))
            ids = np.argsort(d, axis=1, kind="stable")[:, :n]
            return ids, np.maximum(np.take_along_axis(d, ids, axis=1), 0)
        ids = np.full((len(x), n), -1)
        d = np.full((len(x), n), np.inf)
        open_, seen = np.zeros((len(x), n), bool), np.zeros((len(x), k), bool)
        start = np.unique(np.linspace(0, k - 1, min(8, n)).astype(int))
        ids[:, : len(start)], open_[:, : len(start)], seen[:, start] = start, True, True
        d[:, : len(start)] = ((x[:, None, :] - self.points[start][None]) ** 2).sum(axis=2)
        while True:
            waiting = np.where(open_, d, np.inf)
            best = waiting.argmin(axis=1)
            rows = np.flatnonzero(np.isfinite(waiting[np.arange(len(x)), best]))
            if not len(rows):
                break
            open_[rows, best[rows]] = False
            near = self.near[ids[rows, best[rows]]]
            fresh = ~seen[rows[:, None], near]
            seen[rows[:, None], near] = True
            new = np.where(fresh, ((x[rows][:, None, :] - self.points[near]) ** 2).sum(axis=2), np.inf)
            all_ids, all_d = np.hstack([ids[rows], near]), np.hstack([d[rows], new])
            all_open = np.hstack([open_[rows], fresh])
            keep = np.argpartition(all_d, n - 1, axis=1)[:, :n]
            ids[rows], d[rows], open_[rows] = (np.take_along_axis(a, keep, axis=1) for a in (all_ids, all_d, all_open))
        order = np.argsort(d, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(d, order, axis=1)


def fit(sample: np.ndarray, lists: int, seed: int = 7) -> Centroids:
    """Centroids of balanced leaves, and for each its DEGREE nearest and two random others as neighbours."""
    leaves, todo = [], [(np.arange(len(sample)), lists)]
    rng = np.random.default_rng(seed)
    while todo:
        rows, n = todo.pop()
        if n <= 1 or len(rows) < 2 * n:
            leaves.append(sample[rows].mean(axis=0))
            continue
        x = sample[rows]
        means = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            side = ((x - means[0]) ** 2).sum(axis=1) > ((x - means[1]) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            means = np.stack([x[~side].mean(axis=0), x[side].mean(axis=0)])
        order = np.argsort(x @ (means[1] - means[0]), kind="stable")
        cut = len(x) * (n // 2) // n
        todo += [(rows[order[:cut]], n // 2), (rows[order[cut:]], n - n // 2)]
    points = np.array(leaves, np.float32)
    k, near = len(points), []
    for at in range(0, k, 512):
        d = (points[at : at + 512] ** 2).sum(axis=1)[:, None] - 2 * points[at : at + 512] @ points.T + (points**2).sum(axis=1)
        near.append(np.argsort(d, axis=1, kind="stable")[:, : min(k, DEGREE + 1)])
    return Centroids(points, np.hstack([np.vstack(near), rng.integers(0, k, (k, 2))]))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id`` and ``_v`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v")).where("_id is not null and _v is not null")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(~F.exists("_v", bad) & F.exists("_v", lambda x: x != 0))
    length = rows.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("_v") == (length["n"] if length else 0))


def distinct_vectors(rows: DataFrame, keep: int, dtype: str) -> DataFrame:
    """``_key`` (MD5), ``_vec`` (bytes) and ``_ids`` (the ``keep`` smallest) of every different vector. A task
    gathers its own rows' ids first, and tasks are put together in two steps."""
    keep_type = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_vec", T.BinaryType()), T.StructField("_ids", T.ArrayType(keep_type)), T.StructField("_part", T.IntegerType())])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            values = plain(batch.column("_v").flatten().to_numpy(zero_copy_only=False), dtype).reshape(batch.num_rows, -1)
            own: dict[bytes, list] = {}
            for v, i in zip(values, batch.column("_id").to_pylist()):
                own.setdefault(v.tobytes(), []).append(i)
            ids = [sorted(set(x))[:keep] for x in own.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(ids, pa.list_(batch.column("_id").type)),
                                              pa.array([part] * len(own), pa.int32())], ["_vec", "_ids", "_part"])

    def together(parts: DataFrame, *by) -> DataFrame:
        return parts.groupBy("_vec", *by).agg(F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("_ids")))), 1, keep).alias("_ids"))

    parts = rows.mapInArrow(gathered, schema).withColumn("_turn", F.pmod(F.xxhash64(F.spark_partition_id(), "_part"), F.lit(64)))
    return together(together(parts, "_turn")).withColumn("_key", F.unhex(F.md5("_vec")))


def postings(vectors: DataFrame, index, dtype: str) -> DataFrame:
    """``_list``, ``_vec`` and ``_ids``: every vector in its lists."""
    schema = T.StructType([T.StructField("_list", T.IntegerType()), *[vectors.schema[c] for c in ("_vec", "_ids")]])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = index.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = np.frombuffer(b"".join(batch.column("_vec").to_pylist()), dtype).reshape(batch.num_rows, -1).astype(np.float32)
                ids, d = centroids.search(x, min(2 * REPLICAS, len(centroids.points)))
                chosen = np.zeros(ids.shape, bool)
                chosen[:, 0] = True
                for j in range(1, ids.shape[1]):
                    between = ((centroids.points[ids[:, :j]] - centroids.points[ids[:, j]][:, None, :]) ** 2).sum(axis=2)
                    behind = (chosen[:, :j] & (between < d[:, j][:, None])).any(axis=1)
                    chosen[:, j] = np.isfinite(d[:, j]) & (d[:, j] <= BORDER**2 * d[:, 0]) & ~behind & (chosen[:, :j].sum(axis=1) < REPLICAS)
                row, col = np.nonzero(chosen)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col], pa.int32()), taken.column("_vec"), taken.column("_ids")], ["_list", "_vec", "_ids"])

    return vectors.select("_vec", "_ids").mapInArrow(assigned, schema)


def probes(queries: DataFrame, index, dtype: str, most: int, ratio: float) -> DataFrame:
    """``_list``, ``_key`` and ``_vec``: every query with the lists that it reads, ``most`` of them and only those
    whose centroid is up to ``ratio`` times as far as the nearest one."""
    schema = T.StructType([T.StructField("_list", T.IntegerType()), *[queries.schema[c] for c in ("_key", "_vec")]])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = index.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = np.frombuffer(b"".join(batch.column("_vec").to_pylist()), dtype).reshape(batch.num_rows, -1).astype(np.float32)
                ids, d = centroids.search(x, min(most, len(centroids.points)))
                row, col = np.nonzero((d <= ratio**2 * d[:, :1]) & (ids >= 0))
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col], pa.int32()), taken.column("_key"), taken.column("_vec")], ["_list", "_key", "_vec"])

    return queries.select("_key", "_vec").mapInArrow(chosen, schema)


def scanned(lists: DataFrame, wanted: DataFrame, k: int, dtype: str, blocks: int, query_blocks: int) -> DataFrame:
    """``_key``, ``_ids`` and ``score``: of each shelf (SHELF neighbouring lists) the ``k`` + 1 nearest vectors, in those
    of its lists that the query reads. Shelves of many vectors or queries are dealt out in ``blocks`` and
    ``query_blocks`` parts that all meet."""
    schema = T.StructType([wanted.schema["_key"], lists.schema["_ids"], T.StructField("score", T.DoubleType())])
    spread = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shelf = F.floor(F.col("_list") / SHELF).cast("int")
    left = lists.withColumn("_shelf", shelf).withColumn("_a", spread("_vec", blocks)).withColumn("_b", every(query_blocks))
    right = wanted.withColumn("_shelf", shelf).withColumn("_b", spread("_key", query_blocks)).withColumn("_a", every(blocks))

    def matrix(values: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1).astype(np.float64)

    def nearest(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"_key": [], "_ids": [], "score": []}, dtype=object)
        x, ids = matrix(vectors["_vec"]), vectors["_ids"].tolist()
        square, same = (x**2).sum(axis=1), pd.factorize(vectors["_vec"])[0]
        place, reads = vectors["_list"].to_numpy() % SHELF, queries.groupby("_key", sort=False).agg({"_vec": "first", "_list": list})
        out = []
        for at in range(0, len(reads), 256):
            some = reads.iloc[at : at + 256]
            q, read = matrix(some["_vec"]), np.zeros((len(some), SHELF), bool)
            for i, lists_ in enumerate(some["_list"]):
                read[i, np.array(lists_) % SHELF] = True
            rough = np.where(read[:, place], square - 2 * q @ x.T, np.inf)  # the squared distance but for a constant of the query
            n = min((k + 1) * REPLICAS, len(x)) - 1
            limit = np.partition(rough, n, axis=1)[:, n] + 1e-9 * (square.max() + (q**2).sum(axis=1))
            row, col = np.nonzero((rough <= limit[:, None]) & np.isfinite(rough))
            found = pd.DataFrame({"row": row, "col": col, "same": same[col], "id": [ids[c][0] for c in col], "score": np.sqrt(((x[col] - q[row]) ** 2).sum(axis=1))})
            found = found.drop_duplicates(["row", "same"]).sort_values(["row", "score", "id"]).groupby("row").head(k + 1)
            out.append(pd.DataFrame({"_key": some.index[found["row"]].to_numpy(), "_ids": [ids[c] for c in found["col"]], "score": found["score"].to_numpy()}, dtype=object))
        return pd.concat(out)

    return left.groupBy("_shelf", "_a", "_b").cogroup(right.groupBy("_shelf", "_a", "_b")).applyInPandas(nearest, schema)


def calibrated(true: DataFrame, stored: DataFrame, queries: list, centroids: Centroids, dtype: str) -> tuple[int, float]:
    """Number and ratio of the lists to read. ``true``: ``_key`` and ``_id`` of the neighbours of the (at most
    CALIBRATION) queries; where those lie comes to the driver, some rows for each."""
    wanted = true.select("_id").distinct()
    places = stored.select("_list", F.explode("_ids").alias("_id")).join(wanted, "_id", "left_semi").distinct()
    lists = {}
    for r in true.join(places, "_id").select("_key", "_id", "_list").collect():
        lists.setdefault((bytes(r["_key"]), r["_id"]), []).append(r["_list"])
    order, ratios = {}, {}
    for q in queries:
        x = np.frombuffer(q["_vec"], dtype).astype(np.float32)
        d = ((centroids.points - x) ** 2).sum(axis=1)
        rank = np.empty(len(d), np.int64)
        rank[np.argsort(d, kind="stable")] = np.arange(len(d))
        order[bytes(q["_key"])], ratios[bytes(q["_key"])] = rank, np.sqrt(d / max(d.min(), 1e-30))
    first = [min((order[key][x], ratios[key][x]) for x in found) for (key, _), found in lists.items()]
    if not first:
        return len(centroids.points), np.inf
    ranks, far = np.sort([r for r, _ in first]), np.sort([f for _, f in first])
    at = lambda values, share: values[min(len(values) - 1, int(np.ceil(share * len(values))))]
    return int(at(ranks, 1 - (1 - RECALL) * 0.7)) + 1, float(at(far, 1 - (1 - RECALL) * 0.3)) * (1 + 1e-6)


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           sample: int = SAMPLE, list_size: int = LIST_SIZE) -> DataFrame:
    """query_id, rank (from 1), ``id_col`` and score (Euclidean distance) of the ``k`` nearest other rows found for
    every row that ``is_query`` (a condition on the id) names."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    dtype = "<f8" if isinstance(rows.schema["_v"].dataType.elementType, T.DoubleType) else "<f4"
    different = materialize(distinct_vectors(rows, k + 1, dtype))
    total = different.count()
    fitted = different.orderBy(F.xxhash64("_key"), "_key").limit(sample).select("_vec").collect()  # at most `sample` vectors
    points = np.array([np.frombuffer(r["_vec"], dtype) for r in fitted] or [[0]], np.float32)
    lists = max(1, min(MAX_LISTS, total // list_size, len(points) // LEAF))
    index = spark.sparkContext.broadcast(fit(points, lists))
    queries = materialize(rows.where(is_query).select(F.col("_id").alias("query_id"), vector_key(dtype).alias("_key")).distinct())
    asked = queries.select("_key").distinct()
    asked = materialize(different.join(asked, "_key", "left_semi"))
    n_asked, lists = asked.count(), len(index.value.points)
    stored = materialize(postings(different, index, dtype))
    shelves = -(-lists // SHELF)
    blocks = max(1, -(-total * REPLICAS // (shelves * BLOCK * 2)))
    order = Window.partitionBy("_key").orderBy("score", "_id")

    def best(found: DataFrame) -> DataFrame:
        each = found.select("_key", "score", F.explode("_ids").alias("_id")).distinct()
        return each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")

    def read_all(some: DataFrame) -> DataFrame:
        everywhere = some.select(F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("_list"), "_key", "_vec")
        return materialize(best(scanned(stored, everywhere, k, dtype, blocks, 1)))

    some = asked.orderBy(F.xxhash64("_key"), "_key").limit(CALIBRATION)
    true = read_all(materialize(some))
    most, ratio = calibrated(true, stored, some.collect(), index.value, dtype)
    query_blocks = max(1, -(-min(n_asked, n_asked * most // shelves) // (BLOCK * 32)))
    found = materialize(best(scanned(stored, probes(asked, index, dtype, most, ratio), k, dtype, blocks, query_blocks)))
    few = asked.join(found.groupBy("_key").count().where(F.col("count") > k).select("_key"), "_key", "left_anti")
    if lists > 1 and few.take(1):
        more = read_all(few)
        found = found.join(more.select("_key").distinct(), "_key", "left_anti").select(*more.columns).union(more)
    joined = salted_join(queries, found, ["_key"], F.col("query_id"), "inner").where("_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "_id"))
    return joined.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("_id").alias(id_col), "score")


def plain(values: np.ndarray, dtype: str) -> np.ndarray:
    """The numbers with every zero positive, so that equal vectors have equal bytes."""
    return np.asarray(values, dtype) + np.zeros(1, dtype)


def vector_key(dtype: str) -> Column:
    """The MD5 of the vector ``_v``, as the index has it."""

    @F.pandas_udf(T.BinaryType())
    def key(values: pd.Series) -> pd.Series:
        return values.map(lambda v: hashlib.md5(plain(v, dtype).tobytes()).digest())

    return key("_v")
