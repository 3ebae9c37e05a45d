"""Exact integer centroid clustering over Hilbert-ordered blocks with zone maps.

1. Vectors become whole numbers, floor(256 x) per component, and are sorted along a Hilbert curve over all components at once (two
   bits each, cut at the mean and at 0.67 standard deviations around it). A range-partitioned sort deals them out; a serial number splits
   runs of equal vectors. Neighbours on the curve are packed into blocks, written once with the least and greatest value of each
   component: the block's box.
2. A round takes each block's box first. With c* the centroid nearest to its middle, the greatest difference of the squared distances to c*
   and to c over the whole box is a sum of one bound per component; where it is negative, c is nearest to no vector of the block. The
   centroids left are the block's candidates, and its vectors are compared with them exactly, as a matrix product.
3. A task returns at most one sum and count per centroid; Spark adds them up. Only the centroids reach the driver: their number times the
   components, whatever the number of vectors.

Products are taken in doubles where all sums stay below 2**53, which the boxes tell, and in 64-bit integers beyond, so they are exact.

Defined cases: vectors that are null, of another length, or with a null, infinite or NaN component are left out; components beyond +-2**27
count as that; rows that repeat are clustered each; a null id is hashed as an empty string; fewer vectors than centroids give so many
centroids; equal start hashes are taken in order of the vectors' components; sums beyond a long are null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.bytewords import tidy
from brickfolio.llm.tables import bounded, stored

REACH = 1 << 27
EXACT = 1 << 53


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """vec_id, vector: array of int, of the rows with a vector of ``size`` finite components."""
    fit = (F.size(vector_col) == size) & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(REACH))), F.lit(float(-REACH)))).cast("int"))
    return rows.where(F.coalesce(fit, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vector"))


# --- the curve -----------------------------------------------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """cells: rows of coordinates below 2**bits. Returns each cell's place on the Hilbert curve as bytes, most significant first.

    Coordinates are turned and reflected level by level, then Gray-coded (Skilling, 2004), here for all rows at once.
    """
    x = np.ascontiguousarray(cells.T, dtype=np.uint8)
    for level in range(bits - 1, 0, -1):
        low = np.uint8((1 << level) - 1)
        for k in range(len(x)):
            up = (x[k] >> level & 1).astype(bool)
            swapped = np.where(up, 0, (x[0] ^ x[k]) & low).astype(np.uint8)
            x[0] ^= np.where(up, low, swapped)
            x[k] ^= swapped
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint8)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0).astype(np.uint8)
    x ^= flip
    planes = np.concatenate([(x >> b) & 1 for b in range(bits - 1, -1, -1)])
    return np.packbits(planes, axis=0).T


def _keyed(cuts: np.ndarray) -> Callable:
    """cuts: for each component the values at which the curve's cells part, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("vector").flatten().to_numpy().reshape(n, cuts.shape[1])
            keys = hilbert_keys((x[None] > cuts[:, None]).sum(axis=0), 2)
            width = keys.shape[1]
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(keys).tobytes())]).cast(pa.binary())
            flat = x.astype(np.int32)
            bodies = [row.tobytes() for row in flat]
            yield pa.record_batch([batch.column("vec_id"), pa.array(bodies, pa.binary()), packed], ["vec_id", "body", "place"])
    return run


def _packed(size: int, block: int) -> Callable:
    def block_of(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([x.tobytes()], pa.binary()),
            pa.array([x.min(axis=0).tobytes()], pa.binary()), pa.array([x.max(axis=0).tobytes()], pa.binary())], ["ids", "body", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = pa.array([], pa.int64()), np.zeros((0, size), dtype=np.int32)
        for batch in batches:
            ids = pa.concat_arrays([ids, batch.column("vec_id")])
            x = np.concatenate([x, np.frombuffer(b"".join(batch.column("body").to_pylist()), dtype=np.int32).reshape(-1, size)])
            while len(x) >= block:
                yield block_of(ids.slice(0, block), x[:block])
                ids, x = ids.slice(block), x[block:]
        if len(x):
            yield block_of(ids, x)
    return run


def zone_blocks(vectors: DataFrame, size: int = 64, block: int = 256) -> DataFrame:
    """vectors: vec_id, vector. A stored table of blocks along the curve: ids, body (the vectors), low and high (their box)."""
    spark = vectors.sparkSession
    stats = vectors.agg(*[f(F.col("vector")[k].cast("double")) for f in (F.avg, F.stddev_pop) for k in range(size)]).first()
    mean, spread = (np.array([v or 0.0 for v in stats[a:a + size]]) for a in (0, size))
    cuts = np.stack([mean - 0.67 * spread, mean, mean + 0.67 * spread])
    keyed = vectors.mapInArrow(tidy(_keyed(cuts)), "vec_id long, body binary, place binary").withColumn("serial", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "place", "serial").sortWithinPartitions("place", "serial").select("vec_id", "body")
    return stored(ordered.mapInArrow(tidy(_packed(size, block)), "ids array<long>, body binary, low binary, high binary"), "blocks")


# --- rounds ------------------------------------------------------------------------------------------------------------------------


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Ascending numbers of the centroids that may be nearest, or as near, to some point of the box. All int64."""
    middle = (low + high) >> 1
    best = int(np.argmin(((centroids - middle) ** 2).sum(axis=1)))
    slope = 2 * (centroids - centroids[best])     # d(x, best) - d(x, c) = slope x + |best|^2 - |c|^2
    most = np.where(slope > 0, slope * high, slope * low).sum(axis=1) + square[best] - square
    return np.flatnonzero(most >= 0)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a block the nearest centroid, the first of equals, and the squared distance."""
    some = candidates(low, high, centroids, square)
    near = centroids[some]
    reach = int(max(np.abs(low).max(), np.abs(high).max(), np.abs(near).max()))
    if 4 * reach * reach * x.shape[1] < EXACT:
        body = x.astype(np.float64)
        product = (body @ near.astype(np.float64).T).astype(np.int64)
        own = np.einsum("ij,ij->i", body, body).astype(np.int64)
    else:
        body = x.astype(np.int64)
        product = np.einsum("ij,kj->ik", body, near)
        own = np.einsum("ij,ij->i", body, body)
    distance = own[:, None] - 2 * product + square[some]
    place = distance.argmin(axis=1)
    return some[place], distance[np.arange(len(x)), place]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            body, low, high = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=np.int32) for c in ("body", "low", "high"))
            yield batch.column("ids")[k].values, body.reshape(-1, size), low.astype(np.int64), high.astype(np.int64)


def _sums(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        square = (centroids ** 2).sum(axis=1)
        total, count = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, x, low, high in _blocks(batches, size):
            of, _ = nearest(x, low, high, centroids, square)
            order = np.argsort(of, kind="stable")
            some, first = np.unique(of[order], return_index=True)
            total[some] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            count += np.bincount(of, minlength=k)
        some = np.flatnonzero(count)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])
    return run


def _assign(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (centroids ** 2).sum(axis=1)
        for ids, x, low, high in _blocks(batches, centroids.shape[1]):
            of, distance = nearest(x, low, high, centroids, square)
            yield pa.record_batch([ids, pa.array(of, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])
    return run


def start_centroids(vectors: DataFrame, k: int, seed: int = 2) -> np.ndarray:
    """The vectors of the k smallest hashes of their ids, in order of the hashes."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(code.alias("code"), "vector").orderBy("code", "vector").limit(k).collect()   # k rows
    return np.array([r.vector for r in rows], dtype=np.int64)


def move(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid with vectors becomes their mean, rounded down."""
    size = centroids.shape[1]
    sums = (bounded(blocks).mapInArrow(tidy(_sums(centroids)), "cluster int, n long, sums array<long>")
            .groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[d]) for d in range(size)]).alias("sums")).collect())  # a row per centroid
    out = centroids.copy()
    for row in sums:
        out[row.cluster] = [s // row.n for s in row.sums]
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, k: int = 40, rounds: int = 5, scale: int = 256,
            seed: int = 2, block: int = 256) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, id_col, vector_col, size, scale)
    centroids = start_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = zone_blocks(vectors, size, block)
    for _ in range(rounds):
        centroids = move(blocks, centroids)
    assigned = stored(bounded(blocks).mapInArrow(tidy(_assign(centroids)), "vec_id long, cluster int, distance long"), "assigned")
    codes = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    own = assigned.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.try_sum("distance").alias("inertia"))
    # a row per centroid on the side that is broadcast
    known = own.join(spark.createDataFrame(codes, "cluster int, centroid_sha256 string"), "cluster").crossJoin(total)
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _cluster_sql(size: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2) -> str:
    """The same clustering as one statement, a row per vector and component."""
    steps = [f"""v AS (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS xs FROM embeddings
  WHERE len(embedding) = {size} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS (SELECT vec_id, i, xs[i] AS x FROM v, generate_series(1, {size}) AS g(i)),
c0 AS (
  SELECT s.c, i, xs[i] AS y FROM (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, xs FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}) AS s,
    generate_series(1, {size}) AS g(i))"""]
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS (SELECT vec_id, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM x JOIN c{n} USING (i) GROUP BY vec_id, c),
a{n} AS (SELECT vec_id, c, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS k FROM d{n}) WHERE k = 1)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS y FROM (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{n} JOIN x USING (vec_id) GROUP BY c, i)),
c{n + 1} AS (SELECT o.c, o.i, coalesce(m.y, o.y) AS y FROM c{n} AS o LEFT JOIN m{n} AS m ON o.c = m.c AND o.i = m.i)""")
    return "WITH " + ",\n".join(steps) + f""",
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS code FROM c{rounds} GROUP BY c),
w AS (SELECT c, CAST(sum(d) AS BIGINT) AS own FROM a{rounds} GROUP BY c)
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, w.own AS cluster_inertia,
  (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia, h.code AS centroid_sha256
FROM a{rounds} AS a JOIN h USING (c) JOIN w USING (c)"""


CLUSTER_SQL = _cluster_sql()
