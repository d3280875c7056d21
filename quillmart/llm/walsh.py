"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

The transform of an integer vector is exact, and squared distances between transforms
are ``dims`` times those between the vectors. Coefficients are ordered by sequency, so
the first few carry the coarse shape. For a vector, squared differences to all
centroids are added up over a first block of coefficients; the closest one so far is
finished over all of them, and its exact distance is the bar. Block by block, centroids
whose sum already exceeds the bar are strictly worse and drop out; those left are
finished. Everything is integer arithmetic, ties go to the smaller number.

Vectors are transformed once and written to the shared folder; a round reads that
table, adds up counts and coefficients per centroid in each task, and Spark sums
those; the driver gets centroids x (dims + 1) numbers, whatever the input. As the
transform is linear, sums of coefficients give the sums of components.

Defined cases: null vectors, vectors of another length and vectors with null or
non-finite components are left out; null ids are kept but start no centroid unless
there are too few other vectors; repeated rows are vectors of their own (equal ids
start as many centroids as rows, in an order fixed by their transforms); fewer vectors
than centroids make fewer centroids; an empty table gives an empty result. A
component of 16,384 or more in size is an error: its distances would not fit 64 bits.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
LARGEST = 1 << 24  # of a scaled component
BLOCKS = (8, 16, 32, 64)  # coefficients that are known after each step
ROWS_AT_ONCE = 8192
SEED_PREFIX = "3:"


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (length a power of two), in natural order; exact for integers."""
    out = vectors.astype(np.int64)
    n, half = out.shape[1], 1
    while half < n:
        pairs = out.reshape(len(out), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), n)
        half *= 2
    return out


def sequency_order(dims: int) -> np.ndarray:
    """Natural positions of the Walsh functions by their number of sign changes, the smoothest first."""
    functions = transform(np.eye(dims, dtype=np.int64))
    return np.argsort((functions[:, 1:] != functions[:, :-1]).sum(axis=1), kind="stable")


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as integers."""
    out = np.floor(values.astype(np.float64) * SCALE)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST // SCALE} or more in size: distances would not fit 64 bits")
    return out.astype(np.int64)


def usable(vectors: DataFrame, column: str, dims: int | None = None) -> DataFrame:
    """Rows whose vector has ``dims`` components (any number if None), none of them null or not finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    right = F.col(column).isNotNull() & fine
    return vectors.where(right & (F.size(column) == dims) if dims else right)


def nearest(coefs: np.ndarray, centres: np.ndarray, blocks=BLOCKS) -> tuple[np.ndarray, np.ndarray, int]:
    """(centre, squared distance of the transforms, coefficient differences taken) for each row."""
    n, k = len(coefs), len(centres)
    sums = np.zeros((n, k), np.int64)
    alive = np.ones((n, k), bool)
    taken = 0

    def add(rows, centre, a, b):
        part = coefs[rows, a:b] - centre[..., a:b]
        return np.einsum("ij,ij->i", part, part)

    first = blocks[0]
    for c in range(k):
        sums[:, c] = add(slice(None), centres[c], 0, first)
    lead = sums.argmin(axis=1)
    rows = np.arange(n)
    bar = sums[rows, lead] + add(rows, centres[lead], first, coefs.shape[1])
    alive[rows, lead] = False  # it is finished
    taken += n * k * first + n * (coefs.shape[1] - first)
    for a, b in zip(blocks[:-1], blocks[1:]):
        alive &= sums <= bar[:, None]
        for c in range(k):
            left = np.flatnonzero(alive[:, c])
            if len(left):
                sums[left, c] += add(left, centres[c], a, b)
                taken += len(left) * (b - a)
    sums[~alive] = np.iinfo(np.int64).max
    sums[rows, lead] = bar
    best = sums.argmin(axis=1)
    return best, sums[rows, best], taken


def _coefs(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of coefficients from a binary column of little-endian 32-bit integers."""
    blob = b"".join(column.to_pylist())
    return np.frombuffer(blob, "<i4").reshape(-1, dims).astype(np.int64)


def transformed(vectors: DataFrame, column: str = "embedding", dims: int = DIMS) -> DataFrame:
    """(vec_id, coefs): scaled and transformed vectors, by sequency, as little-endian 32-bit integers."""
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                 F.col(column).cast("array<double>").alias("vector")), "vector", dims)
    order = sequency_order(dims)

    def apply(batches):
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            coefs = transform(scaled(values))[:, order].astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes() for c in coefs], pa.binary())], names=["vec_id", "coefs"])

    return rows.mapInArrow(apply, "vec_id long, coefs binary")


def _components(coefs: np.ndarray) -> np.ndarray:
    """Back from coefficients by sequency (of one row) to components."""
    dims = coefs.shape[-1]
    natural = np.zeros((1, dims), object)
    natural[0, sequency_order(dims)] = [int(c) for c in coefs]
    half = 1
    while half < dims:  # in whole numbers of any size: these may be sums over all vectors
        pairs = natural.reshape(1, dims // (2 * half), 2, half)
        natural = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(1, dims)
        half *= 2
    return np.array([x // dims for x in natural[0]], object)


def cluster_centres(table: DataFrame, dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Coefficients of the centroids after ``rounds``, from a table of ``transformed`` vectors."""
    seed = F.sha2(F.concat(F.lit(SEED_PREFIX), F.col("vec_id").cast("string")), 256)
    seeds = table.orderBy(seed.asc_nulls_last(), "coefs").limit(k).collect()  # k rows
    centres = np.array([np.frombuffer(s["coefs"], "<i4") for s in seeds], np.int64).reshape(-1, dims)
    order = sequency_order(dims)
    for _ in range(rounds if len(centres) else 0):
        def tally(batches, centres=centres):
            total = np.zeros((len(centres), dims + 1), np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    coefs = _coefs(batch.column("coefs").slice(at, ROWS_AT_ONCE), dims)
                    best = nearest(coefs, centres)[0]
                    for c in np.unique(best):
                        own = coefs[best == c]
                        total[c, :dims] += own.sum(axis=0)
                        total[c, dims] += len(own)
            full = np.flatnonzero(total[:, dims])
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(list(total[full]), pa.list_(pa.int64()))],
                                             names=["cluster", "sums"])

        sums = (table.select("coefs").mapInArrow(tally, "cluster int, sums array<long>")
                .select("cluster", F.posexplode("sums").alias("at", "value"))
                .groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))
        found: dict[int, dict[int, int]] = {}
        for r in sums.collect():  # k x (dims + 1) rows
            found.setdefault(r["cluster"], {})[r["at"]] = int(r["value"])
        for c, values in found.items():
            whole = _components(np.array([values[j] for j in range(dims)], object))
            means = np.array([[int(x // values[dims]) for x in whole]], np.int64)
            centres[c] = transform(means)[0, order]
    return centres


def cluster(spark: SparkSession, vectors: DataFrame, column: str = "embedding", dims: int = DIMS,
            k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    table = stage(spark, transformed(vectors, column, dims), "walsh")
    centres = cluster_centres(table, dims, k, rounds)

    def assign(batches):
        for batch in batches:
            best, far, _ = nearest(_coefs(batch.column("coefs"), dims), centres)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(far // dims, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    assigned = stage(spark, table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(str(int(x)) for x in _components(c)).encode()).hexdigest() for c in centres]
    per = spark.createDataFrame(
        [(c, s, sum(inertia.values()), digests[c]) for c, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    """The clustering in DuckDB SQL, a pair of CTEs for each round."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c
  FROM (SELECT sha256('{SEED_PREFIX}' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})
)"""]
    assign = """a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS m FROM (
    SELECT vec_id, v, cluster,
           list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)])::BIGINT AS d
    FROM kept, c{i}) GROUP BY vec_id
)"""
    for i in range(rounds):
        parts.append(assign.format(i=i))
        parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(n.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list(mean ORDER BY j) AS c FROM (
      SELECT m.cluster AS cluster, j, CASE WHEN sum(x) >= 0 THEN sum(x) // count(*)
             ELSE -((-sum(x) + count(*) - 1) // count(*)) END AS mean
      FROM (SELECT m, unnest(v) AS x, unnest(range({dims})) AS j FROM a{i}) GROUP BY 1, 2) GROUP BY cluster
  ) n ON n.cluster = c{i}.cluster
)""")
    parts.append(assign.format(i=rounds))
    ctes = ",\n".join(parts)
    return f"""WITH {ctes}
SELECT vec_id, CAST(m.cluster AS INT) AS cluster, m.d AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.cluster = m.cluster"""


ORACLE = oracle()
