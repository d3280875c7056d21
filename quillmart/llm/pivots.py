"""Vector codes by parts, with LAESA pivots in the nearest-entry search.

A vector is cut into equal parts; each part position has a codebook, and a vector's code
is the index of the nearest entry for every part. Distances from each part to a few
fixed pivots are computed once, rounded down to whole numbers and written with the
vectors. In each round the distances from the codebook's entries to the same pivots
are computed anew; by the triangle inequality |d(part, pivot) - d(entry, pivot)| bounds
the distance from part to entry from below. Entries are tried in the order of that
bound: the first gives a distance, the next few lower it, and of the rest only those
whose bound does not exceed it are evaluated. Where the first distance leaves more than an
eighth of a block's entries (parts without much structure), those left are evaluated in one
matrix product instead of one by one. Bounds and distances are integers, so
nothing that could tie or win is passed over.

Each round reads the written table; a task adds up counts and components per entry, Spark
sums those, and the driver gets the codebooks: parts x entries x (components + 1)
numbers, whatever the input.

Defined cases: null vectors and vectors with null or non-finite components are left out, and
so are vectors that lack components or have more: another length than most have
(of equally frequent lengths the larger; it must be a multiple of the number of
parts, and empty vectors never count). Null ids are kept but come last for the codebook's
start; repeated rows are vectors of their own, ordered by id, then by components; fewer vectors
than entries make smaller codebooks; an empty table gives an empty result. A component of 16,384
or more in size is an error. Null labels form one group. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import dealt_anew, stage
from quillmart.llm.walsh import scaled, usable

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["quillmart.llm.walsh"])

PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 4
TRIED = 8  # entries evaluated to lower the bar before the rest is pruned
DENSE = 1 / 8  # share of entries that the first bar leaves from which on a block is evaluated together
ROWS_AT_ONCE = 2048


def whole_root(squares: np.ndarray) -> np.ndarray:
    """Square roots of non-negative 64-bit integers, rounded down."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances from each row to each point, rounded down to whole numbers."""
    out = np.empty((len(rows), len(points)), np.int64)
    for j, p in enumerate(points):
        diff = rows - p
        out[:, j] = np.einsum("ij,ij->i", diff, diff)
    return whole_root(out)


def squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances from each row to each point; by a floating-point product where that is exact."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(points).max(initial=0)))
    kind = np.float64 if 4 * rows.shape[1] * most * most < 1 << 53 else np.int64
    a, b = rows.astype(kind), points.astype(kind)
    out = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
    return out.astype(np.int64)


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    far = distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(pivots, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(entries, entries[chosen[-1]:chosen[-1] + 1])[:, 0])
    return entries[chosen]


def nearest(rows: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance, distances evaluated) for each row; ties to the smaller entry.

    ``to_pivots`` and ``entry_pivots`` are whole distances (rounded down) from rows and
    entries to the same pivots: the true difference is above theirs less one.
    """
    n, k = len(rows), len(entries)
    bound = np.zeros((n, k), np.int32)
    for j in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, j, None].astype(np.int32) - entry_pivots[None, :, j].astype(np.int32)),
                   out=bound)
    bound -= 1
    np.maximum(bound, 0, out=bound)
    every = np.arange(n)
    lead = bound.argmin(axis=1)
    first = rows - entries[lead]
    left = bound <= whole_root(np.einsum("ij,ij->i", first, first))[:, None]  # bound**2 <= distance, in whole numbers
    if left.mean() > DENSE:  # most entries stand: all distances of the block at once
        far = squares(rows, entries)
        far[~left] = np.iinfo(np.int64).max
        best = far.argmin(axis=1)
        return best, far[every, best], n + int(left.sum())
    some = min(TRIED, k)
    trial = np.argpartition(bound, some - 1, axis=1)[:, :some] if some < k else np.tile(np.arange(k), (n, 1))
    trial = np.take_along_axis(trial, np.argsort(np.take_along_axis(bound, trial, 1), axis=1, kind="stable"), 1)
    best, bar, spent = np.full(n, k, np.int64), np.full(n, np.iinfo(np.int64).max, np.int64), n

    def evaluate(at, entry):
        diff = rows[at] - entries[entry]
        return np.einsum("ij,ij->i", diff, diff)

    for j in range(some):  # in the order of their bounds; a bound above the bar ends a row's trials
        low = bound[every, trial[:, j]].astype(np.int64)
        at = np.flatnonzero(low * low <= bar)
        if not len(at):
            break
        entry = trial[at, j]
        far = evaluate(at, entry)
        spent += len(at)
        better = (far < bar[at]) | ((far == bar[at]) & (entry < best[at]))
        best[at[better]], bar[at[better]] = entry[better], far[better]
    left = bound <= whole_root(bar)[:, None]  # bound**2 <= bar, in whole numbers
    np.put_along_axis(left, trial, False, 1)
    at, entry = np.nonzero(left)
    if len(at):
        far = evaluate(at, entry)
        spent += len(at)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        least = np.minimum.reduceat(far, first)
        row = at[first]
        # of equal distances the smallest entry: entries of a row come in ascending order
        hit = np.flatnonzero(far == np.repeat(least, np.diff(np.append(first, len(at)))))
        lead = hit[np.concatenate([[True], at[hit][1:] != at[hit][:-1]])]
        better = (least < bar[row]) | ((least == bar[row]) & (entry[lead] < best[row]))
        best[row[better]], bar[row[better]] = entry[lead][better], least[better]
    return best, bar, spent


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, width).astype(np.int64)


def common_length(vectors: DataFrame, column: str, parts: int) -> int:
    """The length that most usable vectors have, if it can be cut into ``parts``; 0 if there are none."""
    sizes = (vectors.groupBy(F.size(column).alias("n")).count()
             .where((F.col("n") > 0) & (F.col("n") % parts == 0)).orderBy(F.desc("count"), F.desc("n")).first())
    return sizes["n"] if sizes else 0


class PartCodes:
    """Codebooks learned from ``vectors`` (vec_id, ``column``, label) and the codes of these."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, column: str = "embedding", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS):
        self.spark, self.parts, self.entries = spark, parts, entries
        kept = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                                     F.col(column).cast("array<double>").alias("vector")), "vector")
        self.dims = common_length(kept, "vector", parts)
        self.width = self.dims // parts
        kept = kept.where(F.size("vector") == self.dims)
        start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect() if self.dims else []
        first = scaled(np.array([r["vector"] for r in start], np.float64).reshape(len(start), self.dims))
        self.books = [first[:, p * self.width:(p + 1) * self.width].copy() for p in range(parts)]
        self.pivots = [choose_pivots(b, pivots) for b in self.books] if len(first) else []
        self.table = stage(spark, self._with_pivot_distances(kept), "parts") if len(first) else None
        for _ in range(rounds if self.table is not None else 0):
            self._improve()

    def _with_pivot_distances(self, kept: DataFrame) -> DataFrame:
        """(vec_id, label, vector, far): integer components and every part's distances to the pivots."""
        dims, width, pivots = self.dims, self.width, self.pivots
        label = kept.schema["label"].dataType.simpleString()

        def apply(batches):
            for batch in batches:
                rows = scaled(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
                far = np.concatenate([distances(rows[:, p * width:(p + 1) * width], v) for p, v in enumerate(pivots)], 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), batch.column("label"),
                    pa.array([r.tobytes() for r in rows.astype("<i4")], pa.binary()),
                    pa.array([r.tobytes() for r in far.astype("<i4")], pa.binary())],
                    names=["vec_id", "label", "vector", "far"])

        return kept.mapInArrow(apply, f"vec_id long, label {label}, vector binary, far binary")

    def _search(self):
        """batch -> (rows, [(entry, squared distance, evaluations) per part]) in blocks."""
        dims, width, books = self.dims, self.width, self.books
        ties = [distances(b, v) for b, v in zip(books, self.pivots)]
        many = self.pivots[0].shape[0]

        def search(batch):
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = _numbers(part.column("vector"), dims)
                far = _numbers(part.column("far"), many * len(books))
                yield part, rows, [nearest(rows[:, p * width:(p + 1) * width], far[:, p * many:(p + 1) * many], b, t)
                                   for p, (b, t) in enumerate(zip(books, ties))]

        return search

    def _improve(self) -> None:
        """One round: assign all parts, then each used entry becomes the floor of its parts' mean."""
        width, books, search = self.width, self.books, self._search()

        def tally(batches):
            total = [np.zeros((len(b), width + 1), np.int64) for b in books]
            for batch in batches:
                for _, rows, found in search(batch):
                    for p, (entry, *_) in enumerate(found):
                        order = np.argsort(entry, kind="stable")
                        first = np.flatnonzero(np.concatenate([[True], entry[order][1:] != entry[order][:-1]]))
                        sums = np.add.reduceat(rows[order, p * width:(p + 1) * width], first, axis=0)
                        total[p][entry[order][first], :width] += sums
                        total[p][entry[order][first], width] += np.diff(np.append(first, len(order)))
            for p, t in enumerate(total):
                used = np.flatnonzero(t[:, width])
                yield pa.RecordBatch.from_arrays([
                    pa.array([p] * len(used), pa.int32()), pa.array(used, pa.int32()),
                    pa.array(list(t[used]), pa.list_(pa.int64()))], names=["part", "entry", "sums"])

        sums = (self.table.select("vector", "far").mapInArrow(tally, "part int, entry int, sums array<long>")
                .select("part", "entry", F.posexplode("sums").alias("at", "value"))
                .groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
                .groupBy("part", "entry").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("m")))
        new = [b.copy() for b in books]
        for r in sums.collect():  # parts x entries rows
            new[r["part"]][r["entry"]] = [int(r["m"][j]) // int(r["m"][width]) for j in range(width)]
        self.books = new

    def codes(self) -> DataFrame:
        """(vec_id, label, code, error) of every kept vector."""
        search = self._search()
        label = self.table.schema["label"].dataType.simpleString()

        def apply(batches):
            for batch in batches:
                for part, _, found in search(batch):
                    code = np.stack([e for e, *_ in found], axis=1).astype(np.uint8)
                    error = sum(f for _, f, _ in found)
                    yield pa.RecordBatch.from_arrays([
                        part.column("vec_id"), part.column("label"),
                        pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())],
                        names=["vec_id", "label", "code", "error"])

        return self.table.mapInArrow(apply, f"vec_id long, label {label}, code string, error long")

    def digest(self) -> str:
        """sha256 of all components of all codebooks by part, entry and position."""
        return hashlib.sha256(",".join(str(int(x)) for b in self.books for x in b.ravel()).encode()).hexdigest()


def part_codes(spark: SparkSession, vectors: DataFrame, **options) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error (of all vectors with its label), codebooks_sha256."""
    model = PartCodes(spark, vectors, **options)
    if model.table is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = stage(spark, model.codes(), "codes")
    # a label as text that is never null, so that null labels are one key and a hot label is split
    coded = coded.withColumn("k", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = (coded.groupBy("k").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
            .select(dealt_anew("k"), "label_error"))
    return coded.join(sums, "k").select("vec_id", "code", "error", "label_error",
                                        F.lit(model.digest()).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, dims: int = 64) -> str:
    """The codes in DuckDB SQL, for tables whose vectors have ``dims`` components."""
    width = dims // parts
    ctes = [f"""parts AS MATERIALIZED (
  SELECT vec_id, label, p, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)
         FOR x IN embedding[p * {width} + 1 : (p + 1) * {width}]] AS v
  FROM embeddings, (SELECT unnest(range({parts})) AS p)
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM parts
  QUALIFY e < {entries}
)"""]
    # |v - c|^2 = |v|^2 - 2 v.c + |c|^2, in whole numbers
    assign = """a{i} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(v) AS v, min(struct_pack(d := d, e := e)) AS m FROM (
    SELECT vec_id, label, parts.p, v, e,
           CAST(list_dot_product(v::DOUBLE[], v::DOUBLE[]) - 2 * list_dot_product(v::DOUBLE[], c::DOUBLE[])
                + list_dot_product(c::DOUBLE[], c::DOUBLE[]) AS BIGINT) AS d
    FROM parts JOIN b{i} ON b{i}.p = parts.p) GROUP BY vec_id, label, p
)"""
    for i in range(rounds):
        ctes.append(assign.format(i=i))
        ctes.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT b{i}.p, b{i}.e, coalesce(n.c, b{i}.c) AS c FROM b{i} LEFT JOIN (
    SELECT p, e, list(mean ORDER BY j) AS c FROM (
      SELECT p, m.e AS e, j, CASE WHEN sum(x) >= 0 THEN sum(x) // count(*)
             ELSE -((-sum(x) + count(*) - 1) // count(*)) END AS mean
      FROM (SELECT p, m, unnest(v) AS x, unnest(range({width})) AS j FROM a{i}) GROUP BY 1, 2, 3) GROUP BY p, e
  ) n ON n.p = b{i}.p AND n.e = b{i}.e
)""")
    ctes.append(assign.format(i=rounds))
    body = ",\n".join(ctes)
    return f"""WITH {body}, coded AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded"""


ORACLE = oracle()
