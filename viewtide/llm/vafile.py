"""Centroid clustering over a vector approximation file (VA-file).

Vectors are numbered, turned into whole numbers and stored twice: in full, in buckets by number, and as an approximation of eight bits
for each dimension, which names the cell of the dimension that a component lies in. Cells are equally wide between two
extreme quantiles of all vectors, and two of them take what lies outside; any borders give the same results.

A round reads approximations only. For each dimension, cell and centroid a lookup table holds an interval for what a component in
that cell adds to the squared distance. The part that all centroids share, the distance to their middle, is left out on both
ends, which makes intervals narrow where centroids are near each other. Sums of intervals enclose a vector's distance to each
centroid. A vector whose intervals leave one centroid is assigned without being looked at. Full vectors are fetched where
intervals overlap, and compared with the centroids left only, and where an assignment changed, as sums of clusters are kept up by
what enters and leaves them. Fetching joins numbers to the buckets, so full vectors are not shuffled.

All arithmetic is on whole numbers and exact.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from viewtide.session import scratch_path, settled

DIMS, CLUSTERS, ROUNDS = 64, 40, 5
SCALE = 256
SEED = "2"
# Cells of a dimension, and the share of components in each of the two outer ones. On 51,282 vectors of noise with weak clusters 16 cells
# left half of all centroids open, 64 cells three of them, and 256 cells one for 98 of 100 vectors.
CELLS = 256
OUTER = 0.001
# Vectors in a bucket of the full table.
BUCKET = 100_000
# Scaled components lie below this, so that squared distances of 64 components, and their sums in a batch, fit 63 bits.
LIMIT = 1 << 27


def whole_numbers(df: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows with ``dims`` components, none null or not finite: floor(scale * x) as int.

    Fails on components too large for exact distances.
    """
    finite = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") == dims) & finite)
    scaled = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))))
    large = F.exists(scaled, lambda x: F.abs(x) >= LIMIT)
    failed = F.raise_error(F.lit(f"a component is beyond {LIMIT} / {scale}"))
    return rows.select("vec_id", F.when(large, failed.cast("array<int>")).otherwise(scaled.cast("array<int>")).alias("vector"))


class Lookup:
    """Distance intervals between cells and centroids, less the distance to the centroids' middle."""

    def __init__(self, low: np.ndarray, inner: np.ndarray, high: np.ndarray, centroids: np.ndarray):
        # Of each dimension: the least and the greatest number in each cell. A cell without numbers is never asked for.
        first = np.concatenate([low[:, None], inner], axis=1)[:, :, None]
        last = np.concatenate([inner - 1, high[:, None]], axis=1)[:, :, None]
        self.middle = centroids.sum(axis=0) // len(centroids)
        centre, middle = centroids.T[:, None, :], self.middle[:, None, None]
        # (x - centre)^2 - (x - middle)^2 is linear in x, so it is least and greatest at the ends of a cell.
        ends = [(x - centre) ** 2 - (x - middle) ** 2 for x in (first, last)]
        self.least, self.most = np.minimum(*ends), np.maximum(*ends)

    def intervals(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest distance of each vector to each centroid, less that to the middle."""
        least = np.zeros((len(cells), self.least.shape[2]), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            least += self.least[d][cells[:, d]]
            most += self.most[d][cells[:, d]]
        return least, most

    def open(self, cells: np.ndarray) -> np.ndarray:
        """Whether a vector with these cells can be nearest to a centroid, for each vector and centroid."""
        least, most = self.intervals(cells)
        return least <= most.min(axis=1)[:, None]


def coded(vectors: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The cell of each component."""
    return np.stack([np.searchsorted(borders, column, side="right") for borders, column in zip(inner, vectors.T)], axis=1).astype(np.uint8)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _binaries(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _borders(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Least number, inner borders and greatest number of each dimension, none if there are no vectors."""
    columns = []
    for d in range(dims):
        x = F.col("vector")[d]
        ends = F.percentile_approx(x, [OUTER, 1 - OUTER], 10000)
        columns.append(F.struct(F.min(x).alias("low"), ends.alias("ends"), F.max(x).alias("high")))
    row = vectors.agg(F.array(*columns).alias("dims")).first().dims
    if row[0].low is None:
        return None
    low, ends, high = (np.array([r[i] for r in row], np.int64) for i in range(3))
    inner = np.linspace(ends[:, 0], ends[:, 1], CELLS - 1, axis=1)
    return low, np.ceil(inner).astype(np.int64), high


def _approximated(inner: np.ndarray, dims: int):
    """(number, vector) as (number, cells) without a cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = coded(_matrix(batch["vector"], dims), inner)
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch["number"], _binaries(codes), none], ["number", "cells", "cluster"])

    return run


def _narrowed(borders: tuple[np.ndarray, np.ndarray, np.ndarray], centroids: np.ndarray, dims: int):
    """Of (number, cells, cluster) the cluster that cells decide, or the centroids they leave open, one bit each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(*borders, centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            left = lookup.open(_unpacked(batch["cells"], dims))
            decided = left.sum(axis=1) == 1
            found = pa.array(left.argmax(axis=1).astype(np.int32), pa.int32(), mask=~decided)
            bits = pa.array([None if d else b.tobytes() for d, b in zip(decided, np.packbits(left, axis=1))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["number"], batch["cells"], batch["cluster"], found, bits], ["number", "cells", "cluster", "found", "open"]
            )

    return run


def _settle(vectors: np.ndarray, found: pa.Array, bits: pa.Array, centroids: np.ndarray) -> np.ndarray:
    """The nearest of the centroids left open, the smaller of equally near ones; ``found`` where cells have decided."""
    chosen = found.to_numpy(zero_copy_only=False)
    out = np.where(np.isnan(chosen), -1, chosen).astype(np.int64) if chosen.dtype.kind == "f" else chosen.astype(np.int64)
    undecided = np.flatnonzero(out < 0)
    if len(undecided):
        packed = _unpacked(bits.take(pa.array(undecided)), -(-len(centroids) // 8))
        row, centre = np.nonzero(np.unpackbits(packed, axis=1, count=len(centroids)))
        gap = vectors[undecided[row]] - centroids[centre]
        distance = np.full((len(undecided), len(centroids)), np.iinfo(np.int64).max)
        distance[row, centre] = (gap * gap).sum(axis=1)
        out[undecided] = distance.argmin(axis=1)
    return out


def _moved(centroids: np.ndarray, dims: int):
    """The clusters of fetched rows, and at the end what each cluster gained: count and sums, in rows without a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["number", "cells", "cluster", "count", "sums"]
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), dims), np.int64)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            vectors = _matrix(batch["vector"], dims)
            new = _settle(vectors, batch["found"], batch["open"], centroids)
            old = batch["cluster"].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            changed = new != old
            leaves = changed & (old >= 0)
            np.add.at(counts, new[changed], 1)
            np.add.at(sums, new[changed], vectors[changed])
            np.add.at(counts, old[leaves], -1)
            np.add.at(sums, old[leaves], -vectors[leaves])
            none = [pa.nulls(size, pa.int64()), pa.nulls(size, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch["number"], batch["cells"], pa.array(new, pa.int32()), *none], names)
        touched = np.flatnonzero((counts != 0) | (sums != 0).any(axis=1))
        size = len(touched)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.binary()),
                pa.array(touched, pa.int32()),
                pa.array(counts[touched], pa.int64()),
                pa.array(sums[touched].tolist(), pa.list_(pa.int64())),
            ],
            names,
        )

    return run


def _measured(centroids: np.ndarray, dims: int):
    """The cluster of each row and its squared distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch["vector"], dims)
            new = _settle(vectors, batch["found"], batch["open"], centroids)
            gap = vectors - centroids[new]
            columns = [batch["vec_id"], pa.array(new, pa.int32()), pa.array((gap * gap).sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


def _gains(moved: DataFrame, count: int, dims: int) -> tuple[list[int], list[list[int]]]:
    """What each cluster gained, as exact numbers. One row for each cluster and dimension comes to the driver."""
    rows = moved.where("number IS NULL").select("cluster", F.col("count").cast("decimal(38,0)").alias("count"), F.posexplode("sums"))
    rows = rows.groupBy("cluster", "pos").agg(F.sum("count").alias("count"), F.sum(F.col("col").cast("decimal(38,0)")).alias("sum"))
    counts, sums = [0] * count, [[0] * dims for _ in range(count)]
    for r in rows.collect():
        counts[r.cluster] = int(r["count"])
        sums[r.cluster][r.pos] = int(r["sum"])
    return counts, sums


def starts(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The first centroids: the vectors whose ids' digests come first. Rows without an id come last; the vector breaks ties."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "vector").orderBy(F.asc_nulls_last("digest"), "vector").limit(clusters)
    return np.array([r.vector for r in rows.collect()], np.int64)


def clusters(df: DataFrame, count: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """One row for each vector of ``df`` (vec_id, embedding and others) that takes part.

    vec_id, cluster, distance (squared, to the cluster's centroid), cluster_inertia and inertia (distances summed over the
    cluster and over all), centroid_sha256 (of the centroid's components, joined by commas).

    Rows whose vector is null, has another length or a component that is null or not finite take no part. Repeated rows and rows
    without an id count like others; the latter become no centroid while there are others. With fewer vectors than ``count``,
    each starts a cluster. Without any the result is empty. Inertia beyond a long fails.
    """
    spark = df.sparkSession
    vectors = settled(whole_numbers(df, dims, scale).withColumn("number", F.monotonically_increasing_id()))
    borders = _borders(vectors, dims)
    if borders is None:
        kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], kind)
    centroids = starts(vectors, count, seed)
    count = len(centroids)

    # Full vectors in buckets by number: what is fetched comes to them.
    name = f"vectors_{uuid.uuid4().hex}"
    buckets = max(1, -(-vectors.count() // BUCKET))
    writer = vectors.repartition(buckets, "number").write.bucketBy(buckets, "number").sortBy("number")
    writer.option("path", scratch_path(spark, name)).saveAsTable(name)
    full = spark.table(name)

    state = settled(vectors.select("number", "vector").mapInArrow(_approximated(borders[1], dims), "number long, cells binary, cluster int"))
    counts, sums = [0] * count, [[0] * dims for _ in range(count)]
    narrow = "number long, cells binary, cluster int, found int, open binary"
    for _ in range(rounds):
        seen = settled(state.mapInArrow(_narrowed(borders, centroids, dims), narrow))
        stays = F.col("found").eqNullSafe(F.col("cluster")) & F.col("found").isNotNull()
        fetched = seen.where(~stays).join(full.select("number", "vector"), "number")
        moved = settled(fetched.mapInArrow(_moved(centroids, dims), "number long, cells binary, cluster int, count long, sums array<long>"))
        more, gained = _gains(moved, count, dims)
        counts = [a + b for a, b in zip(counts, more)]
        sums = [[a + b for a, b in zip(*pair)] for pair in zip(sums, gained)]
        centroids = np.array([[s // n for s in row] if n else old.tolist() for n, row, old in zip(counts, sums, centroids)], np.int64)
        state = seen.where(stays).select("number", "cells", "cluster").unionByName(moved.where("number IS NOT NULL").select("number", "cells", "cluster"))

    seen = settled(state.mapInArrow(_narrowed(borders, centroids, dims), narrow))
    measured = seen.join(full, "number").mapInArrow(_measured(centroids, dims), "vec_id long, cluster int, distance long")
    measured = settled(measured)
    spark.sql(f"DROP TABLE {name}")

    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = settled(measured.groupBy("cluster").agg(exact.alias("sum")))
    total = each.agg(F.sum("sum")).first()[0]
    # One row for each centroid.
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    named = F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"))
    inertia = F.lit(total).cast("decimal(38,0)").cast("long").alias("inertia")
    each = F.broadcast(each.join(named, "cluster").select("cluster", F.col("sum").cast("long").alias("cluster_inertia"), inertia, "centroid_sha256"))
    return measured.join(each, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(dims: int = DIMS, count: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """All rounds in SQL, over every pair of a vector and a centroid."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id,
          [floor(256.0::DOUBLE * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
          WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dims})""",
        f"""chosen AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS k, v
          FROM kept QUALIFY k < {count})""",
        f"parts AS MATERIALIZED (SELECT id, unnest(range({dims})) AS d, unnest(v) AS x FROM kept)",
        f"c0 AS MATERIALIZED (SELECT k, unnest(range({dims})) AS d, unnest(v) AS x FROM chosen)",
    ]
    for r in range(rounds + 1):
        near = f"SELECT id, k, sum((p.x - c.x) * (p.x - c.x)) AS gap FROM parts p JOIN c{r} c USING (d) GROUP BY 1, 2"
        parts.append(f"a{r} AS MATERIALIZED (SELECT id, min(gap * 64 + k) % 64 AS k, min(gap * 64 + k) // 64 AS gap FROM ({near}) GROUP BY 1)")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, c.d, coalesce(m.x, c.x)::BIGINT AS x FROM c{r} c LEFT JOIN (
              SELECT k, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
              FROM parts JOIN a{r} USING (id) GROUP BY 1, 2) m ON m.k = c.k AND m.d = c.d)""")
    parts.append(f"digests AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY 1)")
    return "WITH " + ",\n".join(parts) + f"""
    SELECT vec_id, k::INTEGER AS cluster, gap::BIGINT AS distance, (sum(gap) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
      (sum(gap) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM a{rounds} JOIN kept USING (id) JOIN digests USING (k)"""


CLUSTER_SQL = _sql()
