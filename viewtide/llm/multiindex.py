"""Exact nearest binary codes by multi-index hashing.

A code has a bit for each component of the longest vector, in 64-bit words of four segments with 16 bits each. Each of the S
segments has a table from its value to the codes. A query's segments are probed with values at growing distance: after radius r
in the first a + 1 segments and r - 1 in the others, every code within S * r + a bits has been met, since one that was not differs in
more bits in each segment. The search ends as soon as the k-th verified distance is covered, so the result is exact, ties included.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from viewtide.llm.hnsw import usable
from viewtide.llm.search import answered, dealt
from viewtide.session import settled

# Segments of a word.
SEGMENTS, BITS = 4, 16
SHARD = 1 << 17


def sign_code(words: int, vector: str = "embedding") -> Column:
    """Bits in ``words`` longs: bit i is set if component i (from 0) is above zero. Components that are missing are not set."""
    bits = f"zip_with(slice({vector}, 64 * w + 1, 64), sequence(0, 63), (x, i) -> if(coalesce(x > 0, false), shiftleft(1L, i), 0L))"
    return F.expr(f"transform(sequence(0, {words - 1}), w -> aggregate({bits}, 0L, (a, b) -> a | b))")


@lru_cache(maxsize=1)
def _masks() -> list[np.ndarray]:
    """The values of a segment by their number of bits."""
    values = np.arange(1 << BITS, dtype=np.uint32)
    counts = np.bitwise_count(values)
    return [values[counts == r] for r in range(BITS + 1)]


class Index:
    """Tables of the segments of distinct codes (rows of words), each code with some ids."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ids: np.ndarray):
        self.codes, self.starts, self.ids = codes, starts, ids
        self.sizes = np.diff(starts)
        self.tables = []
        for word in codes.T:
            for s in range(SEGMENTS):
                values = (word >> np.uint64(s * BITS)).astype(np.uint32) & np.uint32((1 << BITS) - 1)
                order = np.argsort(values, kind="stable")
                places = np.searchsorted(values[order], np.arange((1 << BITS) + 1))
                self.tables.append((order, places))

    def nearest(self, code: list[int], k: int) -> list[tuple[int, int]]:
        """The ``k`` nearest ids as (distance, id), or all if there are fewer."""
        most = 64 * len(code)
        seen = np.zeros(len(self.codes), bool)
        met = [0] * (most + 1)  # ids by distance
        nodes, distances = [], []
        query = np.array(code, np.uint64)
        parts = [(w >> s * BITS) & ((1 << BITS) - 1) for w in code for s in range(SEGMENTS)]
        kth = most
        for radius, masks in enumerate(_masks()):
            for s, (order, places) in enumerate(self.tables):
                values = masks ^ np.uint32(parts[s])
                first, count = places[values], places[values + 1] - places[values]
                first, count = first[count > 0], count[count > 0]
                if len(first):
                    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    found = order[np.repeat(first, count) + inside]
                    found = found[~seen[found]]
                    seen[found] = True
                    apart = np.bitwise_count(self.codes[found] ^ query).sum(1, dtype=np.int64)
                    nodes.append(found)
                    distances.append(apart)
                    for d, n in enumerate(np.bincount(apart, self.sizes[found]).astype(int).tolist()):
                        met[d] += n
                    total = np.cumsum(met)
                    kth = int(np.argmax(total >= k)) if total[-1] >= k else most
                if len(self.tables) * radius + s >= kth:
                    break
            else:
                continue
            break
        nodes, distances = np.concatenate(nodes or [np.empty(0, int)]), np.concatenate(distances or [np.empty(0, int)])
        near = distances <= kth
        pairs = [(int(d), int(i)) for n, d in zip(nodes[near], distances[near]) for i in self.ids[self.starts[n] : self.starts[n + 1]]]
        return sorted(pairs)[:k]


def _words(codes: pa.Array) -> np.ndarray:
    """Codes as rows of words."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    return codes.flatten().to_numpy().reshape(len(codes), -1).view(np.uint64)


def _packed(rows: pa.Table) -> pa.Table:
    """One row with the codes and ids of a shard."""
    code, ids = _words(rows["code"]), rows["vec_id"].to_numpy()
    order = np.lexsort((ids, *code.T))
    code, ids = code[order], ids[order]
    new = np.r_[True, (code[1:] != code[:-1]).any(1)]
    starts = np.r_[np.flatnonzero(new), len(code)].astype(np.int64)
    codes = np.ascontiguousarray(code[new])
    return pa.table({"shard": pa.array([rows["shard"][0].as_py()], pa.int64()), "codes": [codes.tobytes()], "starts": [starts.tobytes()], "ids": [ids.tobytes()]})


def _index(words: int):
    def load(row: dict) -> Index:
        codes, starts, ids = (np.frombuffer(row[c], np.int64) for c in ("codes", "starts", "ids"))
        return Index(codes.view(np.uint64).reshape(-1, words), starts, ids)

    return load


def _searched(k: int):
    def answer(index: Index, batch: pa.RecordBatch) -> list[list]:
        out: list[list] = [[], [], []]
        keys = batch["key"].to_pylist()
        for key, code in zip(keys, _words(batch["query"]).tolist()):
            for d, i in index.nearest(code, k + 1):
                for column, value in zip(out, (key, i, d)):
                    column.append(value)
        return out

    return answer


def nearest(df: DataFrame, every: int = 50, k: int = 10, shard: int = SHARD) -> DataFrame:
    """The ``k`` rows with the fewest differing bits for each row of ``df`` (vec_id, embedding) whose id ``every`` divides.

    query_id, rank (from 1), vec_id, distance; nearest first, ties to the smaller vec_id, never the query's own id, fewer than ``k``
    where there are no more. Exact; all components count, those a shorter vector lacks as not above zero. Rows without an id, and vectors that are null, empty, zero or not finite, take no part.
    Repeated rows count once. Columns besides the two are not looked at. An empty table gives an empty result.
    """
    vectors = settled(usable(df))
    size = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    words = -(-size // 64)
    rows = settled(vectors.select("vec_id", sign_code(words).alias("code")).distinct())
    # Of equal codes the k + 1 smallest ids are enough, as one may be the query's own.
    first = Window.partitionBy("code").orderBy("vec_id")
    few = settled(rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).drop("place"))
    queries = rows.where(F.col("vec_id") % every == 0)

    number, shards = dealt(few.select("code").distinct(), F.col("code"), shard)
    packed = few.withColumn("shard", number).groupBy("shard").applyInArrow(_packed, "shard long, codes binary, starts binary, ids binary")
    # Queries of one code are answered once, under the smallest of their ids.
    asked = settled(queries.groupBy("code").agg(F.min("vec_id").alias("key")))
    sent = asked.select("key", F.col("code").alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    results = answered(packed, sent, shards, _index(words), _searched(k), "key long, vec_id long, distance int")

    best = Window.partitionBy("key").orderBy("distance", "vec_id")
    merged = results.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = merged.groupBy("key").agg(F.collect_list(F.struct("distance", "vec_id")).alias("found"))
    own = "slice(filter(array_sort(found), f -> f.vec_id <> query_id), 1, %d)" % k
    asking = queries.select(F.col("vec_id").alias("query_id"), "code").join(asked, "code").join(lists, "key")
    ranked = asking.select("query_id", F.posexplode(F.expr(own)).alias("rank", "f"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "f.vec_id", "f.distance")


NEAREST_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '')::BIT AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, bit_count(xor(q.code, r.code))::INTEGER AS distance
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""
