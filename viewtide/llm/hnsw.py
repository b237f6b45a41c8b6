"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node with its smallest ids. Distinct vectors are dealt to shards by hash; each shard's graph is built
in one task and stored as flat arrays in one row. A query descends the upper layers greedily and searches the bottom
layer with a list of ``EF`` candidates. The shards' results are merged by exact distance.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from viewtide.llm.search import answered, dealt
from viewtide.session import settled

# Links of a node on the upper layers; twice as many on the bottom one.
LINKS = 16
EF_BUILD, EF = 64, 96
SHARD = 4096
SEED = 42


class Graph:
    """A graph over the rows of ``vectors``.

    ``links`` holds all neighbour lists in a row, filled up with -1: for a node the list of layer 0 with 2 * LINKS places,
    then one with LINKS places for each higher layer it is on. ``starts`` says where a node's lists begin.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: np.ndarray, entry: int):
        self.vectors, self.levels, self.links, self.entry = vectors, levels, links, entry
        self.starts = np.r_[0, np.cumsum(2 * LINKS + LINKS * levels.astype(np.int64))]

    def span(self, node: int, layer: int) -> slice:
        start = int(self.starts[node])
        if layer:
            start += LINKS * (layer + 1)
        return slice(start, start + (LINKS if layer else 2 * LINKS))

    def near(self, node: int, layer: int) -> np.ndarray:
        found = self.links[self.span(node, layer)]
        return found[found >= 0]

    def search(self, distance, entries: list[tuple[float, int]], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ``ef`` nodes of a layer found nearest, nearest first. ``distance`` takes an array of nodes."""
        seen = np.zeros(len(self.vectors), bool)
        seen[[n for _, n in entries]] = True
        todo = list(entries)
        heapq.heapify(todo)
        best = [(-d, n) for d, n in entries]
        heapq.heapify(best)
        while todo:
            d, node = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= ef:
                break
            new = self.near(node, layer)
            new = new[~seen[new]]
            if not len(new):
                continue
            seen[new] = True
            for d, n in zip(distance(new).tolist(), new.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(todo, (d, n))
        return sorted((-d, n) for d, n in best)

    def nearest(self, query: np.ndarray, ef: int) -> list[int]:
        """Nodes near a query, nearest first."""

        def distance(nodes):
            gap = self.vectors[nodes] - query
            return np.einsum("ij,ij->i", gap, gap)

        at = [(float(distance(np.array([self.entry]))[0]), self.entry)]
        for layer in range(int(self.levels[self.entry]), 0, -1):
            at = self.search(distance, at, 1, layer)
        return [n for _, n in self.search(distance, at, ef, 0)]


def _choose(found: list[tuple[float, int]], between: np.ndarray, count: int) -> list[int]:
    """Up to ``count`` of the nodes ``found`` (nearest first): those nearer to the centre than to any chosen before, then the rest."""
    nodes = [n for _, n in found]
    if len(nodes) <= count:
        return nodes
    apart = between[np.ix_(nodes, nodes)]
    least = np.full(len(nodes), np.inf, apart.dtype)
    chosen, rest = [], []
    for i, (d, n) in enumerate(found):
        if d < least[i]:
            chosen.append(n)
            if len(chosen) == count:
                return chosen
            np.minimum(least, apart[i], out=least)
        else:
            rest.append(n)
    return chosen + rest[: count - len(chosen)]


def build(vectors: np.ndarray, seed: int = SEED) -> Graph:
    """Insert the rows one after the other. A shard is small enough to hold all its distances."""
    count = len(vectors)
    drawn = np.random.default_rng(seed).random(count)
    levels = np.minimum(-np.log(1 - drawn) / np.log(LINKS), 12).astype(np.int8)
    wide = vectors.astype(np.float32)
    squares = np.einsum("ij,ij->i", wide, wide)
    between = np.maximum(squares[:, None] + squares[None, :] - 2 * (wide @ wide.T), 0)
    size = int((2 * LINKS + LINKS * levels.astype(np.int64)).sum())
    graph = Graph(wide, levels, np.full(size, -1, np.int32), 0)
    for node in range(1, count):
        row = between[node]
        top, level = int(levels[graph.entry]), int(levels[node])
        at = [(float(row[graph.entry]), graph.entry)]
        for layer in range(top, level, -1):
            at = graph.search(row.take, at, 1, layer)
        for layer in range(min(top, level), -1, -1):
            at = graph.search(row.take, at, EF_BUILD, layer)
            chosen = _choose(at, between, LINKS)
            graph.links[graph.span(node, layer)][: len(chosen)] = chosen
            for other in chosen:
                place = graph.links[graph.span(other, layer)]
                held = int((place >= 0).sum())
                if held < len(place):
                    place[held] = node
                else:
                    row_of = between[other]
                    around = sorted((float(row_of[n]), n) for n in [*place.tolist(), node])
                    kept = _choose(around, between, len(place))
                    place[:] = -1
                    place[: len(kept)] = kept
        if level > top:
            graph.entry = node
    return graph


def usable(df: DataFrame) -> DataFrame:
    """Rows with an id and a vector that is not null, empty or zero and has only finite components, which become doubles."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    some = F.expr("exists(embedding, x -> x <> 0)")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & finite & some)


def _indexed(rows: pa.Table) -> pa.Table:
    """One row with the graph of a shard."""
    vectors = np.array(rows["embedding"].to_pylist())
    order = np.lexsort(vectors.T)  # the same graph whatever order the rows come in
    vectors = vectors[order]
    graph = build(vectors)
    ids = [rows["ids"][int(i)].as_py() for i in order]
    columns = {
        "shard": pa.array([rows["shard"][0].as_py()], pa.int64()),
        "size": pa.array([len(vectors)], pa.int32()),
        "entry": pa.array([graph.entry], pa.int32()),
        "vectors": [vectors.tobytes()],
        "levels": [graph.levels.tobytes()],
        "links": [graph.links.tobytes()],
        "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
    }
    return pa.table(columns)


class Shard:
    """A stored graph with the ids of its nodes."""

    def __init__(self, row: dict):
        self.exact = np.frombuffer(row["vectors"]).reshape(row["size"], -1)
        levels, links = np.frombuffer(row["levels"], np.int8), np.frombuffer(row["links"], np.int32)
        self.graph = Graph(self.exact.astype(np.float32), levels, links, row["entry"])
        self.ids = row["ids"]


def _searched(k: int, ef: int):
    def answer(shard: Shard, batch: pa.RecordBatch) -> list[list]:
        out: list[list] = [[], [], []]
        for key, embedding in zip(batch["key"].to_pylist(), batch["embedding"]):
            vector = np.array(embedding.as_py())
            nodes = shard.graph.nearest(vector.astype(np.float32), max(ef, k + 1))
            gap = shard.exact[nodes] - vector
            scores = np.sqrt((gap * gap).sum(1))
            pairs = sorted((s, i) for s, n in zip(scores.tolist(), nodes) for i in shard.ids[n])[: k + 1]
            for s, i in pairs:
                for column, value in zip(out, (key, i, s)):
                    column.append(value)
        return out

    return answer


def nearest(df: DataFrame, every: int = 100, k: int = 10, ef: int = EF, shard: int = SHARD) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``df`` (vec_id, embedding) whose id ``every`` divides.

    query_id, rank (from 1), vec_id, score (Euclidean distance in double precision); nearest first, ties to the smaller
    vec_id, never the query's own id, fewer than ``k`` where there are no more. Rows without an id, and vectors that are null,
    empty, zero or not finite, take no part; vectors of different lengths are not compared. Repeated rows count once. Columns
    besides the two are not looked at. An empty table gives an empty result.
    """
    rows = usable(df)
    # Of equal vectors the k + 1 smallest ids are enough, as one may be the query's own.
    first = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    nodes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = settled(nodes.withColumn("dims", F.size("embedding")))
    queries = rows.where(F.col("vec_id") % every == 0)
    asked = settled(queries.groupBy("embedding").agg(F.min("vec_id").alias("key")))

    # A shard's vectors have one length. A length's shards are numbered from the length times their number, and only queries of that
    # length are sent there.
    number, shards = dealt(nodes, F.col("embedding"), shard)
    placed = nodes.withColumn("shard", F.col("dims") * F.lit(shards).cast("long") + number)
    kind = "shard long, size int, entry int, vectors binary, levels binary, links binary, ids array<array<long>>"
    graphs = settled(placed.groupBy("shard").applyInArrow(_indexed, kind))

    first_shard = F.size("embedding") * F.lit(shards).cast("long")
    sent = asked.select("key", "embedding", F.explode(F.sequence(first_shard, first_shard + shards - 1)).alias("shard"))
    results = answered(graphs, sent, max(1, graphs.count()), Shard, _searched(k, ef), "key long, vec_id long, score double")
    best = Window.partitionBy("key").orderBy("score", "vec_id")
    merged = results.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = merged.groupBy("key").agg(F.collect_list(F.struct("score", "vec_id")).alias("found"))

    asking = queries.select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(asked, "embedding").select("query_id", "key")
    own = "slice(filter(array_sort(found), f -> f.vec_id <> query_id), 1, %d)" % k
    ranked = asking.join(lists, "key").select("query_id", F.posexplode(F.expr(own)).alias("rank", "f"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "f.vec_id", "f.score")
