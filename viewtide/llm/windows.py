"""Packing to target proportions of tokens by deficit round-robin over the sources.

The documents of a source queue up. In each round, one window's worth of tokens, every queue's deficit grows by the queue's target
share of the window. The queue is then served whole documents as long as its deficit is above zero; what the last one takes
beyond that makes the deficit negative, and is carried over as a debt. So a document is served in the first round whose
deficits have covered all tokens before it in its queue:

    round = tokens before it * sum of weights // (its source's weight * length)

Each document's round thus follows from a running total in its queue, and its place from a running total in the order of
rounds, sources and queues: deficits carry over windows, tasks and partitions without any task dealing out the whole. Documents
longer than a window are served a window's length at a time, so that no source falls behind by more than one window.
What was served is cut every ``length`` tokens into sequences, the only place where documents are cut. All sequences are full but
the last. A source that runs out leaves its share to the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from viewtide.llm.tokens import word_tokenizer
from viewtide.operators.joins import join_null_safe
from viewtide.operators.positions import running_total
from viewtide.session import settled

LENGTH = 4096


def tokenised(df: DataFrame, path: str, end: int) -> DataFrame:
    """``df`` (doc_id, source, text) as token ids: chunk, row, doc_id, source, size, before, kind, ids.

    A chunk is what one task read. ``before`` counts the tokens of the same source earlier in the chunk. A null text
    has only the ``end`` token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, chunk = word_tokenizer(path), TaskContext.get().partitionId()
        last, width = np.array([end], tokenizer.kind).tobytes(), np.dtype(tokenizer.kind).itemsize
        before: dict[str | None, int] = {}
        row = 0
        for batch in batches:
            ids = [i + last for i in tokenizer.batch(batch["text"].to_pylist())]
            sizes = [len(i) // width for i in ids]
            places = []
            for source, size in zip(batch["source"].to_pylist(), sizes):
                places.append(before.get(source, 0))
                before[source] = places[-1] + size
            count = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * count, pa.int64()),
                    pa.array(range(row, row + count), pa.int64()),
                    batch["doc_id"],
                    batch["source"],
                    pa.array(sizes, pa.int64()),
                    pa.array(places, pa.int64()),
                    pa.array([tokenizer.kind] * count, pa.string()),
                    pa.array(ids, pa.binary()),
                ],
                ["chunk", "row", "doc_id", "source", "size", "before", "kind", "ids"],
            )
            row += count

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "chunk long, row long, doc_id long, source string, size long, before long, kind string, ids binary")


def placed(tokens: DataFrame, length: int = LENGTH, weights: Mapping[str | None, int] | None = None) -> DataFrame:
    """For each ``chunk`` and ``row`` of ``tokens`` its ``places``: array of (start, stream), the document's ids before a part of it, and
    all ids served before that part.

    ``tokens`` is a result of ``tokenised`` and should be settled. In a queue, documents are in the order in which they were read;
    in a round, sources are in code point order, null last.
    """
    parts = tokens.groupBy("source", "chunk").agg(F.sum("size").alias("size"))
    parts = running_total(parts, ["source"], [F.asc("chunk")], F.col("size"), "base")
    sources = parts.groupBy("source").agg(F.sum("size").alias("weight"))
    if weights is not None:
        given = tokens.sparkSession.createDataFrame([(k, int(v)) for k, v in weights.items()], "source string, given long")
        sources = join_null_safe(sources, given, ["source"], "left").select("source", F.coalesce("given", F.lit(1)).alias("weight"))
    whole = sources.agg(F.sum("weight")).first()[0] or 0
    parts = settled(join_null_safe(parts.select("source", "chunk", "base"), sources, ["source"]))

    rows = join_null_safe(tokens.select("chunk", "row", "source", "size", "before"), parts, ["source", "chunk"])
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(length).cast("long")))
    rows = rows.withColumn("start", start).withColumn("at", F.col("base") + F.col("before") + F.col("start"))
    # Tokens times tokens go beyond 64 bits.
    turn = F.expr(f"(cast(at AS decimal(19,0)) * cast({whole} AS decimal(19,0))) div (cast(weight AS decimal(19,0)) * cast({length} AS decimal(19,0)))")
    rows = rows.select("chunk", "row", "source", "start", "at", F.least(F.lit(length).cast("long"), F.col("size") - F.col("start")).alias("part"), turn.alias("round"))
    served = running_total(rows, [], [F.asc("round"), F.asc_nulls_last("source"), F.asc("at")], F.col("part"), "stream")
    # As many parts as the document has windows' lengths of tokens.
    return served.groupBy("chunk", "row").agg(F.sort_array(F.collect_list(F.struct("start", "stream"))).alias("places"))


def cuts(places: list[tuple[int, int]], size: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """The pieces (start, length, sequence, offset) of a document with ``size`` tokens whose parts have ``places`` (start, stream)."""
    done, stream = places[0]
    for start, place in [*places[1:], (size, -1)]:
        if place == stream + start - done:
            continue  # the part before goes on
        while done < start:
            part = min(start - done, length - stream % length)
            yield done, part, stream // length, stream % length
            done, stream = done + part, stream + part
        stream = place


def pieces(df: DataFrame, path: str, end: int, length: int = LENGTH, weights: Mapping[str | None, int] | None = None, with_ids: bool = True) -> DataFrame:
    """The packed documents, one row for each piece.

    doc_id, start (the document's ids before the piece), length, ids_crc32, doc_tokens (with the end token), sequence_id,
    offset (in the sequence), row_id (one number for each row of ``df``, so repeated rows can be told apart) and, unless
    ``with_ids`` is off, ids. Each id of each row is in exactly one piece, and a sequence's pieces leave no gap.

    ``weights`` are the target proportions, a positive whole number for each source; a source that is not named weighs 1. Without them
    a source weighs the tokens it has, so that all last to the end.

    Null and empty texts are one end token. A null source has a queue of its own. An empty table gives no pieces.
    """
    if weights is not None and any(v <= 0 or v != int(v) for v in weights.values()):
        raise ValueError("weights must be positive whole numbers")
    tokens = settled(tokenised(df, path, end))
    # A table of the narrow side is met by the rows with ids as they come; a sort would hold them in memory.
    rows = tokens.join(placed(tokens, length, weights).hint("shuffle_hash"), ["chunk", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], row["kind"]).astype("<u4")
                places = [(p["start"], p["stream"]) for p in row["places"]]
                for start, part, sequence, offset in cuts(places, row["size"], length):
                    cut = ids[start : start + part].tobytes()
                    out.append((row["doc_id"], start, part, zlib.crc32(cut), row["size"], sequence, offset, row["row_id"], cut))
            columns = list(zip(*out)) if out else [[]] * 9
            arrays = [pa.array(c, pa.int64()) for c in columns[:8]]
            if with_ids:
                arrays.append(pa.array(columns[8], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row_id"] + ["ids"] * with_ids
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    row_id = F.shiftleft("chunk", 33).bitwiseOR(F.col("row")).alias("row_id")
    return rows.select("doc_id", "size", "kind", "ids", "places", row_id).mapInArrow(run, schema)
