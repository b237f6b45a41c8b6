"""Packing by best-fit-decreasing, written as matrices of token ids.

Documents longer than a sequence are cut into full sequences and a rest. Pieces are placed longest first, each into the
open sequence with the least room that it fits in; a segment tree over the amounts of room finds it in logarithmic time.
A task packs what it reads, ``BUFFER`` tokens at a time, so nothing is shuffled and memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from viewtide.llm.tokens import word_tokenizer

LENGTH = 2048
BUFFER = 1 << 22
# Sequences in one matrix of the written form.
ROWS = 256


class Room:
    """Open bins by free capacity, with the smallest sufficient capacity found by a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _mark(self, capacity: int, value: int) -> None:
        node = self.leaves + capacity
        self.tree[node] = value
        while node > 1:
            node >>= 1
            value = self.tree[2 * node] | self.tree[2 * node + 1]
            if self.tree[node] == value:
                break
            self.tree[node] = value

    def add(self, bin_: int, capacity: int) -> None:
        self.bins[capacity].append(bin_)
        if len(self.bins[capacity]) == 1:
            self._mark(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return a bin with the least capacity of at least ``size``, and that capacity."""
        node = self.leaves + size
        if not self.tree[node]:
            # Up to the first subtree on the right that has a bin, then down its left edge.
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        found = self.bins[capacity].pop()
        if not self.bins[capacity]:
            self._mark(capacity, 0)
        return found, capacity


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of at most ``capacity`` with the numbers of the pieces in each. No piece is larger than a bin."""
    room, bins = Room(capacity), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        found = room.take(size)
        if found is None:
            bins.append([])
            found = len(bins) - 1, capacity
        bin_, free = found
        bins[bin_].append(piece)
        if free > size:
            room.add(bin_, free - size)
    return bins


SEQUENCE = (
    "sequence_id long, tokens int, row_ids array<long>, doc_ids array<long>, starts array<long>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary"
)


def _sequences(path: str, end: int, length: int, buffer: int, pad: int):
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in SEQUENCE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, chunk = word_tokenizer(path), TaskContext.get().partitionId()
        last = np.array([end], tokenizer.kind).tobytes()
        made, row = 0, 0
        pieces: list[tuple] = []
        held = 0

        def flush():
            nonlocal made, pieces, held
            bins = best_fit([len(p[3]) for p in pieces], length)
            out = []
            for bin_ in bins:
                inside = [pieces[i] for i in bin_]
                ids = np.full(length, pad, "<u4")
                places = np.zeros(length, "<u4")
                ends = np.cumsum([0] + [len(p[3]) for p in inside])
                for (_, _, _, part), at in zip(inside, ends):
                    ids[at : at + len(part)] = part
                    places[at : at + len(part)] = np.arange(len(part))
                number = chunk << 33 | made
                made += 1
                out.append((number, int(ends[-1]), [p[0] for p in inside], [p[1] for p in inside], [p[2] for p in inside], ends.tolist(), ids.tobytes(), places.tobytes()))
            pieces, held = [], 0
            for first in range(0, len(out), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[first : first + 256]), kinds)], names)

        for batch in batches:
            for doc_id, found in zip(batch["doc_id"].to_pylist(), tokenizer.batch(batch["text"].to_pylist())):
                ids = np.frombuffer(found + last, tokenizer.kind)
                for start in range(0, len(ids), length):
                    pieces.append((chunk << 33 | row, doc_id, start, ids[start : start + length]))
                row += 1
                held += len(ids)
                if held >= buffer:
                    yield from flush()
        if pieces:
            yield from flush()

    return run


def pack(df: DataFrame, path: str, end: int, length: int = LENGTH, pad: int = 0, buffer: int = BUFFER) -> DataFrame:
    """Packed sequences of the documents of ``df`` (doc_id, text and others), one row each.

    sequence_id; tokens without padding; for each segment the row it comes from, its doc_id, and the ids of the document
    before it; cu_seqlens, where segments begin and the last one ends; input_ids and position_ids, ``length``
    little-endian unsigned 32-bit numbers, where positions begin at 0 in each segment.

    Null and empty texts are one ``end`` token, null doc_ids stay null, repeated rows are packed one by one. An empty table
    gives no sequences. All ids are kept, in exactly one segment each.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_sequences(path, end, length, buffer, pad), SEQUENCE)


def write_matrices(packed: DataFrame, path: str, rows: int = ROWS) -> None:
    """Write packed sequences in matrices of up to ``rows`` rows: input_ids and position_ids row by row, and all
    cu_seqlens in a row with where those of each sequence begin (little-endian unsigned 32-bit numbers).

    Spark's Parquet writer commits the files, so a lost executor leaves no half file behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrix(part):
            starts = np.cumsum([0] + [len(r["cu_seqlens"]) for r in part]).astype("<u4")
            values = [
                [part[0]["sequence_id"]],
                [len(part)],
                [b"".join(r["input_ids"] for r in part)],
                [b"".join(r["position_ids"] for r in part)],
                [np.concatenate([r["cu_seqlens"] for r in part]).astype("<u4").tobytes()],
                [starts.tobytes()],
            ]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["first_id", "rows", "input_ids", "position_ids", "cu_seqlens", "cu_starts"])

        part: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                part.append(row)
                if len(part) == rows:
                    yield matrix(part)
                    part = []
        if part:
            yield matrix(part)

    kept = packed.select("sequence_id", "cu_seqlens", "input_ids", "position_ids")
    schema = "first_id long, rows long, input_ids binary, position_ids binary, cu_seqlens binary, cu_starts binary"
    kept.mapInArrow(run, schema).write.mode("errorifexists").parquet(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """The matrices that ``write_matrices`` wrote."""
    return spark.read.parquet(path)


def digests(packed: DataFrame) -> DataFrame:
    """Packed sequences with the crc32 of their ids and positions in place of the numbers."""
    crc = [F.crc32(c).alias(f"{c}_crc32") for c in ("input_ids", "position_ids")]
    return packed.select("sequence_id", "tokens", "doc_ids", "starts", "cu_seqlens", *crc)
