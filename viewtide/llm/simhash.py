"""SimHash near-duplicates: fingerprints that differ in few bits, found block by block.

A fingerprint has 64 bits. Fingerprints with at most ``bits`` differing bits agree in one of any
``bits + 1`` blocks (pigeonhole), so they meet in the bucket of that block's value. A bucket with
more than ``BUCKET`` fingerprints is not compared but split again: its open bits are cut into
``bits + 1`` further blocks, to which the same argument applies. Splitting ends by itself, as a bucket
with n open bits holds at most 2^n different fingerprints. No pair is lost, no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from viewtide.llm.base import keyed, stored, unboxed
from viewtide.llm.components import components
from viewtide.session import settled

SEED = 42
# Fingerprints compared with each other in one bucket; larger ones are split.
BUCKET = 1024
ALL = (1 << 64) - 1
# Shingles whose bits are counted at a time.
SLICE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of a text as a signed number; zero if it has no words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, SLICE):
        part = np.ascontiguousarray(hashes[start : start + SLICE].astype("<u8"))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The SimHash of a text column as a long. A null text has no words."""

    @F.arrow_udf("long")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py(), shingle) for t in texts), type=pa.int64(), size=len(texts))

    return column(text.cast("binary"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def split_masks(mask: int, blocks: int) -> list[int]:
    """The mask with one of ``blocks`` nearly equal blocks of its open bits added, for each block."""
    open_bits = [i for i in range(64) if not mask >> i & 1]
    parts = np.array_split(open_bits, blocks)
    return [mask | sum(1 << int(i) for i in part) for part in parts]


def _close(codes: np.ndarray, buckets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of the same bucket, one less than there are in a linked group at most.

    Rows of a bucket follow each other. Every row is compared with all later ones of its bucket.
    """
    label = np.arange(len(codes))
    at, step = label, 1
    pairs = []
    while True:
        at = at[at + step < len(codes)]
        at = at[buckets[at] == buckets[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(codes[at] ^ codes[at + step]) <= bits]
        if len(near):
            pairs.append((near, near + step))
        step += 1
    if pairs:
        low, high = (np.concatenate(side) for side in zip(*pairs))
        while True:
            least = label.copy()
            np.minimum.at(least, high, label[low])
            np.minimum.at(least, low, label[high])
            least = least[least]
            if (least == label).all():
                break
            label = least
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return codes[moved], codes[label[moved]]


def _links(bits: int):
    """Compare the rows of each bucket; they come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(columns):
            mask, value, code = columns
            number = np.cumsum(np.r_[0, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]) if len(mask) else mask
            a, b = _close(code.view(np.uint64), number, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        rest = [np.empty(0, np.int64)] * 3
        for batch in batches:
            rest = [np.r_[old, batch.column(i).to_numpy()] for i, old in enumerate(rest)]
            mask, value, _ = rest
            # The last bucket may go on in the next batch.
            last = int(np.argmax((mask == mask[-1]) & (value == value[-1]))) if len(mask) else 0
            if last:
                yield compared([c[:last] for c in rest])
                rest = [c[last:] for c in rest]
        yield compared(rest)

    return run


def links(codes: DataFrame, bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect the different fingerprints ``code`` at ``bits`` or fewer differing bits.

    Pairs at this distance are connected, not necessarily by an edge of their own: a linked group of a bucket
    gives a star. ``codes`` holds each fingerprint once and is read several times.
    """
    spark = codes.sparkSession
    blocks = bits + 1
    each = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in split_masks(0, blocks)])).alias("mask")
    rows = codes.select("code", each)
    found = None
    while True:
        rows = rows.withColumn("value", F.col("code").bitwiseAND(F.col("mask")))
        sizes = settled(rows.groupBy("mask", "value").agg(F.count("*").alias("rows")).where("rows > 1"))
        small = sizes.where(F.col("rows") <= bucket).drop("rows")
        together = rows.join(small, ["mask", "value"]).repartition("mask", "value").sortWithinPartitions("mask", "value")
        edges = together.select("mask", "value", "code").mapInArrow(_links(bits), "a long, b long")
        found = edges if found is None else found.unionByName(edges)
        large = sizes.where(F.col("rows") > bucket).drop("rows")
        if large.isEmpty():
            return found
        # One row for each mask with a large bucket: at most blocks ** level rows, whatever the data.
        masks = [r.mask for r in large.select("mask").distinct().collect()]
        finer = [(m, _signed(c)) for m in masks for c in split_masks(m & ALL, blocks)]
        children = F.broadcast(spark.createDataFrame(finer, "mask long, child long"))
        crowded = rows.join(large, ["mask", "value"]).join(children, "mask")
        rows = settled(crowded.select("code", F.col("child").alias("mask")))


def groups(coded: DataFrame, bits: int = 3) -> DataFrame:
    """For each different ``code`` of ``coded`` (code, doc_id) the smallest doc_id of its linked group.

    Fingerprints that any chain of links connects form a group. Null doc_ids are passed over; a group that
    has no other gets null. ``coded`` is read several times, so it should be settled.
    """
    first = settled(coded.groupBy("code").agg(F.min("doc_id").alias("first")))
    roots = components(links(first.select("code"), bits)).withColumnRenamed("node", "code")
    placed = first.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(least, "root").select("code", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for each row of ``df`` (doc_id, text and others).

    Null and blank texts have fingerprint zero and are linked like others. Repeated rows stay repeated, and a
    null doc_id stays null. Other columns are not looked at. An empty table gives an empty result.
    """
    coded = settled(df.select("doc_id", fingerprints(F.col("text"), shingle).alias("code")))
    hexed = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    return coded.join(groups(coded, bits), "code").select("doc_id", hexed, "component_id")


def first_of_each(df: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``df`` that stay when one document of each group is kept: the one with the smallest doc_id.

    A null doc_id comes last; among equal ones one row is kept. Columns come back as they were.
    """
    df = stored(df)
    rows = settled(keyed(df, doc_id=F.col("doc_id"), code=fingerprints(F.col("text"), shingle)).drop("row"))
    # The group's first row: the smallest doc_id with nulls last, then the row's key.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = settled(rows.groupBy("code").agg(F.min(order).alias("first")))
    roots = components(links(first.select("code"), bits)).withColumnRenamed("node", "code")
    placed = first.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    kept = placed.groupBy("root").agg(F.min("first").alias("first")).select("first.key")
    # Whole rows are met with those that go, which are fewer: Spark needs no shuffle of texts while their keys are small.
    gone = settled(rows.select("key").join(kept, "key", "left_anti"))
    return unboxed(keyed(df).join(gone, "key", "left_anti"))
