"""Passages repeated across documents, by a sparse suffix array.

Suffixes begin at words. Only those are kept whose position is selected by content: in every window of ``GAP`` positions the one
whose next words have the smallest hash (a minimiser). A passage of ``MIN_WORDS = GAP + STEM - 1`` words or more thus holds, in
every document it occurs in, a kept suffix at the same place, with the first ``STEM`` words still in the passage.

Suffixes whose stem occurs once are dropped. The others are sorted by stem and what follows it, and each is compared with its
neighbours from other texts; then the match is extended to the left and the right. As the neighbour with the longest match on
one side need not have the longest on the other, the same is done in the order of stem and what precedes it. A match of
``MIN_WORDS`` words or more is a repeat. Since no kept suffix is more than ``GAP`` words from the next, ``GAP - 1`` words on
each side are enough to reach the ends of every passage.

The text with the longest match on one side is a neighbour in one order, so the longest matches of a suffix with any other text are
known for each side. Only where they belong to different texts can it share a window of ``MIN_WORDS`` words around the stem
with a third one that is a neighbour in neither order. Those windows, at most ``GAP`` for a suffix and each for one suffix only, are settled by their
hashes: all texts with the stem are asked for windows at the same place. So every repeated window is found, whatever the
neighbours and wherever the sorted ranges were cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from viewtide.llm.base import text_or_empty
from viewtide.session import settled

STEM, GAP = 17, 34
MIN_WORDS = STEM + GAP - 1
SIDE = GAP - 1
# Words whose hash orders the positions.
GRAM = 8

BASE = 0x9E3779B97F4A7C15 | 1
ORDERS = (["hash", "after", "before", "number", "pos"], ["hash", "before", "after", "number", "pos"])


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE modulo 2**64, and of its inverse."""
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.r_[np.uint64(1), np.full(count, b, np.uint64)]) for b in (BASE, pow(BASE, -1, 1 << 64)))


class Grams:
    """Hashes of runs of words of a text, all runs of a length at once."""

    powers = _powers(1 << 10)

    def __init__(self, text: bytes | None):
        words = (text or b"").split()
        self.count = len(words)
        digest = xxhash.xxh64_intdigest
        self.words = np.fromiter(map(digest, words), np.uint64, self.count)
        if len(Grams.powers[0]) <= self.count:
            Grams.powers = _powers(2 * self.count)
        with np.errstate(over="ignore"):
            self.sums = np.r_[np.uint64(0), np.cumsum(self.words * self.powers[0][: self.count])]

    def runs(self, length: int) -> np.ndarray:
        """The hash of the words from each position on, for positions that have so many left."""
        count = max(0, self.count - length + 1)
        with np.errstate(over="ignore"):
            found = (self.sums[length : length + count] - self.sums[:count]) * self.powers[1][:count]
            found ^= found >> np.uint64(32)
            found *= np.uint64(0xD6E8FEB86659FD93)
            return found ^ (found >> np.uint64(32))

    def minima(self) -> np.ndarray:
        """The position selected in each window of MIN_WORDS words, in rising order; none in texts with fewer words."""
        if self.count < MIN_WORDS:
            return np.empty(0, np.int64)
        order = self.runs(GRAM)[: self.count - STEM + 1]
        windows = np.lib.stride_tricks.sliding_window_view(order, GAP)
        return windows.argmin(1) + np.arange(len(windows))

    def selected(self) -> np.ndarray:
        """The positions of the kept suffixes."""
        return np.unique(self.minima())


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words, and positions and stems of kept suffixes, in place of a text."""
    for batch in batches:
        counts, places, stems = [], [], []
        for text in batch["text"]:
            grams = Grams(text.as_py())
            at = grams.selected()
            counts.append(grams.count)
            places.append(at.astype(np.int32))
            stems.append(grams.runs(STEM)[at].view(np.int64))
        found = [pa.array(counts, pa.int32()), pa.array(places, pa.list_(pa.int32())), pa.array(stems, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], *found], ["doc_id", "key", "words", "pos", "hash"])


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each repeated stem of a text, with the words before it (nearest first) and after it as 4 bytes each.

    The windows in which it is selected begin ``least`` to ``most`` words before it.
    """
    for batch in batches:
        for number, text, places in zip(batch["number"], batch["text"], batch["places"]):
            grams = Grams(text.as_py())
            at = np.array(places.as_py(), np.int64)
            minima = grams.minima()
            least, most = at - np.searchsorted(minima, at, "right") + 1, at - np.searchsorted(minima, at)
            # Zero stands for no word.
            short = (grams.words >> np.uint64(32)).astype("<u4") | np.uint32(1)
            padded = np.r_[np.zeros(SIDE, "<u4"), short, np.zeros(SIDE, "<u4")]
            step = np.arange(SIDE)
            sides = [padded[at[:, None] + SIDE - 1 - step], padded[at[:, None] + SIDE + STEM + step]]
            for first in range(0, len(at), 4096):
                part = slice(first, first + 4096)
                before, after = (pa.array([r.tobytes() for r in side[part]], pa.binary()) for side in sides)
                stems = pa.array(grams.runs(STEM)[at[part]].view(np.int64))
                numbers = pa.array(np.full(len(stems), number.as_py()), pa.int64())
                places_of = [pa.array(c[part], pa.int32()) for c in (at, least, most)]
                yield pa.RecordBatch.from_arrays([stems, before, after, numbers, *places_of], [*SUFFIX.names, "least", "most"])


SUFFIX = pa.schema([("hash", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("number", pa.int64()), ("pos", pa.int32())])
# The longest match of a suffix on the side of the order, and that of the same neighbour on the other side.
REACH = pa.schema([("reach_of", pa.int64()), ("at", pa.int32()), ("stem", pa.int64()), ("best", pa.int32()), ("side", pa.int32())])
FOUND = pa.schema([("number", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("other", pa.int64())])


def _alike(side: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the stem on are the same on one side."""
    same = (side[a] == side[b]) & (side[a] != 0)
    return np.where(same.all(1), SIDE, same.argmin(1))


def _batch(columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _unknown(rows: pa.Table) -> pa.RecordBatch:
    """Suffixes whose neighbours are elsewhere might match to any length."""
    count = rows.num_rows
    return _batch([rows["number"].to_numpy(), rows["pos"].to_numpy(), rows["hash"].to_numpy(), np.full(count, SIDE), np.full(count, -1)], REACH)


def _matches(rows: pa.Table, order: list[str], last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch, pa.Table, pa.Table]:
    """Repeats and reaches among sorted suffixes, the rows to look at again with those to come, and those of the last run.

    Suffixes of one stem and text that follow each other are a run. Each of its rows is compared with the nearest rows
    of the runs beside it, which are from other texts.
    """
    stem, number, pos = (rows[c].to_numpy() for c in ("hash", "number", "pos"))
    sides = {c: np.frombuffer(b"".join(rows[c].to_pylist()), "<u4").reshape(-1, SIDE) for c in ("before", "after")}
    begins = np.flatnonzero(np.r_[True, (stem[1:] != stem[:-1]) | (number[1:] != number[:-1])])
    run = np.cumsum(np.isin(np.arange(len(stem)), begins)) - 1
    runs = len(begins)
    done = runs if last else runs - 1  # the last run may go on
    ends = np.r_[begins[1:], len(stem)] - 1
    row = np.arange(len(stem))
    back = row[(run > 0) & (run < done)]
    ahead = row[run < done - 1]
    a = np.r_[back, ahead]
    b = np.r_[ends[run[back] - 1], begins[run[ahead] + 1]]
    same = stem[a] == stem[b]
    a, b = a[same], b[same]
    alike = {c: _alike(side, a, b) for c, side in sides.items()}
    before, after = alike["before"], alike["after"]
    # Where a match goes as far as passages are looked at on both sides, or nowhere on one, one neighbour tells all.
    best, side = alike[order[1]], alike[order[2]]
    open_ended = (best > 0) & ((best < SIDE) | (side < SIDE))
    reach = _batch([number[a][open_ended], pos[a][open_ended], stem[a][open_ended], best[open_ended], side[open_ended]], REACH)
    enough = before + after + STEM >= MIN_WORDS
    a, b, before, after = a[enough], b[enough], before[enough], after[enough]
    out = [np.r_[number[a], number[b]], np.r_[pos[a] - before, pos[b] - before], np.r_[pos[a] + STEM + after, pos[b] + STEM + after], np.r_[number[b], number[a]]]
    return _batch(out, FOUND), reach, rows.slice(begins[max(0, runs - 2)] if runs else 0), rows.slice(begins[-1] if runs else 0)


def _compared(order: list[str]):
    """Repeats and reaches among the sorted suffixes of a partition; and its first and last one, which have neighbours elsewhere."""
    schema = pa.schema([*FOUND, *[f.with_name("own") if f.name == "number" else f for f in SUFFIX], *REACH])

    def widened(part: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        part = pa.Table.from_batches([part]) if isinstance(part, pa.RecordBatch) else part.rename_columns(["own" if c == "number" else c for c in part.column_names])
        part = part.combine_chunks()
        columns = [part[f.name].combine_chunks() if f.name in part.column_names else pa.nulls(part.num_rows, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = SUFFIX.empty_table()
        first = None
        for batch in batches:
            fresh = pa.Table.from_batches([batch]).select(SUFFIX.names).cast(SUFFIX)
            rows = pa.concat_tables([rest, fresh])
            if not rows.num_rows:
                continue
            if first is None:
                first = rows.slice(0, 1)
                yield widened(first)
                opening = (first["hash"][0], first["number"][0])
            if opening is not None:
                # The first run, which may begin in an earlier partition.
                other = (fresh["hash"].to_numpy() != opening[0].as_py()) | (fresh["number"].to_numpy() != opening[1].as_py())
                size = int(other.argmax()) if other.any() else len(other)
                yield widened(_unknown(fresh.slice(0, size)))
                if size < len(other):
                    opening = None
            found, reach, rest, _ = _matches(rows, order, last=False)
            # Runs before the last but one were compared; those kept are compared when more has come.
            yield widened(found)
            yield widened(reach)
        if rest.num_rows:
            found, reach, _, closing = _matches(rest, order, last=True)
            yield widened(found)
            yield widened(reach)
            yield widened(_unknown(closing))
            yield widened(rest.slice(rest.num_rows - 1))

    return run


WIDE = "number long, start int, stop int, other long, hash long, before binary, after binary, own long, pos int, reach_of long, at int, stem long, best int, side int"


def _repeats(suffixes: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(number, start, stop, other) for neighbours in one order, and (number, pos, hash, best, side). ``suffixes`` should be settled."""
    ranges = suffixes.select(*SUFFIX.names).repartitionByRange(*order).sortWithinPartitions(*order)
    found = settled(ranges.mapInArrow(_compared(order), WIDE))
    # The first and last suffix of each partition are neighbours of others: two rows for each partition.
    edges = found.where("own is not null").select("hash", "before", "after", F.col("own").alias("number"), "pos")
    beyond = edges.coalesce(1).sortWithinPartitions(*order).mapInArrow(_compared(order), WIDE).where("number is not null")
    reach = found.where("reach_of is not null").groupBy(F.col("reach_of").alias("number"), F.col("at").alias("pos"), F.col("stem").alias("hash"))
    reach = reach.agg(F.max(F.struct("best", "side")).alias("far")).select("number", "pos", "hash", "far.best", "far.side")
    return found.where("number is not null").unionByName(beyond).select(*FOUND.names), reach


def _settled_windows(suffixes: DataFrame, after: DataFrame, before: DataFrame) -> DataFrame:
    """(number, start, stop, other) for windows of MIN_WORDS words that no neighbour decides.

    A window begins ``lead`` words before a stem. The longest match before the stem has to reach ``lead`` words, the longest
    after it the others, and neither of the two texts with these matches may hold the whole window, as it is reported then.
    A window is asked for by the suffix that is selected in it and by no other, and that is the same one in every text.
    """
    after = after.select("hash", "number", "pos", F.col("best").alias("far_after"), F.col("side").alias("near_before"))
    before = before.select("number", "pos", F.col("best").alias("far_before"), F.col("side").alias("near_after"))
    first = F.greatest(F.lit(SIDE) - F.col("far_after"), F.col("near_before") + 1)
    final = F.least(F.col("far_before"), F.lit(SIDE - 1) - F.col("near_after"))
    open_ended = after.join(before, ["number", "pos"]).select("hash", "number", "pos", first.alias("first"), final.alias("final")).where("first <= final")
    open_ended = settled(open_ended)
    if open_ended.isEmpty():
        return open_ended.selectExpr("number", "pos AS start", "pos AS stop", "number AS other")
    # Few stems have such windows. What is beside the others is read and dropped, or at most shuffled once.
    near = settled(suffixes.join(open_ended.select("hash").distinct(), "hash", "left_semi"))
    left, right = F.expr("substring(before, 1, 4 * lead)"), F.expr(f"substring(after, 1, 4 * ({SIDE} - lead))")
    # 128 bits: the stem, and what is beside it.
    beside = F.xxhash64(left, right).alias("beside")
    asked = near.join(open_ended.drop("hash"), ["number", "pos"])
    asked = asked.withColumns({"first": F.greatest("first", "least"), "final": F.least("final", "most")}).where("first <= final")
    undecided = settled(asked.withColumn("lead", F.explode(F.sequence("first", "final"))).select("hash", "lead", beside, "number", "pos"))
    leads = settled(undecided.groupBy("hash").agg(F.collect_set("lead").alias("leads")))
    # Of all texts with a stem no more is needed than whether two hold a window, so they are not shuffled but counted where
    # they are read; only the windows that are undecided for a suffix meet the result.
    # Suffixes with the same words beside them, as near copies have, count once.
    alike = near.groupBy("hash", "before", "after", "least", "most").agg(F.min("number").alias("low"), F.max("number").alias("high"))
    windows = alike.join(leads, "hash").where("exists(leads, l -> l BETWEEN least AND most)")
    windows = windows.withColumn("lead", F.explode(F.expr("filter(leads, l -> l BETWEEN least AND most)")))
    key = ["hash", "lead", "beside"]
    shared = windows.select("hash", "lead", beside, "low", "high").groupBy(*key).agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    other = F.when(F.col("low") == F.col("number"), F.col("high")).otherwise(F.col("low"))
    start = F.col("pos") - F.col("lead")
    met = undecided.join(settled(shared), key)
    return met.select("number", start.cast("int").alias("start"), (start + MIN_WORDS).cast("int").alias("stop"), other.alias("other"))


def _merged(spans: Column) -> Column:
    """Spans (start, stop, other) that touch as one, with the smallest other of them."""
    kind = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("other", pa.int64())])

    @F.arrow_udf("array<struct<start:int,stop:int,other:long>>")
    def column(lists: pa.Array) -> pa.Array:
        out = []
        for found in lists.to_pylist():
            merged: list[list[int]] = []
            for span in sorted((s["start"], s["stop"], s["other"]) for s in found):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                    merged[-1][2] = min(merged[-1][2], span[2])
                else:
                    merged.append(list(span))
            out.append([dict(zip(("start", "stop", "other"), m)) for m in merged])
        return pa.array(out, pa.list_(kind))

    return column(spans)


def repeats(df: DataFrame) -> DataFrame:
    """The passages of MIN_WORDS words or more that occur in more than one row of ``df`` (doc_id, text and others).

    One row for each passage of a document: doc_id, start_word, end_word (exclusive), words (of the document), and other_id, a
    document that shares it or a part of it. Words are what white space separates. Passages that touch are reported as one.

    Equal texts are looked at once; if they have enough words, each of their rows is one passage as a whole. Passages repeated only
    within one text are not reported. Null and short texts have no passages; a null doc_id stays null. Repeated rows are equal
    texts. An empty table gives an empty result.
    """
    key = F.unhex(F.md5(text_or_empty().cast("binary")))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), text_or_empty().cast("binary").alias("text"))
    kinds = "doc_id long, key binary, words int, pos array<int>, hash array<long>"
    docs = settled(rows.mapInArrow(_suffixes, kinds).withColumn("number", F.monotonically_increasing_id()))

    classes = docs.groupBy("key").agg(
        F.min("number").alias("number"), F.count("*").alias("copies"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.first("words").alias("words")
    )
    classes = settled(classes)
    kept = docs.join(classes.select("number"), "number", "left_semi")
    stems = kept.select("number", F.inline(F.arrays_zip("pos", "hash")))
    # Settled, so that the join shuffles it anew and Spark can split the rows of a common stem.
    repeated = settled(stems.groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1").select("hash"))
    places = stems.join(repeated, "hash", "left_semi").groupBy("number").agg(F.sort_array(F.collect_list("pos")).alias("places"))
    places = settled(places.join(classes.select("number", "key"), "number"))

    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    suffixes = settled(texts.join(places, "key").select("number", "text", "places").mapInArrow(_sides, "hash long, before binary, after binary, number long, pos int, least int, most int"))
    (found, far_after), (more, far_before) = (_repeats(suffixes, order) for order in ORDERS)
    found = found.unionByName(more).unionByName(_settled_windows(suffixes, far_after, far_before))
    spans = found.groupBy("number").agg(F.collect_set(F.struct("start", "stop", "other")).alias("spans"))
    spans = spans.select("number", F.inline(_merged(F.col("spans"))))
    shown = spans.join(classes.select(F.col("number").alias("other"), F.col("low").alias("other_id")), "other")

    single = shown.join(classes.where("copies = 1").select("number", "key", "words", F.col("low").alias("doc_id")), "number")
    single = single.select("doc_id", F.col("start").alias("start_word"), F.col("stop").alias("end_word"), "words", "other_id")
    copied = docs.select("doc_id", "key").join(classes.where((F.col("copies") > 1) & (F.col("words") >= MIN_WORDS)), "key")
    other = F.when(F.col("low") == F.col("doc_id"), F.col("high")).otherwise(F.col("low"))
    copied = copied.select("doc_id", F.lit(0).alias("start_word"), F.col("words").alias("end_word"), "words", other.alias("other_id"))
    return single.unionByName(copied)
