"""Phrases whose words are found together more often than apart, by mergeable Misra-Gries summaries.

Phrases are counted in two passes. The first finds which can be frequent. Each task counts the hashes of its phrases, a bounded number of
words at a time, and deals them by hash range. A range is merged into one Misra-Gries summary: whenever it holds more than its
capacity, the largest count that does not fit is taken off all counters. Its capacity exceeds the range's mass divided by the
threshold, so that less than the threshold is taken off in all. Every frequent phrase survives; of the others those go whose
counter plus all that was taken off stays below the threshold. Ranges are cut by mass, so that a summary is of bounded size.

A phrase is frequent only if its parts are. So words and pairs are summed up first, and longer phrases only where all their pairs
survived. Survivors go to the second pass as a bit field by hash, a sieve of bounded size: what a full one lets through costs time
and changes nothing, as the second pass counts phrases as text, exactly.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from viewtide.session import scratch_path, scratch_scope, settled

LEAST, LONGEST, BEST = 30, 4, 2000
# Share of a phrase's occurrences that lie inside a longer one, in hundredths, from which the longer one replaces it.
INSIDE = 80
NO_LANGUAGE = "und"

# Words that a task counts at a time, and words it remembers.
CHUNK, MEMORY = 1_000_000, 200_000
# Hash ranges in which masses are known; of such ranges, as many go into one summary as have this many counters.
RANGES, COUNTERS = 4096, 1 << 20
# Bits of a sieve: so many for each survivor, but no more than 32 MB of them.
SIEVE, MOST_BITS = 64, 28

# Bytes of text whose words are hashed at a time.
BLOCK = 1 << 20

# A byte that no text has stands for what separates pieces. A-Z become a-z.
BREAK = b"\xff"
TABLE = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(count, base, np.uint64)], dtype=np.uint64)


def hashed(block: bytes, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Where the words of a block begin, their hashes, the breaks before each, and all breaks.

    A word's hash is a polynomial of its bytes modulo 2^64, taken from running sums over the block. ``up`` and ``down`` are
    powers of the base and of its inverse. Equal words have equal hashes; nothing rests on different ones having different hashes.
    """
    data = np.frombuffer(block, np.uint8)
    breaks = data == 255
    apart = breaks | (data == 32) | (data == 9)
    edges = np.flatnonzero(np.diff(np.r_[True, apart, True].view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
    codes = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * ODD
    codes = (codes ^ (codes >> np.uint64(31))) * ODD
    before = np.cumsum(breaks)
    return starts, codes ^ (codes >> np.uint64(29)), before[starts] if len(starts) else starts, int(before[-1]) if len(data) else 0


class Words(dict):
    """Numbers for words, in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Text:
    """The words of a chunk of documents as hashes, with the pieces they are in; and as numbers if they are to be ``named``."""

    def __init__(self, named: bool = False) -> None:
        self.named = named
        self.words = Words()
        self.up, self.down = powers(ODD, BLOCK), powers(INVERSE, BLOCK)
        self.clear()

    def clear(self) -> None:
        if len(self.words) > MEMORY:
            self.words.clear()
        self.ids = array("I")
        self.languages: dict[str, int] = {}
        self.waiting: list[tuple[bytes, int]] = []
        self.held = self.count = self.pieces = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, text: bytes, language: str) -> None:
        code = self.languages.setdefault(language, len(self.languages))
        text = text.translate(TABLE) + BREAK
        while len(text) > BLOCK:
            # A long text is cut between words, which leaves its pieces as they are. A longer word stays whole.
            places = [text.rfind(c, 0, BLOCK) for c in (b" ", b"\t", BREAK)]
            cut = max(places) + 1 or min(p for p in (text.find(c, BLOCK) for c in (b" ", b"\t", BREAK)) if p >= 0) + 1
            self._hold(text[:cut], code)
            text = text[cut:]
        self._hold(text, code)

    def _hold(self, text: bytes, code: int) -> None:
        if self.held and self.held + len(text) > BLOCK:
            self._flush()
        self.waiting.append((text, code))
        self.held += len(text)

    def _flush(self) -> None:
        if not self.waiting:
            return
        block = b"".join(t for t, _ in self.waiting)
        if len(block) >= len(self.up):
            self.up, self.down = powers(ODD, len(block)), powers(INVERSE, len(block))
        starts, codes, pieces, breaks = hashed(block, self.up, self.down)
        ends = np.cumsum([len(t) for t, _ in self.waiting])
        words = np.diff(np.r_[0, np.searchsorted(starts, ends)])
        language = np.repeat(np.array([c for _, c in self.waiting], np.int64), words)
        self.parts.append((codes, pieces + self.pieces, language))
        if self.named:
            self.ids.extend(map(self.words.__getitem__, block.replace(BREAK, b" ").split()))
        self.pieces += breaks
        self.count += len(starts)
        self.waiting, self.held = [], 0

    def close(self) -> None:
        """Put the words together and work out, at each place, how many words are left in the piece."""
        self._flush()
        none = np.empty(0, np.int64)
        self.word, pieces, self.language = map(np.concatenate, zip(*(self.parts or [(none.astype(np.uint64), none, none)])))
        self.language_names = list(self.languages)
        seeds = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in self.language_names], np.uint64)
        ends = np.flatnonzero(np.r_[pieces[1:] != pieces[:-1], True]) + 1 if len(pieces) else none
        self.room = np.repeat(ends, np.diff(np.r_[0, ends])) - np.arange(len(pieces))
        self.start = (self.word ^ seeds[self.language]) * ODD if len(seeds) else self.word
        self.all = np.frombuffer(self.ids, np.uint32).astype(np.int64)
        if self.named:
            self.names = list(self.words)

    def phrases(self, longest: int, sieves: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length where its phrases begin, and their hashes.

        ``sieves`` belong to lengths 1 and 2, and to longer ones. Phrases a given sieve does not hold are left out, and so are
        longer ones whose pairs are not all held.
        """
        at, code = np.flatnonzero(self.room >= 1), self.start
        code = code[at]
        pairs = None
        for size in range(1, longest + 1):
            if size > 1:
                more = self.room[at] >= size
                at, code = at[more], code[more]
                code = (code ^ (code >> np.uint64(32))) * ODD + self.word[at + size - 1]
            level = min(size, 3) // 3
            if pairs is not None:
                # A phrase one word longer needs the pair at its end too; the others were looked at before.
                more = pairs[at + size - 2]
                at, code = at[more], code[more]
            found = code ^ (code >> np.uint64(29))
            found = found * ODD
            if len(sieves) > level:
                kept = holds(sieves[level], found)
                if size == 2:
                    pairs = np.zeros(len(self.word) + longest, bool)
                    pairs[at[kept]] = True
                yield size, at[kept], found[kept]
                if size == 2:
                    at, code = at[kept], code[kept]
            else:
                yield size, at, found

    def spelled(self, at: int, size: int) -> str:
        return b" ".join([self.names[i] for i in self.all[at : at + size]]).decode("utf-8", "replace")


def holds(sieve: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether a sieve, a bit field of a power of two, has the bits of these hashes."""
    bits = len(sieve).bit_length() + 2
    place = codes >> np.uint64(64 - bits)
    return (sieve[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


# Hashes are summed up by their upper six bytes, which is fewer to shuffle.
LOW = np.uint64(16)


def packed(codes: np.ndarray) -> bytes:
    """The upper six bytes of each hash."""
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The hashes, with zeros for the lower bytes."""
    rows = np.zeros((len(data) // 6, 8), np.uint8)
    rows[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return rows.view("<u8").reshape(-1).astype(np.uint64)


def counted(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different hash in order, with its counts added up."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters between merges, and what was taken off each in all."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.codes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.held += len(codes)
        if self.held >= max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        parts = [(self.codes, self.counts), *self.waiting]
        codes, counts = counted(*(np.concatenate(side) for side in zip(*parts)))
        self.waiting, self.held = [], 0
        if len(codes) > self.capacity:
            # The largest count that does not fit. At least capacity + 1 counters lose it.
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.taken += cut
            codes, counts = codes[counts > cut], counts[counts > cut] - cut
        self.codes, self.counts = codes, counts

    def survivors(self, least: int) -> np.ndarray:
        """The hashes that may have been added ``least`` times."""
        self.merge()
        return self.codes[self.counts + self.taken >= least]


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, named: bool = False) -> Iterator[Text]:
    text = Text(named)
    for batch in batches:
        for body, language in zip(batch["text"], batch["lang"].to_pylist()):
            text.add(body.as_py() or b"", language)
            if text.count >= chunk:
                text.close()
                yield text
                text.clear()
    if text.languages:
        text.close()
        yield text


def _tallied(longest: int, sieves: list[np.ndarray], ranges: int, chunk: int):
    """Hashes and counts of a task's phrases, a row for each range and chunk; and words of each language."""
    # Phrases of lengths that a sieve is already there for are not asked for again.
    skip = 2 * len(sieves)
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "lang", "mass", "codes", "counts"]
        for text in _chunks(batches, chunk):
            found = [code for size, _, code in text.phrases(longest, sieves) if size > skip]
            codes = np.concatenate(found) if found else np.empty(0, np.uint64)
            codes, counts = np.unique(codes >> LOW << LOW, return_counts=True)
            # Counts of two bytes; a larger one takes several entries.
            times = -(-counts // 65535)
            codes, small = np.repeat(codes, times), np.full(int(times.sum()), 65535, np.int64)
            small[np.cumsum(times) - 1] = counts - (times - 1) * 65535
            small = small.astype("<u2")
            where = (codes >> shift).astype(np.int64)
            first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else where
            ends = np.r_[first[1:], len(codes)] if len(first) else first
            rows = [(int(where[a]), None, int(small[a:b].sum(dtype=np.int64)), packed(codes[a:b]), small[a:b].tobytes()) for a, b in zip(first, ends)]
            if not sieves:
                said = np.bincount(text.language, minlength=len(text.language_names))
                rows += [(None, n, int(c), None, None) for n, c in zip(text.language_names, said)]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
            for start in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[start : start + 1000]), kinds)], names)

    return run


def _merged(least: int):
    """Survivors of the ranges, which come one after the other: their hashes in bounded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary = None, None

        def rows() -> Iterator[pa.RecordBatch]:
            codes = summary.survivors(least)
            for start in range(0, len(codes), 1 << 16):
                part = codes[start : start + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], ["rows", "codes"])

        for batch in batches:
            for part, mass, codes, counts in zip(*(batch[c].to_pylist() for c in ("part", "total", "codes", "counts"))):
                if part != current:
                    if summary is not None:
                        yield from rows()
                    current, summary = part, Summary(mass // least + 1)
                summary.add(unpacked(codes), np.frombuffer(counts, "<u2").astype(np.int64))
        if summary is not None:
            yield from rows()

    return run


def _sieved(bits: int, pages: int):
    """The bit field of the hashes a task reads, page by page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for codes in batch["codes"].to_pylist():
                place = np.frombuffer(codes, np.uint64) >> np.uint64(64 - bits)
                np.bitwise_or.at(sieve, place >> np.uint64(3), np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8)))
        for page, part in enumerate(sieve.reshape(pages, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["page", "bits"])

    return run


def _sieve(tallies: DataFrame, least: int, counters: int, per_survivor: int) -> np.ndarray:
    """The survivors of summed-up tallies as a bit field. At most 32 MB come to the driver."""
    spark = tallies.sparkSession
    rows = tallies.where("codes IS NOT NULL")
    # One row for each range.
    masses = rows.groupBy("range").agg(F.sum("mass").alias("mass")).orderBy("range").collect()
    parts, total = [], 0
    for r in masses:
        if not parts or total + r.mass > counters * least:
            parts.append([])
            total = 0
        parts[-1].append(r)
        total += r.mass
    placed = [(r.range, p, sum(o.mass for o in part)) for p, part in enumerate(parts) for r in part]
    table = F.broadcast(spark.createDataFrame(placed, "range int, part int, total long"))
    dealt = rows.join(table, "range").select("part", "total", "codes", "counts")
    dealt = dealt.repartition(max(1, len(parts)), "part").sortWithinPartitions("part")
    survivors = settled(dealt.mapInArrow(_merged(least), "rows long, codes binary"))
    count = survivors.agg(F.sum("rows")).first()[0] or 0
    bits = min(MOST_BITS, max(16, (count * per_survivor).bit_length()))
    pages = max(1, 1 << max(0, bits - 3 - 16))
    sieve = np.zeros((pages, (1 << (bits - 3)) // pages), np.uint8)
    either = survivors.mapInArrow(_sieved(bits, pages), "page int, bits binary")
    for r in either.collect():
        sieve[r.page] |= np.frombuffer(r.bits, np.uint8)
    return sieve.reshape(-1)


def _spelled(longest: int, sieves: list[np.ndarray], chunk: int):
    """The phrases that the sieves hold as text, with their counts in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in _chunks(batches, chunk, named=True):
            # Codes are sorted with their places in the lowest bits; what that loses of a code is looked at as words.
            bits = np.uint64(len(text.word).bit_length())
            for size, at, codes in text.phrases(longest, sieves):
                if not len(at):
                    continue
                keys = np.sort(codes >> bits << bits | at.astype(np.uint64))
                at, codes = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), keys >> bits
                first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
                rows = np.diff(np.r_[first, len(codes)])
                shown = np.repeat(at[first], rows)
                same = text.language[at] == text.language[shown]
                for i in range(size):
                    same &= text.all[at + i] == text.all[shown + i]
                counts = np.add.reduceat(same.astype(np.int64), first)
                found = list(zip(at[first].tolist(), counts.tolist()))
                if not same.all():
                    # Different phrases with the same hash, told apart by their words.
                    others = Counter((int(text.language[a]), *text.all[a : a + size].tolist()) for a in at[~same])
                    places = {(int(text.language[a]), *text.all[a : a + size].tolist()): int(a) for a in at[~same]}
                    found += [(places[k], c) for k, c in others.items()]
                languages = [text.language_names[text.language[a]] for a, _ in found]
                phrases = [text.spelled(a, size) for a, _ in found]
                for start in range(0, len(found), 10000):
                    part = slice(start, start + 10000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(languages[part], pa.string()),
                            pa.array([size] * len(phrases[part]), pa.int32()),
                            pa.array(phrases[part], pa.string()),
                            pa.array([c for _, c in found[part]], pa.int64()),
                        ],
                        ["lang", "size", "phrase", "count"],
                    )

    return run


def frequent(
    df: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    ranges: int = RANGES,
    counters: int = COUNTERS,
    chunk: int = CHUNK,
    per_survivor: int = SIEVE,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words found ``least`` times or more in their language: lang, size, phrase, f. And the
    words ``n`` of each lang. Both are stored. Other columns of ``df`` (text, lang) are not looked at.
    """
    language = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    texts = df.select(F.col("text").cast("binary").alias("text"), language)
    kind = "range int, lang string, mass long, codes binary, counts binary"
    spark = df.sparkSession
    sieves: list[np.ndarray] = []
    path = scratch_path(spark, "words")
    for upto in (min(2, longest), longest):
        if len(sieves) * 2 >= longest:
            break
        # Tallies are as large as the texts and go when their sieve is there.
        with scratch_scope(spark):
            tallies = settled(texts.mapInArrow(_tallied(upto, list(sieves), ranges, chunk), kind))
            if not sieves:
                tallies.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("mass").alias("n")).write.parquet(path)
            sieves.append(_sieve(tallies, least, counters, per_survivor))
    phrases = texts.mapInArrow(_spelled(longest, sieves, chunk), "lang string, size int, phrase string, count long")
    phrases = phrases.groupBy("lang", "size", "phrase").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    return settled(phrases), spark.read.schema("lang string, n long").parquet(path)


def _whole(column: str) -> str:
    """A count as a decimal, as products may pass 64 bits."""
    return f"cast({column} AS decimal(19,0))"


def collocations(df: DataFrame, best: int = BEST, inside: int = INSIDE, **limits: int) -> DataFrame:
    """The ``best`` phrases of two words or more for each language of ``df`` (text, lang and others).

    lang, rank (from 1), phrase, a (occurrences), l and r (of the parts of the cut that scores lowest), n (words of the language),
    score: floor(2,000,000 a / (l + r)). A phrase inside a longer frequent one that has ``inside`` hundredths of its occurrences
    is left out. By score, then a, both descending, then phrase.

    A null text is empty, a null lang is ``und``. Repeated rows count as often as they are there. Without phrases the result is
    empty. ``limits`` go to ``frequent``.
    """
    phrases, totals = frequent(df, **limits)
    words = F.split("phrase", " ")
    candidates = settled(phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words")))

    # Of the longer phrases around a phrase the most frequent one decides.
    spans = "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> array_join(slice(words, i, s), ' '))))"
    around = candidates.where("size > 2").select("lang", F.explode(F.expr(f"array_distinct({spans})")).alias("phrase"), F.col("a").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.expr(f"longer IS NULL OR 100 * {_whole('longer')} < {inside} * {_whole('a')}"))

    cuts = kept.select("lang", "phrase", "a", "size", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.expr("array_join(slice(words, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(words, k + 1, size - k), ' ')").alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    score = F.expr(f"(2000000 * {_whole('a')}) div ({_whole('l')} + {_whole('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return ranked.join(totals, "lang").select(*columns)


# The same in SQL, with all phrases counted.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PHRASE_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY 1),
spans AS (SELECT lang, s, unnest([array_to_string(w[i:i + s - 1], ' ') for i in range(1, len(w) - s + 2)]) AS phrase
  FROM worded, range(1, 5) AS t(s)),
f AS MATERIALIZED (SELECT lang, s, phrase, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 30),
candidates AS MATERIALIZED (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE s > 1),
inner_spans AS (SELECT lang, a, unnest([array_to_string(w[i:i + t.s - 1], ' ') for i in range(1, c.s - t.s + 2)]) AS phrase
  FROM candidates c, range(2, 4) AS t(s) WHERE t.s < c.s),
around AS (SELECT lang, phrase, max(a) AS longer FROM inner_spans GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS left_part, array_to_string(w[k + 1:s], ' ') AS right_part
  FROM kept, range(1, 4) AS t(k) WHERE k < s),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = left_part JOIN f y ON y.lang = c.lang AND y.phrase = right_part
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
JOIN totals USING (lang) WHERE rank <= 2000
"""
