"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a sample of its labelled text. A text is parsed against an
automaton: from each position the longest match is taken, and where it ends the next phrase begins. Text of
the language needs few, long phrases. The number of phrases times the bits that name a place in the sample,
divided by the length of the text, estimates the cross entropy; the smallest one wins.

Texts are parsed in segments of ``SEGMENT`` symbols, and no phrase goes beyond its segment. All segments of
many texts then take each step together, whatever the lengths of the texts, and a very long text is no slow one.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from viewtide.llm.base import boxed, kept, unboxed
from viewtide.session import settled

# The sample: so many characters in all, dealt evenly to the languages, in pieces of texts; at least a piece of each language.
SAMPLE_CHARS = 120_000
PIECE_CHARS = 200
# Parts in which a language's texts are ranked first.
SALTS = 64
# Letters whose transitions are kept in full; those of all other letters are looked up. Results do not depend on it.
DENSE = 61
SEGMENT = 256
# Symbols of texts parsed at a time.
BLOCK = 1 << 21
# Phrases per symbol from which a text matches none of the languages.
FOREIGN = 0.75

BREAK, OTHER = 0, 1  # symbols of non-letters and of letters that no sample has

UNDETERMINED = "und"


def sample(labelled: DataFrame, chars: int = SAMPLE_CHARS, piece: int = PIECE_CHARS) -> list[tuple[str, str]]:
    """``chars // piece`` pieces (lang, text) of labelled texts at most, as many of each language as of others.

    Where there are more languages than that, each has one piece.

    ``labelled`` has columns lang and text; rows with a null in either, or without a letter, are passed over. The
    choice follows a hash of the text: it looks at all rows, and copies of a text count once per language.
    """
    number = chars // piece
    digest = F.xxhash64("text")
    start = F.pmod(digest, F.greatest(F.length("text") - piece, F.lit(0)) + 1)
    pieces = (
        labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .select(F.col("lang").cast("string").alias("lang"), digest.alias("digest"), F.col("text").substr(start.cast("int") + 1, F.lit(piece)).alias("piece"))
        .distinct()
    )
    # First in SALTS parts of each language, so that a common one is not ranked in one task.
    salted = Window.partitionBy("lang", F.pmod("digest", F.lit(SALTS))).orderBy("digest", "piece")
    first = pieces.withColumn("turn", F.row_number().over(salted)).where(F.col("turn") <= number)
    turn = Window.partitionBy("lang").orderBy("digest", "piece")
    ranked = settled(first.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= number))
    chosen = ranked.orderBy("turn", "lang").limit(max(number, ranked.where("turn = 1").count()))
    return [(r.lang, r.piece) for r in chosen.collect()]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """OTHER at the code points of letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)], np.uint8) * OTHER


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence, for each state by symbol."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(step[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Tables:
    """An automaton as tables that many texts step through together.

    A step gives twice the place of the next state's row, plus one if a phrase begins. Symbols below ``width`` have a column in
    ``dense``. Others have few transitions each, which are found by ``keys`` (state times ``total`` plus symbol).
    """

    def __init__(self, step: list[dict[int, int]], width: int, total: int):
        self.width, self.total = width, total
        edges = np.array([(state, c, to) for state, row in enumerate(step) for c, to in row.items()], np.int64).reshape(-1, 3)
        state, symbol, to = edges[edges[:, 1] < width].T
        dense = np.full((len(step), width), -1, np.int64)
        dense[state, symbol] = to
        fresh = np.maximum(dense[0], 0)
        goes_on = dense >= 0
        goes_on[0] = False
        dense = np.where(goes_on, dense, fresh) * width * 2 + ~goes_on
        dense[:, width - 1] = 0  # past the end of a text
        self.dense = dense.astype(np.int32 if len(step) * width < 1 << 30 else np.int64).ravel()
        state, symbol, to = edges[edges[:, 1] >= width].T
        order = np.lexsort((symbol, state))
        self.keys = np.r_[(state * total + symbol)[order], np.iinfo(np.int64).max]
        self.to = np.r_[to[order], 0]

    def after(self, value: np.ndarray, symbols: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """The next values. ``rare`` are the places of ``symbols`` from ``width`` on."""
        if not len(rare):
            return self.dense.take((value >> 1) + symbols)
        state = (value[rare] >> 1) // self.width
        found = self.dense.take((value >> 1) + np.where(symbols < self.width, symbols, OTHER))
        wanted = symbols[rare].astype(np.int64)
        key = state.astype(np.int64) * self.total + wanted
        place, root = np.searchsorted(self.keys, key), np.searchsorted(self.keys, wanted)
        goes_on = (self.keys[place] == key) & (state > 0)
        fresh = np.where(self.keys[root] == wanted, self.to[root], 0)
        found[rare] = np.where(goes_on, self.to[place], fresh) * self.width * 2 + ~goes_on
        return found


class Model:
    """Automata of the languages in a sample. Every letter of the sample is a symbol of its own."""

    def __init__(self, pieces: tuple[tuple[str, str], ...]):
        texts: dict[str, list[str]] = {}
        for lang, text in pieces:
            texts.setdefault(lang, []).append(text)
        self.langs = sorted(texts)
        counts = Counter(c for _, text in pieces for c in text.lower() if c.isalpha())
        letters = sorted(sorted(counts), key=counts.get, reverse=True)
        self.pad = min(len(letters), DENSE) + 2
        self.width = self.pad + 1
        self.symbol = _letters().astype(np.int32)
        for i, c in enumerate(letters):
            for variant in {c, c.upper()}:
                if len(variant) == 1 and variant.lower() == c:
                    self.symbol[ord(variant)] = i + 2 + (i >= DENSE)
        self.tables, self.bits = [], []
        for lang in self.langs:
            joined = self.symbols(" ".join(texts[lang]))
            known = joined[joined != OTHER]
            self.tables.append(Tables(_automaton(known.tolist()), self.width, len(letters) + 3))
            self.bits.append(np.log2(len(known) + 2))

    def symbols(self, text: str) -> np.ndarray:
        """A text as symbols; several non-letters in a row are one."""
        found = self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        inner = found == BREAK
        return found[~(inner & np.r_[True, inner[:-1]])] if len(found) else found

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """The number of phrases of each text (row) in each language (column)."""
        sizes = np.array([-(-len(t) // SEGMENT) for t in texts])
        rows = np.full((sizes.sum(), SEGMENT), self.pad, np.int32)
        flat, at = rows.ravel(), 0
        for text, size in zip(texts, sizes):
            flat[at : at + len(text)] = text
            at += size * SEGMENT
        steps = np.ascontiguousarray(rows.T)
        rare = [np.flatnonzero(symbols >= self.width) for symbols in steps]
        ends = np.r_[0, np.cumsum(sizes)]
        out = np.zeros((len(texts), len(self.langs)))
        for k, table in enumerate(self.tables):
            value = np.zeros(len(rows), table.dense.dtype)
            count = np.zeros(len(rows), np.int32)
            for symbols, others in zip(steps, rare):
                value = table.after(value, symbols, others)
                count += value & 1
            total = np.r_[0, np.cumsum(count)]
            out[:, k] = total[ends[1:]] - total[ends[:-1]]
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Language, score and phrases per symbol of each text."""
        out: list = [(UNDETERMINED, 0.0, 1.0)] * len(texts)
        where: list[int] = []
        block: list[np.ndarray] = []
        held = 0

        def flush():
            counts = self.phrases(block)
            sizes = np.array([len(t) for t in block])
            cost = counts * np.array(self.bits)
            order = np.argsort(cost, axis=1, kind="stable")
            for row, i in enumerate(where):
                best = order[row, 0]
                second = cost[row, order[row, 1]] if len(self.langs) > 1 else np.inf
                score = 1.0 if np.isinf(second) else float(second / (second + cost[row, best]))
                out[i] = (self.langs[best], score, float(counts[row, best] / sizes[row]))

        for i, text in enumerate(texts):
            found = self.symbols(text or "")
            if not self.langs or not (found != BREAK).any():
                continue
            where.append(i)
            block.append(found)
            held += len(found)
            if held >= BLOCK:
                flush()
                where, block, held = [], [], 0
        if block:
            flush()
        return out


@kept
def _model(pieces: tuple[tuple[str, str], ...]) -> Model:
    """One model for each Python worker, however many tasks it runs."""
    return Model(pieces)


def language(text: Column, pieces: list[tuple[str, str]]) -> Column:
    """A struct (lang, score, phrases) for each whole text: the language, the share of the runner-up's cost in the cost
    of the best two (0.5 to 1), and the phrases per symbol. A text without letters is ``und``, as is any without a sample.
    """
    pieces = tuple(map(tuple, pieces))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("phrases", pa.float64())])

    @F.arrow_udf("lang string, score double, phrases double")
    def column(texts: pa.Array) -> pa.Array:
        found = _model(pieces).predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), kind)], fields=list(kind)) if found else pa.array([], kind)

    return column(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(df: DataFrame) -> list[tuple[str, str]]:
    """The sample of the documents to learn from: those with an id that are not held out."""
    return sample(df.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text"))


def identify(df: DataFrame, pieces: list[tuple[str, str]]) -> DataFrame:
    """One row (doc_id, held_out, lang_pred, score) for each row of ``df``.

    Only the text is looked at. Null, empty and letterless texts get ``und`` and score 0; repeated rows stay.
    """
    found = df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language(F.col("text"), pieces).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def accepted(df: DataFrame, pieces: list[tuple[str, str]], foreign: float = FOREIGN) -> DataFrame:
    """The rows of ``df`` whose text is in one of the learned languages, columns as they were.

    Rejected are texts without a letter and texts that need ``foreign`` or more phrases per symbol: their letters or
    letter pairs occur in none of the samples.
    """
    found = boxed(df, found=language(F.col("text"), pieces))
    return unboxed(found.where((F.col("found.lang") != UNDETERMINED) & (F.col("found.phrases") < foreign)))
