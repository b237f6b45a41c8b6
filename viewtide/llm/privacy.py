"""Personal data, and terms that give it away.

Four kinds of personal data are found by pattern and checked: email, ip, card, phone. Redacting them is not
enough where words in the same document identify them as well. Information theory says how much a term t reveals of a
protected value e: their pointwise mutual information log2(p(t,e) / p(t)p(e)), as a share of e's information
-log2 p(e). All probabilities are shares of the documents, of which equal ones count once. Since any word of a single
document seems to reveal a value found there only, the share is discounted by support: the first document with both is
the one that suggests the link, and of k documents the other k - 1 bear it out, so the share is multiplied by
(k - 1) / (k - 1 + SUPPORT). A term that then reveals most of the information is removed, one that reveals much of it is generalised.

Everything is built from column expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.llm.base import keyed, stored, text_or_empty, unboxed
from viewtide.session import settled

# The kinds in their order and what they look like. Possessive quantifiers change no match here, as
# no part of a pattern could give back what it took; they keep matching linear and without recursion. A match of
# email or ip begins where a run of its first characters begins or where the last match ended, since any later
# start in the run would need the same characters after it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A character that every match has, where there is one.
NEEDED = {"email": "@", "phone": "+"}

WORD = r"\p{L}[\p{L}\p{M}'-]*+"
# Documents, besides the first, whose evidence is halved.
SUPPORT = 0.5
REMOVE, GENERALISE = 0.9, 0.6

SPAN = "struct<start:bigint,end:bigint,value:string>"
TERM = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"
# Matches whose positions are added up together.
CHUNK = 64


def _valid(kind: str, match: str = "m.value") -> str:
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": rf"forall(split({match}, '\\.'), p -> coalesce(try_cast(p AS decimal(38,0)) <= 255, false))",
        "card": f"length({digits}) BETWEEN 12 AND 19 AND luhn_check({digits})",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
    }[kind]


def _steps(text: Column, pattern: str) -> Column:
    """A text as pairs (gap, value): the text before a match, and the match; the last value is null."""
    gaps = F.split(text, pattern, -1)
    values = F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array(F.lit(None).cast("string")))
    return F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).cast("long").alias("gap"), v.alias("value")))


def _placed(steps: str) -> Column:
    """The matches with their code point positions. Lengths are added up in chunks, so that many matches take about linear time."""
    length = "x.gap + coalesce(length(x.value), 0)"
    within = (
        f"aggregate(c, named_struct('at', b, 'out', cast(array() AS array<{SPAN}>)), (a, x) -> named_struct("
        f"'at', a.at + {length}, 'out', if(x.value IS NULL, a.out, concat(a.out, array(named_struct("
        "'start', a.at + x.gap, 'end', a.at + x.gap + length(x.value), 'value', x.value))))), a -> a.out)"
    )
    chunks = f"transform(sequence(1, size({steps}), {CHUNK}), i -> slice({steps}, i, {CHUNK}))"
    sums = f"transform({chunks}, c -> aggregate(c, 0L, (a, x) -> a + {length}))"
    bases = f"slice(aggregate({sums}, array(0L), (a, s) -> concat(a, array(element_at(a, -1) + s))), 1, size({sums}))"
    return F.expr(f"flatten(zip_with({chunks}, {bases}, (c, b) -> {within}))")


def found(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``spans``: array of (start, rank, end, kind, value), by start and then kind.

    Positions count code points, ends are exclusive. Matches of one kind do not overlap, those of different kinds may.
    """
    none = F.expr("array(named_struct('gap', 0L, 'value', cast(null AS string)))")
    columns = {}
    for kind, pattern in PATTERNS.items():
        steps = _steps(F.col(text), pattern)
        needed = NEEDED.get(kind)
        columns[f"_{kind}"] = F.when(F.col(text).contains(needed), steps).otherwise(none) if needed else steps
    stepped = df.withColumns(columns)
    placed = stepped.withColumns({f"_{kind}": _placed(f"_{kind}") for kind in PATTERNS})
    tagged = [
        F.expr(
            f"transform(filter(_{kind}, m -> {_valid(kind)}), m -> named_struct("
            f"'start', m.start, 'rank', {rank}, 'end', m.end, 'kind', '{kind}', 'value', m.value))"
        )
        for rank, kind in enumerate(PATTERNS)
    ]
    spans = F.array_sort(F.concat(*tagged))
    return placed.withColumn("spans", spans).drop(*columns)


def _holds(text: str = "text") -> Column:
    """Whether ``found`` has any span in a text, without their places."""
    kinds = []
    for kind, pattern in PATTERNS.items():
        held = F.expr(f"exists(regexp_extract_all({text}, r'{pattern}', 0), m -> {_valid(kind, 'm')})")
        kinds.append(F.col(text).contains(NEEDED[kind]) & held if kind in NEEDED else held)
    return reduce(Column.__or__, kinds)


def printed(spans: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def _digest(text: str = "text") -> Column:
    """A number that equal texts share."""
    return F.xxhash64(F.col(text))


def _values() -> Column:
    """The different protected values of a document."""
    # Letters in an address mean the same in either case; other values are their digits and dots.
    value = "CASE s.kind WHEN 'email' THEN lower(s.value) WHEN 'ip' THEN s.value ELSE regexp_replace(s.value, '[^0-9]', '') END"
    return F.expr(f"array_distinct(transform(spans, s -> concat(s.kind, ':', {value})))")


def _rewritten(spans: str, name: str) -> Column:
    """``text`` with ``name`` for each of ``spans`` (s, of which the text up to ``a.at`` is written), by start.

    The text is cut to a part for each chunk of spans, and each part to its pieces, so that many spans take about linear time.
    """
    chunks = f"transform(sequence(1, greatest(size({spans}), 1), {CHUNK}), i -> slice({spans}, i, {CHUNK}))"
    # How far earlier spans reach at the beginning of each chunk, and at the end.
    reach = "aggregate(chunks, array(0L), (r, c) -> concat(r, array(greatest(element_at(r, -1), array_max(transform(c, s -> s.end))))))"
    piece = f"concat(substring(a.part, cast(a.at - b AS int) + 1, cast(greatest(s.start - a.at, 0L) AS int)), {name})"
    written = (
        "aggregate(c, named_struct('at', b, 'part', substring(text, cast(b AS int) + 1, cast(array_max(transform(c, s -> s.end)) - b AS int)), 'out', ''),"
        f" (a, s) -> named_struct('at', greatest(a.at, s.end), 'part', a.part, 'out', concat(a.out, {piece})), a -> a.out)"
    )
    parts = f"zip_with(x.chunks, slice(x.reach, 1, size(x.chunks)), (c, b) -> {written})"
    bound = f"transform(array({chunks}), chunks -> named_struct('chunks', chunks, 'reach', {reach}))"
    return F.expr(f"element_at(transform({bound}, x -> concat(array_join({parts}, ''), substring(text, cast(element_at(x.reach, -1) AS int) + 1))), 1)")


def _cleared() -> Column:
    """``text`` with a blank for each character of ``spans``, so that places stay."""
    return _rewritten("spans", "repeat(' ', cast(greatest(s.end - greatest(s.start, a.at), 0L) AS int))")


def _words(text: str) -> Column:
    """The different words of a text in lower case, those of one letter aside."""
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.lower)
    return F.filter(F.array_distinct(words), lambda w: F.length(w) > 1)


def disclosing(rows: DataFrame, texts: DataFrame, support: float = SUPPORT, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """Per ``key`` the ``terms`` that reveal its protected values, at each place: array of (start, rank, end, kind, value).

    ``rows`` (key, digest, text, spans, values) has the documents with protected values and should be settled, ``texts``
    (key, text) all documents. Equal texts count once; their digests tell.
    """
    spark = rows.sparkSession
    none = rows.select("key", F.expr(f"cast(array() AS array<{TERM}>)").alias("terms")).where("false")

    # The discount leaves nothing of a single document, so that values and pairs of one need not be looked at.
    holds = rows.select("key", "digest", F.explode("values").alias("value"))
    values = settled(holds.select("digest", "value").distinct().groupBy("value").agg(F.count("*").alias("with_value")).where("with_value > 1"))
    if values.isEmpty():
        return none
    shared = holds.join(values.select("value"), "value", "left_semi").groupBy("key").agg(F.collect_list("value").alias("shared"))
    documents = rows.select("key", "digest", _cleared().alias("clear")).join(shared, "key")
    documents = settled(documents.withColumn("words", _words("clear")))

    def paired(df: DataFrame) -> DataFrame:
        return df.withColumn("value", F.explode("shared")).withColumn("term", F.explode("words")).drop("shared", "words")

    pairs = paired(documents.select("digest", "shared", "words").dropDuplicates(["digest"]))
    pairs = settled(pairs.groupBy("value", "term").agg(F.count("*").alias("with_both")).where("with_both > 1"))
    if pairs.isEmpty():
        return none

    # In how many documents of the whole corpus each of these terms is found. Texts stay where they are: rows are told from
    # copies by their digests and keys alone.
    known = settled(texts.select("key", _digest().alias("digest")))
    firsts = settled(known.groupBy("digest").agg(F.min("key").alias("first")))
    number = firsts.count()
    copies = settled(known.join(firsts, "digest").where("key <> first").select("key"))
    words = texts.join(copies, "key", "left_anti").select(F.explode(_words("text")).alias("term"))
    # Words are counted before they meet the pairs. A semi join would be moved below the count, and shuffle each word of each
    # text once the pairs are too many to broadcast.
    terms = words.groupBy("term").agg(F.count("*").alias("with_term"))

    reveals = F.log2(F.lit(number) * F.col("with_both") / (F.col("with_term") * F.col("with_value")))
    # A value of all documents has no information.
    share = F.try_divide(reveals, F.log2(F.lit(number) / F.col("with_value")))
    share = share * (F.col("with_both") - 1) / (F.col("with_both") - 1 + F.lit(support))
    telling = pairs.join(terms, "term").join(values, "value").withColumn("share", share).where(F.col("share") >= generalise)
    kind = F.when(F.col("share") >= remove, "removed").otherwise("term")
    telling = settled(telling.select("value", "term", kind.alias("kind")))
    if telling.isEmpty():
        return none
    # The stronger kind holds where a term reveals several values of a document.
    told = paired(documents.select("key", "shared", "words")).join(telling, ["value", "term"]).groupBy("key", "term").agg(F.min("kind").alias("kind"))
    told = told.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("told"))
    placed = documents.select("key", "clear").join(told, "key").withColumn("_all", _steps(F.col("clear"), WORD)).withColumn("_all", _placed("_all"))
    terms = (
        "transform(filter(transform(_all, m -> named_struct('m', m, 'term', lower(m.value))), w -> map_contains_key(told, w.term)), w -> "
        f"named_struct('start', w.m.start, 'rank', {len(PATTERNS)}, 'end', w.m.end, 'kind', told[w.term], 'value', w.term))"
    )
    return placed.select("key", F.expr(terms).alias("terms"))


def _with_terms(rows: DataFrame, spotted: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` (key, spans, others) with ``all_spans``: base spans and telling terms, which ``spotted`` (key, spans, text) gives."""
    marked = spotted.where(F.size("spans") > 0).select("key", "spans", "text")
    marked = settled(marked.withColumns({"digest": _digest(), "values": _values()}))
    joined = rows.join(settled(disclosing(marked, texts)), "key", "left")
    both = F.concat("spans", F.coalesce("terms", F.expr("slice(spans, 1, 0)")))
    return joined.withColumn("all_spans", F.array_sort(both)).drop("terms")


def _keyed_texts(df: DataFrame, **columns: Column) -> DataFrame:
    return keyed(df, text=text_or_empty(), **columns)


def personal_data(df: DataFrame) -> DataFrame:
    """One row for each row of ``df`` (doc_id, text): counts by kind, the digest of the base spans, and all spans.

    A null text is empty. Repeated rows stay and are found to hold the same. Terms that give a value away are spans of
    kind ``removed`` or ``term``. An empty table gives an empty result.
    """
    df = stored(df)
    texts = _keyed_texts(df, doc_id=F.col("doc_id"))
    held = F.when(F.size("spans") > 0, F.col("text")).alias("text")
    spotted = settled(found(texts).select("key", "doc_id", "spans", held))
    rows = _with_terms(spotted.drop("text"), spotted, texts.select("key", "text"))
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in PATTERNS]
    digest = F.sha2(printed("spans").cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, digest, printed("all_spans").alias("spans"))


# What stands in the text instead of a span; a removed term leaves nothing.
MASK = "CASE s.kind WHEN 'removed' THEN '' ELSE concat('[', upper(s.kind), ']') END"


def masked(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with personal data and telling terms replaced in ``text``; ``n_chars`` follows where it is a column.

    Values become the name of their kind, telling terms ``[TERM]`` or nothing. Of overlapping spans the first is replaced by
    its name and the rest of the other removed. Texts without spans, null ones too, stay as they are.
    """
    df = stored(df)
    texts = _keyed_texts(df)
    # Stored before it is filtered, as a filter by spans would find them once more.
    spotted = settled(found(texts).select("key", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")))
    spans = _with_terms(spotted.where(F.size("spans") > 0).select("key", "spans"), spotted, texts.select("key", "text"))
    # Only rows that hold something meet their spans. The others are told where they are read, and are neither shuffled nor copied.
    untouched = unboxed(texts.where(~_holds()))
    rows = texts.where(_holds()).join(spans.select("key", "all_spans"), "key")
    # A span that begins before an earlier one has ended gets no name of its own.
    rows = rows.withColumn("text", _rewritten("all_spans", f"if(s.start >= a.at, {MASK}, '')"))
    columns = {"text": F.col("text")}
    if "n_chars" in df.columns:
        columns["n_chars"] = F.length("text").cast(df.schema["n_chars"].dataType)
    return untouched.union(rows.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in df.columns]))
