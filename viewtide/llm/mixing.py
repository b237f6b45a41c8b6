"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

Weights share out the total size. A source takes at most ``epochs`` times its own size; what it cannot take
goes to the others by weight, until no source is above its limit. In the end every source below its limit gets
its weight times one common level. The level follows from running totals over the sources in the order in
which they reach their limits, without iteration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from viewtide.llm.base import keyed, stored, text_or_empty, unboxed
from viewtide.operators.joins import join_null_safe
from viewtide.operators.positions import number_rows, running_total
from viewtide.session import settled

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 42

# White space, the first character of the word that follows, the rest of it.
FIRST = r"[\x20\x09-\x0D]*+([^\x20\x09-\x0D]?)[^\x20\x09-\x0D]*+"


def words(text: Column) -> Column:
    """The number of words of a text: of their first characters, as a list of all words would take many times the text's memory."""
    return F.length(F.regexp_replace(text, FIRST, "$1")).cast("long")


def shares(sizes: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source: ``source_size``, ``target``, and the target as ``whole`` repetitions and ``extra`` words.

    ``sizes`` has columns source and size and should be settled. Sources are weighted in code point order, null last,
    by ``weights`` in turn. A source of size 0 has target 0.
    """
    totals = settled(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    placed = number_rows(totals, [], [F.asc_nulls_last("source")], "place")
    turn = F.array(*[F.lit(w) for w in weights])
    weighted = placed.withColumn("weight", F.element_at(turn, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    whole = weighted.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if whole.weight is None:
        return weighted.selectExpr("source", "source_size", "0D target", "0L whole", "0D extra")
    limit = F.col("source_size") * epochs
    order = [F.asc(F.col("source_size") / F.col("weight")), F.asc("place")]
    filled = running_total(weighted, [], order, limit, "full")
    filled = settled(running_total(filled, [], order, F.col("weight"), "used"))
    # The level if the sources that come first are full. It rises while they are, and falls from the first that is not.
    level = (F.lit(whole.size) - F.col("full")).cast("double") / (F.lit(whole.weight) - F.col("used")).cast("double")
    level = F.lit(filled.agg(F.max(level)).first()[0])
    target = F.least(limit.cast("double"), level * F.col("weight"))
    times = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    found = filled.select("source", "source_size", target.alias("target"), times.alias("whole"))
    return found.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))


def drawn(doc_id: Column, seed: int = SEED) -> Column:
    """The place of a row in the order drawn by ``seed``, as text that sorts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))


def repetitions(sized: DataFrame, seed: int = SEED, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sized`` (doc_id, source, size, key) with source_size, target, ``whole`` and whether the row ``fits`` once more.

    All rows are taken ``whole`` times. Of the remaining words of a source's target, those rows are taken once more
    that come first in an order drawn by ``seed``, up to the row at least half of which fits. A source's words thus miss
    its target by at most half a row. ``sized`` should be settled.
    """
    found = shares(sized.select("source", "size"), epochs, weights)
    rows = sized.withColumn("draw", drawn(F.col("doc_id"), seed))
    order = [F.asc("draw"), F.asc("doc_id"), F.asc("size"), F.asc("key")]
    rows = running_total(rows, ["source"], order, F.col("size"), "before")
    rows = join_null_safe(rows, found, ["source"])
    fits = (F.col("extra") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("extra"))
    return rows.withColumn("fits", fits).drop("before", "extra")


def mix(df: DataFrame, seed: int = SEED) -> DataFrame:
    """One row (doc_id, size, source_size, target, taken) for each row of ``df`` (doc_id, source, text and others).

    Null and blank texts have size 0 and take nothing. A null source is a source of its own. Repeated rows are drawn
    one by one. An empty table gives an empty result.
    """
    number = F.monotonically_increasing_id().alias("key")
    sized = settled(df.select("doc_id", "source", words(text_or_empty()).alias("size"), number))
    rows = repetitions(sized, seed)
    times = F.col("whole") + F.col("fits").cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed(df: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, columns as they were.

    The rows that fit once more are the first of their source in the order drawn. So the last of them says it all, and the
    whole rows are met with one row for each source.
    """
    df = stored(df)
    sized = keyed(df, doc_id=F.col("doc_id"), source=F.col("source"), size=words(text_or_empty()))
    placed = repetitions(settled(sized.drop("row")), seed)
    last = F.max(F.when(F.col("fits"), F.struct("draw", "doc_id", "size", "key"))).alias("last")
    cuts = settled(placed.groupBy("source").agg(F.first("whole").alias("whole"), last))
    rows = keyed(df, doc_id=F.col("doc_id"), source=F.col("source"), draw=drawn(F.col("doc_id"), seed))
    rows = join_null_safe(rows, cuts, ["source"])
    # Words are counted again only where draws are equal.
    size = words(text_or_empty("row.text")).alias("size")
    same = (F.col("draw") == F.col("last.draw")) & (F.struct("doc_id", size, "key") <= F.struct("last.doc_id", "last.size", "last.key"))
    fits = F.col("last").isNotNull() & ((F.col("draw") < F.col("last.draw")) | same)
    times = (F.col("whole") + fits.cast("long")).cast("int")
    return unboxed(rows.select("row", F.explode(F.array_repeat(F.lit(0), times))))


# The same in SQL. The level is found as above; draws come from the same digest.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM totals),
filled AS (
  SELECT *, coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS used_size, coalesce(sum(weight) OVER w, 0)::BIGINT AS used_weight
  FROM weighted WINDOW w AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT max(((SELECT sum(source_size) FROM totals) - used_size)::DOUBLE
    / ((SELECT sum(weight) FROM weighted) - used_weight)::DOUBLE) AS level FROM filled),
targets AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target FROM filled, levels),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('42:' || doc_id::VARCHAR), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN target - whole * source_size > 0 AND before + size / 2 <= target - whole * source_size
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed JOIN shares ON placed.source IS NOT DISTINCT FROM shares.source
"""
