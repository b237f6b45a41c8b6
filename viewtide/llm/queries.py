"""The registered query of each operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import bestfit, chat, collocations, hnsw, language, mixing, multiindex, pages, privacy, simhash, suffixes, vafile, windows
from viewtide.llm.base import query, table

# The vocabulary file and its token for the end of a text.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_OF_TEXT = 49407


@query()
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document."""
    documents = table(spark, folder, "documents")
    return simhash.near_duplicates(documents, shingle=3, bits=3)


@query(mixing.MIX_SQL)
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix(table(spark, folder, "documents"))


@query()
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    documents = table(spark, folder, "documents")
    return language.identify(documents, language.learned(documents))


@query()
def op6_privacy(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document, and terms that give it away."""
    return privacy.personal_data(table(spark, folder, "documents"))


@query()
def op3_bestfit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, with digests of the packed matrices."""
    documents = table(spark, folder, "documents")
    return bestfit.digests(bestfit.pack(documents, TOKENIZER, END_OF_TEXT, length=2048))


@query()
def op8_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, each with every source's share."""
    documents = table(spark, folder, "documents")
    return windows.pieces(documents, TOKENIZER, end=2, length=4096, with_ids=False)


@query()
def op9_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return hnsw.nearest(table(spark, folder, "embeddings"), every=100, k=10)


@query(multiindex.NEAREST_SQL)
def op10_multiindex(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest sign codes of every fiftieth vector."""
    return multiindex.nearest(table(spark, folder, "embeddings"), every=50, k=10)


@query()
def op7_tagpaths(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return pages.main_texts(table(spark, folder, "pages"))


@query()
def op4_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """The passages of 50 words or more that documents share."""
    return suffixes.repeats(table(spark, folder, "documents"))


@query(chat.CHAT_SQL)
def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations in a chat template, and what is read back from it."""
    conversations = table(spark, folder, "conversations")
    return chat.digests(chat.formatted(chat.with_hostile(conversations)))


@query(vafile.CLUSTER_SQL)
def op13_vafile(spark: SparkSession, folder: str) -> DataFrame:
    """40 clusters of all vectors after five rounds."""
    return vafile.clusters(table(spark, folder, "embeddings"))


@query(collocations.PHRASE_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 phrases of each language whose words are most often found together."""
    return collocations.collocations(table(spark, folder, "documents"))
