"""Corpus pipeline: raw ``documents`` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet under ``spark.checkpoint.dir`` and rereads it as the
next stage's documents. All stages but the last return the columns of their
input. Rows may have null or repeated doc_id, null or empty texts and further
columns of any name; each stage says what becomes of them. A text is held whole in
one row, up to the 2 GB that a string of Spark may have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, line_dedup, minhash, mixing, toxicity
from folioforge.llm.common import materialize, read_table, ready

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``TOXIC`` or more go (op 9); labels of sf_dir train the
    model. Null and empty texts stay (they score the bias)."""
    ready(spark)
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"), TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go from the text (op 4); n_chars is
    counted anew. Every row stays, also one whose lines have all gone; rows with
    null doc_id stay as they are."""
    ready(spark)
    return line_dedup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least doc_id stays
    (op 3); of rows that repeat a doc_id one; rows with null doc_id all stay."""
    ready(spark)
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix (op 6): a document once for each pass over its source that takes
    it, cut behind the last word taken. Rows without a word are never taken."""
    ready(spark)
    return mixing.take_text(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text) of every row (op 8): packed token ids and the
    text decoded from them. Null texts are empty."""
    ready(spark)
    return bpe.decode(bpe.encode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: The toxicity model is trained; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``, each result written as Parquet and reread."""
    ready(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
