"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, personal data, packing.

Each stage takes the documents that the one before wrote, and returns the columns of documents; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_lake.llm import lines, minhash, packing, pii, queries, toxicity
from care_lake.llm.common import table
from care_lake.session import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents; ``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier marks as toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share stay in one of them only."""
    return _documents(lines.drop_lines(docs, lines.line_bitmaps(docs, keep_first=True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.drop_near_duplicates(docs).select(*COLUMNS)


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced."""
    return _documents(pii.sanitise(docs, pii.personal_spans(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of sequences of 4096 tokens."""
    return packing.piece_digests(packing.pack(docs, packing.read_tokenizer(queries.WORD_TOKENIZER)))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_shared_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("personal data", sanitise_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the signatures; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
