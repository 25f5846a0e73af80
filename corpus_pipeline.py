"""From documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept and returns a DataFrame; all but
the last return the columns of ``documents``. Between stages the documents are
written to the shared folder and read again, so that a lost executor costs no
more than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import decontaminate, jaccard, language, line_dedup, packing
from tallycast.session import materialise

# Rows that are handled at once where texts are read and handed to Python. Texts may
# be long, and a batch is held several times, so the defaults (4,096 and 10,000) are too many.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 500, "spark.sql.parquet.columnarReaderBatchSize": 1000}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 0


def small_batches(spark: SparkSession) -> None:
    for name, rows in BATCH_ROWS.items():
        if not 0 < int(spark.conf.get(name)) <= rows:
            spark.conf.set(name, str(rows))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in one or more languages, by a model of those with a known ``lang``."""
    small_batches(spark)
    found = language.predict(docs, language.fit(docs))
    return found.filter(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of line runs of 50 words or more."""
    small_batches(spark)
    return line_dedup.without_repeats(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are at least 0.8 alike."""
    small_batches(spark)
    return jaccard.one_of_each(docs, jaccard.Spec(words=5, part=80, whole=100))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their places in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, TOKENIZER, END_ID)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

# Learned models and tokenizers cannot be written as SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
