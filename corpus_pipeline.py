"""The corpus pipeline: documents through filters and a mixture into token files.

Each stage is a corpus operator at work. Its result is written as Parquet and read again as
the documents of the next stage, so a lost executor costs at most the stage it is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import mixture, simhash, token_files, toxicity, winnowing
from tripmart.llm.common import discard, scope, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; the model is learned from the
    labels of documents of this stage."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return winnowing.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixture.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; one row per document with its place in them."""
    return token_files.read_token_files(spark, token_files.write_token_files(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixture", mix_sources),
    ("token_files", write_tokens),
]

# A trained model and a tokenizer have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables.

    When a stage is stored, what it stored on its way goes, and so does the stage before. The
    result and the token files stay.
    """
    docs = _table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        with scope() as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
            before += made[:-1]
            del made[:-1]
            discard(before)
            if name != STAGES[-1][0]:
                before, made[:] = made[:], []
    return docs
