"""Corpus pipeline: five stages over documents, each written as Parquet and reread by the next.

toxicity (rejected documents go), exact dedup, SimHash near-dedup (one document
of a component stays), benchmark decontamination, packing.

Defined cases: a null text counts as empty, and rows of null ids, repeated rows and
extra columns of any name go through every stage as the operators' docstrings say; of
equal or near texts the row they name stays, ties included; very long texts are never
cut off; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from shopstream.llm.common import arrow_rows, cut, cuts_made, documents, remove_cuts
from shopstream.llm.queries import PACK_END_ID, TOXIC_THRESHOLD, WINDOW, vocabulary

# rows that Spark hands to Python at a time and words that a worker remembers: an executor's
# memory holds the workers of all stages, where a job of its own has it to itself
ROWS = 1024
WORDS = 100_000

# the toxicity model and the fingerprints have no SQL form; tests compare with brute force
ORACLE_SQL = None


def clean_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, ROWS):
        model = toxicity.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), cache=WORDS)
    return toxicity.keep_clean(spark, docs, model, threshold=TOXIC_THRESHOLD, cache=WORDS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, ROWS):
        return exact_dedup.dedup(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, ROWS):
        return simhash.dedup(spark, docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, ROWS):
        return decontaminate.remove(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), cache=WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_rows(spark, ROWS):
        pieces = packing.pack(spark, docs, vocabulary("word_bpe_49k.json"), PACK_END_ID, window=WINDOW,
                              rows=256, batch_bytes=1 << 18, cache=WORDS)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "ids", "doc_tokens",
                         "sequence_id", "offset", "boundary")


STAGES = [("toxicity", clean_toxicity), ("exact dedup", drop_copies), ("simhash near-dedup", drop_near_copies),
          ("benchmark decontamination", drop_contaminated), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and reread.

    Once a stage's rows are written, what it wrote on the way and the rows before
    it are read no more and go; a run that fails leaves them. Only the folder of
    the result stays.
    """
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        with cuts_made() as made:
            docs = cut(spark, stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        remove_cuts(spark, before + made[:-1])
        before = made[-1:]
    return docs
