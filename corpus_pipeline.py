"""A cleaning pipeline over `documents`: quality rules, near duplicates, benchmark leaks, secrets, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, fertility, jaccard, lattice, secrets
from eventloom.llm.stored import Scratch, forget, stored

_scratch: list[Scratch] = []


def _with_scratch(work):
    """What a stage stores for itself is removed when the next one begins: by then its result has been written."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _scratch:
            _scratch.pop().remove()
        with Scratch(spark) as scratch:
            _scratch.append(scratch)
            return work(spark, docs, sf_dir)

    stage.__name__, stage.__doc__ = work.__name__, work.__doc__
    return stage


@_with_scratch
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's bands go."""
    return fertility.kept(docs)


@_with_scratch
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, Jaccard of 0.8 or more."""
    return jaccard.representatives(docs, join=jaccard.Join(width=5, num=80, den=100))


@_with_scratch
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_with_scratch
def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars follows."""
    masked = secrets.redacted(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


@_with_scratch
def piece_samples(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, with their ids and inclusion scores."""
    # Executors have run four stages by now: smaller slices and fewer lattices than by default leave room beside them.
    options = lattice.Sampling(k=2, ids=True, together=1 << 19, remembered=1_000_000)
    found, samples = lattice.sampled(docs, keep=["doc_id"], options=options)
    return found.select("doc_id", F.inline(samples))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scans", secret_masks),
    ("SentencePiece encoding", piece_samples),
]

#: Tokenisers, a trained forest and sampling are no SQL: the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
