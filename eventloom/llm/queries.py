"""The registered queries of the operators on texts, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import alignment, decontaminate, edits, fertility, jaccard, lattice, licences, naming, negatives, passages, pii, revisits, secrets
from eventloom.llm.oracles import ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fertility(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found, m = fertility.judged(docs, keep=["doc_id"])
    ratios = ("chars_per_piece", "chars_per_bpe", "byte_share", "entropy_share")
    return found.select("doc_id", *[f"{m}.{c}" for c in (*fertility.BASE, "base_failed", "kept", *ratios)])


def op2_spaced_seeds(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark, sf_dir):
    """Token counts of every document before and after the edits of a cleaning pass."""
    found, m = edits.recounted(table(spark, sf_dir, "documents"), edits.cleaning_edits, keep=["doc_id"])
    return found.select("doc_id", *[f"{m}.{c}" for c in edits.FOUND.names if c != "tree"])


def op4_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op5_passages(spark, sf_dir):
    return passages.repeated(table(spark, sf_dir, "documents"))


def op6_segmentations(spark, sf_dir):
    """A row per document and sampled segmentation."""
    found, samples = lattice.sampled(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.inline(samples))


def op7_revisits(spark, sf_dir):
    found = revisits.resolved(revisits.page_records(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_lines(F.col("headers")))


def op8_secrets(spark, sf_dir):
    """A row per secret; the value itself only as a hash."""
    found = secrets.findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "score")


def op9_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard.linked(docs, join=jaccard.Join(width=3, num=90, den=100))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def op10_personal_data(spark, sf_dir):
    found, m = pii.found(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[f"{m}.n_{k}" for k in pii.KINDS], f"{m}.base_sha256", f"{m}.spans", f"{m}.n_added")


def op11_block_naming(spark, sf_dir):
    found, m = naming.grouped(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[f"{m}.{c}" for c in ("keep_id", "group_size", "kept", "text_sha256")])


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.select("vec_id", "embedding", label.alias("label")))


def op13_alignment(spark, sf_dir):
    found, m = alignment.aligned(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *[f"{m}.{c}" for c in alignment.FOUND.names if c != "groups"])


QUERIES = {
    "op1_fertility": op1_fertility,
    "op2_spaced_seeds": op2_spaced_seeds,
    "op3_token_counts": op3_token_counts,
    "op4_licences": op4_licences,
    "op5_passages": op5_passages,
    "op6_segmentations": op6_segmentations,
    "op7_revisits": op7_revisits,
    "op8_secrets": op8_secrets,
    "op9_jaccard": op9_jaccard,
    "op10_personal_data": op10_personal_data,
    "op11_block_naming": op11_block_naming,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_alignment": op13_alignment,
}

__all__ = ["ORACLES", "QUERIES"]
