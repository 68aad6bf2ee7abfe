"""Queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import abuse, budget, containers, mixing, segments, survivor
from factloom.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.supplied_fields(p2_survivors(spark, d))


def p2_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "filing_info"), table(spark, d, "capture_channels"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return segments.oversized(table(spark, d, "sections"))


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return segments.segment(table(spark, d, "sections"))


def p4_token_totals(spark: SparkSession, d: str) -> DataFrame:
    return budget.budget(table(spark, d, "sections"), table(spark, d, "filings"), table(spark, d, "documents"))


def p4_section_tokens(spark: SparkSession, d: str) -> DataFrame:
    return budget.section_tokens(table(spark, d, "sections"))


def p4_document_tokens(spark: SparkSession, d: str) -> DataFrame:
    return budget.document_tokens(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return containers.pack_documents(table(spark, d, "documents"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return containers.fill_report(p7_containers(spark, d))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    counts = mixing.token_counts(table(spark, d, "documents"))
    return mixing.mix(counts, mixing.rates(counts, table(spark, d, "mix_targets")))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    counts = mixing.token_counts(table(spark, d, "documents"))
    return mixing.shares(counts, mixing.rates(counts, table(spark, d, "mix_targets")))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where("offensive").select("doc_id").distinct()


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.score_documents(table(spark, d, "documents"), table(spark, d, "review_labels"))


def p9_held_out(spark: SparkSession, d: str) -> DataFrame:
    """How the machine, and additive weights for comparison, do on labelled documents they were not trained on."""
    tables = table(spark, d, "documents"), table(spark, d, "review_labels")
    return abuse.held_out(*tables).withColumn("model", F.lit("pairs")).unionByName(abuse.held_out(*tables, pairs=False).withColumn("model", F.lit("additive")))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p9_scores(spark, d))


QUERIES = {f.__name__: f for f in (
    p2_found, p2_survivors, p3_found, p3_pieces, p4_token_totals, p4_section_tokens, p4_document_tokens,
    p7_containers, p7_fill, p8_mixture, p8_shares, p9_found, p9_scores, p9_rates, p9_held_out,
)}
