"""A collection in which each source has its target share of the tokens.

Tokens are aggregated per source; the largest total for which no source needs more
repeats than it may have fixes a repetition rate per source. Every document is emitted
``floor(rate)`` times, and once more with the fraction as probability, drawn from a hash
of its id and the seed, so the draw is the same on every run and on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.tokens import VOCABULARY, with_tokens
from factloom.session import durable, small

SEED = 20240501


def source_key(source: Column) -> Column:
    """A source without regard to case and surrounding blanks."""
    return F.lower(F.trim(source))


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, n_tokens`` of all documents, through durable storage: it is read several times."""
    counted = with_tokens(documents, "text", ["doc_id", "source"], vocabulary)
    return durable(counted.select("doc_id", source_key(F.col("source")).alias("source"), "n_tokens"))


def rates(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: available tokens and documents, target share and the repetition rate.

    Shares of sources without any token cannot be reached: their rate is null and the
    others keep their shares relative to each other. A source listed twice has the sum of
    its shares and the smaller of its limits; shares that are null, zero or negative ask
    for nothing. A null limit is no limit; a limit of zero or less leaves its source out
    like one without tokens. Where no source has a limit, every document of the source
    richest in tokens for its share is used once.
    """
    asked = targets.where("target_share > 0").groupBy(source_key(F.col("source")).alias("source"))
    asked = asked.agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats")).where("source is not null")
    held = counts.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("available_docs"))
    both = asked.join(held, "source", "left")
    # The one number that all sources share: the largest total that no source's limit forbids.
    usable = F.col("max_repeats").isNull() | (F.col("max_repeats") > 0)
    reach = F.when(usable, F.col("available_tokens") / F.col("target_share"))
    most = both.agg(F.coalesce(F.min(reach * F.col("max_repeats")), F.max(reach)).alias("total")).collect()[0]["total"]
    return both.withColumn("rate", F.when(usable, F.lit(float(most or 0.0)) * F.col("target_share") / F.col("available_tokens")))


def mix(counts: DataFrame, rated: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, source, n_tokens, copy``: every use of a document in the collection, copies numbered from 1.

    Documents without tokens, of no source, or of a source without target are not used.
    Rows with one id draw alike.
    """
    d = counts.where("n_tokens > 0").join(small(rated.where("rate > 0").select("source", "rate", "max_repeats")), "source")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**53)) / F.lit(float(2**53))
    whole = F.floor(F.col("rate") + F.lit(1e-12))
    # ``least`` skips a null limit.
    copies = F.least(whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0), F.col("max_repeats")).cast("int")
    used = d.withColumn("copies", copies).where("copies > 0")
    return used.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))


def shares(counts: DataFrame, rated: DataFrame, seed: int = SEED) -> DataFrame:
    """Per target source: the rate, the documents and tokens used, the most uses of one document, and the share reached."""
    m = mix(counts, rated, seed).groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("uses"), F.countDistinct("doc_id").alias("docs_used"), F.max("copy").alias("most_uses"))
    all_rows = rated.join(m, "source", "left").na.fill(0, ["mixed_tokens", "uses", "docs_used", "most_uses", "available_tokens", "available_docs"])
    total = all_rows.agg(F.sum("mixed_tokens").alias("t")).collect()[0]["t"] or 0
    share = F.when(F.lit(total) > 0, F.col("mixed_tokens") / F.lit(float(max(total, 1)))).otherwise(0.0)
    return all_rows.select("source", "target_share", "max_repeats", "available_docs", "available_tokens", "rate", "docs_used", "uses", "most_uses", "mixed_tokens", share.alias("actual_share"))
