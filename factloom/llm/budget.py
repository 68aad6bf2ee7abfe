"""How many tokens there are, by owner, language and form type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.tokens import VOCABULARY, with_tokens


def language(value: Column) -> Column:
    """A language tag as its lower-case main part; ``und`` for null or blank."""
    main = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]+)", 1)
    return F.when(main != "", main).otherwise("und")


def form(value: Column) -> Column:
    """A form type in capitals, without a leading ``Form``, with its dash; ``none`` for null or blank."""
    bare = F.regexp_replace(F.upper(F.trim(value)), r"^FORM\s*", "")
    return F.when(F.coalesce(bare, F.lit("")) == "", "none").otherwise(F.regexp_replace(bare, r"^(\d+)\s*-?\s*([A-Z])", "$1-$2"))


def ticker(value: Column) -> Column:
    """A ticker in capitals without blanks or marks before or after; ``none`` for null or blank."""
    bare = F.regexp_replace(F.upper(value), r"^[^A-Z0-9]+|[^A-Z0-9]+$", "")
    bare = F.regexp_replace(bare, r"^.*[:.]|[ .\-](?:US|N|O|Q|UN|UW)$", "")
    return F.when(F.coalesce(bare, F.lit("")) == "", "none").otherwise(bare)


def section_tokens(sections: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``section_key, filing_id, lang, n_tokens``: the exact count of every section, 0 for null or empty texts."""
    return with_tokens(sections, "text_content", ["section_key", "filing_id", "lang"], vocabulary)


def document_tokens(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, company_ticker, filing_type, lang, n_tokens``: the exact count of every document."""
    return with_tokens(documents, "text", ["doc_id", "source", "company_ticker", "filing_type", "lang"], vocabulary)


def budget(sections: DataFrame, filings: DataFrame, documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Totals over the cube of owner, language and form type.

    ``corpus`` is ``sections`` (owner: the company's ticker) or ``documents`` (owner: the
    source). ``owner, lang, form`` are null where summed over; ``n_texts, n_tokens``.
    Sections of unknown filings and dirty or missing values count under ``none`` or
    ``und``. Counts are summed per filing, then per slice, and only the slices are cubed,
    so no text and no hot company is ever shuffled.
    """
    one = filings.groupBy("filing_id").agg(F.min(F.struct("company_ticker", "filing_type")).alias("f"))
    s = section_tokens(sections, vocabulary).groupBy("filing_id", language(F.col("lang")).alias("lang"))
    s = s.agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_texts")).join(one, "filing_id", "left")
    s = s.select(F.lit("sections").alias("corpus"), ticker(F.col("f.company_ticker")).alias("owner"), "lang", form(F.col("f.filing_type")).alias("form"), "n_texts", "n_tokens")
    d = document_tokens(documents, vocabulary)
    d = d.select(F.lit("documents").alias("corpus"), F.coalesce("source", F.lit("none")).alias("owner"), language(F.col("lang")).alias("lang"),
                 form(F.col("filing_type")).alias("form"), F.lit(1).cast("bigint").alias("n_texts"), "n_tokens")
    totals = [F.sum("n_texts").alias("n_texts"), F.sum("n_tokens").alias("n_tokens")]
    slices = s.unionByName(d).groupBy("corpus", "owner", "lang", "form").agg(*totals)
    keys = [F.col("owner"), F.col("lang"), F.col("form")]
    full = slices.cube("corpus", *keys).agg(*totals, F.grouping_id().alias("gid"))
    return full.where(F.col("gid") < 8).drop("gid")
