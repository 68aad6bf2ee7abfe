"""Catalogue operations: keyed upserts, differences, partitioned output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """``base`` with rows of ``changes`` in place of those with equal keys; of several changes the latest by ``version``.

    An aggregate with map-side combining, not a join: a hot key costs no skew. Rows with
    null keys are kept as one key each side agrees on.
    """
    columns = [c for c in base.columns if c not in keys]
    both = base.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    order = F.struct("__new", version, *[c for c in columns if c != version])
    return both.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("__row")).select(*keys, "__row.*").select(*base.columns)


def write_layout(df: DataFrame, path: str, columns: tuple[str, ...] = ("company_ticker", "filing_type", "fiscal_year", "fiscal_period")) -> None:
    """Write by directories of ticker, form, year and period; only the partitions present in ``df`` are replaced."""
    df.repartition(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def write_new(df: DataFrame, existing: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Append the rows whose keys are not in ``existing``; returns them."""
    new = df.join(existing.select(*keys).distinct(), keys, "left_anti")
    new.write.mode("append").parquet(path)
    return new


def partition_paths(df: DataFrame) -> DataFrame:
    """Where each filing lies in the layout; amendments in a directory of their own."""
    amended = F.trim("filing_type").endswith("/A")
    form = F.regexp_replace(F.trim("filing_type"), "/A$", "")
    tail = F.when(F.col("fiscal_period").isNull() | (F.col("fiscal_period") == "annual"), "").otherwise(F.concat(F.lit("/"), "fiscal_period"))
    path = F.concat(F.lit("companies/"), "company_ticker", F.lit("/"), form, F.when(amended, "/a").otherwise(""), F.lit("/"), "fiscal_year", tail)
    return df.select("filing_id", path.alias("path"))


def merged_calendars(own: DataFrame, others: DataFrame) -> DataFrame:
    """Calendar entries (ticker, period_end, ...): all of ``own``, and of ``others`` those of tickers that ``own`` does not have."""
    return own.unionByName(others.join(own.select("ticker").distinct(), "ticker", "left_anti"))


def added_calendar(calendar: DataFrame, ticker: str, entries: DataFrame) -> DataFrame:
    """The calendar with all entries of one ticker replaced by ``entries`` (period_end, fiscal_year, fiscal_period)."""
    kept = calendar.where(F.coalesce(F.col("ticker") != ticker, F.lit(True)))
    return kept.unionByName(entries.withColumn("ticker", F.lit(ticker)).select(*calendar.columns))


def text_documents(filings: DataFrame, sections: DataFrame) -> DataFrame:
    """(filing_id, line_ord, text): text documents as lines: a header of metadata, a guide to the sections, and the sections between marks.

    Lines stay rows until the sink writes them, so a document of any length is never one value.
    """
    head = ["company_name", "cik", "filing_type", "period_end_date", "filing_date", "fiscal_year", "fiscal_period"]
    tags = F.array_compact(F.array(*[F.concat(F.lit(f"@{c.upper()}: "), F.col(c).cast("string")) for c in head]))
    top = filings.select("filing_id", F.posexplode(tags).alias("n", "text")).select("filing_id", F.struct(F.lit(0).alias("part"), F.col("n").cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("key")).alias("line_ord"), "text")
    s = sections.where("filing_id is not null and section_id is not null")
    place = lambda part: F.struct(F.lit(part).alias("part"), F.coalesce("pos", F.lit(0)).alias("pos"), F.col("section_key").alias("key")).alias("line_ord")
    guide = s.select("filing_id", place(1), F.concat(F.lit("@SECTION_GUIDE: "), "section_id", F.coalesce(F.concat(F.lit(" | "), "heading"), F.lit(""))).alias("text"))
    marked = F.concat(F.lit("@SECTION_START: "), "section_id", F.lit("\n"), F.coalesce("text_content", F.lit("")), F.lit("\n@SECTION_END: "), "section_id")
    return top.unionByName(guide).unionByName(s.select("filing_id", place(2), marked.alias("text")))


def write_texts(documents: DataFrame, path: str) -> None:
    """Write documents (filing_id, line_ord, text) as text, one directory per filing, lines in order; files of a filing are in order of their names."""
    laid = documents.repartitionByRange("filing_id", "line_ord").sortWithinPartitions("filing_id", "line_ord")
    laid.select("filing_id", "text").write.mode("overwrite").partitionBy("filing_id").text(path)
