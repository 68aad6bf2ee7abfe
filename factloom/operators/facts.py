"""Facts with their contexts: joins, codes, groups, firsts and lasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import periods, text
from factloom.operators.ordered import numbered


def unique_contexts(contexts: DataFrame) -> DataFrame:
    """One row per filing and context id: the last in document order; ids that are null are left out."""
    last = F.max_by(F.struct("pos", "period", "entity"), F.coalesce("pos", F.lit(-1))).alias("c")
    kept = contexts.where("filing_id is not null and context_id is not null").groupBy("filing_id", "context_id").agg(last)
    return kept.select("filing_id", "context_id", F.col("c.pos").alias("context_pos"), "c.period", "c.entity")


def unique_units(units: DataFrame) -> DataFrame:
    """One row per filing and unit id: the first measure in order."""
    return units.where("filing_id is not null and unit_id is not null").groupBy("filing_id", "unit_id").agg(F.min("measure").alias("measure"))


def with_context(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts with period and entity of their context, null where it is missing; no fact is lost or repeated."""
    c = unique_contexts(contexts).withColumnRenamed("context_id", "contextref")
    return facts.join(c, ["filing_id", "contextref"], "left")


def dated(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts that have a period, with ``date_type`` INSTANT or DURATION."""
    kind = F.when(F.col("period.instant").isNotNull(), "INSTANT").when(F.col("period.enddate").isNotNull(), "DURATION")
    return with_context(facts, contexts).withColumn("date_type", kind).where("date_type is not null")


def prefix(concept: Column) -> Column:
    """The part of a concept before its colon; empty without one."""
    return F.when(F.contains(concept, F.lit(":")), F.split(concept, ":")[0]).otherwise("")


def context_codes(contexts: DataFrame) -> DataFrame:
    """``c-1, c-2, ...`` per filing in document order."""
    n = numbered(unique_contexts(contexts), ["filing_id"], ["context_pos", "context_id"])
    return n.withColumn("code", F.concat(F.lit("c-"), F.col("rn").cast("string"))).drop("rn")


def period_codes(contexts: DataFrame) -> DataFrame:
    """``P1, P2, ...`` for durations by start and ``I1, I2, ...`` for days, per filing."""
    c = unique_contexts(contexts).withColumn("kind", F.when(F.col("period.instant").isNotNull(), "I").when(F.col("period.startdate").isNotNull(), "P"))
    c = c.where("kind is not null").withColumn("begins", F.coalesce("period.instant", "period.startdate"))
    n = numbered(c, ["filing_id", "kind"], ["begins", "context_pos", "context_id"])
    return n.withColumn("code", F.concat("kind", F.col("rn").cast("string"))).drop("rn", "begins")


def modal_decimals(facts: DataFrame) -> DataFrame:
    """Per filing the decimals most facts have; the one that comes first wins a tie."""
    n = facts.where("decimals is not null").groupBy("filing_id", "decimals").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    return n.groupBy("filing_id").agg(F.max_by(F.struct("decimals", "n"), F.struct("n", (-F.col("first_pos")).alias("p"), "decimals")).alias("m")).select("filing_id", "m.*")


def first_value(facts: DataFrame) -> DataFrame:
    """Per filing, concept and context the value of the first fact in document order."""
    return facts.groupBy("filing_id", "name", "contextref").agg(F.min_by("value", F.struct("pos", "fact_id")).alias("value"))


def last_value(facts: DataFrame) -> DataFrame:
    """Per filing, concept and context the value of the last fact in document order."""
    return facts.groupBy("filing_id", "name", "contextref").agg(F.max_by("value", F.struct("pos", "fact_id")).alias("value"))


def most_reported(facts: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Per ``keys`` the ``n`` most frequent values, more frequent first, then by value."""
    counts = facts.groupBy(*keys, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), value)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def readable(facts: DataFrame) -> DataFrame:
    """Facts with a readable concept name and the value as documents show it."""
    return facts.withColumn("readable", text.readable_concept(F.col("name")))


def with_codes(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts with the short code and the spoken label of their context, null where it is missing."""
    c = context_codes(contexts)
    day = lambda part: F.col(f"period.{part}").try_cast("date")
    label = periods.context_label(day("startdate"), day("enddate"), day("instant"), text.segment_text(F.col("entity.segment")))
    return facts.join(c.select("filing_id", F.col("context_id").alias("contextref"), "code", label.alias("label")), ["filing_id", "contextref"], "left")


def tagged(elements: DataFrame) -> DataFrame:
    """Elements that are facts: those with a context, other than contexts, units and references to schemas."""
    local = F.lower(text.local_name(F.col("element")))
    return elements.where(F.col("contextref").isNotNull() & (F.trim("contextref") != "") & ~F.coalesce(local.isin("context", "unit", "schemaref"), F.lit(False)))


def filing_filter(filings: DataFrame, amended: bool, fiscal_year: str) -> DataFrame:
    """Filings of a fiscal year that are amendments, or those that are none."""
    is_amended = F.coalesce(F.trim("filing_type").endswith("/A"), F.lit(False))
    return filings.where((is_amended == F.lit(amended)) & (F.col("fiscal_year") == fiscal_year))


def primary_contexts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """(filing_id, day, contextref, assets): per day the context with the most assets, the first in document order of equals."""
    f = facts.where(F.col("name").isin("us-gaap:Assets", "us-gaap_Assets"))
    f = f.select("filing_id", "contextref", F.replace("value", F.lit(","), F.lit("")).try_cast("double").alias("v"), "pos", "fact_id").where("v is not null")
    c = unique_contexts(contexts).select("filing_id", F.col("context_id").alias("contextref"), F.col("period.enddate").alias("e"), F.col("period.instant").alias("i"))
    day = F.coalesce("e", "i", periods.context_date(F.lit(None).cast("string"), F.col("contextref")))
    f = f.join(c, ["filing_id", "contextref"], "left").withColumn("day", day)
    best = F.max_by(F.struct("contextref", F.col("v").alias("assets")), F.struct("v", -F.col("pos"), -F.col("fact_id")))
    return f.groupBy("filing_id", "day").agg(best.alias("b")).select("filing_id", "day", "b.*")


def first_pairs(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each combination of ``keys`` in the given order, found by an aggregate."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def latest_filings(filings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, filing_id): the filing filed last of each combination, one without a date before all others; the greatest id of equals."""
    best = F.max(F.struct("filing_date", "filing_id")).alias("best")
    return filings.groupBy(*keys).agg(best).select(*keys, "best.filing_id")


def with_next(rows: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Rows with the value that ``column`` has in the next row within ``keys`` by ``order``, null in the last; null keys are one key.

    Rows are numbered and joined with the number after theirs, so no key is one task's.
    """
    n = numbered(rows, keys, order, "__n")
    after = n.select(*[F.col(k).alias(f"__k_{k}") for k in keys], (F.col("__n") - 1).alias("__before"), F.col(column).alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return n.join(after, [F.col("__n") == F.col("__before"), *same], "left").drop("__n", "__before", *[f"__k_{k}" for k in keys])
