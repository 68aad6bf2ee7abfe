"""Totals and the items that belong to them, by names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import classify

#: Names meet base terms on this many leading characters of a term.
GRAM = 3


def named_items(facts: DataFrame) -> DataFrame:
    """(filing_id, section, item, first_pos): the distinct items of a filing by part of the document, with where they come first."""
    item = classify.spaced_name(F.col("name"))
    f = facts.where("filing_id is not null and name is not null").groupBy("filing_id", "name").agg(F.min("pos").alias("first_pos"))
    f = f.select("filing_id", classify.document_part(F.col("name")).alias("section"), item.alias("item"), "first_pos")
    return f.groupBy("filing_id", "section", "item").agg(F.min("first_pos").alias("first_pos"))


def totals(items: DataFrame) -> DataFrame:
    """Items that are totals, with their base term: the name without ``total``, null if nothing is left or it has none."""
    base = F.when(F.contains("item", F.lit("total")), F.trim(F.replace("item", F.lit("total"), F.lit(""))))
    return items.where(classify.is_total(F.col("item"))).withColumn("base", F.nullif(base, F.lit("")))


def subtotals(items: DataFrame) -> DataFrame:
    """(filing_id, section, total, base, item, is_parent): the items under each total, that is those whose name holds its base term.

    ``is_parent`` marks the total that an item goes to: of several the one that comes last
    in the document. Names meet terms on the first characters of the term, at every place
    of the name, within their filing and section.
    """
    t = totals(items).where("base is not null").select("filing_id", "section", F.col("item").alias("total"), "base", F.col("first_pos").alias("total_pos"), F.left("base", F.lit(GRAM)).alias("gram"))
    places = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("item")), lambda i: F.substring("item", i, F.lit(GRAM))))
    # Terms shorter than a gram meet the names' shorter grams.
    shorter = lambda n: F.transform(places, lambda g: F.left(g, F.lit(n)))
    grams = F.array_distinct(F.concat(places, *map(shorter, range(1, GRAM))))
    named = items.select("filing_id", "section", "item", F.explode(grams).alias("gram"))
    met = t.join(named, ["filing_id", "section", "gram"]).where("item <> total and contains(item, base)").drop("gram")
    last = met.groupBy("filing_id", "section", "item").agg(F.max(F.struct("total_pos", "total")).alias("last"))
    return met.join(last, ["filing_id", "section", "item"]).select("filing_id", "section", "total", "base", "item", (F.col("last.total") == F.col("total")).alias("is_parent"))
