"""Facts arranged into statements: primary statements, pivots, long rows, balance sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import classify
from factloom.functions.text import readable_concept
from factloom.session import small

RANK = {"BALANCE_SHEET": 1, "INCOME_STATEMENT": 2, "CASH_FLOW": 3, "EQUITY": 4}


def _named(facts: DataFrame) -> DataFrame:
    """Every concept named by facts with its statement type, and its section in each statement.

    The word lists are matched once per name, not once per fact.
    """
    names = facts.select(F.col("name").alias("__name")).where("name is not null").distinct()
    sections = [classify.statement_section(F.col("__name"), F.lit(s)).alias(f"__in_{s}") for s in RANK]
    return names.select("__name", classify.statement_type(F.col("__name")).alias("statement"), *sections)


def _classified(facts: DataFrame, named: DataFrame) -> DataFrame:
    f = facts.join(named, F.col("name") == F.col("__name"), "left").drop("__name")
    return f.withColumn("statement", F.coalesce("statement", F.lit("OTHER")))


def classified(facts: DataFrame) -> DataFrame:
    """Facts with the statement type of their concept, OTHER for a null name."""
    f = _classified(facts, small(_named(facts)))
    return f.drop(*[c for c in f.columns if c.startswith("__in_")])


def _primary(f: DataFrame) -> DataFrame:
    n = f.groupBy("filing_id", "contextref", "statement").agg(F.count("*").alias("n"))
    rank = F.coalesce(*[F.when(F.col("statement") == s, -r) for s, r in RANK.items()])
    # Facts of no statement are left out in the aggregate: a filter would be carried through the join and match the word lists once per fact.
    best = F.max(F.when(F.col("statement") != "OTHER", F.struct("n", rank.alias("rank"), "statement"))).alias("best")
    return n.groupBy("filing_id", "contextref").agg(best).where("best is not null").select("filing_id", "contextref", "best.statement", "best.n")


def primary_statements(facts: DataFrame) -> DataFrame:
    """(filing_id, contextref, statement, n): the statement most facts of a context belong to; ties by the statements' order."""
    return _primary(classified(facts.select("filing_id", "contextref", "name")))


def organised(facts: DataFrame) -> DataFrame:
    """Facts with statement and section; those of no statement take their context's primary one, if it has one."""
    named = small(_named(facts))
    p = _primary(_classified(facts.select("filing_id", "contextref", "name"), named)).select("filing_id", "contextref", F.col("statement").alias("primary_statement"))
    f = _classified(facts, named).join(p, ["filing_id", "contextref"], "left")
    f = f.withColumn("statement", F.when(F.col("statement") == "OTHER", F.coalesce("primary_statement", F.lit("OTHER"))).otherwise(F.col("statement")))
    section = F.coalesce(*[F.when(F.col("statement") == s, F.coalesce(f"__in_{s}", F.lit("OTHER"))) for s in RANK], F.lit("OTHER"))
    return f.withColumn("section", section).drop("primary_statement", *[f"__in_{s}" for s in RANK])


def statement_cells(facts: DataFrame) -> DataFrame:
    """(filing_id, statement, section, item, contextref, value): the cells of the statements by period.

    ``item`` is the readable concept; the last fact in document order wins a cell; values in
    dollars have their sign. Facts of no statement, name or context are left out.
    """
    f = organised(facts.select("fact_id", "filing_id", "contextref", "name", "pos", "unitref", "value")).where("statement <> 'OTHER' and name is not null and contextref is not null")
    value = F.coalesce("value", F.lit(""))
    shown = F.when((F.lower("unitref") == "usd") & ~value.startswith("$"), F.concat(F.lit("$"), value)).otherwise(value)
    item = F.when(F.contains("name", F.lit(":")), readable_concept(F.col("name"))).otherwise(F.col("name"))
    last = F.max_by(shown, F.struct("pos", "fact_id")).alias("value")
    return f.groupBy("filing_id", "statement", "section", item.alias("item"), "contextref").agg(last)


def statement_rows(cells: DataFrame) -> DataFrame:
    """(filing_id, statement, section, item, text): every row of a statement, ``-`` where a period has no value.

    The columns are the statement's contexts in order of their ids. A row has a value for each
    of them, so the list of them is no longer than a row; statements are never gathered.
    """
    columns = cells.groupBy("filing_id", "statement").agg(F.sort_array(F.collect_set("contextref")).alias("columns"))
    rows = cells.groupBy("filing_id", "statement", "section", "item").agg(F.map_from_entries(F.collect_list(F.struct("contextref", "value"))).alias("cells"))
    rows = rows.join(columns, ["filing_id", "statement"])
    values = F.transform("columns", lambda c: F.coalesce(F.try_element_at("cells", c), F.lit("-")))
    return rows.select("filing_id", "statement", "section", "item", F.concat_ws(" | ", "item", F.array_join(values, " | ")).alias("text"))


def pivoted(rows: DataFrame, keys: list[str], column: str, columns: list[str], value: Column, missing: str = "-") -> DataFrame:
    """Rows to one column per entry of ``columns``, ``missing`` where there is no value; the greatest wins a cell."""
    cells = [F.coalesce(F.max(F.when(F.col(column) == c, value)), F.lit(missing)).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*cells)


def unpivoted(wide: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row per key and column that holds a value; null, empty and ``-`` cells are dropped."""
    rows = wide.unpivot([F.col(k) for k in keys], [F.col(c) for c in columns], name, value)
    return rows.where(F.col(value).isNotNull() & ~F.trim(F.col(value).cast("string")).isin("", "-"))


def long_table(text: Column) -> Column:
    """A pipe table as ``array<struct<row, item, column, value>>``: first line the header, first cell the item."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit("|")))
    cells = F.transform(lines, lambda line: F.transform(F.split(line, r"\|"), lambda cell: F.trim(cell)))
    header = cells[0]
    body = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    rows = F.transform(body, lambda row, i: F.transform(
        F.slice(row, F.lit(2), F.greatest(F.size(row) - 1, F.lit(0))),
        lambda v, j: F.struct((i + 1).alias("row"), row[0].alias("item"), F.get(header, j + 1).alias("column"), v.alias("value"))))
    return F.filter(F.flatten(rows), lambda r: ~r["value"].isin("", "-"))


# The five lines of a balance sheet.
BALANCE = {
    "assets": "us-gaap:Assets", "liabilities": "us-gaap:Liabilities", "equity": "us-gaap:StockholdersEquity",
    "minority": "us-gaap:MinorityInterest", "total": "us-gaap:LiabilitiesAndStockholdersEquity",
}


def balance_sheets(values: DataFrame, keys: list[str], zero: bool = False) -> DataFrame:
    """One row per key with the five balance-sheet lines out of ``concept, value, pos``.

    The last fact in document order wins a line. With ``zero`` missing lines are 0 and a
    missing total is derived; else they are null, and where assets and the total are there
    a missing liability or, if that is there, a missing equity is derived from the total.
    """
    last = lambda c: F.max_by(F.when(F.col("concept") == c, F.col("value")), F.when(F.col("concept") == c, F.struct("pos", "fact_id")))
    rows = values.where(F.col("concept").isin(*BALANCE.values())).groupBy(*keys).agg(*[last(c).alias(k) for k, c in BALANCE.items()])
    if zero:
        rows = rows.na.fill(0.0, list(BALANCE))
        return rows.withColumn("total", F.when(F.col("total") == 0, F.col("liabilities") + F.col("equity") + F.col("minority")).otherwise(F.col("total")))
    minority = F.coalesce("minority", F.lit(0.0))
    known = F.col("assets").isNotNull() & F.col("total").isNotNull()
    return rows.withColumn("liabilities_full", F.coalesce("liabilities", F.when(known, F.col("total") - F.col("equity") - minority))).withColumn(
        "equity_full", F.coalesce("equity", F.when(known, F.col("total") - F.col("liabilities") - minority))
    )


def completed_rows(sheets: DataFrame, keys: list[str]) -> DataFrame:
    """The sheets of ``balance_sheets`` as rows (keys, concept, value, derived) in whole dollars, for sheets with assets.

    Assets, liabilities, equity, minority interest where it is positive, and the total where
    it is known; ``derived`` where the line was calculated.
    """
    lines = [("Assets", "assets", "assets"), ("Liabilities", "liabilities_full", "liabilities"), ("Stockholders Equity", "equity_full", "equity"), ("Minority Interest", "minority", "minority"), ("Liabilities And Stockholders Equity", "total", "total")]
    row = lambda name, full, own: F.struct(F.lit(name).alias("concept"), F.col(full).alias("amount"), F.col(own).isNull().alias("derived"))
    rows = sheets.where("assets is not null").select(*keys, F.inline(F.array(*[row(*line) for line in lines])))
    rows = rows.where("amount is not null and (concept <> 'Minority Interest' or amount > 0)")
    shown = F.concat(F.lit("$"), F.format_number(F.bround("amount", 0), 0))
    return rows.select(*keys, "concept", shown.alias("value"), "derived")


def balanced(assets: Column, liabilities: Column, equity: Column, minority: Column, tolerance: float = 0.001) -> Column:
    """Assets equal liabilities, equity and minority within the tolerance of the greater side, or liabilities alone."""
    total = liabilities + equity + minority
    return (F.abs(assets - total) <= F.greatest(assets, total) * tolerance) | (F.abs(assets - liabilities) <= F.greatest(assets, liabilities) * tolerance)
