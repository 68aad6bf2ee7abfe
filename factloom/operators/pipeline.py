"""A run over all filings: what was found of each, which checks it passes, and a summary.

Every filing has one row with a status; a failing one stops nothing. Rules are Columns over
per-filing aggregates, so a run is one pass over facts and one over sections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import text as t
from factloom.operators import render, statements

#: A rendered filing has at least so many bytes.
LEAST_BYTES = 10 * 1024

# Sections of annual reports that must be there, that may be there, and all main ones by form.
REQUIRED = """ITEM_1_BUSINESS ITEM_1A_RISK_FACTORS ITEM_2_PROPERTIES ITEM_3_LEGAL_PROCEEDINGS ITEM_7_MD_AND_A ITEM_7A_MARKET_RISK
    ITEM_8_FINANCIAL_STATEMENTS ITEM_9A_CONTROLS ITEM_10_DIRECTORS ITEM_11_EXECUTIVE_COMPENSATION""".split()
OPTIONAL = """ITEM_1B_UNRESOLVED_STAFF_COMMENTS ITEM_1C_CYBERSECURITY ITEM_4_MINE_SAFETY_DISCLOSURES ITEM_5_MARKET ITEM_6_SELECTED_FINANCIAL_DATA
    ITEM_9_DISAGREEMENTS ITEM_9B_OTHER_INFORMATION ITEM_9C_FOREIGN_JURISDICTIONS ITEM_12_SECURITY_OWNERSHIP ITEM_13_RELATIONSHIPS
    ITEM_14_ACCOUNTANT_FEES ITEM_15_EXHIBITS ITEM_16_SUMMARY""".split()
QUARTERLY = """ITEM_1_FINANCIAL_STATEMENTS ITEM_2_MD_AND_A ITEM_3_MARKET_RISK ITEM_4_CONTROLS ITEM_1A_RISK_FACTORS_Q ITEM_4_MINE_SAFETY_Q
    ITEM_5_OTHER_INFORMATION_Q ITEM_6_EXHIBITS_Q""".split()
#: Main items that are no items of annual reports alone, and so count for their standard coverage too.
SHARED = "ITEM_1_FINANCIAL_STATEMENTS ITEM_2_MD_AND_A ITEM_3_MARKET_RISK ITEM_4_CONTROLS ITEM_1_LEGAL_PROCEEDINGS ITEM_2_UNREGISTERED_SALES ITEM_3_DEFAULTS".split()
STANDARD = REQUIRED + OPTIONAL + SHARED


def coverage(sections: DataFrame) -> DataFrame:
    """Per filing with sections: shares of required, standard and quarterly sections found, counts, and which required ones are missing.

    ``required, optional, standard, quarterly`` are counts of distinct ids; ``required_pct``
    and so on shares in per cent; ``missing`` the required ids not found, by the list's order.
    """
    listed = sorted({*STANDARD, *QUARTERLY})
    have = F.coalesce(F.collect_set(F.when(F.col("section_id").isin(*listed), F.col("section_id"))), F.array())
    s = sections.where("filing_id is not null").groupBy("filing_id").agg(have.alias("have"))
    lists = {"required": REQUIRED, "optional": OPTIONAL, "standard": STANDARD, "quarterly": QUARTERLY}
    of = lambda ids: F.array(*map(F.lit, ids))
    n = {k: F.size(F.array_intersect("have", of(ids))).cast("bigint") for k, ids in lists.items()}
    shares = [(n[k] * 100.0 / len(lists[k])).alias(f"{k}_pct") for k in ("required", "standard", "quarterly")]
    return s.select("filing_id", *[c.alias(k) for k, c in n.items()], *shares, F.array_join(F.array_except(of(REQUIRED), "have"), ",").alias("missing"))


def integrity(sections: DataFrame, facts: DataFrame) -> DataFrame:
    """Per filing what its texts hold: ``xbrl_facts, tables, table_rows, paragraphs, narrative, included, preservation_pct``.

    A paragraph stands between blank lines; tables are told by ``table_like``; a table or
    paragraph is included if it is not blank. A filing without tables has preserved all.
    """
    p = sections.where("filing_id is not null").select("filing_id", F.explode(F.split("text_content", r"\n\s*\n")).alias("p"))
    p = p.select("filing_id", t.table_like(F.col("p")).alias("is_table"), F.size(F.split("p", "\n")).alias("rows"), (F.trim("p") != "").alias("filled"))
    per = p.groupBy("filing_id").agg(
        F.count_if("is_table").alias("tables"), F.count_if(F.col("is_table") & F.col("filled")).alias("tables_included"), F.coalesce(F.sum(F.when(F.col("is_table"), F.col("rows"))), F.lit(0)).alias("table_rows"),
        F.count("*").alias("paragraphs"), F.count_if(~F.col("is_table")).alias("narrative"), F.count_if(~F.col("is_table") & F.col("filled")).alias("included"),
    )
    n = facts.groupBy("filing_id").agg(F.count("*").alias("xbrl_facts"))
    kept = F.when(F.col("tables") > 0, F.col("tables_included") * 100.0 / F.col("tables")).otherwise(100.0)
    return per.join(n, "filing_id", "left").select("filing_id", F.coalesce("xbrl_facts", F.lit(0)).alias("xbrl_facts"), "tables", "table_rows", "paragraphs", "narrative", "included", kept.alias("preservation_pct"))


def balance_status(facts: DataFrame) -> DataFrame:
    """(filing_id, sheets, balanced): contexts with a whole balance sheet, and those in which it balances."""
    f = facts.select("filing_id", "contextref", F.replace("name", F.lit("us-gaap_"), F.lit("us-gaap:")).alias("concept"), F.replace("value", F.lit(","), F.lit("")).try_cast("double").alias("value"), "pos", "fact_id")
    sheets = statements.balance_sheets(f.where("value is not null"), ["filing_id", "contextref"]).where("assets is not null and liabilities_full is not null and equity_full is not null")
    good = statements.balanced(F.col("assets"), F.col("liabilities_full"), F.col("equity_full"), F.coalesce("minority", F.lit(0.0)))
    return sheets.groupBy("filing_id").agg(F.count("*").alias("sheets"), F.count_if(good).alias("balanced"))


#: What can go wrong with a filing, in the order in which it is reported: (status, rule over the counts).
CHECKS: list[tuple[str, str]] = [
    ("no_document", "n_facts = 0 and n_sections = 0"), ("no_facts", "n_facts = 0"), ("no_text", "n_sections = 0"), ("unbalanced", "sheets > balanced"), ("too_small", f"n_bytes < {LEAST_BYTES}"),
]


def status(checks: list[tuple[str, str]] = CHECKS) -> Column:
    """The first check that a filing fails, else ``ok``."""
    return F.coalesce(*[F.when(F.expr(rule), name) for name, rule in checks], F.lit("ok"))


def processed(filings: DataFrame, facts: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per catalogued filing: ``filing_id, n_facts, n_sections, n_bytes, sheets, balanced, status``.

    ``n_bytes`` is the size of its fact lines and texts. Filings catalogued twice count once.
    """
    lines = render.fact_lines(facts).groupBy("filing_id").agg(F.count("*").alias("n_facts"), F.sum(F.octet_length("text") + 1).alias("fact_bytes"))
    filled = F.coalesce(F.trim("text_content"), F.lit("")) != ""
    texts = sections.groupBy("filing_id").agg(F.count_if(filled).alias("n_sections"), F.sum(F.octet_length("text_content")).alias("text_bytes"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    f = filings.select("filing_id").distinct().join(lines, "filing_id", "left").join(texts, "filing_id", "left").join(balance_status(facts), "filing_id", "left")
    f = f.select("filing_id", zero("n_facts").alias("n_facts"), zero("n_sections").alias("n_sections"), (zero("fact_bytes") + zero("text_bytes")).alias("n_bytes"), zero("sheets").alias("sheets"), zero("balanced").alias("balanced"))
    return f.withColumn("status", status())


def summary(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Totals, successes and failures overall and by each dimension; the other dimensions are null in a row."""
    sets = rows.groupingSets([[]] + [[d] for d in dimensions], *dimensions)
    good = F.count_if(F.col("status") == "ok")
    return sets.agg(F.count("*").alias("total"), good.alias("succeeded"), (F.count("*") - good).alias("failed"))
