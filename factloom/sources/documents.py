"""Whole documents: files under a folder, metadata, contents lists, untagged instances."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import headings
from factloom.sources.markup import FACT_DDL, _rows_udtf, primary_document, scan, visible_text


def find_documents(spark: SparkSession, folder: str, tickers: list[str] | None = None, forms: list[str] | None = None, years: list[int] | None = None) -> DataFrame:
    """HTML files under ``<folder>/<ticker>/<form>/<accession>/``: path, ticker, form, accession, year, text; index pages are left out.

    The year is the first ``20..`` in the accession directory or file name; filters that are None let all pass.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.htm*").load(folder)
    part = lambda i: F.element_at(F.split("path", "/"), -i)
    year = F.regexp_extract(F.concat_ws("/", part(2), part(1)), r"(20\d{2})", 1).try_cast("int")
    out = files.select("path", part(4).alias("ticker"), part(3).alias("form"), part(2).alias("accession"), year.alias("year"), "modificationTime", F.decode("content", "UTF-8").alias("html"))
    out = out.where(~F.lower(part(1)).startswith("index"))
    for column, wanted in (("ticker", tickers), ("form", forms), ("year", years)):
        out = out if wanted is None else out.where(F.col(column).isin(wanted))
    return out


def latest_file(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys`` the file modified last; the path decides a tie."""
    return files.groupBy(*keys).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


#: Where each field of the metadata is looked for, in order.
METADATA = {
    "company": [r"COMPANY CONFORMED NAME:\s*([^\n]+)", r"<title>\s*([^<|]+?)\s*(?:\||-\s|<)", r"<h1[^>]*>\s*([^<]+?)\s*</h1>"],
    "cik": [r"CENTRAL INDEX KEY:\s*(\d+)"],
    "form": [r"CONFORMED SUBMISSION TYPE:\s*([^\n]+)", r"(?i)form\s+(10-[kq](?:/a)?)"],
    "period": [r"CONFORMED PERIOD OF REPORT:\s*(\d{8})", r"(?i)for the (?:fiscal year|quarterly period) ended\s+([A-Za-z]+ \d{1,2}, \d{4})"],
}


def metadata(text: Column) -> Column:
    """``struct<company, cik, form, period>`` from the submission header, else from title, heading and wording."""
    first = lambda patterns: F.coalesce(*[F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit("")) for p in patterns])
    return F.struct(*[first(patterns).alias(name) for name, patterns in METADATA.items()])


def balance_lines(text: Column) -> Column:
    """``array<struct<line, value, context, day>>`` of statement rows ``Balance_Sheet|Assets|$1,234|c-1|As of 2020-12-31``."""
    pattern = r"Balance_Sheet\|(Assets|Liabilities|StockholdersEquity|MinorityInterest|LiabilitiesAndStockholdersEquity)\|\$?(-?[\d,.]+)\|([^|\n]+)\|As of (\d{4}-\d{2}-\d{2})"
    groups = [F.regexp_extract_all(text, F.lit(pattern), i) for i in (1, 2, 3, 4)]
    rows = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("line", "value", "context", "day"))])
    return F.transform(rows, lambda r: F.struct(r["line"].alias("line"), F.translate(r["value"], ",", "").try_cast("double").alias("value"), r["context"].alias("context"), r["day"].alias("day")))


def verified_balances(texts: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """(filing_id, context, day, assets, total, balanced) read back from documents; missing lines are 0, later rows win."""
    from factloom.operators.statements import balanced

    rows = texts.select("filing_id", F.posexplode(balance_lines(F.col("text"))).alias("pos", "r")).select("filing_id", "pos", "r.*")
    last = lambda line: F.coalesce(F.max_by(F.when(F.col("line") == line, F.col("value")), F.when(F.col("line") == line, F.col("pos"))), F.lit(0.0))
    sheet = rows.groupBy("filing_id", "context", "day").agg(*[last(x).alias(n) for n, x in (("assets", "Assets"), ("liabilities", "Liabilities"), ("equity", "StockholdersEquity"), ("minority", "MinorityInterest"))])
    total = F.col("liabilities") + F.col("equity") + F.col("minority")
    return sheet.select("filing_id", "context", "day", "assets", total.alias("total"), balanced(F.col("assets"), F.col("liabilities"), F.col("equity"), F.col("minority"), tolerance).alias("balanced"))


def balance_text(sheets: DataFrame) -> DataFrame:
    """(filing_id, text): statement rows of ``filing_id, context, day, line, value``."""
    row = F.concat(F.lit("Balance_Sheet|"), "line", F.lit("|$"), F.format_string("%.2f", "value"), F.lit("|"), "context", F.lit("|As of "), "day")
    ordered = F.array_sort(F.collect_list(F.struct("context", "line", row.alias("row"))))
    return sheets.groupBy("filing_id").agg(F.array_join(F.transform(ordered, lambda s: s["row"]), "\n").alias("text"))


def table_of_contents(documents: DataFrame) -> DataFrame:
    """(filing_id, pos, entry): the rows of the first table behind a ``Table of Contents`` mark."""

    def rows(filing: str, html: str) -> list[tuple]:
        at = re.search(r"(?i)table\s+of\s+contents", html)
        table = re.search(r"(?is)<table\b.*?</table>", html[at.end() :]) if at else None
        found = [text for _, _, text, _, _ in scan(table.group(), lambda t, _a: t == "tr")] if table else []
        return [(filing, i, re.sub(r"\s+", " ", text)) for i, text in enumerate(filter(None, found), 1)]

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, pos bigint, entry string", rows)


def untagged_instance(documents: DataFrame, as_of: str) -> DataFrame:
    """Facts of instances without context references: the leaves of the tree, with contexts made up from dates.

    The context is the date in the leaf's tag, else in its parents' tags, else the first
    date written in the document, else ``as_of``; provenance says which.
    """
    date = re.compile(r"(\d{4})[-_]?(\d{2})[-_]?(\d{2})")
    ddl = FACT_DDL + ", provenance string"

    def rows(filing: str, xml: str) -> list[tuple]:
        elements = scan(xml, lambda t, _a: True)
        inner = {path for *_, path, _ in elements}
        first = date.search(re.sub(r"<[^>]*>", " ", xml))
        out = []
        for tag, _, text, path, n in elements:
            if not text or f"{path}/{tag}".lstrip("/") in inner:
                continue
            own, above = date.search(tag), date.search(path)
            m, how = (own, "tag") if own else (above, "parent") if above else (first, "document") if first else (None, "default")
            day = "-".join(m.groups()) if m else as_of
            out.append((filing, n, tag, tag, f"AsOf_{day}", None, None, None, None, text, how))
        return out

    return _rows_udtf(documents, "filing_id", "html", ddl, rows)


def any_text_facts(documents: DataFrame, stop: tuple[str, ...] = ("html", "head", "body", "script", "style", "meta", "link", "title", "br")) -> DataFrame:
    """The last resort: every element outside the stop list that holds text of its own, flagged as fallback."""
    ddl = FACT_DDL + ", fallback boolean"

    def rows(filing: str, html: str) -> list[tuple]:
        elements = scan(html, lambda t, _a: t not in stop)
        return [(filing, n, tag, tag, None, None, None, None, None, text, True) for tag, _, text, _, n in elements if text]

    return _rows_udtf(documents, "filing_id", "html", ddl, rows)


#: Sections looked for in the bare text when headings give fewer than two, and how long one must be.
FALLBACK_SECTIONS = {
    "ITEM_1_BUSINESS": r"ITEM\s+1\.?\s*Business(.*?)ITEM\s+1A", "ITEM_1A_RISK_FACTORS": r"ITEM\s+1A\.?\s*Risk\s+Factors(.*?)ITEM\s+1B",
    "ITEM_7_MD_AND_A": r"ITEM\s+7\.?\s*Management.*Discussion(.*?)ITEM\s+7A", "ITEM_2_MD_AND_A": r"ITEM\s+2\.?\s*Management.*Discussion(.*?)ITEM\s+3",
}
FALLBACK_LENGTH = 500


def section_texts(documents: DataFrame) -> DataFrame:
    """(filing_id, section_id, heading, text): sections of html documents by their headings.

    A section begins behind a heading (h1 to h4) that a pattern of the T8 list finds and runs
    to the next heading of more than 5 characters; the last heading of a section wins. A
    document with fewer than two such sections also gives those that the fallback patterns
    find in its bare text, if they are longer than 500 characters; its own win.
    """
    patterns = [(re.compile(p, re.I), s) for p, s in headings.DOCUMENT]

    def rows(filing: str, html: str) -> list[tuple]:
        heads = [m for m in re.finditer(r"(?is)<(h[1-4])\b[^>]*>(.*?)</\1\s*>", html)]
        found: dict[str, tuple] = {}
        plain = [re.sub(r"\s+", " ", visible_text(m.group(2))).strip() for m in heads]
        ends = [m.start() for m, t in zip(heads, plain) if len(t) > 5]
        for m, title in zip(heads, plain):
            section = next((s for p, s in patterns if p.search(title)), None) if 6 <= len(title) <= 99 else None
            if section:
                end = next((e for e in ends if e >= m.end()), len(html))
                text = visible_text(html[m.end() : end])
                if text:
                    found[section] = (title, text)
        if len(found) < 2:
            bare = visible_text(html)
            for section, pattern in FALLBACK_SECTIONS.items():
                m = re.search(pattern, bare, re.I | re.S)
                if m and len(m.group(1).strip()) > FALLBACK_LENGTH:
                    found.setdefault(section, (section.replace("_", " ").title(), m.group(1).strip()))
        return [(filing, section, title, text) for section, (title, text) in found.items()]

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, section_id string, heading string, text string", rows)


#: Where the main part of a document is looked for, in order: (name, opening tag).
CONTAINERS = [
    ("document", r"<document\b[^>]*>.*?<html\b[^>]*>.*?<body\b[^>]*>"), ("main-content", r"<div\b[^>]*\bid\s*=\s*[\"']main-content[\"'][^>]*>"),
    ("formGrouping", r"<div\b[^>]*\bclass\s*=\s*[\"'][^\"']*\bformGrouping\b[^\"']*[\"'][^>]*>"), ("body", r"<body\b[^>]*>"),
]


def main_content(html: str) -> tuple[str, str]:
    """(which container, its inner markup): the first container there is, else the whole document."""
    for name, opening in CONTAINERS:
        m = re.search(opening, html, re.I | re.S)
        if m:
            tag = "body" if name in ("document", "body") else "div"
            depth, at = 1, m.end()
            for step in re.finditer(rf"(?i)<(/?){tag}\b[^>]*>", html[m.end() :]):
                depth += -1 if step.group(1) else 1
                if not depth:
                    return name, html[m.end() : m.end() + step.start()]
            return name, html[at:]
    return "whole", html


def main_texts(documents: DataFrame) -> DataFrame:
    """(filing_id, container, text): the visible text of the main part of html documents."""

    def rows(filing: str, html: str) -> list[tuple]:
        name, inner = main_content(html)
        return [(filing, name, visible_text(inner))]

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, container string, text string", rows)


def html_filings(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(filing_id, href, container, text): index pages followed to their main document, whose main text is read; a page without one is read itself.

    ``documents`` has (href, html): what a fetch would bring. A main document that is not there leaves the page.
    """
    linked = pages.join(primary_document(pages), "filing_id", "left").join(documents.select("href", F.col("html").alias("main_html")), "href", "left")
    read = main_texts(linked.select("filing_id", F.coalesce("main_html", "html").alias("html")))
    return linked.select("filing_id", F.when(F.col("main_html").isNotNull(), F.col("href")).alias("href")).join(read, "filing_id")
