"""Operators over whole filings on small frames: totals, status, periods, references, documents, calendars."""

import datetime

import pytest
from pyspark.sql import functions as F

from factloom.functions import periods
from factloom.operators import catalogue, evidence, facts, hierarchy, pipeline, render, statements, totals
from factloom.sources import documents, registry

FACT = "fact_id bigint, filing_id string, contextref string, name string, pos bigint, unitref string, decimals string, value string, element string, section string"


def _facts(spark, rows):
    return spark.createDataFrame([(i, *r, "ix:nonFraction", "x") for i, r in enumerate(rows, 1)], FACT)


def test_totals_and_their_items(spark):
    names = ["g:TotalRevenue", "g:ProductRevenue", "g:ServiceRevenue", "g:TotalProductRevenue", "g:GrossProfit", "g:NetSales", "g:Total", "g:Inventory"]
    f = _facts(spark, [("f", "c", n, i, None, None, "1") for i, n in enumerate(names)] + [("f", "d", "g:TotalRevenue", 99, None, None, "1"), (None, "c", "g:TotalRevenue", 1, None, None, "1"), ("g", "c", None, 1, None, None, "1")])
    items = totals.named_items(f)
    assert {(r["item"], r["base"]) for r in totals.totals(items).collect()} == {("total revenue", "revenue"), ("total product revenue", "product revenue"), ("gross profit", None), ("net sales", None), ("total", None)}
    got = {(r["total"], r["item"], r["is_parent"]) for r in totals.subtotals(items).collect()}
    # Of several totals the one that comes last in the document gets the item.
    assert got == {("total revenue", "product revenue", False), ("total revenue", "service revenue", True), ("total revenue", "total product revenue", True), ("total product revenue", "product revenue", True)}
    assert totals.subtotals(items.limit(0)).count() == 0


def test_short_terms_meet_names(spark):
    items = spark.createDataFrame([("f", "s", n, i) for i, n in enumerate(["total ab", "xaby", "b", "ba"])], "filing_id string, section string, item string, first_pos int")
    assert {r["item"] for r in totals.subtotals(items).collect()} == {"xaby"}


def test_completed_sheets(spark):
    rows = [("f", "c", "us-gaap:Assets", 1, "usd", "0", "1,000"), ("f", "c", "us-gaap:StockholdersEquity", 2, "usd", "0", "400"), ("f", "c", "us-gaap:MinorityInterest", 3, "usd", "0", "50"), ("f", "c", "us-gaap:LiabilitiesAndStockholdersEquity", 4, "usd", "0", "1000"),
            ("f", "d", "us-gaap:LiabilitiesAndStockholdersEquity", 5, "usd", "0", "10"), ("f", "d", "us-gaap:StockholdersEquity", 6, "usd", "0", "4")]
    f = _facts(spark, rows).withColumn("concept", F.col("name")).withColumn("value", F.replace("value", F.lit(","), F.lit("")).cast("double"))
    sheets = statements.balance_sheets(f, ["filing_id", "contextref"])
    assert {r["contextref"]: r["liabilities_full"] for r in sheets.collect()} == {"c": 550.0, "d": None}
    got = {(r["concept"], r["value"], r["derived"]) for r in statements.completed_rows(sheets, ["filing_id", "contextref"]).collect()}
    assert got == {("Assets", "$1,000", False), ("Liabilities", "$550", True), ("Stockholders Equity", "$400", False), ("Minority Interest", "$50", False), ("Liabilities And Stockholders Equity", "$1,000", False)}


def test_statement_rows(spark):
    f = _facts(spark, [("f", "c2", "g:TotalAssets", 1, "USD", "0", "5"), ("f", "c1", "g:TotalAssets", 2, "USD", "0", "$4"), ("f", "c1", "g:TotalAssets", 3, "USD", "0", "6"), ("f", "c2", "g:CashAsset", 4, None, "0", None), ("f", None, "g:TotalAssets", 5, None, "0", "1"), ("f", "c9", None, 6, None, "0", "1")])
    rows = statements.statement_rows(statements.statement_cells(f)).collect()
    assert {r["text"] for r in rows} == {"Total Assets | $6 | $5", "Cash Asset | - | "} and {r["statement"] for r in rows} == {"BALANCE_SHEET"}


def test_filing_status(spark):
    filings = spark.createDataFrame([(f,) for f in "abcdef"] + [("a",)], "filing_id string")
    big = "text " * 3000
    sheet = lambda f, liabilities: [(f, "c", "us-gaap:Assets", 1, "usd", "0", "100"), (f, "c", "us-gaap_Liabilities", 2, "usd", "0", liabilities), (f, "c", "us-gaap:StockholdersEquity", 3, "usd", "0", "40")]
    f = _facts(spark, [*sheet("a", "60"), *sheet("b", "10"), *sheet("c", "60"), ("d", "c", "g:X", 1, None, None, "1"), ("zz", "c", "g:X", 1, None, None, "1")])
    sections = spark.createDataFrame([("a", big), ("b", big), ("c", "short"), ("d", " "), ("e", big), (None, big)], "filing_id string, text_content string")
    rows = pipeline.processed(filings, f, sections)
    assert {r["filing_id"]: r["status"] for r in rows.collect()} == {"a": "ok", "b": "unbalanced", "c": "too_small", "d": "no_text", "e": "no_facts", "f": "no_document"} and rows.count() == 6
    s = {r["kind"]: (r["total"], r["succeeded"], r["failed"]) for r in pipeline.summary(rows.withColumn("kind", F.when(F.col("filing_id") < "d", "x").otherwise("y")), ["kind"]).collect()}
    assert s == {None: (6, 1, 5), "x": (3, 1, 2), "y": (3, 0, 3)}


def test_coverage_and_integrity(spark):
    rows = [("f", "ITEM_1_BUSINESS", "a\n\nb | c\nd | e\n\n  "), ("f", "ITEM_1_BUSINESS", None), ("f", "ITEM_2_MD_AND_A", ""), ("f", None, "x"), ("g", "OTHER", "y"), (None, "ITEM_1_BUSINESS", "z")]
    s = spark.createDataFrame(rows, "filing_id string, section_id string, text_content string")
    c = {r["filing_id"]: r for r in pipeline.coverage(s).collect()}
    assert set(c) == {"f", "g"} and (c["f"]["required"], c["f"]["standard"], c["f"]["quarterly"], c["g"]["required_pct"]) == (1, 2, 1, 0.0)
    assert "ITEM_1_BUSINESS" not in c["f"]["missing"] and c["g"]["missing"].count(",") == 9
    i = {r["filing_id"]: r for r in pipeline.integrity(s, _facts(spark, [("f", "c", "g:X", 1, None, None, "1")])).collect()}
    assert (i["f"]["xbrl_facts"], i["f"]["tables"], i["f"]["table_rows"], i["f"]["narrative"], i["f"]["included"], i["f"]["preservation_pct"]) == (1, 1, 2, 4, 2, 100.0)


DAY = datetime.date(2023, 10, 29)


@pytest.mark.parametrize("text,form,end,month,want", [
    ("For the fiscal year ended January 28, 2024", "10-K", None, None, ("2024", "annual")), ("for the period ending\nMay", "10-K", DAY, None, ("2023", "annual")), ("fiscal 2019 was good", "10-K", DAY, None, ("2019", "annual")),
    ("Form 10-Q\nQuarterly report for the third quarter; for the quarterly period ended October 29, 2023", "10-Q", None, None, ("2023", "Q3")), ("for the quarter ended April 30, 2023", "10-Q", None, 1, ("2024", "Q1")),
    ("nothing here", "10-Q", DAY, 1, ("2024", "Q3")), ("nothing here", "10-Q", DAY, None, ("2023", None)), (None, "10-Q", None, None, (None, None)), ("fiscal 2020", "8-K", DAY, 1, None), (None, None, None, None, None),
])
def test_period_in_document(spark, text, form, end, month, want):
    df = spark.createDataFrame([(text, form, end, month)], "t string, f string, e date, m int")
    got = df.select(periods.period_in_document(F.col("t"), F.col("f"), F.col("e"), F.col("m")).alias("p")).first()["p"]
    assert (tuple(got) if got else None) == want


def test_evidence_of_filings(spark):
    day = datetime.date
    rows = [("a", "T", "10-K", day(2023, 1, 29), day(2023, 3, 1)), ("b", "T", "10-Q", day(2023, 4, 30), day(2023, 5, 20)), ("c", "T", "10-K", day(2022, 1, 30), day(2022, 9, 1)), ("d", None, "10-K", day(2022, 1, 30), None), ("e", "T", "10-K/A", day(2022, 1, 30), None), ("f", "T", "10-K", None, None)]
    filings = spark.createDataFrame(rows, "filing_id string, company_ticker string, filing_type string, period_end_date date, filing_date date")
    texts = spark.createDataFrame([("b", 1, "Form 10-Q quarterly report, quarter first. For the Apr 30, 2023"), ("b", 2, None), ("a", 3, "Form 10-Q quarterly first for the April 30, 2023")], "filing_id string, text_id bigint, text string")
    got = {(r["key"], r["signal_id"], r["value"], r["confidence"]) for r in evidence.filing_signals(filings, texts).collect()}
    assert got == {("T|fiscal_year_end_month", "a", "1", 0.8), ("T|fiscal_year_end_day", "a", "29", 0.8), ("T|fiscal_year_end_month", "a|lag", "1", 0.6), ("T|fiscal_year_end_month", "c", "1", 0.8), ("T|fiscal_year_end_day", "c", "30", 0.8), ("T|quarter_mapping", "b|1", "4:Q1", 0.7)}


def test_child_pairs_need_one_statement(spark):
    rows = [("a:Assets", "B"), ("b:AssetsCurrent", "B"), ("a:AssetsSold", "I"), ("a:TotalAssets", "B"), ("a:RawInventory", "B"), ("a:Inventory", None), ("a:Other", "Unknown"), ("x:OtherThing", "Unknown"), (None, "B")]
    got = {(r["parent"], r["child"]) for r in hierarchy.child_of(spark.createDataFrame(rows, "concept string, statement string")).collect()}
    assert got == {("a:Assets", "b:AssetsCurrent"), ("a:TotalAssets", "b:AssetsCurrent"), ("a:Assets", "a:RawInventory"), ("a:TotalAssets", "a:RawInventory")}


def test_reference_tiers(spark):
    c = spark.createDataFrame([("id_1", "us-gaap:Cash"), ("own_Sales", "own:Sales"), ("x", "NetSales"), ("x", "us-gaap_Assets"), (None, None)], "concept_id string, name string")
    hrefs = {"s#us-gaap_Assets": ("us-gaap_Assets", 1), "s#us-gaap_Cash": ("us-gaap:Cash", 2), "#id_1": ("us-gaap:Cash", 3), "a_NetSales_b": ("NetSales", 4), "q_Cash_w": ("us-gaap:Cash", 5), "extraNetSales": ("NetSales", 6), "nothing": None, "": None, None: None}
    got = {r["href"]: (r["concept"], r["tier"]) for r in hierarchy.resolve_references(spark.createDataFrame([(h,) for h in hrefs], "href string"), c).collect()}
    assert got == {h: w for h, w in hrefs.items() if w}


def test_network_falls_back_on_patterns(spark):
    arcs = spark.createDataFrame([("r", "a", "b", 1.0, None)], "role string, parent string, child string, ord double, weight double")
    concepts = spark.createDataFrame([("g:Assets",), ("g:AssetsCurrent",)], "concept string")
    assert [(r["source"], r["weight"]) for r in hierarchy.network(arcs.limit(0), arcs, concepts).collect()] == [("calculation", 1.0)]
    assert [(r["parent"], r["child"], r["source"]) for r in hierarchy.network(arcs.limit(0), arcs.withColumn("role", F.lit("")), concepts).collect()] == [("g:Assets", "g:AssetsCurrent", "patterns")]


def test_section_texts(spark):
    long = "word " * 200
    html = {
        "two": "<h2>Item 2. Properties</h2><p>old</p><h3>Item 2.  Properties</h3><p>plants</p><h1>Next heading</h1><h2>Item 9A. Controls and Procedures</h2><p>fine</p><h2>ok</h2><p>more</p>",
        "bare": f"<p>ITEM 1. Business {long} ITEM 1A. Risk Factors short ITEM 1B</p>", "none": "<p>x</p>", "null": None,
    }
    got = documents.section_texts(spark.createDataFrame(list(html.items()), "filing_id string, html string"))
    rows = {(r["filing_id"], r["section_id"]): r["text"] for r in got.collect()}
    assert rows == {("two", "ITEM_2_PROPERTIES"): "plants", ("two", "ITEM_9A_CONTROLS"): "fine\n\nok\n\nmore", ("bare", "ITEM_1_BUSINESS"): long.strip()}


def test_main_content():
    page = "<document><html><body><div>a<body>b</body></div></body></html></document>tail"
    assert documents.main_content(page) == ("document", "<div>a<body>b</body></div>")
    assert documents.main_content("<p>x</p>") == ("whole", "<p>x</p>") and documents.main_content("<body>open")[1] == "open"
    assert documents.main_content("<body><div id=\"main-content\">a<div>b</div>c</div>d</body>") == ("main-content", "a<div>b</div>c")


def test_sources_by_name(spark, tmp_path):
    folder = tmp_path / "ACME" / "10-K" / "0001-23-000001"
    folder.mkdir(parents=True)
    (folder / "acme-20231231.htm").write_text("<p>x</p>")
    (folder / "index.htm").write_text("<p>y</p>")
    found = registry.get_source("direct")(spark, str(tmp_path), forms=["10-K"])
    assert [(r["ticker"], r["form"], r["year"]) for r in found.collect()] == [("ACME", "10-K", 2023)]
    with pytest.raises(ValueError, match="direct"):
        registry.get_source("absent")
    registry.register_source("mine", lambda spark: spark.range(1))
    assert registry.get_source("mine")(spark).count() == 1


def test_calendars(spark):
    ddl = "ticker string, period_end date, fiscal_year string, fiscal_period string"
    own = spark.createDataFrame([("A", DAY, "2024", "Q3")], ddl)
    others = spark.createDataFrame([("A", DAY, "1999", "Q1"), ("B", DAY, "2023", "Q4")], ddl)
    assert {(r["ticker"], r["fiscal_year"]) for r in catalogue.merged_calendars(own, others).collect()} == {("A", "2024"), ("B", "2023")}
    new = catalogue.added_calendar(others, "A", spark.createDataFrame([(DAY, "2024", "Q3")], "period_end date, fiscal_year string, fiscal_period string"))
    assert {(r["ticker"], r["fiscal_year"]) for r in new.collect()} == {("A", "2024"), ("B", "2023")}


def test_text_documents_are_written_in_order(spark, load, tmp_path):
    lines = catalogue.text_documents(load("filings"), load("sections"))
    path = str(tmp_path / "texts")
    catalogue.write_texts(lines, path)
    back = spark.read.text(path)
    assert back.select("filing_id").distinct().count() == lines.select("filing_id").distinct().count()
    one = lines.first()["filing_id"]
    text = "\n".join(r["value"] for r in spark.read.text(f"{path}/filing_id={one}").collect())
    want = [r["text"] for r in lines.where(F.col("filing_id") == one).orderBy("line_ord").collect()]
    assert text.split("\n") == "\n".join(want).split("\n") or len(text) >= sum(map(len, want))


def test_large_filing_in_a_few_partitions(spark):
    """One filing of 200,000 facts: numbering, reading back and statements do not gather it."""
    n = 200_000
    f = spark.range(n).select(
        F.col("id").alias("fact_id"), F.lit("f").alias("filing_id"), F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("contextref"), F.concat(F.lit("g:Asset"), (F.col("id") % 3000).cast("string")).alias("name"),
        F.col("id").alias("pos"), F.lit("usd").alias("unitref"), F.lit("0").alias("decimals"), F.col("id").cast("string").alias("value"))
    assert render.read_block_lines(render.block_lines(f), ["contextref", "prefix", "kind", "fact_id"]).where("contextref is not null").count() == n
    cells = statements.statement_cells(f)
    rows = statements.statement_rows(cells)
    assert rows.count() == 3000 and cells.count() == f.select("contextref", "name").distinct().count()


def test_checkpoint_folder_is_asked_for(spark, monkeypatch):
    from factloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
            session.checkpoint_folder(Session())


@pytest.mark.parametrize("run", [
    lambda e: statements.statement_rows(statements.statement_cells(e("facts"))), lambda e: totals.subtotals(totals.named_items(e("facts"))), lambda e: pipeline.processed(e("filings"), e("facts"), e("sections")),
    lambda e: pipeline.coverage(e("sections")), lambda e: pipeline.integrity(e("sections"), e("facts")), lambda e: render.filing_lines(e("filings"), e("contexts"), e("units"), e("facts"), e("sections")),
    lambda e: facts.with_codes(e("facts"), e("contexts")), lambda e: facts.primary_contexts(e("facts"), e("contexts")), lambda e: catalogue.text_documents(e("filings"), e("sections")),
])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0
