"""Operators on small frames: hierarchies, statements, markup, rendering, evidence, streams, catalogue."""

import math

import pytest
from pyspark.sql import functions as F

from factloom.operators import catalogue, evidence, facts, hierarchy, render, statements
from factloom.sources import markup
from factloom.streaming import events


def test_tree_cuts_depth_children_and_cycles(spark):
    arcs = [("r", f"c{i:02d}", float(i)) for i in range(12)] + [("c00", "d", 1.0), ("d", "e", 1.0), ("e", "f", 1.0), ("c01", "r", 1.0), ("c02", "c02", 1.0)]
    a = spark.createDataFrame(arcs, "parent string, child string, ord double")
    t = hierarchy.tree(a, spark.createDataFrame([("r",)], "concept string")).collect()
    assert sum(r["depth"] == 1 for r in t) == 10 and max(r["depth"] for r in t) == 3 and not any(r["concept"] == "f" for r in t)
    assert {(r["concept"], r["depth"]) for r in t if r["is_cycle"]} == {("r", 2), ("c02", 2)}
    assert [r["concept"] for r in sorted(t, key=lambda r: r["path_key"])][:4] == ["r", "c00", "d", "e"]


def test_levels_and_roots(spark):
    a = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "parent string, child string")
    tops = hierarchy.roots(a)
    assert {tuple(r) for r in hierarchy.levels(a, tops).collect()} == {("a", 0), ("b", 1), ("c", 1), ("d", 2)}


@pytest.mark.parametrize("assets,liabilities,equity,minority,want", [(100, 60, 40, 0, True), (100, 60, 39.95, 0, True), (100, 60, 39, 0, False), (100, 50, 40, 10, True), (100, 100, 40, 0, True), (0, 0, 0, 0, True), (-100, -60, -40, 0, False)])
def test_balance(spark, assets, liabilities, equity, minority, want):
    got = statements.balanced(*[F.lit(float(x)) for x in (assets, liabilities, equity, minority)])
    assert spark.range(1).select(got.alias("b")).first()["b"] is want


def test_missing_line_is_derived(spark):
    v = spark.createDataFrame([("f", c, x, i, i) for i, (c, x) in enumerate([("us-gaap:Assets", 100.0), ("us-gaap:StockholdersEquity", 40.0), ("us-gaap:LiabilitiesAndStockholdersEquity", 100.0)])], "f string, concept string, value double, pos int, fact_id int")
    row = statements.balance_sheets(v, ["f"]).first()
    assert row["liabilities"] is None and row["liabilities_full"] == 60.0
    assert statements.balance_sheets(v, ["f"], zero=True).first()["liabilities"] == 0.0


def test_unpivot_undoes_pivot(spark):
    rows = [("k1", "a", "1"), ("k1", "b", "2"), ("k2", "b", "3")]
    df = spark.createDataFrame(rows, "k string, c string, v string")
    wide = statements.pivoted(df, ["k"], "c", ["a", "b"], F.col("v"))
    assert {tuple(r) for r in statements.unpivoted(wide, ["k"], ["a", "b"], "c", "v").collect()} == set(rows)


def test_long_table(spark):
    t = "Line Item | c-1 | c-2\nAssets | 5 | -\nCash |  | 7"
    got = spark.createDataFrame([(t,)], "t string").select(F.inline(statements.long_table(F.col("t")))).collect()
    assert {(r["item"], r["column"], r["value"]) for r in got} == {("Assets", "c-1", "5"), ("Cash", "c-2", "7")}


HTML = """<html><head><title>Report</title><script>var x = 1;</script></head><body>
<ix:header><xbrli:context id="c-1"><xbrli:entity><xbrli:identifier>42</xbrli:identifier><xbrli:segment><xbrldi:explicitMember dimension="a:X">m:1</xbrldi:explicitMember></xbrli:segment></xbrli:entity>
<xbrli:period><xbrli:instant>2020-12-31</xbrli:instant></xbrli:period></xbrli:context><xbrli:unit id="u"><xbrli:divide><xbrli:measure>iso4217:USD</xbrli:measure><xbrli:measure>xbrli:shares</xbrli:measure></xbrli:divide></xbrli:unit></ix:header>
<p>Assets <ix:nonFraction name="us-gaap:Assets" contextRef="c-1" unitRef="u" decimals="-6" scale="6">1,2<b>34</b></ix:nonFraction> and <us-gaap:cash contextref="c-1">5</us-gaap:cash>
<ix:nonNumeric name="dei:Name" contextRef="c-1">A &amp; B</ix:nonNumeric></p><table><tr><td>Sales</td><td>77</td></tr></table>"""


def test_scans(spark):
    d = spark.createDataFrame([("f", HTML), ("g", None), ("h", "<p>no tags"), ("i", "")], "filing_id string, html string")
    f = {r["name"]: r for r in markup.scan_facts(d).collect()}
    assert f["us-gaap:Assets"]["value"] == "1,234" and f["us-gaap:Assets"]["scale"] == "6" and f["dei:Name"]["value"] == "A & B" and f["us-gaap:cash"]["value"] == "5"
    assert markup.scan_facts(d, "ix").count() == 2 and markup.scan_all_facts(d).count() == 6 and markup.scan_facts(d, "prefixed").count() == 1
    c = markup.scan_contexts(d).first()
    assert (c["context_id"], c["instant"], c["identifier"], c["segment"]) == ("c-1", "2020-12-31", "42", {"a:X": "m:1"})
    assert markup.scan_units(d).first()["measure"] == "iso4217:USD/xbrli:shares"
    assert markup.table_facts(d).first()["name"] == "Table1_Sales"
    texts = {r["filing_id"]: r for r in markup.document_texts(d).collect()}
    assert texts["f"]["title"] == "Report" and "var x" not in texts["f"]["text"] and "Sales" in texts["f"]["text"]


def test_content_guards():
    table = '<table style="x" width="5"><tr><td class="a">Revenue 1,200</td> <td>3.5</td></tr></table>'
    lean = markup.lean_table(table)
    assert len(lean) < len(table) and "1,200" in lean and "style" not in lean
    assert markup.safe_text("<div><p>Total 5</p></div>") == "Total 5"
    hidden = "<p>1</p><script>2</script>"
    assert markup.safe_text(hidden) == markup.lean_table(hidden)


LINKS = """<link:linkbase><link:presentationLink xlink:role="http://r/balance"><link:loc xlink:label="a" xlink:href="s.xsd#us-gaap_Assets"/><link:loc xlink:label="b" xlink:href="s.xsd#us-gaap_AssetsCurrent"/>
<link:presentationArc xlink:from="a" xlink:to="b" order="2"/><link:presentationArc xlink:from="a" xlink:to="b" order="9"/><link:presentationArc xlink:from="a" xlink:to="lost" order="1"/></link:presentationLink>
<link:labelLink><link:loc xlink:label="l" xlink:href="s.xsd#us-gaap_Assets"/><link:label xlink:label="t" xlink:role="std">Old</link:label><link:label xlink:label="t" xlink:role="std">Assets, total</link:label><link:labelArc xlink:from="l" xlink:to="t"/></link:labelLink></link:linkbase>"""


def test_links(spark):
    links = markup.scan_links(spark.createDataFrame([("f", LINKS)], "filing_id string, html string"))
    arcs = markup.concept_arcs(links, "presentation").collect()
    assert [(r["parent"], r["child"], r["ord"], r["role"]) for r in arcs] == [("us-gaap:Assets", "us-gaap:AssetsCurrent", 2.0, "http://r/balance")]
    assert markup.concept_labels(links).first()["text"] == "Assets, total"


def test_rendered_facts_are_read_back(load):
    f = load("facts")
    texts = render.documents(render.fact_lines(f))
    assert render.read_fact_lines(texts.withColumn("text", F.replace("text", F.lit("|@"), F.lit(" | @")))).count() == f.count()


def test_deduplicated_blocks(spark):
    d = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k int, t string")
    assert {(r["k"], r["is_reference"], r["first_key"]) for r in render.deduplicated_blocks(d, "k", "t").collect()} == {(1, False, 1), (2, True, 1), (3, False, 3)}


def test_splice(spark):
    row = spark.createDataFrame([("x\n@SECTION: ITEM_8\ny",), ("a",), ("@STATEMENTS",), ("d\n@END_DICTIONARY\ne",)], "t string")
    got = [r[0] for r in row.select(render.spliced(F.col("t"), F.lit("@STATEMENTS $1"))).collect()]
    assert got == ["x\n@STATEMENTS $1\n@SECTION: ITEM_8\ny", "a\n@STATEMENTS $1", "@STATEMENTS", "d\n@END_DICTIONARY\n@STATEMENTS $1\ne"]


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "c", 0), (2, "d", 5), (3, "e", 1)], "k int, v string, t int")
    assert {tuple(r) for r in catalogue.upsert(base, new, ["k"], "t").collect()} == {(1, "a", 1), (2, "d", 5), (3, "e", 1)}


def test_layout_and_new_rows(spark, load, tmp_path):
    f = load("filings").where("fiscal_period is not null")
    path = str(tmp_path / "layout")
    catalogue.write_layout(f, path)
    catalogue.write_layout(f, path)
    assert spark.read.parquet(path).count() == f.count()
    assert catalogue.write_new(f, f, ["filing_id"], str(tmp_path / "new")).count() == 0


def _brute_fold(signals):
    out = {}
    for key, _, _, value, confidence in sorted(signals, key=lambda s: (s[0], s[1], s[2])):
        out.setdefault(key, []).append((value, confidence))
    result = {}
    for key, seen in out.items():
        value, best = None, 0.0
        for i, (v, c) in enumerate(seen, 1):
            if c > best:
                value, best = v, c
                continue
            best = max(best, sum(x for _, x in seen[:i]) / i)
            names = [x for x, _ in seen[:i]]
            common = max(dict.fromkeys(names), key=names.count)
            if i >= 2 and names.count(common) > 0.7 * i:
                value, best = common, min(best * 1.2, 1.0)
        result[key] = (value, best, len(seen))
    return result


def test_fold_batch_and_stream_agree(spark, data, load):
    signals = events.event_signals(load("events"))
    want = _brute_fold([(r["key"], r["ts"], r["signal_id"], r["value"], r["confidence"]) for r in signals.collect()])
    batch = {r["key"]: (r["value"], r["confidence"], r["n"]) for r in evidence.fold(signals).collect()}
    stream = {r["key"]: (r["value"], r["confidence"], r["n"]) for r in events.folded_stream(spark, f"{data}/events.parquet").collect()}
    assert set(want) == set(batch) == set(stream)
    for k, (v, c, n) in want.items():
        for got in (batch[k], stream[k]):
            assert got[0] == v and got[2] == n and math.isclose(got[1], c, rel_tol=1e-9)


def test_codes_and_joins_keep_rows(load):
    f, c = load("facts"), load("contexts")
    assert facts.with_context(f, c).count() == f.count()
    codes = facts.context_codes(c)
    assert codes.count() == facts.unique_contexts(c).count() == codes.select("filing_id", "code").distinct().count()


@pytest.mark.parametrize("run", [
    lambda e: facts.with_context(e("facts"), e("contexts")), lambda e: facts.dated(e("facts"), e("contexts")), lambda e: facts.context_codes(e("contexts")), lambda e: facts.period_codes(e("contexts")),
    lambda e: facts.modal_decimals(e("facts")), lambda e: statements.organised(e("facts")), lambda e: statements.primary_statements(e("facts")), lambda e: render.fact_lines(e("facts")),
    lambda e: render.document_lines(e("filings"), e("contexts"), e("units"), e("facts")), lambda e: render.consolidated_contexts(e("facts")), lambda e: render.deduplicated_blocks(e("documents"), "doc_id", "text"),
    lambda e: evidence.fold(evidence.filing_signals(e("filings"))), lambda e: markup.scan_facts(e("documents").selectExpr("cast(doc_id as string) filing_id", "text html")),
])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_grouped_lines_keep_every_fact(spark):
    rows = [("f", 1, "c1", "us-gaap:Assets", "5"), ("f", 2, "c1", "us-gaap_Assets", "6"), ("f", 3, "c2", "dei_Name", "x"), ("f", 4, None, "us-gaap:Cash", "7"), ("f", 5, "c2", None, "8"), ("f", 6, "c2", "@PLAIN", None), ("f", 7, "c2", "a:b:c", "9")]
    df = spark.createDataFrame(rows, "filing_id string, fact_id bigint, contextref string, name string, value string")
    got = render.read_block_lines(render.block_lines(df), ["contextref", "prefix", "kind", "fact_id"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((f, c, n, v or "")) for f, _, c, n, v in rows)


def test_whole_tree_has_all_children_and_depths(spark):
    arcs = [("r", f"c{i}", float(i)) for i in range(12)] + [(f"d{i}" if i else "c11", f"d{i + 1}", 0.0) for i in range(6)] + [("d6", "c11", 0.0)]
    df, tops = spark.createDataFrame(arcs, "parent string, child string, ord double"), spark.createDataFrame([("r",)], "concept string")
    got = {(r["concept"], r["depth"], r["is_cycle"]) for r in hierarchy.whole_tree(df, tops).collect()}
    assert got == {("r", 0, False), *((f"c{i}", 1, False) for i in range(12)), *((f"d{i}", i + 1, False) for i in range(1, 7)), ("c11", 8, True)}


def test_sections_by_the_whole_lists(spark):
    from factloom.operators import headings

    assert len(headings.DOCUMENT) == 33 and len(headings.SUBSECTIONS) == 11 and [len(v) - 11 for v in headings.BY_TYPE.values()] == [20, 15, 4]
    text = "Item 2. Properties\nplants\nITEM 9A. Controls and Procedures\nfine\nNotes to Consolidated Financial Statements\n" + "They discuss liquidity and capital resources and more. " * 4
    df = spark.createDataFrame([("k", text, " form 10k "), ("q", text, "10-Q"), ("a", text, "10-K/A"), ("n", text, None)], "filing_id string, text string, filing_type string")
    ids = lambda got: {k: [r["section_id"] for r in got.where(F.col("filing_id") == k).orderBy("start").collect()] for k in "kqan"}
    assert set(map(tuple, ids(render.sections_of(df, headings.DOCUMENT)).values())) == {("ITEM_2_PROPERTIES", "ITEM_9A_CONTROLS", "NOTES_TO_FINANCIAL_STATEMENTS")}
    got = ids(render.sections_of(df, headings.BY_TYPE, None))
    assert got["k"] == ["ITEM_2_PROPERTIES", "ITEM_9A_CONTROLS", "LIQUIDITY_AND_CAPITAL"]
    assert got["q"] == ["CONTROLS_AND_PROCEDURES", "NOTES_TO_FINANCIAL_STATEMENTS", "LIQUIDITY_AND_CAPITAL"]
    assert got["a"] == got["n"] == ["CONTROLS_AND_PROCEDURES", "FINANCIAL_STATEMENTS", "LIQUIDITY_AND_CAPITAL"]
