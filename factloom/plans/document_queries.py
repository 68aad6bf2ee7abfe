"""Queries over references, labels, guarded tables, read-back statements and whole pipelines, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.text import readable_concept
from factloom.operators import hierarchy, render, statements
from factloom.plans.fact_queries import _RANK, _section, _statement
from factloom.plans.graph_queries import _ARCS, _geo
from factloom.session import small, table
from factloom.sources import documents, markup

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def _as_pages(df, key: str, html):
    return df.select(F.col(key).cast("string").alias("filing_id"), html.alias("html"))


def _link_file(spark, d, kind: str):
    """One relationship file per region: its nations below it, with weights, orders and labels."""
    g = _geo(spark, d).where(~F.col("child").rlike(r"^S\d+$"))
    loc = lambda c: F.concat(F.lit('<link:loc xlink:label="l_'), c, F.lit('" xlink:href="schema.xsd#geo_'), c, F.lit('"/>'))
    arc = F.concat(F.lit(f'<link:{kind}Arc xlink:arcrole="http://arc/{kind}" xlink:from="l_'), "parent", F.lit('" xlink:to="l_'), "child", F.lit('" order="'), F.col("ord").cast("string"), F.lit('" weight="-1.0"/>'))
    body = F.array_join(F.array_sort(F.collect_list(F.concat(loc(F.col("parent")), loc(F.col("child")), arc))), "")
    return g.groupBy(F.col("parent").alias("filing_id")).agg(F.concat(F.lit(f'<link:{kind}Link xlink:role="http://role/geo">'), body, F.lit(f"</link:{kind}Link>")).alias("html"))


_ARC_SQL = "select r_name as filing_id, 'geo:' || r_name as parent, 'geo:' || n_name as child, {extra} from nation join region on n_regionkey = r_regionkey"


@query("op_s14_s23_h24_calculation_arcs", _ARC_SQL.replace("{extra}", "-1.0::double as weight"))
def s23(spark, d):
    return markup.concept_arcs(markup.scan_links(_link_file(spark, d, "calculation")), "calculation").select("filing_id", "parent", "child", "weight")


@query("op_s20_s24_h25_definition_arcs", _ARC_SQL.replace("{extra}", "'http://arc/definition' as arcrole"))
def s24(spark, d):
    return markup.concept_arcs(markup.scan_links(_link_file(spark, d, "definition")), "definition").select("filing_id", "parent", "child", "arcrole")


# A role for each region, whose words tell the statement.
_ROLES = {"AFRICA": "BalanceSheet", "AMERICA": "StatementsOfOperations", "ASIA": "CashFlow", "EUROPE": "StockholdersEquity"}
_ROLE_STATEMENTS = {"AFRICA": "Balance_Sheet", "AMERICA": "Income_Statement", "ASIA": "Cash_Flow_Statement", "EUROPE": "Statement_Of_Equity"}


def _case(values: dict[str, str], default: str) -> str:
    return "case r_name " + " ".join(f"when '{k}' then '{v}'" for k, v in values.items()) + f" else '{default}' end"


@query("op_s21_h23_presentation_by_role", f"select 'http://role/' || {_case(_ROLES, 'geo')} as role, {_case(_ROLE_STATEMENTS, 'Unknown')} as statement, 'geo:' || r_name as parent, 'geo:' || n_name as child from nation join region on n_regionkey = r_regionkey")
def h23(spark, d):
    from factloom.functions.classify import statement_of_role

    named = F.coalesce(*[F.when(F.col("filing_id") == k, v) for k, v in _ROLES.items()], F.lit("geo"))
    files = _link_file(spark, d, "presentation").select("filing_id", F.replace("html", F.lit("http://role/geo"), F.concat(F.lit("http://role/"), named)).alias("html"))
    arcs = markup.concept_arcs(markup.scan_links(files), "presentation")
    return arcs.select("role", statement_of_role(F.col("role")).alias("statement"), "parent", "child")


@query("op_s8_s25_labels", "select name as concept, 'http://role/label' as label_role, 'Label of ' || name as text from concepts")
def s25(spark, d):
    c = table(spark, d, "concepts")
    xml = F.concat(F.lit('<link:labelLink xlink:role="x"><link:loc xlink:label="l" xlink:href="s.xsd#'), "concept_id", F.lit('"/><link:label xlink:label="t" xlink:role="http://role/label">Old</link:label><link:label xlink:label="t" xlink:role="http://role/label">Label of '), "name", F.lit('</link:label><link:labelArc xlink:from="l" xlink:to="t"/></link:labelLink>'))
    return markup.concept_labels(markup.scan_links(_as_pages(c, "concept_id", xml))).select("concept", "label_role", "text")


@query("op_s18_s19_references", "select concept_id as filing_id, 'schema' as kind, name || '.xsd' as href from concepts union all select concept_id, 'calculation', name || '_cal.xml' from concepts")
def s18(spark, d):
    xml = F.concat(F.lit('<link:schemaRef xlink:href="'), "name", F.lit('.xsd"/><link:linkbaseRef xlink:role="http://x/calculationLinkbaseRef" xlink:href="'), "name", F.lit('_cal.xml"/>'))
    return markup.references(_as_pages(table(spark, d, "concepts"), "concept_id", xml)).select("filing_id", "kind", "href")


@query("op_s43_table_facts", "select cast(l_orderkey as varchar) as filing_id, count(*) as n, sum(cast(l_quantity as bigint)) as total from lineitem group by 1")
def s43(spark, d):
    row = F.concat(F.lit("<tr><td>Quantity "), F.col("l_linenumber").cast("string"), F.lit("</td><td>"), F.col("l_quantity").cast("bigint").cast("string"), F.lit("</td></tr>"))
    pages = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("<table>"), F.array_join(F.collect_list(row), ""), F.lit("</table>")).alias("html"))
    facts = markup.table_facts(_as_pages(pages, "l_orderkey", F.col("html")))
    return facts.groupBy("filing_id").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("bigint")).alias("total"))


_AMOUNT = "cast(cast(l_extendedprice as decimal(12,2)) as varchar)"


@query("op_n4_n5_guarded_markup", f"""select l_orderkey, '<table>' || string_agg('<tr><td>' || {_AMOUNT} || '</td><td>' || cast(l_quantity as bigint) || '</td></tr>', '' order by l_linenumber, l_partkey, l_suppkey) || '</table>' as lean,
  string_agg({_AMOUNT} || ' ' || cast(l_quantity as bigint), ' ' order by l_linenumber, l_partkey, l_suppkey) as plain from lineitem group by 1""")
def n4(spark, d):
    amount, quantity = F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.col("l_quantity").cast("bigint").cast("string")
    row = F.concat(F.lit('<tr style="color: red"><td class="x" width="50">'), amount, F.lit("</td> <td>"), quantity, F.lit("</td></tr>"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("row")))), lambda r: r["row"])
    pages = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit('<table border="1">'), F.array_join(rows, ""), F.lit("</table>")).alias("html"))
    pages = pages.select(F.col("l_orderkey").cast("string").alias("filing_id"), "html")
    lean = markup._rows_udtf(pages, "filing_id", "html", "filing_id string, lean string, plain string", lambda k, h: [(k, markup.lean_table(h), markup.safe_text(h))])
    return lean.select(F.col("filing_id").cast("bigint").alias("l_orderkey"), "lean", F.trim(F.regexp_replace("plain", r"\s+", " ")).alias("plain"))


@query("op_n10_long_tables", """select l_orderkey, 'l' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as item, m.m as column, case m.m when 'quantity' then cast(cast(l_quantity as bigint) as varchar) else cast(cast(l_tax * 100 as bigint) as varchar) end as value
  from lineitem, (select unnest(['quantity', 'tax']) as m) m""")
def n10(spark, d):
    li = table(spark, d, "lineitem")
    item = F.concat(F.lit("l"), F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_partkey").cast("string"), F.lit("."), F.col("l_suppkey").cast("string"))
    line = F.concat_ws(" | ", item, F.col("l_quantity").cast("bigint").cast("string"), F.rint(F.col("l_tax") * 100).cast("bigint").cast("string"), F.lit("-"))
    wide = li.groupBy("l_orderkey").agg(F.concat(F.lit("Line Item | quantity | tax | none\n"), F.array_join(F.collect_list(line), "\n")).alias("t"))
    return wide.select("l_orderkey", F.inline(statements.long_table(F.col("t")))).select("l_orderkey", "item", "column", "value")


@query("op_n16_spliced", """select section_key, length(case when contains(doc, '@STATEMENTS') then doc when contains(doc, '@END_DICTIONARY') then replace(doc, '@END_DICTIONARY', '@END_DICTIONARY' || chr(10) || '@STATEMENTS x')
   when contains(doc, '@SECTION: ITEM_8') then left(doc, instr(doc, '@SECTION: ITEM_8') - 1) || '@STATEMENTS x' || chr(10) || substr(doc, instr(doc, '@SECTION: ITEM_8')) else '@STATEMENTS x' || chr(10) || doc end) as n
  from (select section_key, '@SECTION: ' || section_id || chr(10) || coalesce(text_content, '') as doc from sections)""")
def n16(spark, d):
    s = table(spark, d, "sections")
    doc = F.concat(F.lit("@SECTION: "), "section_id", F.lit("\n"), F.coalesce("text_content", F.lit("")))
    return s.select("section_key", F.length(render.spliced(doc, F.lit("@STATEMENTS x"))).cast("bigint").alias("n"))


@query("op_t13_metadata", "select filing_id, trim(company_name) as company, cik, trim(filing_type) as form, strftime(period_end_date, '%Y%m%d') as period from filings where period_end_date is not null and company_name is not null and cik is not null and filing_type is not null")
def t13(spark, d):
    f = table(spark, d, "filings").where("period_end_date is not null and company_name is not null and cik is not null and filing_type is not null")
    text = F.concat(F.lit("COMPANY CONFORMED NAME: "), "company_name", F.lit("\nCENTRAL INDEX KEY: "), "cik", F.lit("\nCONFORMED SUBMISSION TYPE: "), "filing_type", F.lit("\nCONFORMED PERIOD OF REPORT: "), F.date_format("period_end_date", "yyyyMMdd"))
    return f.select("filing_id", documents.metadata(text).alias("m")).select("filing_id", "m.*")


@query("op_t15_table_of_contents", "select cast(p_partkey as varchar) as filing_id, 1 as pos, p_name || ' ' || p_size as entry from part")
def t15(spark, d):
    html = F.concat(F.lit("<table><tr><td>no</td></tr></table><p>TABLE OF CONTENTS</p><table><tr><td>"), "p_name", F.lit("</td><td> "), F.col("p_size").cast("string"), F.lit("</td></tr></table>"))
    return documents.table_of_contents(_as_pages(table(spark, d, "part"), "p_partkey", html))


_SHEET = """select r_name as filing_id, 'c-1' as context, '2020-12-31' as day, sum(cast(c_acctbal as decimal(12,2)))::double as assets, sum(cast(c_acctbal as decimal(12,2)))::double as total, true as balanced
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1"""


@query("op_s41_t25_read_back_balances", _SHEET)
def s41(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    total = j.groupBy(F.col("r_name").alias("filing_id")).agg(F.sum(F.col("c_acctbal").cast("decimal(12,2)")).cast("double").alias("v"))
    lines = F.array(*[F.struct(F.lit(x).alias("line"), v.alias("value")) for x, v in (("Assets", F.col("v")), ("Liabilities", F.col("v")), ("StockholdersEquity", F.lit(0.0)))])
    sheets = total.select("filing_id", F.lit("c-1").alias("context"), F.lit("2020-12-31").alias("day"), F.inline(lines))
    return documents.verified_balances(documents.balance_text(sheets))


@query("op_s10_s11_untagged_instances", "select cast(o_orderkey as varchar) as filing_id, 'AsOf_' || strftime(o_orderdate, '%Y-%m-%d') as contextref, 'parent' as provenance, o_orderstatus as value from orders")
def s10(spark, d):
    xml = F.concat(F.lit("<root><d"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("><status>"), "o_orderstatus", F.lit("</status></d"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("></root>"))
    return documents.untagged_instance(_as_pages(table(spark, d, "orders"), "o_orderkey", xml), "1970-01-01").select("filing_id", "contextref", "provenance", "value")


@query("op_s12_any_text", "select cast(n_nationkey as varchar) as filing_id, n_name as value, true as fallback from nation")
def s12(spark, d):
    html = F.concat(F.lit("<html><body><p>"), "n_name", F.lit("</p></body></html>"))
    return documents.any_text_facts(_as_pages(table(spark, d, "nation"), "n_nationkey", html)).select("filing_id", "value", "fallback")


_TOPS = f"""{_ARCS}, tops as (select distinct parent as concept from arcs where parent not in (select child from arcs)),
   one as (select distinct child as concept from arcs where parent in (select concept from tops)), two as (select distinct child as concept from arcs where parent in (select concept from one)),
   lv as (select concept, min(level) as level from (select concept, 0 as level from tops union all select concept, 1 from one union all select concept, 2 from two) group by 1)"""


@query("op_j6_h21_annotated_facts", f"""with {_TOPS}, up as (select child as concept, arg_min(parent, (ord, parent)) as parent from arcs group by 1)
  select f.fact_id, f.name, coalesce(lv.level, -1) as level, up.parent, array_to_string(list_transform(string_split(regexp_replace(list_extract(string_split(f.name, ':'), -1), '([a-z])([A-Z])', '\\1 \\2', 'g'), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as label
  from facts f left join lv on lv.concept = f.name left join up on up.concept = f.name""")
def j6(spark, d):
    arcs = hierarchy.pattern_arcs(spark, table(spark, d, "concepts").select(F.col("name").alias("concept")))
    level = small(hierarchy.levels(arcs, hierarchy.roots(arcs)))
    parent = small(arcs.groupBy(F.col("child").alias("name")).agg(F.min_by("parent", F.struct("ord", "parent")).alias("parent")))
    f = table(spark, d, "facts").select("fact_id", "name").join(level.withColumnRenamed("concept", "name"), "name", "left").join(parent, "name", "left")
    return f.select("fact_id", "name", F.coalesce("level", F.lit(-1)).alias("level"), "parent", readable_concept(F.col("name")).alias("label"))


@query("op_t19_t22_alternate_document", f"""with recursive {_TOPS}, kept as (select parent, child, n from (select *, row_number() over (partition by parent order by ord, child) as n from arcs) where n <= 10),
   t as (select concept as root, concept, 0 as depth, [concept] as path, concept as path_key, false as is_cycle from tops union all
    select root, child, depth + 1, list_append(path, child), path_key || '/' || lpad(cast(n as varchar), 4, '0'), list_contains(path, child) from t join kept on t.concept = kept.parent where depth < 3 and not is_cycle)
  select 'structure' as part, path_key as ord, repeat('  ', depth) || concept || case when is_cycle then ' (cycle)' else '' end as text from t
  union all select 'calculation', parent, parent || ' = ' || string_agg('+ ' || child, ' ' order by ord, child) from arcs group by parent
  union all select 'facts', filing_id || '|' || contextref || '|' || fact_id, name || ' = ' || coalesce(value, '') from facts where filing_id is not null and contextref is not null and name is not null""")
def t19(spark, d):
    concepts = table(spark, d, "concepts").select(F.col("name").alias("concept"))
    arcs = hierarchy.pattern_arcs(spark, concepts)
    tree = hierarchy.tree(arcs, hierarchy.roots(arcs))
    structure = tree.select(F.lit("structure").alias("part"), F.col("path_key").alias("ord"), F.concat(F.repeat(F.lit("  "), F.col("depth")), "concept", F.when(F.col("is_cycle"), " (cycle)").otherwise("")).alias("text"))
    sums = hierarchy.equations(arcs.withColumn("weight", F.lit(1.0))).select(F.lit("calculation").alias("part"), F.col("parent").alias("ord"), F.col("equation").alias("text"))
    f = table(spark, d, "facts").where("filing_id is not null and contextref is not null and name is not null")
    told = f.select(F.lit("facts").alias("part"), F.concat_ws("|", "filing_id", "contextref", F.col("fact_id").cast("string")).alias("ord"), F.concat("name", F.lit(" = "), F.coalesce("value", F.lit(""))).alias("text"))
    return structure.unionByName(sums).unionByName(told)


@query("op_c3_t7_pipeline", f"""with n as (select filing_id, contextref, {_statement('name')} as statement, count(*) as n from facts group by all),
   p as (select filing_id, contextref, statement from (select *, row_number() over (partition by filing_id, contextref order by n desc, {_RANK}) as rn from n where statement <> 'OTHER') where rn = 1),
   s as (select f.*, case when {_statement('f.name')} = 'OTHER' then coalesce(p.statement, 'OTHER') else {_statement('f.name')} end as statement from facts f left join p using (filing_id, contextref))
  select filing_id, name, contextref, statement, {_section('name', 'statement')} as section, count(*) as n from s group by all""")
def c3(spark, d):
    """Facts to markup, back by the scan, organised into statements: no fact is lost or changed on the way."""
    from factloom.plans.graph_queries import _html

    organised = statements.organised(markup.scan_facts(_html(spark, d)))
    return organised.groupBy("filing_id", "name", "contextref", "statement", "section").agg(F.count("*").alias("n"))


@query("op_x3_learned_formats", "select company_ticker, max_by(format, (n, format)) as format, sum(n) as seen from (select company_ticker, format, count(*) as n from facts where format is not null group by all) group by 1")
def x3(spark, d):
    n = table(spark, d, "facts").where("format is not null").groupBy("company_ticker", "format").agg(F.count("*").alias("n"))
    return n.groupBy("company_ticker").agg(F.max_by("format", F.struct("n", "format")).alias("format"), F.sum("n").alias("seen"))
