"""Queries over hierarchies, markup, rendered documents and evidence, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.text import TAG_SHORT
from factloom.operators import evidence, headings, hierarchy, render
from factloom.operators.catalogue import partition_paths
from factloom.operators.facts import unique_contexts
from factloom.sources import markup
from factloom.streaming import events as streams
from factloom.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


_PATTERNS = "(values " + ", ".join(f"('{p}', '{c}', {i}, {j})" for i, (p, cs) in enumerate(hierarchy.PATTERNS.items()) for j, c in enumerate(cs)) + ") as t(pe, ce, p, c)"
_ARCS = f"""names as (select distinct name as concept, list_extract(string_split(name, ':'), -1) as local from concepts),
  arcs as (select a.concept as parent, b.concept as child, row_number() over (partition by a.concept order by p, c, b.concept) - 1 as ord
   from {_PATTERNS} join names a on suffix(a.local, pe) join names b on suffix(b.local, ce) where a.concept <> b.concept)"""


def _arcs(spark, d):
    return hierarchy.pattern_arcs(spark, table(spark, d, "concepts").select(F.col("name").alias("concept")))


@query("op_h4_h20_pattern_arcs", f"with {_ARCS} select parent, child, ord from arcs")
def h4(spark, d):
    return _arcs(spark, d)


@query("op_u1_u2_roots", f"with {_ARCS} select distinct parent as concept from arcs where parent not in (select child from arcs)")
def u1(spark, d):
    return hierarchy.roots(_arcs(spark, d))


@query("op_h6_h7_levels", f"""with {_ARCS}, tops as (select distinct parent as concept from arcs where parent not in (select child from arcs)),
   one as (select distinct child as concept from arcs where parent in (select concept from tops)), two as (select distinct child as concept from arcs where parent in (select concept from one))
  select concept, min(level) as level from (select concept, 0 as level from tops union all select concept, 1 from one union all select concept, 2 from two) group by 1""")
def h7(spark, d):
    arcs = _arcs(spark, d)
    return hierarchy.levels(arcs, hierarchy.roots(arcs))


_GEO = """arcs as (select r_name as parent, n_name as child, cast(n_nationkey as double) as ord from nation join region on n_regionkey = r_regionkey union all
   select n_name, 'S' || s_suppkey, cast(s_suppkey as double) from supplier join nation on s_nationkey = n_nationkey)"""


def _geo(spark, d):
    n, r, s = (table(spark, d, t) for t in ("nation", "region", "supplier"))
    up = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"), F.col("n_nationkey").cast("double").alias("ord"))
    low = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("parent"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("child"), F.col("s_suppkey").cast("double").alias("ord"))
    return up.unionByName(low)


@query("op_h8_h9_h10_tree", f"""with recursive {_GEO}, kept as (select parent, child, n from (select *, row_number() over (partition by parent order by ord, child) as n from arcs) where n <= 10),
   t as (select r_name as root, r_name as concept, 0 as depth, [r_name] as path, r_name as path_key, false as is_cycle from region union all
    select root, child, depth + 1, list_append(path, child), path_key || '/' || lpad(cast(n as varchar), 4, '0'), list_contains(path, child) from t join kept on t.concept = kept.parent where depth < 3 and not is_cycle)
  select root, concept, depth, path_key, is_cycle from t""")
def h8(spark, d):
    tops = table(spark, d, "region").select(F.col("r_name").alias("concept"))
    return hierarchy.tree(_geo(spark, d), tops).drop("path")


@query("op_h9_h10_whole_tree", f"""with recursive {_GEO}, kept as (select parent, child, row_number() over (partition by parent order by ord, child) as n from arcs),
   t as (select r_name as root, r_name as concept, 0 as depth, [r_name] as path, r_name as path_key, false as is_cycle from region union all
    select root, child, depth + 1, list_append(path, child), path_key || '/' || lpad(cast(n as varchar), 10, '0'), list_contains(path, child) from t join kept on t.concept = kept.parent where not is_cycle)
  select root, concept, depth, path_key, is_cycle from t""")
def h9(spark, d):
    tops = table(spark, d, "region").select(F.col("r_name").alias("concept"))
    return hierarchy.whole_tree(_geo(spark, d), tops).drop("path")


@query("op_h2_h3_h12_h13_adjacency", f"with {_GEO} select parent, count(*) as n, string_agg(child, ',' order by ord, child) as children from arcs group by 1")
def h13(spark, d):
    kids = F.transform(F.array_sort(F.collect_list(F.struct("ord", "child"))), lambda s: s["child"])
    return _geo(spark, d).groupBy("parent").agg(F.count("*").alias("n"), F.array_join(kids, ",").alias("children"))


@query("op_h22_equations", f"""with {_GEO} select parent, parent || ' = ' || string_agg((case when ord % 2 = 1 then '- ' else '+ ' end) || child, ' ' order by ord, child) as equation from arcs group by 1""")
def h22(spark, d):
    return hierarchy.equations(_geo(spark, d).withColumn("weight", F.when(F.col("ord") % 2 == 1, -1.0).otherwise(1.0)))


@query("op_h22_calculation_check", """with v as (select n_nationkey, sum(cast(c_acctbal as decimal(12,2))) as b, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1),
   r as (select n_regionkey, sum(cast(c_acctbal as decimal(12,2))) as total from customer join nation on c_nationkey = n_nationkey group by 1)
  select r_name as parent, r.total as value, sum(v.b) as summed, count(*) as n_children, abs(r.total - sum(v.b)) <= 0.001 * greatest(abs(r.total), abs(sum(v.b))) as agrees from r join region on r_regionkey = n_regionkey join nation on nation.n_regionkey = r.n_regionkey join v on v.n_nationkey = nation.n_nationkey group by 1, 2""")
def h22b(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).withColumn("b", F.col("c_acctbal").cast("decimal(12,2)"))
    by = lambda key: j.groupBy(F.col(key).alias("concept")).agg(F.sum("b").alias("value"))
    values = by("n_name").unionByName(by("r_name")).withColumn("k", F.lit(1))
    arcs = _geo(spark, d).where(~F.col("child").rlike(r"^S\d+$")).withColumn("weight", F.lit(1).cast("decimal(2,0)"))
    out = hierarchy.calculation_check(values, arcs, ["k"])
    return out.select("parent", "value", F.col("summed").cast("decimal(30,2)").alias("summed"), "n_children", "agrees")


def _html(spark, d):
    """The facts of every filing as an inline-tagged document."""
    escape = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    attribute = lambda a, c: F.coalesce(F.concat(F.lit(f' {a}="'), escape(F.col(c)), F.lit('"')), F.lit(""))
    attributes = [attribute(a, c) for a, c in (("name", "name"), ("contextRef", "contextref"), ("unitRef", "unitref"), ("decimals", "decimals"), ("scale", "scale"), ("format", "format"))]
    element = F.concat(F.lit("<ix:nonFraction"), *attributes, F.lit(">"), escape(F.coalesce("value", F.lit(""))), F.lit("</ix:nonFraction>"))
    f = table(spark, d, "facts").groupBy("filing_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fact_id", element.alias("e")))), lambda s: s["e"]), "\n").alias("body"))
    return f.select("filing_id", F.concat(F.lit("<html><body>\n"), "body", F.lit("\n</body></html>")).alias("html"))


_SCANNED = """select filing_id, row_number() over (partition by filing_id order by fact_id) as pos, name, contextref, unitref, decimals, scale, format, trim(coalesce(value, ''), ' ' || chr(9) || chr(10) || chr(13) || chr(160)) as value from facts"""


@query("op_s2_s4_s6_scanned_facts", _SCANNED)
def s2(spark, d):
    return markup.scan_facts(_html(spark, d)).drop("element")


@query("op_s3_s42_scanned_ix_facts", _SCANNED)
def s3(spark, d):
    return markup.scan_facts(_html(spark, d), "ix_star").drop("element")


@query("op_s7_scanned_tag_names", _SCANNED.replace("name, contextref", "'ix:nonfraction' as name, contextref"))
def s7(spark, d):
    return markup.scan_facts(_html(spark, d), name_from="tag").drop("element")


@query("op_s9_scan_union", "select filing_id, name, contextref, unitref, value, 2 * count(*) as n from (" + _SCANNED + ") group by all")
def s9(spark, d):
    return markup.scan_all_facts(_html(spark, d)).groupBy("filing_id", "name", "contextref", "unitref", "value").agg(F.count("*").alias("n"))


@query("op_s12_s37_scan_fallback", _SCANNED.replace("select filing_id,", "select 'contextref' as provenance, filing_id,"))
def s12(spark, d):
    return markup.scan_with_fallback(_html(spark, d)).drop("element")


@query("op_s5_prefix_statistics", "select case when contains(name, ':') then split_part(name, ':', 1) else '' end as prefix, count(*) as n_facts, count(distinct name) as n_concepts from facts group by 1")
def s5(spark, d):
    return markup.prefix_statistics(markup.scan_facts(_html(spark, d)))


def _context_html(spark, d):
    c = unique_contexts(table(spark, d, "contexts"))
    part = lambda tag, col: F.coalesce(F.concat(F.lit(f"<xbrli:{tag}>"), F.col(col), F.lit(f"</xbrli:{tag}>")), F.lit(""))
    members = F.array_join(F.transform(F.map_entries("entity.segment"), lambda e: F.concat(F.lit('<xbrldi:explicitMember dimension="'), e["key"], F.lit('">'), e["value"], F.lit("</xbrldi:explicitMember>"))), "")
    element = F.concat(F.lit('<xbrli:context id="'), "context_id", F.lit('">'), part("identifier", "entity.identifier"), F.coalesce(members, F.lit("")), part("instant", "period.instant"), part("startDate", "period.startdate"), part("endDate", "period.enddate"), F.lit("</xbrli:context>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("context_pos", "context_id", element.alias("e")))), lambda s: s["e"]), "\n")
    return c.groupBy("filing_id").agg(F.concat(F.lit("<ix:header>"), body, F.lit("</ix:header>")).alias("html"))


@query("op_s1_t18_scanned_contexts", """with c as (select filing_id, context_id, max_by(period, coalesce(pos, -1)) as period, max_by(entity, coalesce(pos, -1)) as entity from contexts where filing_id is not null and context_id is not null group by all)
  select filing_id, context_id, period.instant as instant, period.startdate as startdate, period.enddate as enddate, entity.identifier as identifier, coalesce(cardinality(entity.segment), 0) as dimensions from c""")
def t18(spark, d):
    c = markup.scan_contexts(_context_html(spark, d))
    return c.select("filing_id", "context_id", "instant", "startdate", "enddate", "identifier", F.coalesce(F.size("segment"), F.lit(0)).alias("dimensions"))


@query("op_s1_scanned_units", "select filing_id, unit_id, min(measure) as measure from units group by all")
def s1u(spark, d):
    u = table(spark, d, "units").groupBy("filing_id", "unit_id").agg(F.min("measure").alias("measure"))
    ratio = F.regexp_replace("measure", "/", "</xbrli:measure><xbrli:measure>")
    element = F.concat(F.lit('<xbrli:unit id="'), "unit_id", F.lit('"><xbrli:measure>'), ratio, F.lit("</xbrli:measure></xbrli:unit>"))
    html = u.groupBy("filing_id").agg(F.array_join(F.array_sort(F.collect_list(element)), "\n").alias("html"))
    return markup.scan_units(html).select("filing_id", "unit_id", "measure")


def _linkbase(spark, d):
    g = _geo(spark, d).where(~F.col("child").rlike(r"^S\d+$"))
    loc = lambda c: F.concat(F.lit('<link:loc xlink:label="l_'), c, F.lit('" xlink:href="schema.xsd#geo_'), c, F.lit('"/>'))
    arc = F.concat(F.lit('<link:presentationArc xlink:from="l_'), "parent", F.lit('" xlink:to="l_'), "child", F.lit('" order="'), F.col("ord").cast("string"), F.lit('"/>'))
    body = F.array_join(F.array_sort(F.collect_list(F.concat(loc(F.col("parent")), loc(F.col("child")), arc, arc))), "")
    return g.agg(F.concat(F.lit('<link:presentationLink xlink:role="http://role/geo">'), body, F.lit("</link:presentationLink>")).alias("html")).select(F.lit("geo").alias("filing_id"), "html")


@query("op_s13_s22_linkbase_arcs", "select 'geo:' || r_name as parent, 'geo:' || n_name as child, cast(n_nationkey as double) as ord, 'http://role/geo' as role from nation join region on n_regionkey = r_regionkey")
def s13(spark, d):
    return markup.concept_arcs(markup.scan_links(_linkbase(spark, d)), "presentation").select("parent", "child", "ord", "role")


@query("op_s17_schema_concepts", "select concept_id, name, type_name, substitution_group, balance, period_type from concepts")
def s17(spark, d):
    attribute = lambda a, c: F.coalesce(F.concat(F.lit(f' {a}="'), F.col(c), F.lit('"')), F.lit(""))
    names = (("id", "concept_id"), ("name", "name"), ("type", "type_name"), ("substitutionGroup", "substitution_group"), ("xbrli:balance", "balance"), ("xbrli:periodType", "period_type"))
    element = F.concat(F.lit("<xs:element"), *[attribute(a, c) for a, c in names], F.lit("/>"))
    xml = table(spark, d, "concepts").agg(F.array_join(F.array_sort(F.collect_list(element)), "").alias("html")).select(F.lit("schema").alias("filing_id"), "html")
    return markup.scan_schema(xml).drop("filing_id", "pos")


@query("op_s26_t16_filing_index", r"""select record_id, original_filing_type as form, regexp_extract(documents_url, '(\d{10}-\d{2}-\d{6})', 1) as accession, filing_date from filing_info where documents_url is not null and original_filing_type is not null and trim(original_filing_type) = original_filing_type and original_filing_type <> ''""")
def s26(spark, d):
    i = table(spark, d, "filing_info").where("documents_url is not null and original_filing_type is not null and trim(original_filing_type) = original_filing_type and original_filing_type <> ''")
    html = F.concat(F.lit("<table><tr><td>"), "original_filing_type", F.lit("</td><td>report</td><td>"), "filing_date", F.lit('</td><td><a href="'), "documents_url", F.lit('">docs</a></td></tr></table>'))
    found = markup.filing_index(i.select(F.col("record_id").cast("string").alias("filing_id"), html.alias("html")))
    return found.select(F.col("filing_id").cast("bigint").alias("record_id"), "form", "accession", "filing_date")


@query("op_s27_primary_document", "select record_id, primary_doc_name as href from filing_info where primary_doc_name like '%.htm'")
def s27(spark, d):
    i = table(spark, d, "filing_info").where("primary_doc_name like '%.htm'")
    html = F.concat(F.lit('<tr><td>10-K</td><td><a href="/ix?doc='), "primary_doc_name", F.lit('">doc</a></td></tr><tr><td>EX-99</td><td><a href="exhibit.htm">x</a></td></tr>'))
    return markup.primary_document(i.select(F.col("record_id").cast("string").alias("filing_id"), html.alias("html"))).select(F.col("filing_id").cast("bigint").alias("record_id"), "href")


_CLEANED = r"regexp_replace(coalesce({c}, ''), '[\r\n|]+', ' ', 'g')"


@query("op_s38_grouped_lines_read_back", f"select filing_id, contextref, split_part(name, ':', 1) || ':' || split_part(name, ':', 2) as name, {_CLEANED.replace('{c}', 'value')} as value from facts where contains(name, ':')")
def s38(spark, d):
    # As its SQL: only the facts named with a prefix; the next query has all.
    return _read_back(table(spark, d, "facts").where(F.contains("name", F.lit(":"))))


@query("op_s38_all_grouped_lines_read_back", f"select filing_id, contextref, name, {_CLEANED.replace('{c}', 'value')} as value from facts")
def s38_all(spark, d):
    return _read_back(table(spark, d, "facts"))


def _read_back(facts):
    return render.read_block_lines(render.block_lines(facts), ["contextref", F.col("prefix"), "kind", "fact_id"])


_N12_LINE = "'@CONCEPT: ' || " + " || ' | @".join(f"{t}: ' || " * (i > 0) + rf"coalesce(regexp_replace({c}, '[\r\n|]+', ' ', 'g'), '')" for i, (t, c) in enumerate(zip(render.FIELDS, ("name", "value", "contextref", "unitref", "decimals"))))
_N12_TAGS = "text"
for _tag, _short in TAG_SHORT.items():
    _N12_TAGS = f"replace({_N12_TAGS}, '{_tag}', '{_short}')"
_N12 = rf"""with d as (select filing_id, string_agg({_N12_LINE}, chr(10) order by fact_id) as text from facts group by 1),
   o as (select filing_id, strlen(text) as size_before, strlen(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_N12_TAGS}, '[ \t]+\n', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' *\| *', '|', 'g'), '[ \t]{{2,}}', ' ', 'g')) as size_after from d)
  select filing_id, size_before, size_after, 100.0::double * (size_before - size_after) / greatest(size_before, 1) as reduction from o"""


@query("op_n7_consolidated_contexts", r"""with i as (select distinct filing_id, contextref, 'c-' || dense_rank() over (partition by filing_id order by contextref) as code from facts where regexp_matches(contextref, '^i[0-9a-f]{32}_[DI]'))
  select f.fact_id, coalesce(i.code, f.contextref) as short_ref from facts f left join i using (filing_id, contextref)""")
def n7(spark, d):
    return render.consolidated_contexts(table(spark, d, "facts")).select("fact_id", "short_ref")


@query("op_n8_deduplicated_blocks", """with f as (select md5(text) as h, min(doc_id) as first_key from documents group by 1) select doc_id, doc_id <> first_key as is_reference, first_key, md5(case when doc_id <> first_key then '@REF: ' || h else text end) as body from documents join f on md5(text) = h""")
def n8(spark, d):
    return render.deduplicated_blocks(table(spark, d, "documents"), "doc_id", "text").withColumn("body", F.md5("body"))


@query("op_n12_k1_optimised_size", _N12)
def n12(spark, d):
    lines = render.fact_lines(table(spark, d, "facts"))
    plain = lines.groupBy("filing_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "text"))), lambda s: s["text"]), "\n").alias("text"))
    return render.save_report(plain, plain.select("filing_id", render.optimised(F.col("text")).alias("text")))


@query("op_k9_k10_layout", """select filing_id, 'companies/' || company_ticker || '/' || regexp_replace(trim(filing_type), '/A$', '') || case when trim(filing_type) like '%/A' then '/a' else '' end || '/' || fiscal_year
   || case when fiscal_period is null or fiscal_period = 'annual' then '' else '/' || fiscal_period end as path from filings""")
def k9(spark, d):
    return partition_paths(table(spark, d, "filings"))


@query("op_t8_t10_sections", None)
def t8(spark, d):
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("filing_id"), "text", "filing_type")
    rule = lambda name, found: found.withColumn("rule", F.lit(name))
    found = rule("T8", render.sections_of(texts, headings.DOCUMENT)).unionByName(rule("T10", render.sections_of(texts, headings.BY_TYPE, None)))
    return found.unionByName(rule("PLAIN", render.sections_of(texts, headings.PLAIN)))


@query("op_t11_section_markers", "select section_key, length('@SECTION_START: ' || section_id || chr(10) || text_content || chr(10) || '@SECTION_END: ' || section_id) as n from sections")
def t11(spark, d):
    return table(spark, d, "sections").select("section_key", F.length(render.with_markers(F.col("text_content"), F.col("section_id"))).cast("bigint").alias("n"))


@query("op_a7_evidence_fold")
def a7(spark, d):
    return evidence.fold(evidence.filing_signals(table(spark, d, "filings")))


@query("op_a8_model_confidence")
def a8(spark, d):
    return evidence.model_confidence(a7(spark, d), F.split("key", r"\|")[0])


@query("op_x1_x2_stream_fold")
def x1(spark, d):
    return streams.folded_stream(spark, f"{d}/events.parquet")


@query("op_x1_batch_fold")
def x1b(spark, d):
    return evidence.fold(streams.event_signals(table(spark, d, "events")))


@query("op_ext_event_windows", """select time_bucket(interval 1 hour, ts) as starts, event_type, count(*) as n, sum(cast(value as decimal(18,6))) as total from events group by all""")
def windows(spark, d):
    return streams.windowed_counts(table(spark, d, "events")).select(F.col("w.start").cast("timestamp_ntz").alias("starts"), "event_type", "n", "total")
