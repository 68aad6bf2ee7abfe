"""Queries over whole filings: totals, completed statements, coverage, status, periods and documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import classify, periods, text
from factloom.functions.classify import PART_WORDS, TOTAL_WORDS
from factloom.operators import catalogue, evidence, hierarchy, pipeline, render, statements, totals
from factloom.operators import facts as ops
from factloom.operators.ordered import numbered
from factloom.plans.fact_queries import _BS, _BS_KEYS, _CONTEXTS, _RANK, _SPACED, _first, _section, _sheet_rows, _statement
from factloom.plans.text_queries import _sql_text
from factloom.session import table
from factloom.sources import documents, markup

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


_ITEM = _SPACED.replace("{c}", "name")


@query("op_l8_document_parts", f"select distinct name, {_first(_ITEM, PART_WORDS, 'OTHER_FINANCIAL')} as part from facts")
def l8(spark, d):
    return table(spark, d, "facts").select("name").distinct().select("name", classify.document_part(F.col("name")).alias("part"))


@query("op_l10_subtotals", f"""with i as (select filing_id, {_first(_ITEM, PART_WORDS, 'OTHER_FINANCIAL')} as section, {_ITEM} as item, min(pos) as first_pos from facts where filing_id is not null and name is not null group by all),
   t as (select filing_id, section, item as total, first_pos as total_pos, nullif(trim(replace(item, 'total', '')), '') as base from i where regexp_matches(item, '{TOTAL_WORDS}') and contains(item, 'total'))
  select t.filing_id, t.section, t.total, t.base, i.item, t.total = arg_max(t.total, (t.total_pos, t.total)) over (partition by t.filing_id, t.section, i.item) as is_parent
  from t join i on i.filing_id = t.filing_id and i.section = t.section and i.item <> t.total and contains(i.item, t.base)""")
def l10(spark, d):
    return totals.subtotals(totals.named_items(table(spark, d, "facts")))


# The tables hold few totals; names of parts, taken for items, hold many words in common.
@query("op_l10_word_families", """with i as (select distinct p_brand as filing_id, p_name as item from part), t as (select filing_id, 'total ' || split_part(item, ' ', 1) as total, split_part(item, ' ', 1) as base from i group by all)
  select t.filing_id, t.total, i.item from t join i on i.filing_id = t.filing_id and contains(i.item, t.base)""")
def l10_parts(spark, d):
    i = table(spark, d, "part").select(F.col("p_brand").alias("filing_id"), F.lit("all").alias("section"), F.col("p_name").alias("item"), F.lit(1).alias("first_pos")).distinct()
    t = i.select("filing_id", "section", F.concat(F.lit("total "), F.split_part("item", F.lit(" "), F.lit(1))).alias("item"), "first_pos").distinct()
    # Totals come as items too; none is under another here.
    return totals.subtotals(i.unionByName(t)).where("not startswith(item, 'total ')").select("filing_id", "total", "item")


_FULL = _BS.rsplit("select filing_id, contextref, ", 1)[0].replace("'us-gaap:MinorityInterest')", "'us-gaap:MinorityInterest', 'us-gaap:LiabilitiesAndStockholdersEquity')") + ", b as (select filing_id, contextref, " + ", ".join(
    f"max(v) filter (concept = 'us-gaap:{c}') as {k}" for k, c in {**_BS_KEYS, "total": "LiabilitiesAndStockholdersEquity"}.items()
) + """ from l group by all), c as (select *, coalesce(liabilities, case when assets is not null then total - equity - coalesce(minority, 0) end) as liabilities_full,
  coalesce(equity, case when assets is not null then total - liabilities - coalesce(minority, 0) end) as equity_full from b)"""  # fmt: skip


@query("op_a14_m4_m5_completed_sheets", _FULL + """ select filing_id, contextref, assets, liabilities_full, equity_full, minority, total,
  abs(assets - total) <= 0.01 * greatest(assets, total) as near from c""")
def a14(spark, d):
    b = statements.balance_sheets(_sheet_rows(spark, d), ["filing_id", "contextref"])
    near = F.abs(F.col("assets") - F.col("total")) <= 0.01 * F.greatest("assets", "total")
    return b.select("filing_id", "contextref", "assets", "liabilities_full", "equity_full", "minority", "total", F.when(F.col("assets").isNotNull() & F.col("total").isNotNull(), near).alias("near"))


_DOLLARS = "'$' || case when round_even({x}, 0) < 0 then '-' else '' end || replace(format('{:,}', cast(abs(round_even({x}, 0)) as bigint)), '''', ',')"
_LINES = [("Assets", "assets", "assets"), ("Liabilities", "liabilities_full", "liabilities"), ("Stockholders Equity", "equity_full", "equity"), ("Minority Interest", "minority", "minority"), ("Liabilities And Stockholders Equity", "total", "total")]


@query("op_a15_completed_rows", _FULL + " select filing_id, contextref, concept, " + _DOLLARS.replace("{x}", "amount") + " as value, derived from (" + " union all ".join(
    f"select filing_id, contextref, '{n}' as concept, {full} as amount, {own} is null as derived from c where assets is not null" for n, full, own in _LINES
) + ") where amount is not null and (concept <> 'Minority Interest' or amount > 0)")
def a15(spark, d):
    return statements.completed_rows(statements.balance_sheets(_sheet_rows(spark, d), ["filing_id", "contextref"]), ["filing_id", "contextref"])


def _ids(ids: list[str]) -> str:
    return "[" + ", ".join(f"'{i}'" for i in ids) + "]"


_COVERAGE = f"""h as (select filing_id, list_distinct(list(section_id) filter (section_id is not null)) as have from sections where filing_id is not null group by 1),
  n as (select filing_id, """ + ", ".join(
    f"coalesce(len(list_intersect(have, {_ids(ids)})), 0) as {k}" for k, ids in (("required", pipeline.REQUIRED), ("optional", pipeline.OPTIONAL), ("standard", pipeline.STANDARD), ("quarterly", pipeline.QUARTERLY))
) + f", array_to_string(list_filter({_ids(pipeline.REQUIRED)}, lambda x: not coalesce(list_contains(have, x), false)), ',') as missing from h)"


@query("op_a13_u6_section_coverage", f"""with {_COVERAGE} select filing_id, required, optional, standard, quarterly, required * 100.0 / {len(pipeline.REQUIRED)} as required_pct,
  standard * 100.0 / {len(pipeline.STANDARD)} as standard_pct, quarterly * 100.0 / {len(pipeline.QUARTERLY)} as quarterly_pct, missing from n""")
def a13(spark, d):
    return pipeline.coverage(table(spark, d, "sections"))


_TABLE_LIKE = r"""(contains(p, '|') or contains(p, chr(9)) or (regexp_matches(p, '(?i)\$|%|\b(?:total|net|assets|revenue)\b') and len(list_filter(string_split(p, chr(10)), lambda x: regexp_matches(x, '\S {2,}\(?\$?\d[\d,.]*\)?\s*$'))) >= 2)
  or len(list_filter(string_split(p, chr(10)), lambda x: regexp_matches(x, '\S {2,}\S.* {2,}\S'))) >= 3)"""


@query("op_n15_table_paragraphs", rf"""with p as (select doc_id, unnest(string_split_regex(text, '\n\s*\n')) as p from documents) select doc_id, count(*) filter ({_TABLE_LIKE}) as n_tables, count(*) as n_paragraphs from p group by 1""")
def n15(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", r"\n\s*\n")).alias("paragraph"))
    return p.groupBy("doc_id").agg(F.count_if(text.table_like(F.col("paragraph"))).alias("n_tables"), F.count("*").alias("n_paragraphs"))


_INTEGRITY = rf"""p as (select filing_id, unnest(string_split_regex(text_content, '\n\s*\n')) as p from sections where filing_id is not null), q as (select filing_id, {_TABLE_LIKE} as is_table, len(string_split(p, chr(10))) as n, trim(p) <> '' as filled from p),
  g as (select filing_id, count(*) filter (is_table) as tables, count(*) filter (is_table and filled) as tables_included, coalesce(sum(n) filter (is_table), 0)::bigint as table_rows, count(*) as paragraphs,
   count(*) filter (not is_table) as narrative, count(*) filter (not is_table and filled) as included from q group by 1), f as (select filing_id, count(*) as n from facts group by 1)"""


@query("op_a12_integrity", f"""with {_INTEGRITY} select g.filing_id, coalesce(f.n, 0) as xbrl_facts, tables, table_rows, paragraphs, narrative, included,
  case when tables > 0 then tables_included * 100.0 / tables else 100.0 end as preservation_pct from g left join f using (filing_id)""")
def a12(spark, d):
    return pipeline.integrity(table(spark, d, "sections"), table(spark, d, "facts"))


_LINE = "'@CONCEPT: ' || {name} || ' | @VALUE: ' || {value} || ' | @CONTEXT_REF: ' || {contextref} || ' | @UNIT_REF: ' || {unitref} || ' | @DECIMALS: ' || {decimals}".format(
    **{c: rf"coalesce(regexp_replace({c}, '[\r\n|]+', ' ', 'g'), '')" for c in ("name", "value", "contextref", "unitref", "decimals")}
)
_STATUS = _FULL.removeprefix("with ") + f""", k as (select filing_id, count(*) as sheets, count(*) filter (abs(assets - (liabilities_full + equity_full + coalesce(minority, 0))) <= greatest(assets, liabilities_full + equity_full + coalesce(minority, 0)) * 0.001
    or abs(assets - liabilities_full) <= greatest(assets, liabilities_full) * 0.001) as balanced from c where assets is not null and liabilities_full is not null and equity_full is not null group by 1),
  x as (select filing_id, count(*) as n_facts, sum(strlen({_LINE}) + 1) as fact_bytes from facts group by 1), y as (select filing_id, count(*) filter (trim(coalesce(text_content, '')) <> '') as n_sections, sum(strlen(text_content)) as text_bytes from sections group by 1),
  r as (select f.filing_id, coalesce(n_facts, 0) as n_facts, coalesce(n_sections, 0) as n_sections, (coalesce(fact_bytes, 0) + coalesce(text_bytes, 0))::bigint as n_bytes, coalesce(sheets, 0) as sheets, coalesce(balanced, 0) as balanced
   from (select distinct filing_id from filings) f left join x using (filing_id) left join y using (filing_id) left join k using (filing_id)),
  s as (select *, case """ + " ".join(f"when {rule} then '{name}'" for name, rule in pipeline.CHECKS) + " else 'ok' end as status from r)"  # fmt: skip


def _processed(spark, d):
    return pipeline.processed(*(table(spark, d, t) for t in ("filings", "facts", "sections")))


@query("op_c2_c5_filing_status", f"with {_STATUS} select * from s")
def c2(spark, d):
    return _processed(spark, d)


@query("op_a9_a17_run_summary", f"""with {_STATUS} select company_ticker, fiscal_year, filing_type, count(*) as total, count(*) filter (status = 'ok') as succeeded, count(*) filter (status <> 'ok') as failed
  from s join filings using (filing_id) group by grouping sets ((), (company_ticker), (filing_type), (fiscal_year))""")
def a9(spark, d):
    rows = _processed(spark, d).join(table(spark, d, "filings").select("filing_id", "company_ticker", "filing_type", "fiscal_year"), "filing_id")
    return pipeline.summary(rows, ["company_ticker", "filing_type", "fiscal_year"])


_CELLS = f"""n as (select filing_id, contextref, {_statement('name')} as statement, count(*) as n from facts group by all),
   p as (select filing_id, contextref, statement from (select *, row_number() over (partition by filing_id, contextref order by n desc, {_RANK}) as rn from n where statement <> 'OTHER') where rn = 1),
   s as (select f.*, case when {_statement('f.name')} = 'OTHER' then coalesce(p.statement, 'OTHER') else {_statement('f.name')} end as statement from facts f left join p using (filing_id, contextref)),
   v as (select filing_id, statement, {_section('name', 'statement')} as section, case when contains(name, ':') then array_to_string(list_transform(string_split(regexp_replace(list_extract(string_split(name, ':'), -1), '([a-z])([A-Z])', '\\1 \\2', 'g'), ' '),
     lambda w: upper(w[1]) || lower(w[2:])), ' ') else name end as item, contextref, arg_max(case when lower(unitref) = 'usd' and not starts_with(coalesce(value, ''), '$') then '$' || coalesce(value, '') else coalesce(value, '') end, (pos, fact_id)) as value
    from s where statement <> 'OTHER' and name is not null and contextref is not null group by all)"""


@query("op_t3_t4_statement_rows", f"""with {_CELLS}, k as (select filing_id, statement, list_sort(list(distinct contextref)) as columns from v group by all),
   m as (select filing_id, statement, section, item, map_from_entries(list((contextref, value))) as cells from v group by all)
  select filing_id, statement, section, item, item || ' | ' || array_to_string(list_transform(columns, lambda c: coalesce(cells[c], '-')), ' | ') as text from m join k using (filing_id, statement)""")
def t3(spark, d):
    return statements.statement_rows(statements.statement_cells(table(spark, d, "facts")))


@query("op_a5_primary_context", f"""with {_CONTEXTS}, v as (select f.filing_id, f.contextref, try_cast(replace(value, ',', '') as double) as v, f.pos, fact_id, coalesce(c.period.enddate, c.period.instant) as day from facts f left join c on c.filing_id = f.filing_id and c.context_id = f.contextref
    where name in ('us-gaap:Assets', 'us-gaap_Assets')), w as (select *, coalesce(day, nullif(regexp_replace(regexp_extract(contextref, '_I(\\d{{8}})|C_\\d+_(\\d{{8}})$', 1), '^(\\d{{4}})(\\d{{2}})(\\d{{2}})$', '\\1-\\2-\\3'), '')) as d from v where v is not null)
  select filing_id, contextref, v as assets, d is not null as dated from (select *, row_number() over (partition by filing_id, day order by v desc, pos, fact_id) as rn from w where day is not null) where rn = 1""")
def a5(spark, d):
    # Contexts that are not in the table have their day in their id or none; the SQL leaves those out.
    c = table(spark, d, "contexts")
    known = ops.unique_contexts(c).where("coalesce(period.enddate, period.instant) is not null").select("filing_id", F.col("context_id").alias("contextref"))
    f = table(spark, d, "facts").join(known, ["filing_id", "contextref"], "left_semi")
    return ops.primary_contexts(f, c).select("filing_id", "contextref", "assets", F.col("day").isNotNull().alias("dated"))


@query("op_a10_element_histogram", """with n as (select coalesce(element, '') as element, count(*) as n from facts group by 1), t as (select sum(n)::bigint as total, count(*) as elements from n)
  select element, n, total, elements from n, t order by n desc, element limit 10""")
def a10(spark, d):
    n = table(spark, d, "facts").groupBy(F.coalesce("element", F.lit("")).alias("element")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"), F.count("*").alias("elements"))
    return n.orderBy(F.desc("n"), "element").limit(10).join(F.broadcast(total)).select("element", "n", "total", "elements")


@query("op_a18_o4_facts_by_concept", "select fact_id, name, row_number() over (partition by name order by pos, fact_id) as place from facts")
def a18(spark, d):
    return numbered(table(spark, d, "facts").select("fact_id", "name", "pos"), ["name"], ["pos", "fact_id"], "place").select("fact_id", "name", "place")


@query("op_f1_context_facts", "select fact_id from facts where contextref is not null and trim(contextref) <> '' and lower(list_extract(string_split(coalesce(element, ''), ':'), -1)) not in ('context', 'unit', 'schemaref')")
def f1(spark, d):
    return ops.tagged(table(spark, d, "facts")).select("fact_id")


@query("op_f7_amendment_modes", """select filing_id, m.m as amended, fiscal_year from filings, (select unnest([true, false]) as m) m where coalesce(suffix(trim(filing_type), '/A'), false) = m.m and fiscal_year = '2022'""")
def f7(spark, d):
    f = table(spark, d, "filings")
    modes = [ops.filing_filter(f, mode, "2022").select("filing_id", F.lit(mode).alias("amended"), "fiscal_year") for mode in (True, False)]
    return modes[0].unionByName(modes[1])


@query("op_w8_first_pairs", "select filing_id, contextref, name, arg_min(fact_id, (pos, fact_id)) as fact_id from facts group by all")
def w8(spark, d):
    return ops.first_pairs(table(spark, d, "facts").select("filing_id", "contextref", "name", "pos", "fact_id"), ["filing_id", "contextref", "name"], ["pos", "fact_id"]).drop("pos")


_LABEL = r"""coalesce(case when date_diff('day', s, e) between 350 and 380 then 'FY' || year(e) else year(e) || '_Q' || quarter(e) end, year(i) || case when month(i) = 12 then '_FY_END' else '_Q' || quarter(i) || '_END' end, 'unknown')"""
_SEGMENT = r"""coalesce(nullif(array_to_string(list_sort(list_transform(map_entries(entity.segment), lambda e: regexp_replace(list_extract(string_split(e.key, ':'), -1), '(Segment|Dimension|Axis|Member)$', '') || ': ' ||
    regexp_replace(list_extract(string_split(e.value, ':'), -1), '(Segment|Dimension|Axis|Member)$', ''))), ', '), ''), 'Consolidated')"""


@query("op_j11_semantic_codes", f"""with c as (select filing_id, context_id, max_by(pos, coalesce(pos, -1)) as cpos, max_by(period, coalesce(pos, -1)) as period, max_by(entity, coalesce(pos, -1)) as entity from contexts where filing_id is not null and context_id is not null group by all),
   k as (select *, 'c-' || row_number() over (partition by filing_id order by cpos, context_id) as code, try_cast(period.startdate as date) as s, try_cast(period.enddate as date) as e, try_cast(period.instant as date) as i, {_SEGMENT} as segment from c)
  select f.fact_id, k.code, case when k.code is not null then {_LABEL} || case when segment = 'Consolidated' then '' else ' (' || segment || ')' end end as label from facts f left join k on k.filing_id = f.filing_id and k.context_id = f.contextref""")
def j11(spark, d):
    return ops.with_codes(table(spark, d, "facts").select("fact_id", "filing_id", "contextref"), table(spark, d, "contexts")).select("fact_id", "code", "label")


_CAL = "select distinct {t} as ticker, {e} as period_end, {y} as fiscal_year from {f} where {t} is not null and {e} is not null"


@query("op_r7_g5_merged_calendars", "with own as (" + _CAL.format(t="upper(trim(company_ticker))", e="period_end_date", y="fiscal_year", f="filings") + "), others as (" + _CAL.format(t="upper(trim(ticker))", e="try_cast(period_end_date as date)", y="fiscal_year", f="filing_info")
       + ") select * from own union all select * from others where ticker not in (select ticker from own)")
def r7(spark, d):
    entry = lambda df, t, e: df.select(F.upper(F.trim(t)).alias("ticker"), e.alias("period_end"), "fiscal_year").where("ticker is not null and period_end is not null").distinct()
    own = entry(table(spark, d, "filings"), "company_ticker", F.col("period_end_date"))
    return catalogue.merged_calendars(own, entry(table(spark, d, "filing_info"), "ticker", F.col("period_end_date").try_cast("date")))


_READ = {c: rf"nullif(trim(coalesce(regexp_replace({c}, '[\r\n|]+', ' ', 'g'), '')), '')" for c in ("name", "value", "contextref", "unitref", "decimals")}
_READ_SQL = ", ".join(f"{e} as {c}" for c, e in _READ.items())


def _read_facts(spark, d):
    lines = render.fact_lines(table(spark, d, "facts")).select("filing_id", "text")
    return render.read_fact_lines(lines).drop("pos")


@query("op_s40_facts_read_back", f"select filing_id, {_READ_SQL} from facts")
def s40(spark, d):
    return _read_facts(spark, d)


@query("op_s39_facts_with_units", f"select filing_id, {_READ_SQL} from facts where {_READ['unitref']} is not null")
def s39(spark, d):
    return _read_facts(spark, d).where("unitref is not null")


@query("op_u5_lost_numbers", r"""select section_key, len(list_filter(list_distinct(regexp_extract_all(text_content, '(\d[\d,.]*\d|\d)', 1)), lambda x: not list_contains(regexp_extract_all(coalesce(heading, ''), '(\d[\d,.]*\d|\d)', 1), x))) as lost
  from sections where text_content is not null""")
def u5(spark, d):
    s = table(spark, d, "sections").where("text_content is not null")
    return s.select("section_key", F.size(text.lost_numbers(F.col("text_content"), F.coalesce("heading", F.lit("")))).cast("bigint").alias("lost"))


_HEAD = f"lower(substr(text_content, 1, {periods.HEAD_CHARACTERS}))"


def _sql_first(pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract(h, {_sql_text(pattern)}, {group}), '')"


@query("op_d19_period_in_document", f"""with cal as (select upper(trim(company_ticker)) as t, month(max(period_end_date)) as m from filings where trim(filing_type) = '10-K' and company_ticker is not null group by 1),
   s as (select section_key, {_HEAD} as h, trim(f.filing_type) as form, f.period_end_date as pe, cal.m from sections left join filings f using (filing_id) left join cal on cal.t = upper(trim(f.company_ticker))),
   x as (select *, {_sql_first(periods.QUARTER_PATTERN)} as mention, try_strptime({_sql_first(periods.STATED_END)}, '%B %d, %Y')::date as stated from s),
   y as (select *, coalesce(stated, pe) as dd, case """ + " ".join(f"when regexp_matches(mention, '{w}') then '{q}'" for q, w in periods.QUARTER_WORDS.items()) + """ end as quarter from x),
   z as (select *, ((month(dd) - m) % 12 + 12) % 12 as ahead from y)
  select section_key, case form when '10-K' then coalesce(""" + ", ".join(_sql_first(p) for p in periods.YEAR_PATTERNS["10-K"]) + """, cast(year(pe) as varchar))
    when '10-Q' then coalesce(case when quarter is null and m is not null then cast(year(dd) + case when month(dd) > m then 1 else 0 end as varchar) end, """ + ", ".join(_sql_first(p) for p in periods.YEAR_PATTERNS["10-Q"]) + """, cast(year(stated) as varchar), cast(year(pe) as varchar)) end as fiscal_year,
   case form when '10-K' then 'annual' when '10-Q' then coalesce(quarter, case when ahead = 0 then 'annual' else 'Q' || cast(ceil(ahead / 3) as integer) end) end as fiscal_period from z""")  # fmt: skip
def d19(spark, d):
    f, s = table(spark, d, "filings"), table(spark, d, "sections")
    t = lambda c: F.upper(F.trim(c))
    cal = f.where("trim(filing_type) = '10-K' and company_ticker is not null").groupBy(t("company_ticker").alias("t")).agg(F.month(F.max("period_end_date")).alias("m"))
    known = f.select("filing_id", F.trim("filing_type").alias("form"), "period_end_date", t("company_ticker").alias("t")).join(cal, "t", "left")
    p = periods.period_in_document(F.col("text_content"), F.col("form"), F.col("period_end_date"), F.col("m"))
    return s.select("section_key", "filing_id", "text_content").join(known, "filing_id", "left").select("section_key", p.alias("p")).select("section_key", "p.fiscal_year", "p.fiscal_period")


@query("op_d21_filing_signals", rf"""with b as (select *, trim(filing_type) as form from filings where company_ticker is not null and period_end_date is not null), k as (select * from b where form = '10-K'),
   t as (select filing_id, section_key, lower(substr(regexp_extract(text_content, '{evidence.DATED_QUARTER}', 1), 1, 3)) as name, lower(regexp_extract(text_content, '{evidence.NAMED_QUARTER}', 1)) as mention from sections where filing_id is not null)
  select company_ticker || '|fiscal_year_end_month' as key, filing_id as signal_id, cast(month(period_end_date) as varchar) as value, 0.8 as confidence from k
  union all select company_ticker || '|fiscal_year_end_day', filing_id, cast(day(period_end_date) as varchar), 0.8 from k
  union all select company_ticker || '|fiscal_year_end_month', filing_id || '|lag', cast(month(period_end_date) as varchar), 0.6 from k where date_diff('day', period_end_date, filing_date) between 20 and 90
  union all select company_ticker || '|quarter_mapping', filing_id || '|' || section_key, cast(coalesce(nullif(list_position([{', '.join(f"'{m[:3]}'" for m in periods.MONTH_NAMES.split('|'))}], name), 0), month(period_end_date)) as varchar) || ':' ||
     case {' '.join(f"when regexp_matches(mention, '{w}') then '{q}'" for q, w in periods.QUARTER_WORDS.items())} end, 0.7 from b join t using (filing_id) where form = '10-Q' and name <> '' and mention <> ''""")
def d21(spark, d):
    texts = table(spark, d, "sections").where("filing_id is not null").select("filing_id", F.col("section_key").alias("text_id"), F.col("text_content").alias("text"))
    return evidence.filing_signals(table(spark, d, "filings"), texts).drop("ts")


_NAMED = "n as (select distinct name as concept, list_extract(string_split(name, ':'), -1) as local, " + _first("list_extract(string_split(name, ':'), -1)", classify.NAME_PARTS, "Unknown") + " as statement from concepts)"
_PAIRS = "(values " + ", ".join(f"('{p}', '{c}')" for p, c in hierarchy.CHILD_PAIRS) + ") as t(p, c)"


@query("op_j7_h5_child_of", f"""with {_NAMED} select a.concept as parent, b.concept as child, a.statement from n a join n b on a.statement = b.statement and a.concept <> b.concept
  where a.statement <> 'Unknown' and ((starts_with(b.local, a.local) and a.local <> b.local) or exists (select 1 from {_PAIRS} where suffix(a.local, p) and suffix(b.local, c)))""")
def j7(spark, d):
    return hierarchy.child_of(table(spark, d, "concepts").select(F.col("name").alias("concept"), classify.statement_of_name(F.col("name")).alias("statement")))


_HREFS = "select concept_id as href from concepts union select 'schema.xsd#' || concept_id from concepts union select name from concepts union select 'x#my_' || local from l union select 'x#ext' || local from l union select 'x#us-gaap_' || local from l union select 'x#q_' || name || '_9' from concepts"
_TIERS = r"""select href, concept, 1 as tier, 0 as rank from f join c on f = concept union all select href, concept, 2, 0 from f join c on regexp_matches(f, '^(us-gaap_|dei_|ifrs-full_)') and suffix(concept, regexp_replace(f, '^[^_]*_', '')) and regexp_replace(f, '^[^_]*_', '') <> ''
  union all select href, concept, 3, 0 from f join c on f = concept_id union all select href, concept, 4, i from p join c on part = concept union all select href, concept, 5, i from p join c on part = local
  union all select href, concept, 6, length(f) - length(local) from f join c on suffix(f, local)"""


@query("op_h15_h19_resolved_references", f"""with l as (select list_extract(string_split(name, ':'), -1) as local from concepts), f as (select href, list_extract(string_split(href, '#'), -1) as f from ({_HREFS})), c as (select distinct name as concept, concept_id, list_extract(string_split(name, ':'), -1) as local from concepts),
   p as (select href, unnest(string_split(f, '_')) as part, generate_subscripts(string_split(f, '_'), 1) - 1 as i from f), t as ({_TIERS})
  select href, concept, tier from (select *, row_number() over (partition by href order by tier, rank, concept) as rn from t) where rn = 1""")
def h15(spark, d):
    c = table(spark, d, "concepts")
    local = text.local_name(F.col("name"))
    shapes = ["concept_id", F.concat(F.lit("schema.xsd#"), "concept_id"), "name", F.concat(F.lit("x#my_"), local), F.concat(F.lit("x#ext"), local), F.concat(F.lit("x#us-gaap_"), local), F.concat(F.lit("x#q_"), "name", F.lit("_9"))]
    return hierarchy.resolve_references(c.select(F.explode(F.array(*shapes)).alias("href")), c)


_HEADING = "coalesce(heading, '') as t"


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


_BARE = f"md5(regexp_replace(text_content, '{text.WS}', '', 'g')) as h"


@query("op_n6_t12_visible_text", f"select section_key, {_BARE} from sections where text_content is not null")
def n6(spark, d):
    s = table(spark, d, "sections").where("text_content is not null")
    html = F.concat(F.lit("<html><head><title>x</title><script>var a;</script></head><body><p>"), _escaped(F.col("text_content")), F.lit("</p></body></html>"))
    out = markup.document_texts(s.select(F.col("section_key").cast("string").alias("filing_id"), html.alias("html")))
    return out.select(F.col("filing_id").cast("bigint").alias("section_key"), F.md5(F.regexp_replace("text", text.WS, "")).alias("h"))


@query("op_t9_section_texts", f"select section_key, 'ITEM_1A_RISK_FACTORS' as section_id, 'Item 1A. Risk Factors' as heading, {_BARE} from sections where regexp_replace(coalesce(text_content, ''), '{text.WS}', '', 'g') <> '' union all select section_key, 'ITEM_2_PROPERTIES', 'Item 2. Properties', md5('Plants.') from sections")
def t9(spark, d):
    s = table(spark, d, "sections")
    part = lambda title, body: F.concat(F.lit(f"<h2>{title}</h2><div><p>"), body, F.lit("</p></div>"))
    html = F.concat(F.lit("<html><body>"), part("Item 1A. Risk Factors", F.lit("earlier")), part("Item 1A.  Risk Factors", _escaped(F.coalesce("text_content", F.lit("")))), part("Item 2. <b>Properties</b>", F.lit("Plants.")), F.lit("<h4>Other matters</h4><p>end</p></body></html>"))
    out = documents.section_texts(s.select(F.col("section_key").cast("string").alias("filing_id"), html.alias("html")))
    # Where the last part is empty, the earlier one of that name stays.
    out = out.where("not (section_id = 'ITEM_1A_RISK_FACTORS' and text = 'earlier')")
    return out.select(F.col("filing_id").cast("bigint").alias("section_key"), "section_id", "heading", F.md5(F.regexp_replace("text", text.WS, "")).alias("h"))


@query("op_t14_t17_main_content", """select s_suppkey, case s_suppkey % 4 when 0 then 'main-content' when 1 then 'formGrouping' when 2 then 'body' else 'whole' end as container, s_name as text, case when s_suppkey % 3 = 0 then 'd' || s_suppkey || '.htm' end as href from supplier""")
def t14(spark, d):
    s = table(spark, d, "supplier")
    k, name = F.col("s_suppkey"), F.concat(F.lit("<p>"), "s_name", F.lit("</p>"))
    body = (
        F.when(k % 4 == 0, F.concat(F.lit("<body><p>menu</p><div id='main-content'><div>"), name, F.lit("</div></div><p>foot</p></body>")))
        .when(k % 4 == 1, F.concat(F.lit('<body><p>menu</p><div class="x formGrouping">'), name, F.lit("</div></body>")))
        .when(k % 4 == 2, F.concat(F.lit("<title>t</title><body>"), name, F.lit("</body>"))).otherwise(name)
    )
    href = F.concat(F.lit("d"), k.cast("string"), F.lit(".htm"))
    link = F.concat(F.lit('<table><tr><td>10-K</td><td><a href="/ix?doc='), href, F.lit('">doc</a></td></tr></table>'))
    linked = k % 3 == 0
    pages = s.select(k.cast("string").alias("filing_id"), F.when(linked, link).otherwise(body).alias("html"))
    out = documents.html_filings(pages, s.where(linked).select(href.alias("href"), body.alias("html")))
    return out.select(F.col("filing_id").cast("bigint").alias("s_suppkey"), "container", "text", "href")


_DOC_SECTIONS = "sections where section_id is not null and trim(coalesce(text_content, '')) <> ''"
_T1 = rf"""with {_CONTEXTS.replace("max_by(period, coalesce(pos, -1)) as period", "max_by(period, coalesce(pos, -1)) as period, max_by(entity, coalesce(pos, -1)) as entity")}, cc as (select *, 'c-' || row_number() over (partition by filing_id order by cpos, context_id) as code from c),
  {_CELLS}, k as (select filing_id, statement, list_sort(list(distinct contextref)) as columns from v group by all), m as (select filing_id, statement, section, item, map_from_entries(list((contextref, value))) as cells from v group by all), {_COVERAGE.replace("  n as (", "  nn as (")}, {_INTEGRITY.replace("p as (select filing_id, unnest", "pp as (select filing_id, unnest").replace("from p)", "from pp)")},
  hd as (select filing_id, list_filter(['@DOCUMENT: ' || company_ticker, '@TYPE: ' || filing_type, '@PERIOD: ' || period_end_date, '@FISCAL_YEAR: ' || fiscal_year, '@FISCAL_PERIOD: ' || fiscal_period], lambda x: x is not null) as hs from filings)
  select filing_id, 0 as section_ord, generate_subscripts(hs, 1) - 1 as line_ord, unnest(hs) as text from hd
  union all select filing_id, 1, coalesce(cpos, 0), concat_ws(' | ', '@CONTEXT: ' || context_id, code, coalesce(period.instant, concat_ws(' to ', period.startdate, period.enddate)), {_SEGMENT}) from cc
  union all select filing_id, 2, 0, concat_ws(' | ', '@UNIT: ' || unit_id, min(measure)) from units where filing_id is not null and unit_id is not null group by filing_id, unit_id
  union all select filing_id, 3, fact_id, {_LINE} from facts
  union all select filing_id, 4, {_RANK}, '@STATEMENT: ' || statement || ' | ' || section || ' | ' || item || ' | ' || array_to_string(list_transform(columns, lambda c: coalesce(cells[c], '-')), ' | ') from m join k using (filing_id, statement)
  union all select filing_id, 5, coalesce(pos, 0), '@SECTION_START: ' || section_id || chr(10) || text_content || chr(10) || '@SECTION_END: ' || section_id from {_DOC_SECTIONS}
  union all select filing_id, 6, 0, printf('@DOCUMENT_COVERAGE: %.1f%% of required, %.1f%% of standard sections; missing: %s', required * 100.0::double / {len(pipeline.REQUIRED)}, standard * 100.0::double / {len(pipeline.STANDARD)}, missing) from nn
  union all select g.filing_id, 7, 0, printf('@DATA_INTEGRITY: %d facts, %d tables, %.1f%% preserved, %d table rows, %d paragraphs, %d included', coalesce(f.n, 0), tables, case when tables > 0 then tables_included * 100.0::double / tables else 100.0::double end, table_rows, narrative, included) from g left join f using (filing_id)"""


@query("op_t1_document_lines", _T1)
def t1(spark, d):
    return render.filing_lines(*(table(spark, d, t) for t in ("filings", "contexts", "units", "facts", "sections")))


@query("op_k11_text_documents", """with h as (select filing_id, list_filter(['@COMPANY_NAME: ' || company_name, '@CIK: ' || cik, '@FILING_TYPE: ' || filing_type, '@PERIOD_END_DATE: ' || period_end_date, '@FILING_DATE: ' || filing_date, '@FISCAL_YEAR: ' || fiscal_year, '@FISCAL_PERIOD: ' || fiscal_period], lambda x: x is not null) as hs from filings),
   s as (select * from sections where filing_id is not null and section_id is not null)
  select filing_id, 0 as part, generate_subscripts(hs, 1) - 1 as pos, 0 as key, unnest(hs) as text from h union all select filing_id, 1, coalesce(pos, 0), section_key, '@SECTION_GUIDE: ' || section_id || coalesce(' | ' || heading, '') from s
  union all select filing_id, 2, coalesce(pos, 0), section_key, '@SECTION_START: ' || section_id || chr(10) || coalesce(text_content, '') || chr(10) || '@SECTION_END: ' || section_id from s""")
def k11(spark, d):
    return catalogue.text_documents(table(spark, d, "filings"), table(spark, d, "sections")).select("filing_id", "line_ord.*", "text")


@query("op_s33_filing_index_rows", r"""select record_id, regexp_replace(regexp_replace(coalesce(original_filing_type, ''), '^[\s\xa0]+|[\s\xa0]+$', '', 'g'), 'x^', '') as form, coalesce(nullif(regexp_extract(documents_url, '(\d{10}-\d{2}-\d{6})', 1), ''), regexp_extract(documents_url, '/(\d{10})(\d{2})(\d{6})/', 1) || '-' || regexp_extract(documents_url, '/(\d{10})(\d{2})(\d{6})/', 2) || '-' || regexp_extract(documents_url, '/(\d{10})(\d{2})(\d{6})/', 3)) as accession
  from filing_info where regexp_matches(coalesce(documents_url, ''), '\d{10}-\d{2}-\d{6}|/\d{18}/')""")
def s33(spark, d):
    html = F.concat(F.lit("<table><tr><td>"), _escaped(F.coalesce("original_filing_type", F.lit(""))), F.lit("</td><td>report</td><td>"), F.lit('</td><td><a href="'), F.coalesce("documents_url", F.lit("")), F.lit('">docs</a></td></tr></table>'))
    found = markup.filing_index(table(spark, d, "filing_info").select(F.col("record_id").cast("string").alias("filing_id"), html.alias("html")))
    return found.select(F.col("filing_id").cast("bigint").alias("record_id"), "form", "accession")
