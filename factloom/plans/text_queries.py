"""Queries of the text, value and period functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import periods, text
from factloom.functions.let import let
from factloom.functions.text import CLEAN_STEPS, ONE_TO_MANY, ONE_TO_ONE
from factloom.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_plain(column: str) -> str:
    out = f"translate({column}, {_sql_text(''.join(ONE_TO_ONE))}, {_sql_text(''.join(ONE_TO_ONE.values()))})"
    for a, b in ONE_TO_MANY.items():
        out = f"replace({out}, {_sql_text(a)}, {_sql_text(b)})"
    return out


def _sql_clean(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern, replacement in CLEAN_STEPS:
        out = f"regexp_replace({out}, {_sql_text(pattern)}, {_sql_text(replacement.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2'))}, 'g')"
    return out


@query("op_n1_special_characters", f"select doc_id, md5({_sql_plain('text')}) as h, {_sql_plain('text')} <> text as changed from documents")
def n1(spark, d):
    out = text.plain_characters(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(out).alias("h"), (out != F.col("text")).alias("changed"))


@query("op_n2_clean_text", f"select section_key, md5({_sql_clean('text_content')}) as h, length({_sql_clean('text_content')}) as n from sections")
def n2(spark, d):
    # The text is cleaned once for both.
    out = let(text.clean_text(F.col("text_content")), lambda t: F.struct(F.md5(t).alias("h"), F.length(t).cast("bigint").alias("n")))
    return table(spark, d, "sections").select("section_key", out.alias("o")).select("section_key", "o.h", "o.n")


@query("op_n11_less_white_space", r"""select section_key, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text_content, '[ \t]+\n', chr(10), 'g'),
  '\n{3,}', chr(10) || chr(10), 'g'), ' *\| *', '|', 'g'), '[ \t]{2,}', ' ', 'g')) as h from sections""")
def n11(spark, d):
    return table(spark, d, "sections").select("section_key", F.md5(text.less_white_space(F.col("text_content"))).alias("h"))


@query("op_n9_short_tags", """select fact_id, replace(replace(replace(replace(replace(replace(replace(
  '@CONCEPT: ' || name || ' @VALUE: ' || coalesce(value, '') || ' @CONTEXT_REF: ' || contextref || ' @DECIMALS: ' || coalesce(decimals, ''),
  '@CONTEXT_REF', '@CR'), '@CONTEXT', '@CX'), '@CONCEPT', '@C'), '@VALUE', '@V'), '@UNIT_REF', '@UR'), '@DECIMALS', '@D'), '@SECTION', '@S') as line from facts""")
def n9(spark, d):
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(F.lit("@CONCEPT: "), "name", F.lit(" @VALUE: "), e("value"), F.lit(" @CONTEXT_REF: "), "contextref", F.lit(" @DECIMALS: "), e("decimals"))
    return table(spark, d, "facts").select("fact_id", text.short_tags(line).alias("line"))


@query("op_n13_estimated_tokens", r"""with s as (select doc_id, text, length(text) as n,
    length(regexp_replace(text, '[\p{L}\p{N}\p{Z}\s]', '', 'g')) / greatest(length(text), 1) as special,
    length(regexp_replace(substr(text, 1, 1000), '[^\p{Nd}]', '', 'g')) as digits from documents)
  select doc_id, cast(coalesce(floor(floor(n / (case when contains(text, '@') and contains(text, '|') and special > 0.1 then 3.0::double
    when special > 0.15 then 2.5::double when digits > 300 then 3.0::double else 4.0::double end)) * 1.05::double), 0) as bigint) as tokens from s""")
def n13(spark, d):
    return table(spark, d, "documents").select("doc_id", text.estimated_tokens(F.col("text")).alias("tokens"))


@query("op_n14_same_value", """select a.fact_id as a, b.fact_id as b, coalesce(a.value = b.value or coalesce(
    try_cast(replace(trim(a.value), ',', '') as decimal(38,10)) = try_cast(replace(trim(b.value), ',', '') as decimal(38,10)), false), false) as same
  from facts a join facts b on a.filing_id = b.filing_id and a.contextref = b.contextref and a.name = b.name and a.pos + 1 = b.pos""")
def n14(spark, d):
    f = table(spark, d, "facts")
    k = ["filing_id", "contextref", "name"]
    a = f.select(*k, F.col("fact_id").alias("a"), F.col("value").alias("va"), (F.col("pos") + 1).alias("pos"))
    b = f.select(*k, F.col("fact_id").alias("b"), F.col("value").alias("vb"), "pos")
    return a.join(b, [*k, "pos"]).select("a", "b", text.same_value(F.col("va"), F.col("vb")).alias("same"))


@query("op_n17_slug", r"""select filing_id, regexp_replace(regexp_replace(lower(trim(company_name)), '[^a-z0-9\s_-]', '', 'g'), '[\s-]+', '_', 'g') as slug from filings""")
def n17(spark, d):
    return table(spark, d, "filings").select("filing_id", text.slug(F.col("company_name")).alias("slug"))


@query("op_n3_leading_identifiers", r"""select doc_id, length(regexp_replace(text, '^(?:[a-z0-9:\-]+\s*)+(UNITED STATES|FORM|[A-Z]{3,})', '@NOTE: XBRL context identifiers removed' || chr(10) || chr(10) || '\1')) as n
  from (select doc_id, 'c-1 us-gaap:assets 2023 UNITED STATES ' || text as text from documents)""")
def n3(spark, d):
    # The identifiers are put in front here, so that every document has some to remove.
    t = F.concat(F.lit("c-1 us-gaap:assets 2023 UNITED STATES "), "text")
    return table(spark, d, "documents").select("doc_id", F.length(text.without_leading_identifiers(t)).cast("bigint").alias("n"))


@query("op_proj_readable_concept", r"""select distinct name, array_to_string(list_transform(string_split(regexp_replace(list_extract(string_split(name, ':'), -1), '([a-z])([A-Z])', '\1 \2', 'g'), ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ') as readable from facts""")
def p3(spark, d):
    return table(spark, d, "facts").select("name").distinct().select("name", text.readable_concept(F.col("name")).alias("readable"))


@query("op_proj_money_text", """select l_orderkey, count(*) as n, '$' || replace(format('{:,}', cast(round_even(sum(cast(l_extendedprice as decimal(18,2))), 0) as bigint)), '''', ',') as shown
  from lineitem group by l_orderkey""")
def p6(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    return x.select("l_orderkey", "n", text.money_text(F.col("v")).alias("shown"))


@query("op_proj_shown_value", """with u as (select filing_id, unit_id, min(measure) as measure from units group by all)
  select f.fact_id, case
    when lower(u.measure) like '%shares' and lower(u.measure) not like '%usd%' then f.value || ' shares'
    when lower(u.measure) like '%usd%' and lower(u.measure) not like '%shares%' then
      (case when f.value like '$%' then f.value else '$' || f.value end) || case f.decimals when '-3' then '[K]' when '-6' then '[M]' when '-9' then '[B]' else '' end
    else f.value end as shown
  from facts f left join u on f.filing_id = u.filing_id and f.unitref = u.unit_id""")
def p4(spark, d):
    u = table(spark, d, "units").groupBy("filing_id", F.col("unit_id").alias("unitref")).agg(F.min("measure").alias("measure"))
    f = table(spark, d, "facts").select("fact_id", "filing_id", "unitref", "value", "decimals").join(u, ["filing_id", "unitref"], "left")
    return f.select("fact_id", text.shown_value(F.col("value"), F.col("measure"), F.col("decimals")).alias("shown"))


@query("op_proj_segment_text", r"""select filing_id, pos, context_id, coalesce(nullif(array_to_string(list_sort(list_transform(map_entries(entity.segment), lambda e:
    regexp_replace(list_extract(string_split(e.key, ':'), -1), '(Segment|Dimension|Axis|Member)$', '') || ': ' ||
    regexp_replace(list_extract(string_split(e.value, ':'), -1), '(Segment|Dimension|Axis|Member)$', ''))), ', '), ''), 'Consolidated') as segment from contexts""")
def p5(spark, d):
    return table(spark, d, "contexts").select("filing_id", "pos", "context_id", text.segment_text(F.col("entity.segment")).alias("segment"))


@query("op_proj_header", """select filing_id, concat_ws(chr(10), '@DOCUMENT: ' || upper(trim(company_ticker)), '@TYPE: ' || trim(filing_type), '@PERIOD: ' || cast(period_end_date as varchar),
  '@FISCAL_YEAR: ' || fiscal_year, '@FISCAL_PERIOD: ' || fiscal_period) as header from filings""")
def p7(spark, d):
    tag = lambda t, c: F.concat(F.lit(t), c)
    parts = [tag("@DOCUMENT: ", F.upper(F.trim("company_ticker"))), tag("@TYPE: ", F.trim("filing_type")), tag("@PERIOD: ", F.col("period_end_date").cast("string")), tag("@FISCAL_YEAR: ", F.col("fiscal_year")), tag("@FISCAL_PERIOD: ", F.col("fiscal_period"))]
    return table(spark, d, "filings").select("filing_id", F.concat_ws("\n", *parts).alias("header"))


@query("op_m2_m7_decimals", """select fact_id, case when upper(trim(decimals)) = 'INF' then 'infinite' else cast(try_cast(trim(decimals) as integer) as varchar) end as places,
  case decimals when '0' then 'units' when '-3' then 'thousands' when '-6' then 'millions' when '-9' then 'billions' end as words from facts""")
def m2(spark, d):
    n = text.decimals_number(F.col("decimals"))
    return table(spark, d, "facts").select("fact_id", F.when(n == float("inf"), "infinite").otherwise(n.cast("int").cast("string")).alias("places"), text.decimals_words(F.col("decimals")).alias("words"))


@query("op_m1_canonical_number", r"""with b as (select fact_id, value, decimals, translate(regexp_replace(trim(value), '^\((.*)\)$', '-\1'), '$, ', '') as bare from facts)
  select fact_id, coalesce(case when regexp_full_match(bare, '-?\d+(?:\.\d+)?') then regexp_replace(regexp_replace(cast(try_cast(bare as decimal(38,10)) as varchar), '(\.\d*?)0+$', '\1'), '\.$', '') end, value) as number from b""")
def m1(spark, d):
    return table(spark, d, "facts").select("fact_id", text.canonical_number(F.col("value"), F.col("decimals")).alias("number"))


@query("op_u5_number_tokens", r"""select section_key, len(list_distinct(regexp_extract_all(text_content, '(\d[\d,.]*\d|\d)', 1))) as n_numbers from sections where text_content is not null""")
def u5(spark, d):
    s = table(spark, d, "sections").where("text_content is not null")
    return s.select("section_key", F.size(text.number_tokens(F.col("text_content"))).cast("bigint").alias("n_numbers"))


@query("op_a19_document_stats", r"""select doc_id, case when coalesce(trim(text), '') = '' then 0 else len(string_split_regex(trim(text), '\s+')) end as words, length(text) as chars,
  len(string_split_regex(text, '\n\s*\n')) as paragraphs from documents""")
def a19(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.word_count(t).cast("bigint").alias("words"), F.length(t).cast("bigint").alias("chars"), F.size(F.split(t, r"\n\s*\n")).cast("bigint").alias("paragraphs"))


_DATES = """with v as (select f.fact_id, trim(f.value) as t from facts f join concepts c on f.name = c.name or f.name = c.concept_id where c.type_name = 'xbrli:dateItemType')"""


@query("op_d1_normalised_date", _DATES + r""" select fact_id, coalesce(
   case when regexp_full_match(t, '\d{4}-\d{2}-\d{2}') then cast(try_strptime(t, '%Y-%m-%d') as date) end,
   case when regexp_full_match(t, '\d{8}') then cast(try_strptime(t, '%Y%m%d') as date) end,
   case when regexp_full_match(t, '\d{2}/\d{2}/\d{4}') then cast(try_strptime(t, '%m/%d/%Y') as date) end,
   case when regexp_full_match(t, '\d{4}/\d{2}/\d{2}') then cast(try_strptime(t, '%Y/%m/%d') as date) end,
   case when regexp_full_match(t, '[A-Z][a-z]+ \d{1,2}, \d{4}') then cast(try_strptime(t, '%B %d, %Y') as date) end) as day from v""")
def d1(spark, d):
    c = table(spark, d, "concepts").where("type_name = 'xbrli:dateItemType'").select(F.explode(F.array("name", "concept_id")).alias("name"))
    return table(spark, d, "facts").join(F.broadcast(c), "name", "left_semi").select("fact_id", periods.normalised_date(F.col("value")).alias("day"))


_FYE = "9"


@query("op_d3_rule_fiscal_period", f"""select filing_id, year(period_end_date) + case when (month(period_end_date) > {_FYE} or (month(period_end_date) = {_FYE} and day(period_end_date) >= 26))
    and not (trim(filing_type) = '10-K' and month(period_end_date) = {_FYE} and day(period_end_date) = 26) then 1 else 0 end as fiscal_year,
  case when trim(filing_type) = '10-K' then 'annual' else 'Q' || (case when (month(period_end_date) - {_FYE} + 12) % 12 between 1 and 3 then 1
    when (month(period_end_date) - {_FYE} + 12) % 12 between 4 and 6 then 2 when (month(period_end_date) - {_FYE} + 12) % 12 between 7 and 9 then 3 else 4 end) end as fiscal_period
  from filings where period_end_date is not null""")
def d3(spark, d):
    f = table(spark, d, "filings").where("period_end_date is not null")
    form = F.trim("filing_type")
    return f.select("filing_id", periods.fiscal_year(F.col("period_end_date"), 9, 26, form).cast("bigint").alias("fiscal_year"), periods.fiscal_quarter(F.col("period_end_date"), 9, form).alias("fiscal_period"))


_STANDARD = r"""case when coalesce(t, '') = '' then null
    when t in ('FY','ANNUAL','10-K','YEAR','YR','FINAL','A') then 'annual' when t in ('1','1Q','Q1','QTR1','FIRST','1ST') then 'Q1'
    when t in ('2','2Q','Q2','QTR2','SECOND','2ND') then 'Q2' when t in ('3','3Q','Q3','QTR3','THIRD','3RD') then 'Q3'
    when t in ('4','4Q','Q4','QTR4','FOURTH','4TH') then 'Q4'
    when regexp_extract(t, '^[QTR]*\s*([1-4])', 1) <> '' then 'Q' || regexp_extract(t, '^[QTR]*\s*([1-4])', 1) else t end"""


@query("op_d4_standard_period", f"with s as (select record_id, upper(trim(fiscal_period)) as t from filing_info) select record_id, {_STANDARD} as period from s")
def d4(spark, d):
    return table(spark, d, "filing_info").select("record_id", periods.standard_period(F.col("fiscal_period")).alias("period"))


@query("op_d5_d6_period_dialects", f"""with s as (select record_id, upper(trim(fiscal_period)) as t from filing_info), p as (select record_id, {_STANDARD} as i from s)
  select record_id, i as internal, case when i = 'annual' then 'Q4' else i end as display, i as folder,
    case when i = 'annual' then '4Q' when regexp_full_match(i, 'Q[1-4]') then i[2] || 'Q' else i end as old from p""")
def d5(spark, d):
    f = table(spark, d, "filing_info").select("record_id", periods.standard_period(F.col("fiscal_period")).alias("i"))
    return f.select("record_id", *[periods.period_dialect(F.col("i"), x).alias(x) for x in ("internal", "display", "folder", "old")])


@query("op_d7_d8_quarter_map", """select n_nationkey, m.m as month, 'Q' || cast(((m.m - (n_nationkey % 12 + 1) - 1 + 12) % 12) // 3 + 1 as varchar) as quarter
  from nation, (select unnest(range(1, 13)) as m) m""")
def d7(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.posexplode(periods.quarter_map(F.col("n_nationkey") % 12 + 1)).alias("i", "quarter"))
    return n.select("n_nationkey", (F.col("i") + 1).cast("bigint").alias("month"), "quarter")


@query("op_d9_current_quarter", """select distinct cast(o_orderdate as date) as today, year(o_orderdate) + case when month(o_orderdate) > 6 then 1 else 0 end as fiscal_year,
  ((month(o_orderdate) - 7 + 12) % 12) // 3 + 1 as quarter from orders""")
def d9(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("today")).distinct()
    o = o.withColumn("c", periods.current_fiscal_quarter(F.col("today"), F.lit(6)))
    return o.select("today", F.col("c.fiscal_year").cast("bigint").alias("fiscal_year"), F.col("c.quarter").cast("bigint").alias("quarter"))


@query("op_d10_d11_quarter_months", """with g as (select n_nationkey, n_nationkey % 12 + 1 as fye, q from nation, (select unnest([1, 2, 3, 4]) as q))
  select n_nationkey, q as quarter, (fye + 3 * q - 2 + 11) % 12 + 1 as first_month,
   last_day(make_date(case when (fye + 3 * q - 1) % 12 + 1 <= fye then 2023 else 2022 end, (fye + 3 * q - 1) % 12 + 1, 1)) as ends from g""")
def d10(spark, d):
    g = table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") % 12 + 1).alias("fye"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("q"))
    first = periods.quarter_months(F.col("fye"), F.col("q"))[0]
    return g.select("n_nationkey", F.col("q").alias("quarter"), first.cast("bigint").alias("first_month"), periods.quarter_end(F.col("fye"), F.lit(2023), F.col("q")).alias("ends"))


_SPAN = """with s as (select filing_id, pos, context_id, try_cast(period.startdate as date) as s, try_cast(period.enddate as date) as e, try_cast(period.instant as date) as i from contexts)"""


@query("op_d12_d14_durations", _SPAN + """ select filing_id, pos, context_id, date_diff('day', s, e) as days,
  case when date_diff('day', s, e) between 350 and 380 then 'annual' when date_diff('day', s, e) between 85 and 95 then 'quarter'
   when date_diff('day', s, e) between 175 and 190 then 'six_months' when date_diff('day', s, e) between 265 and 280 then 'nine_months' else 'other' end as category,
  case when date_diff('day', s, e) between 88 and 95 then 'Quarter ' || quarter(e) || ' ' || year(e) when date_diff('day', s, e) between 360 and 371 then 'Annual ' || year(e)
   when date_diff('day', s, e) between 175 and 190 then 'Semi-annual ' || year(e) else 'Period ' || year(e) end as label,
  case when date_diff('day', s, e) between 85 and 95 then 'three months' when date_diff('day', s, e) between 175 and 190 then 'six months'
   when date_diff('day', s, e) between 265 and 280 then 'nine months' end as words from s where s is not null and e is not null""")
def d12(spark, d):
    day = lambda c: F.col(c).try_cast("date")
    c = table(spark, d, "contexts").select("filing_id", "pos", "context_id", day("period.startdate").alias("s"), day("period.enddate").alias("e")).where("s is not null and e is not null")
    days = F.datediff("e", "s")
    return c.select("filing_id", "pos", "context_id", days.cast("bigint").alias("days"), periods.duration_category(days, F.lit("10-Q")).alias("category"), periods.duration_label(F.col("s"), F.col("e")).alias("label"), periods.duration_description(days).alias("words"))


@query("op_d15_d16_context_labels", _SPAN + """ select filing_id, pos, context_id, coalesce(case when date_diff('day', s, e) between 350 and 380 then 'FY' || year(e) else year(e) || '_Q' || quarter(e) end,
   year(i) || case when month(i) = 12 then '_FY_END' else '_Q' || quarter(i) || '_END' end, 'unknown') as label from s""")
def d15(spark, d):
    day = lambda c: F.col(c).try_cast("date")
    label = periods.context_label(day("period.startdate"), day("period.enddate"), day("period.instant"), F.lit("Consolidated"))
    return table(spark, d, "contexts").select("filing_id", "pos", "context_id", label.alias("label"))


_REF = r"""case when regexp_matches({r}, 'C_\d+_(\d{8})_(\d{8})') then struct_pack(i := '', s := regexp_extract({r}, 'C_\d+_(\d{8})_(\d{8})', 1), e := regexp_extract({r}, 'C_\d+_(\d{8})_(\d{8})', 2))
  when regexp_matches({r}, 'C_\d+_(\d{8})$') then struct_pack(i := regexp_extract({r}, 'C_\d+_(\d{8})$', 1), s := '', e := '')
  when regexp_matches({r}, '_D(\d{8})-(\d{8})') then struct_pack(i := '', s := regexp_extract({r}, '_D(\d{8})-(\d{8})', 1), e := regexp_extract({r}, '_D(\d{8})-(\d{8})', 2))
  when regexp_matches({r}, '_I(\d{8})') then struct_pack(i := regexp_extract({r}, '_I(\d{8})', 1), s := '', e := '') end""".replace("{r}", "contextref")
_DASH = "nullif(regexp_replace({c}, '^(\\d{4})(\\d{2})(\\d{2})$', '\\1-\\2-\\3'), '')"


@query("op_d17_context_id_periods", f"with r as (select distinct contextref from facts), p as (select contextref, {_REF} as p from r) select contextref, "
       + ", ".join(f"{_DASH.replace('{c}', 'p.' + a)} as {b}" for a, b in (("i", "instant"), ("s", "startdate"), ("e", "enddate"))) + " from p")
def d17(spark, d):
    r = table(spark, d, "facts").select("contextref").distinct().withColumn("p", periods.context_period(F.col("contextref")))
    return r.select("contextref", "p.instant", "p.startdate", "p.enddate")


@query("op_d18_context_date", f"""with r as (select filing_id, contextref, max(period.enddate) as ends from (select distinct filing_id, contextref from facts) f
    left join contexts c on c.filing_id = f.filing_id and c.context_id = f.contextref group by all), p as (select *, {_REF} as p from r)
  select filing_id, contextref, coalesce(ends, {_DASH.replace('{c}', 'p.i')}, {_DASH.replace('{c}', 'p.e')}, nullif(regexp_extract(contextref, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '')) as day from p""".replace("select filing_id, contextref, max", "select f.filing_id, f.contextref, max"))
def d18(spark, d):
    r = table(spark, d, "facts").select("filing_id", "contextref").distinct()
    c = table(spark, d, "contexts").groupBy("filing_id", F.col("context_id").alias("contextref")).agg(F.max("period.enddate").alias("e"))
    return r.join(c, ["filing_id", "contextref"], "left").select("filing_id", "contextref", periods.context_date(F.col("e"), F.col("contextref")).alias("day"))


@query("op_d22_nearest_quarter_month", """select o_orderkey, (case when month(o_orderdate) <= 4 then 3 when month(o_orderdate) <= 7 then 6 when month(o_orderdate) <= 10 then 9 else 12 end) as month from orders""")
def d22(spark, d):
    return table(spark, d, "orders").select("o_orderkey", periods.nearest_quarter_month(F.month("o_orderdate")).alias("month"))


@query("op_g1_g2_period_formats", r"""select distinct contextref, case when regexp_matches(contextref, 'C_\d+_(\d{8})_(\d{8})') then 'cik_duration' when regexp_matches(contextref, 'C_\d+_(\d{8})$') then 'cik_instant'
   when regexp_matches(contextref, '_D(\d{8})-(\d{8})') then 'duration' when regexp_matches(contextref, '_I(\d{8})') then 'instant' end as format from facts""")
def g1(spark, d):
    return table(spark, d, "facts").select("contextref").distinct().select("contextref", periods.period_format(F.col("contextref")).alias("format"))
