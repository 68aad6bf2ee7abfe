"""Queries over facts, contexts and statements, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.functions import classify
from factloom.functions.classify import CATEGORY_WORDS, NAME_PARTS, ROLE_WORDS, SECTION_WORDS, STATEMENT_WORDS, TOP_LEVEL, alternation
from factloom.operators import facts as ops
from factloom.operators import statements
from factloom.operators.ordered import carried, numbered
from factloom.session import small, table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


_LOCAL = "list_extract(string_split({c}, ':'), -1)"
_SPACED = "lower(regexp_replace(" + _LOCAL + r", '([a-z])([A-Z])', '\1 \2', 'g'))"


def _first(expr: str, classes: dict[str, list[str]], default: str) -> str:
    return "case " + " ".join(f"when regexp_matches({expr}, '{alternation(w)}') then '{k}'" for k, w in classes.items()) + f" else '{default}' end"


def _statement(c: str) -> str:
    return _first(_SPACED.replace("{c}", c), STATEMENT_WORDS, "OTHER")


def _section(c: str, s: str) -> str:
    return "case " + " ".join(f"when {s} = '{k}' then {_first(_SPACED.replace('{c}', c), v, 'OTHER')}" for k, v in SECTION_WORDS.items()) + " else 'OTHER' end"


_CONTEXTS = """c as (select filing_id, context_id, max_by(pos, coalesce(pos, -1)) as cpos, max_by(period, coalesce(pos, -1)) as period from contexts
  where filing_id is not null and context_id is not null group by all)"""
_RANK = "case statement when 'BALANCE_SHEET' then 1 when 'INCOME_STATEMENT' then 2 when 'CASH_FLOW' then 3 when 'EQUITY' then 4 end"


@query("op_j1_facts_with_contexts", f"with {_CONTEXTS} select f.fact_id, c.cpos as context_pos, c.period.instant as instant, c.period.enddate as enddate from facts f left join c on c.filing_id = f.filing_id and c.context_id = f.contextref")
def j1(spark, d):
    out = ops.with_context(table(spark, d, "facts").select("fact_id", "filing_id", "contextref"), table(spark, d, "contexts"))
    return out.select("fact_id", "context_pos", "period.instant", "period.enddate")


@query("op_proj_dated_facts", f"""with {_CONTEXTS} select f.fact_id, case when c.period.instant is not null then 'INSTANT' else 'DURATION' end as date_type from facts f
  join c on c.filing_id = f.filing_id and c.context_id = f.contextref where c.period.instant is not null or c.period.enddate is not null""")
def p2(spark, d):
    return ops.dated(table(spark, d, "facts").select("fact_id", "filing_id", "contextref"), table(spark, d, "contexts")).select("fact_id", "date_type")


@query("op_proj_reshaped_facts", "select fact_id, name as concept, value, contextref as context_ref, unitref as unit_ref, scale, decimals from facts")
def p1(spark, d):
    return table(spark, d, "facts").select("fact_id", F.col("name").alias("concept"), "value", F.col("contextref").alias("context_ref"), F.col("unitref").alias("unit_ref"), "scale", "decimals")


@query("op_f2_standard_prefixes", "select fact_id from facts where split_part(name, ':', 1) in ('us-gaap', 'ifrs-full', 'gaap', 'ifrs') and contains(name, ':')")
def f2(spark, d):
    return table(spark, d, "facts").where(ops.prefix(F.col("name")).isin("us-gaap", "ifrs-full", "gaap", "ifrs")).select("fact_id")


@query("op_f3_f5_populated_contexts", "select filing_id, contextref, count(*) as n, count(*) >= 10 as ten from facts group by all having count(*) >= 3")
def f3(spark, d):
    n = table(spark, d, "facts").groupBy("filing_id", "contextref").agg(F.count("*").alias("n"))
    return n.where("n >= 3").withColumn("ten", F.col("n") >= 10)


@query("op_f4_worthwhile_tables", """select filing_id, count(distinct contextref) as contexts, count(distinct name) as concepts from facts group by 1
  having count(distinct contextref) >= 2 and count(distinct name) >= 3""")
def f4(spark, d):
    n = table(spark, d, "facts").groupBy("filing_id").agg(F.countDistinct("contextref").alias("contexts"), F.countDistinct("name").alias("concepts"))
    return n.where("contexts >= 2 and concepts >= 3")


@query("op_f6_w4_first_paragraphs", r"""with p as (select doc_id, unnest(string_split_regex(text, '\n\s*\n')) as t, generate_subscripts(string_split_regex(text, '\n\s*\n'), 1) as i from documents)
  select doc_id, i, rn, md5(t) as h from (select *, row_number() over (partition by doc_id order by i) as rn from p where length(t) >= 100 and not contains(t, '|')) where rn <= 5""")
def f6(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", r"\n\s*\n")).alias("i", "t"))
    p = p.where((F.length("t") >= 100) & ~F.contains("t", F.lit("|")))
    p = p.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("i"))).where("rn <= 5")
    return p.select("doc_id", (F.col("i") + 1).cast("bigint").alias("i"), F.col("rn").cast("bigint").alias("rn"), F.md5("t").alias("h"))


@query("op_f1_f8_headings", "select section_key, trim(heading) as heading from sections where length(trim(heading)) between 6 and 99")
def f8(spark, d):
    h = F.trim("heading")
    return table(spark, d, "sections").where(F.length(h).between(6, 99)).select("section_key", h.alias("heading"))


@query("op_a1_a2_grouped_facts", """select fact_id, filing_id, contextref, case when contains(name, ':') then split_part(name, ':', 1) else '' end as prefix,
  row_number() over (partition by filing_id, contextref, case when contains(name, ':') then split_part(name, ':', 1) else '' end order by pos, fact_id) as place from facts""")
def a1(spark, d):
    f = table(spark, d, "facts").select("fact_id", "filing_id", "contextref", "pos", ops.prefix(F.col("name")).alias("prefix"))
    return numbered(f, ["filing_id", "contextref", "prefix"], ["pos", "fact_id"], "place").drop("pos")


@query("op_a3_modal_decimals", """with n as (select filing_id, decimals, count(*) as n, min(pos) as p from facts where decimals is not null group by all)
  select filing_id, decimals, n from (select *, row_number() over (partition by filing_id order by n desc, p, decimals desc) as rn from n) where rn = 1""")
def a3(spark, d):
    return ops.modal_decimals(table(spark, d, "facts"))


@query("op_a4_primary_statements", f"""with n as (select filing_id, contextref, {_statement('name')} as statement, count(*) as n from facts group by all)
  select filing_id, contextref, statement, n from (select *, row_number() over (partition by filing_id, contextref order by n desc, {_RANK}) as rn from n where statement <> 'OTHER') where rn = 1""")
def a4(spark, d):
    return statements.primary_statements(table(spark, d, "facts"))


_NUM = "try_cast(replace(value, ',', '') as double)"


def _order_facts(spark, d):
    money = lambda e: F.sum(e).cast("decimal(18,4)")
    x = lambda c: F.col(c).cast("decimal(12,2)")
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        money(x("l_extendedprice")).alias("assets"), money((x("l_extendedprice") * (1 - x("l_discount"))).cast("decimal(18,4)")).alias("liabilities"),
        money((x("l_extendedprice") * x("l_discount")).cast("decimal(18,4)")).alias("equity"))
    return li


_ORDER = """select l_orderkey, sum(cast(l_extendedprice as decimal(12,2))) as assets, sum(cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(12,2))) as decimal(18,4))) as liabilities,
  sum(cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(12,2)) as decimal(18,4))) as equity from lineitem group by 1"""


@query("op_m3_identity", f"""with b as ({_ORDER}) select o.o_orderkey, b.l_orderkey is not null as has_lines, abs(assets - liabilities - equity) <= greatest(assets, liabilities + equity) * 0.001 as balanced,
  abs(cast(o.o_totalprice as decimal(18,4)) - b.assets) <= greatest(cast(o.o_totalprice as decimal(18,4)), b.assets) * 0.001 as total_agrees from orders o left join b on o.o_orderkey = b.l_orderkey""")
def m3(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,4)").alias("t")).join(_order_facts(spark, d), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    near = lambda a, b: F.abs(a - b) <= F.greatest(a, b) * F.lit(0.001).cast("decimal(4,3)")
    return o.select("o_orderkey", F.col("l_orderkey").isNotNull().alias("has_lines"), near(F.col("assets"), F.col("liabilities") + F.col("equity")).alias("balanced"), near(F.col("t"), F.col("assets")).alias("total_agrees"))


_BS_KEYS = {"assets": "Assets", "liabilities": "Liabilities", "equity": "StockholdersEquity", "minority": "MinorityInterest"}
_BS = "with v as (select filing_id, contextref, replace(name, 'us-gaap_', 'us-gaap:') as concept, " + _NUM + " as v, pos, fact_id from facts), l as (select filing_id, contextref, concept, arg_max(v, (pos, fact_id)) as v from v where v is not null and concept in (" + ", ".join(f"'us-gaap:{c}'" for c in _BS_KEYS.values()) + ") group by all) select filing_id, contextref, "


def _sheet_rows(spark, d):
    f = table(spark, d, "facts")
    return f.select("filing_id", "contextref", F.replace("name", F.lit("us-gaap_"), F.lit("us-gaap:")).alias("concept"), F.replace("value", F.lit(","), F.lit("")).try_cast("double").alias("value"), "pos", "fact_id").where("value is not null")


@query("op_a6_balance_sheet_zero", _BS + ", ".join(f"coalesce(max(v) filter (concept = 'us-gaap:{c}'), 0) as {k}" for k, c in _BS_KEYS.items())
       + ", coalesce(max(v) filter (concept = 'us-gaap:Liabilities'), 0) + coalesce(max(v) filter (concept = 'us-gaap:StockholdersEquity'), 0) + coalesce(max(v) filter (concept = 'us-gaap:MinorityInterest'), 0) as total from l group by all")
def a6(spark, d):
    return statements.balance_sheets(_sheet_rows(spark, d), ["filing_id", "contextref"], zero=True)


@query("op_t24_balance_sheet_rows", _BS.rsplit("select filing_id, contextref, ", 1)[0] + """select filing_id, contextref, concept, v as value from l where concept <> 'us-gaap:MinorityInterest' or v <> 0""")
def t24(spark, d):
    b = statements.balance_sheets(_sheet_rows(spark, d), ["filing_id", "contextref"])
    rows = statements.unpivoted(b.select("filing_id", "contextref", *_BS_KEYS), ["filing_id", "contextref"], list(_BS_KEYS), "line", "value")
    named = F.coalesce(*[F.when(F.col("line") == k, f"us-gaap:{c}") for k, c in _BS_KEYS.items()])
    return rows.where((F.col("line") != "minority") | (F.col("value") != 0)).select("filing_id", "contextref", named.alias("concept"), "value")


@query("op_a16_mode_format", """with n as (select company_ticker, format, count(*) as n from facts where format is not null group by all)
  select company_ticker, format, n from (select *, row_number() over (partition by company_ticker order by n desc, format) as rn from n) where rn = 1""")
def a16(spark, d):
    return ops.most_reported(table(spark, d, "facts").where("format is not null"), ["company_ticker"], "format", 1).drop("rank")


@query("op_w1_context_codes", f"with {_CONTEXTS} select filing_id, context_id, 'c-' || row_number() over (partition by filing_id order by cpos, context_id) as code from c")
def w1(spark, d):
    return ops.context_codes(table(spark, d, "contexts")).select("filing_id", "context_id", "code")


@query("op_w2_period_codes", f"""with {_CONTEXTS}, k as (select *, case when period.instant is not null then 'I' when period.startdate is not null then 'P' end as kind from c)
  select filing_id, context_id, kind || row_number() over (partition by filing_id, kind order by coalesce(period.instant, period.startdate), cpos, context_id) as code from k where kind is not null""")
def w2(spark, d):
    return ops.period_codes(table(spark, d, "contexts")).select("filing_id", "context_id", "code")


@query("op_w3_dense_codes", "select distinct filing_id, contextref, dense_rank() over (partition by filing_id order by contextref) as code from facts")
def w3(spark, d):
    return numbered(table(spark, d, "facts").select("filing_id", "contextref").distinct(), ["filing_id"], ["contextref"], "code")


@query("op_w5_originals_first", """select record_id, row_number() over (partition by cik order by coalesce(is_amended, false), filing_date, record_id) as rn from filing_info""")
def w5(spark, d):
    i = table(spark, d, "filing_info").select("record_id", "cik", F.coalesce("is_amended", F.lit(False)).alias("amended"), "filing_date")
    # SQL puts nulls last, ranges put them first.
    i = i.withColumn("undated", F.col("filing_date").isNull())
    return numbered(i, ["cik"], ["amended", "undated", "filing_date", "record_id"]).select("record_id", "rn")


@query("op_w6_t11_next_section", """select section_key, coalesce(lead(pos) over (partition by filing_id order by pos, section_key), -1) as next_pos from sections""")
def w6(spark, d):
    return ops.with_next(table(spark, d, "sections").select("section_key", "filing_id", "pos"), ["filing_id"], ["pos", "section_key"], "pos", "next_pos").select("section_key", F.coalesce("next_pos", F.lit(-1)).alias("next_pos"))


@query("op_w7_carry_forward", """select fact_id, last_value(caption ignore nulls) over (partition by filing_id order by pos, fact_id rows between unbounded preceding and current row) as caption from facts""")
def w7(spark, d):
    f = table(spark, d, "facts").select("fact_id", "filing_id", "pos", "caption")
    return carried(f, ["filing_id"], ["pos", "fact_id"], "caption", "carried").select("fact_id", F.col("carried").alias("caption"))


@query("op_o1_o5_ordered_contexts", f"""with {_CONTEXTS}, n as (select filing_id, contextref, count(*) as n from facts group by all)
  select n.filing_id, n.contextref, row_number() over (partition by n.filing_id order by n.n desc, n.contextref) as by_count,
   row_number() over (partition by n.filing_id order by coalesce(replace(coalesce(c.period.instant, c.period.enddate), '-', ''), 'Z'), n.contextref) as by_date,
   row_number() over (partition by n.filing_id order by coalesce(replace(coalesce(c.period.instant, c.period.enddate), '-', ''), '') desc, n.contextref desc) as latest
  from n left join c on c.filing_id = n.filing_id and c.context_id = n.contextref""")
def o1(spark, d):
    n = table(spark, d, "facts").groupBy("filing_id", "contextref").agg(F.count("*").alias("n"))
    c = ops.with_context(n, table(spark, d, "contexts"))
    key = F.replace(F.coalesce("period.instant", "period.enddate"), F.lit("-"), F.lit(""))
    c = c.select("filing_id", "contextref", "n", F.coalesce(key, F.lit("Z")).alias("early"), F.coalesce(key, F.lit("")).alias("late"))
    for name, order in (("by_count", [F.desc("n"), "contextref"]), ("by_date", ["early", "contextref"]), ("latest", [F.desc("late"), F.desc("contextref")])):
        c = numbered(c, ["filing_id"], order, name)
    return c.select("filing_id", "contextref", "by_count", "by_date", "latest")


@query("op_o3_o8_row_order", r"""with r as (select distinct filing_id, name, regexp_matches(lower(regexp_replace(list_extract(string_split(name, ':'), -1), '([a-z])([A-Z])', '\1 \2', 'g')), 'total|^(?:gross|net|operating|consolidated)') as total from facts)
  select filing_id, name, row_number() over (partition by filing_id order by not total, name) as rn from r""")
def o3(spark, d):
    r = table(spark, d, "facts").select("filing_id", "name").distinct().withColumn("total", classify.is_total(classify.spaced_name(F.col("name"))))
    r = r.select("filing_id", "name", (~F.col("total")).alias("part"), F.col("name").isNull().alias("unnamed"))
    return numbered(r, ["filing_id"], ["part", "unnamed", "name"]).select("filing_id", "name", "rn")


@query("op_o9_latest_upload", "select company_ticker, max_by(filing_id, (upload_date, filing_id)) as filing_id from filings where upload_date is not null group by 1")
def o9(spark, d):
    f = table(spark, d, "filings").where("upload_date is not null")
    return f.groupBy("company_ticker").agg(F.max_by("filing_id", F.struct("upload_date", "filing_id")).alias("filing_id"))


@query("op_u3_j9_concept_sets", """select 'reported_only' as side, count(*) as n from (select name from facts except select name from concepts) union all
  select 'dictionary_only', count(*) from (select name from concepts except select name from facts) union all
  select 'both', count(*) from (select name from facts intersect select name from concepts) union all
  select 'both_local', count(*) from (select list_extract(string_split(name, ':'), -1) from facts intersect select list_extract(string_split(name, ':'), -1) from concepts)""")
def u3(spark, d):
    f, c = table(spark, d, "facts").select("name"), table(spark, d, "concepts").select("name")
    local = lambda x: x.select(F.element_at(F.split("name", ":"), -1).alias("name"))
    side = lambda n, x: x.agg(F.lit(n).alias("side"), F.count("*").alias("n"))
    return side("reported_only", f.subtract(c)).unionByName(side("dictionary_only", c.subtract(f))).unionByName(side("both", f.intersect(c))).unionByName(side("both_local", local(f).intersect(local(c))))


@query("op_u4_context_union", "select filing_id, contextref from facts union select filing_id, context_id from contexts")
def u4(spark, d):
    return table(spark, d, "facts").select("filing_id", "contextref").union(table(spark, d, "contexts").select("filing_id", "context_id")).distinct()


@query("op_j4_a11_completeness", """with a as (select filing_id, name, contextref, coalesce(unitref, '') as u, arg_max(coalesce(value, ''), fact_id) as v from facts where feed = 'inline' group by all),
   b as (select filing_id, name, contextref, coalesce(unitref, '') as u, arg_max(coalesce(value, ''), fact_id) as v from facts where feed = 'instance' group by all)
  select coalesce(a.filing_id, b.filing_id) as filing_id, count(*) filter (a.v = b.v) as matched, count(*) filter (a.v <> b.v) as mismatched, count(*) filter (b.v is null) as missing,
   count(*) filter (a.v is null) as extra, coalesce(100.0 * count(*) filter (a.v = b.v) / nullif(count(a.v), 0), 0) as pct
  from a full join b on a.filing_id = b.filing_id and a.name = b.name and a.contextref = b.contextref and a.u = b.u group by 1""")
def j4(spark, d):
    def side(feed: str, v: str):
        f = table(spark, d, "facts").where(F.col("feed") == feed)
        return f.groupBy("filing_id", "name", "contextref", F.coalesce("unitref", F.lit("")).alias("u")).agg(F.max_by(F.coalesce("value", F.lit("")), "fact_id").alias(v))

    both = side("inline", "a").join(side("instance", "b"), ["filing_id", "name", "contextref", "u"], "full_outer")
    n = F.count_if(F.col("a") == F.col("b"))
    pct = F.coalesce(F.lit(100.0) * n / F.nullif(F.count("a"), F.lit(0)), F.lit(0.0))
    return both.groupBy("filing_id").agg(n.alias("matched"), F.count_if(F.col("a") != F.col("b")).alias("mismatched"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"), pct.alias("pct"))


@query("op_j5_second_chance", """select a.fact_id from facts a where a.feed = 'viewer' and exists (select 1 from facts b where b.feed = 'inline' and b.filing_id = a.filing_id and b.name = a.name
   and replace(b.value, ',', '') = replace(a.value, ',', ''))""")
def j5(spark, d):
    f = table(spark, d, "facts")
    v = F.replace("value", F.lit(","), F.lit("")).alias("v")
    return f.where("feed = 'viewer'").select("fact_id", "filing_id", "name", v).join(f.where("feed = 'inline'").select("filing_id", "name", v), ["filing_id", "name", "v"], "left_semi").select("fact_id")


@query("op_j3_key_spellings", """select f.fact_id from facts f where exists (select 1 from concepts c where c.period_type = 'instant' and f.name in (c.name, c.concept_id, list_extract(string_split(c.name, ':'), -1)))""")
def j3(spark, d):
    c = table(spark, d, "concepts").where("period_type = 'instant'")
    keys = c.select(F.explode(F.array("name", "concept_id", F.element_at(F.split("name", ":"), -1))).alias("name"))
    return table(spark, d, "facts").join(small(keys), "name", "left_semi").select("fact_id")


@query("op_j8_d2_d20_calendar", """with cal as (select upper(trim(company_ticker)) as t, period_end_date as e, max(fiscal_year) as fy, max(fiscal_period) as fp from filings where period_end_date is not null group by all),
   r as (select record_id, upper(trim(ticker)) as t, try_cast(period_end_date as date) as e, filing_type from filing_info)
  select r.record_id, cal.fy as fiscal_year, coalesce(cal.fp, case when trim(r.filing_type) = '10-K' then 'annual' else 'Q?' end) as fiscal_period, cal.e is not null as in_calendar
  from r left join cal on r.t = cal.t and r.e = cal.e""")
def j8(spark, d):
    t = lambda c: F.upper(F.trim(c)).alias("t")
    cal = table(spark, d, "filings").where("period_end_date is not null").groupBy(t("company_ticker"), F.col("period_end_date").alias("e")).agg(F.max("fiscal_year").alias("fiscal_year"), F.max("fiscal_period").alias("fp"), F.lit(True).alias("known"))
    r = table(spark, d, "filing_info").select("record_id", t("ticker"), F.col("period_end_date").try_cast("date").alias("e"), "filing_type").join(cal, ["t", "e"], "left")
    default = F.when(F.trim("filing_type") == "10-K", "annual").otherwise("Q?")
    return r.select("record_id", "fiscal_year", F.coalesce("fp", default).alias("fiscal_period"), F.coalesce("known", F.lit(False)).alias("in_calendar"))


@query("op_f9_j10_j12_nearest_period", """with t as (select distinct company_ticker, make_date(cast(fiscal_year as integer), m, 1) as target from filings, (select unnest([3, 6, 9, 12]) as m) where regexp_full_match(fiscal_year, '20\\d\\d')),
   p as (select t.company_ticker, t.target, f.filing_id, abs((year(f.period_end_date) - year(t.target)) * 12 + month(f.period_end_date) - month(t.target)) as gap, f.period_end_date as e
    from t join filings f on f.company_ticker = t.company_ticker and f.period_end_date between t.target - interval 1 month and last_day(t.target + interval 1 month))
  select company_ticker, target, filing_id, gap from (select *, row_number() over (partition by company_ticker, target order by gap, e, filing_id) as rn from p) where rn = 1""")
def f9(spark, d):
    f = table(spark, d, "filings")
    t = f.where(F.col("fiscal_year").rlike(r"^20\d\d$")).select("company_ticker", F.col("fiscal_year").cast("int").alias("y")).distinct()
    t = t.select(F.col("company_ticker").alias("t"), F.explode(F.transform(F.array(*map(F.lit, (3, 6, 9, 12))), lambda m: F.make_date(F.col("y"), m, F.lit(1)))).alias("target"))
    # Months within one of each other meet by equality of the month, so a hot ticker joins by ticker and month.
    months = lambda c: F.year(c) * 12 + F.month(c)
    at = f.where("period_end_date is not null").select("company_ticker", "filing_id", "period_end_date", F.explode(F.sequence(months("period_end_date") - 1, months("period_end_date") + 1)).alias("month"))
    p = t.withColumn("month", months("target")).join(at.withColumnRenamed("company_ticker", "t"), ["t", "month"])
    gap = F.abs(months("period_end_date") - F.col("month")).cast("bigint")
    best = F.min(F.struct(gap.alias("gap"), "period_end_date", "filing_id")).alias("best")
    return p.groupBy(F.col("t").alias("company_ticker"), "target").agg(best).select("company_ticker", "target", "best.filing_id", "best.gap")


@query("op_l1_l2_statement_and_section", f"with s as (select distinct name, {_statement('name')} as statement from facts) select name, statement, {_section('name', 'statement')} as section from s")
def l1(spark, d):
    s = table(spark, d, "facts").select("name").distinct().withColumn("statement", classify.statement_type(F.col("name")))
    return s.withColumn("section", classify.statement_section(F.col("name"), F.col("statement")))


@query("op_l3_t2_t26_organised", f"""with n as (select filing_id, contextref, {_statement('name')} as statement, count(*) as n from facts group by all),
   p as (select filing_id, contextref, statement from (select *, row_number() over (partition by filing_id, contextref order by n desc, {_RANK}) as rn from n where statement <> 'OTHER') where rn = 1),
   s as (select f.*, case when {_statement('f.name')} = 'OTHER' then coalesce(p.statement, 'OTHER') else {_statement('f.name')} end as statement from facts f left join p using (filing_id, contextref))
  select filing_id, statement, {_section('name', 'statement')} as section, count(*) as n from s group by all""")
def l3(spark, d):
    return statements.organised(table(spark, d, "facts").select("filing_id", "contextref", "name")).groupBy("filing_id", "statement", "section").agg(F.count("*").alias("n"))


@query("op_l4_l6_l7_l15_by_name", "select distinct name, " + _first(_LOCAL.replace("{c}", "name"), NAME_PARTS, "Unknown") + " as statement, case "
       + " ".join(f"when name in ({', '.join(chr(39) + c + chr(39) for c in cs)}) then '{k}'" for k, cs in TOP_LEVEL.items()) + " end as heads from facts")
def l4(spark, d):
    return table(spark, d, "facts").select("name").distinct().select("name", classify.statement_of_name(F.col("name")).alias("statement"), classify.top_level(F.col("name")).alias("heads"))


@query("op_l5_l11_l14_by_role", "select distinct section_id, " + _first("lower(replace(section_id, '_', ' '))", ROLE_WORDS, "Unknown") + " as statement from sections")
def l5(spark, d):
    return table(spark, d, "sections").select("section_id").distinct().select("section_id", classify.statement_of_role(F.replace("section_id", F.lit("_"), F.lit(" "))).alias("statement"))


@query("op_l8_l9_categories", "select distinct name, " + _first(_SPACED.replace("{c}", "name"), CATEGORY_WORDS, "Other") + " as category from facts")
def l9(spark, d):
    return table(spark, d, "facts").select("name").distinct().select("name", classify.row_category(F.col("name")).alias("category"))


@query("op_l17_context_statements", "select filing_id, contextref, bool_or(contains(lower(name), 'asset')) as balance, bool_or(contains(lower(name), 'revenue')) as income from facts group by all")
def l17(spark, d):
    return classify.context_statements(table(spark, d, "facts"))


@query("op_t3_t4_pivot", """select filing_id, name, coalesce(max(value) filter (feed = 'exhibit'), '-') as exhibit, coalesce(max(value) filter (feed = 'inline'), '-') as inline,
   coalesce(max(value) filter (feed = 'instance'), '-') as instance, coalesce(max(value) filter (feed = 'viewer'), '-') as viewer from facts group by all""")
def t3(spark, d):
    return statements.pivoted(table(spark, d, "facts"), ["filing_id", "name"], "feed", ["exhibit", "inline", "instance", "viewer"], F.col("value"))


@query("op_t5_t6_long_rows", f"""select f.fact_id, {_statement('name')} || '|' || name || '|' || coalesce(value, '-') || '|' || contextref as line from facts f where contains(name, ':')""")
def t5(spark, d):
    # As its SQL: only the facts named with a prefix; the next query has all.
    return _long_rows(table(spark, d, "facts").where(F.contains("name", F.lit(":"))))


@query("op_t5_t6_all_long_rows", f"""select f.fact_id, {_statement('name')} || '|' || coalesce(name, '') || '|' || coalesce(value, '-') || '|' || coalesce(contextref, '') as line from facts f""")
def t5_all(spark, d):
    return _long_rows(table(spark, d, "facts"))


def _long_rows(facts):
    e = lambda c: F.coalesce(c, F.lit(""))
    return facts.select("fact_id", F.concat_ws("|", classify.statement_type(F.col("name")), e("name"), F.coalesce("value", F.lit("-")), e("contextref")).alias("line"))


@query("op_n10_unpivot", """select l_orderkey, l_partkey, l_suppkey, l_linenumber, measure, value from (unpivot (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem)
   on l_quantity, l_extendedprice, l_discount, l_tax into name measure value value)""")
def n10(spark, d):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return statements.unpivoted(table(spark, d, "lineitem"), keys, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "measure", "value")


@query("op_m6_first_value", "select filing_id, name, contextref, arg_min(value, (pos, fact_id)) as value from facts where value is not null group by all")
def m6(spark, d):
    return ops.first_value(table(spark, d, "facts").where("value is not null"))


@query("op_t3_last_value", "select filing_id, name, contextref, arg_max(value, (pos, fact_id)) as value from facts where value is not null group by all")
def last(spark, d):
    return ops.last_value(table(spark, d, "facts").where("value is not null"))


@query("op_s30_latest_per_type", """select company_ticker, filing_type, filing_id from (select *, row_number() over (partition by company_ticker, filing_type order by filing_date desc nulls last, filing_id desc) as rn from filings) where rn = 1""")
def s30(spark, d):
    return ops.latest_filings(table(spark, d, "filings"), ["company_ticker", "filing_type"])


@query("op_s28_cik_lookup", "select f.record_id, m.cik as looked_up from filing_info f left join (select upper(trim(company_ticker)) as t, min(cik) as cik from filings where company_ticker is not null group by 1) m on m.t = upper(trim(f.ticker))")
def s28(spark, d):
    m = table(spark, d, "filings").where("company_ticker is not null").groupBy(F.upper(F.trim("company_ticker")).alias("t")).agg(F.min("cik").alias("looked_up"))
    return table(spark, d, "filing_info").select("record_id", F.upper(F.trim("ticker")).alias("t")).join(m, "t", "left").select("record_id", "looked_up")


@query("op_s29_date_range", "select filing_id from filings where filing_date between date '2018-01-01' and date '2020-12-31'")
def s29(spark, d):
    return table(spark, d, "filings").where("filing_date between date'2018-01-01' and date'2020-12-31'").select("filing_id")


@query("op_s31_metadata_cascade", r"""select record_id, coalesce(try_cast(period_end_date as date), try_cast(regexp_replace(regexp_extract(primary_doc_name, '(\d{8})', 1), '^(\d{4})(\d{2})(\d{2})$', '\1-\2-\3') as date), try_cast(filing_date as date)) as period_end from filing_info""")
def s31(spark, d):
    named = F.regexp_replace(F.regexp_extract("primary_doc_name", r"(\d{8})", 1), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")
    return table(spark, d, "filing_info").select("record_id", F.coalesce(F.col("period_end_date").try_cast("date"), named, F.col("filing_date").try_cast("date")).alias("period_end"))


@query("op_k3_k6_j13_catalogue_diff", """select filing_id, 'no_facts' as status from filings f where not exists (select 1 from facts x where x.filing_id = f.filing_id)
  union all select distinct filing_id, 'not_catalogued' from facts x where not exists (select 1 from filings f where f.filing_id = x.filing_id)""")
def k6(spark, d):
    c, f = table(spark, d, "filings").select("filing_id"), table(spark, d, "facts").select("filing_id").distinct()
    return c.join(f, "filing_id", "left_anti").withColumn("status", F.lit("no_facts")).unionByName(f.join(c, "filing_id", "left_anti").withColumn("status", F.lit("not_catalogued")))


@query("op_k4_r8_upsert", """with u as (select filing_id, company_name, upload_date, 0 as new from filings union all select filing_id, company_name || ' (updated)', upload_date + interval 1 day, 1 from filings where fiscal_period = 'Q1')
  select filing_id, company_name from (select *, row_number() over (partition by filing_id order by new desc, upload_date desc nulls last) as rn from u) where rn = 1""")
def k4(spark, d):
    from factloom.operators.catalogue import upsert

    base = table(spark, d, "filings").select("filing_id", "company_name", "upload_date")
    changes = table(spark, d, "filings").where("fiscal_period = 'Q1'").select("filing_id", F.concat("company_name", F.lit(" (updated)")).alias("company_name"), (F.col("upload_date") + F.expr("interval 1 day")).alias("upload_date"))
    return upsert(base, changes, ["filing_id"], "upload_date").select("filing_id", "company_name")


@query("op_k8_odd_directories", r"select record_id from filing_info where regexp_matches(split_part(documents_url, '/', 5), '^\d+$') and not regexp_full_match(split_part(documents_url, '/', 5), '20\d\d')")
def k8(spark, d):
    part = F.split_part("documents_url", F.lit("/"), F.lit(5))
    return table(spark, d, "filing_info").where(part.rlike(r"^\d+$") & ~part.rlike(r"^20\d\d$")).select("record_id")


@query("op_c1_filing_grid", """select n_nationkey, y as fiscal_year, q as quarter, case when q = 4 then '10-K' else '10-Q' end as form from nation, (select unnest(range(2021, 2025)) as y), (select unnest([1, 2, 3, 4]) as q)""")
def c1(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(2021), F.lit(2024))).alias("fiscal_year"))
    n = n.withColumn("quarter", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    return n.withColumn("form", F.when(F.col("quarter") == 4, "10-K").otherwise("10-Q"))


@query("op_r1_context_dictionary", f"""with {_CONTEXTS}, k as (select *, row_number() over (partition by filing_id order by cpos, context_id) as rn from c)
  select filing_id, 'c-' || rn as code, context_id, coalesce(period.instant, period.enddate) as ends, case when period.instant is not null then 'instant' when period.enddate is not null then 'duration' else 'unknown' end as type from k""")
def r1(spark, d):
    k = ops.context_codes(table(spark, d, "contexts"))
    kind = F.when(F.col("period.instant").isNotNull(), "instant").when(F.col("period.enddate").isNotNull(), "duration").otherwise("unknown")
    return k.select("filing_id", "code", "context_id", F.coalesce("period.instant", "period.enddate").alias("ends"), kind.alias("type"))


@query("op_r2_r3_dimensions", r"""select filing_id, pos, context_id, list_extract(string_split(e.key, ':'), -1) as dimension, list_extract(string_split(e.value, ':'), -1) as member
  from (select filing_id, pos, context_id, unnest(map_entries(entity.segment)) as e from contexts)""")
def r2(spark, d):
    c = table(spark, d, "contexts").select("filing_id", "pos", "context_id", F.explode("entity.segment").alias("k", "v"))
    local = lambda x: F.element_at(F.split(x, ":"), -1)
    return c.select("filing_id", "pos", "context_id", local("k").alias("dimension"), local("v").alias("member"))


@query("op_r5_quarantine", """select filing_id, case when fiscal_year is null or not regexp_full_match(fiscal_year, '\\d{4}') then 'fiscal_year' when period_end_date is null then 'period_end_date'
  when filing_date < period_end_date then 'filed_before_end' end as reason from filings""")
def r5(spark, d):
    bad = F.when(~F.coalesce(F.col("fiscal_year").rlike(r"^\d{4}$"), F.lit(False)), "fiscal_year").when(F.col("period_end_date").isNull(), "period_end_date").when(F.col("filing_date") < F.col("period_end_date"), "filed_before_end")
    return table(spark, d, "filings").select("filing_id", bad.alias("reason"))


@query("op_r6_known_fields", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def r6(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("op_r9_g3_format_rules", "select record_id, case when primary_doc_name like '%.xml' then 'instance' when primary_doc_name like '%.htm%' then 'inline' else 'standard' end as format from filing_info")
def r9(spark, d):
    n = F.col("primary_doc_name")
    return table(spark, d, "filing_info").select("record_id", F.when(n.endswith(".xml"), "instance").when(F.contains(n, F.lit(".htm")), "inline").otherwise("standard").alias("format"))


@query("op_r4_json_documents", f"""select filing_id, {_statement('name')} as statement, row_number() over (partition by filing_id, {_statement('name')} order by pos, fact_id) as place,
  json_object('name', name, 'contextref', contextref, 'value', value)::varchar as line from facts""")
def r4(spark, d):
    # A document is its lines in order: it is never one value, however large.
    f = statements.classified(table(spark, d, "facts").select("fact_id", "filing_id", "name", "contextref", "value", "pos"))
    f = f.withColumn("line", F.to_json(F.struct("name", "contextref", "value"), {"ignoreNullFields": "false"}))
    return numbered(f, ["filing_id", "statement"], ["pos", "fact_id"], "place").select("filing_id", "statement", "place", "line")
