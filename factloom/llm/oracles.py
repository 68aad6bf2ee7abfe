"""SQL for a second engine, of the corpus queries that SQL can state on whole tables."""

from __future__ import annotations

from factloom.llm.segments import ABBREVIATIONS

P2_FOUND = r"""
with keyed as (
  select f.*, coalesce(
      nullif(regexp_extract(f.accession_number, '(\d{1,10})[^0-9](\d{2})[^0-9](\d{6})', 1), ''), '') as a,
    case when f.accession_number is null then f.documents_url else f.accession_number end as src
  from filing_info f),
parts as (
  select *, regexp_extract(src, '(\d{1,10})[^0-9](\d{2})[^0-9](\d{6})', ['a', 'b', 'c']) as p,
    regexp_extract(src, '(\d{10})(\d{2})(\d{6})', ['a', 'b', 'c']) as q
  from (select * exclude (src), case when accession_number is null then regexp_extract(documents_url, '([^/]*)$', 1) else src end as src from keyed)),
ided as (
  select *, case when p.a <> '' then lpad(p.a, 10, '0') || '-' || p.b || '-' || p.c
    when q.a <> '' then q.a || '-' || q.b || '-' || q.c end as filing_id
  from parts),
ranked as (
  select i.filing_id, i.record_id, i.captured_at, i.is_amended, coalesce(c.trust_rank, 2147483647) as trust,
    regexp_replace(regexp_replace(upper(i.original_filing_type), '[\s.\-_]', '', 'g'), '^FORM', '') as form,
    try_cast(regexp_extract(lower(trim(i.fiscal_year)), '^(?:fy|fiscal)?\s*(\d{4})(?:\.0*)?$', 1) as integer) as fy,
    upper(regexp_replace(trim(i.fiscal_period), '[\s\-]|20\d\d$', '', 'g')) as fp
  from ided i left join (
    select replace(replace(lower(trim(channel)), '-', ''), '_', '') as k, min(trust_rank) as trust_rank from capture_channels group by 1) c
    on c.k = replace(replace(lower(trim(i.capture_channel)), '-', ''), '_', '')
  where i.filing_id is not null),
several as (select filing_id from ranked group by filing_id having count(*) >= 2),
usable as (
  select filing_id, 'is_amended' as field_name, record_id, trust, captured_at from ranked where is_amended is not null
  union all select filing_id, 'original_filing_type', record_id, trust, captured_at from ranked where regexp_full_match(form, '10[KQ](/A)?')
  union all select filing_id, 'fiscal_year', record_id, trust, captured_at from ranked where fy between 2001 and 2030
  union all select filing_id, 'fiscal_period', record_id, trust, captured_at from ranked
    where regexp_full_match(fp, 'Q[1-4]|[1-4]Q|QTR[1-4]|QUARTER[1-4]|FIRST|SECOND|THIRD|FOURTH|ANNUAL|FY|FULLYEAR'))
select filing_id, field_name, record_id from (
  select u.*, row_number() over (partition by filing_id, field_name
    order by trust, coalesce(captured_at, timestamp '0001-01-01') desc, record_id desc) as rn
  from usable u semi join several using (filing_id))
where rn = 1
"""

_ABBREVIATED = "|".join(sorted(w.replace(".", r"\.") for w in ABBREVIATIONS))
_BREAK = r"\n"
# The longest stretch is measured without the separators. Full stops behind abbreviations and single letters are taken out first.
P3_FOUND = rf"""
with long as (select section_key, regexp_replace(text_content, '\r\n?', chr(10), 'g') as t from sections where length(text_content) > 4000),
stops as (
  select *, regexp_replace(regexp_replace(t, '(?i)(^|[\s(\["''“„«])({_ABBREVIATED})\.', '\1\2', 'g'), '(^|[\s(\["''“„«])(\pL)\.', '\1\2', 'g') as plain from long),
longest as (
  select section_key,
    list_max(list_transform(string_split_regex(t, '{_BREAK}[ \t]*{_BREAK}\s*'), lambda x: length(x))) as paragraph,
    list_max(list_transform(string_split_regex(t, '{_BREAK}'), lambda x: length(x))) as line,
    list_max(list_transform(string_split_regex(plain, '[.!?…]+["''”’»)\]]*\s+|[。！？｡]+["''”’」』）]*\s*|{_BREAK}'), lambda x: length(x))) as sentence,
    list_max(list_transform(string_split_regex(t, '\s+|[。！？｡]+'), lambda x: length(x))) as word
  from stops)
select section_key, case when paragraph <= 4000 then 'paragraph' when line <= 4000 then 'line' when sentence <= 4000 then 'sentence' when word <= 4000 then 'word' else 'none' end as cut_level from longest
"""

ORACLES = {"p2_found": P2_FOUND, "p3_found": P3_FOUND}
