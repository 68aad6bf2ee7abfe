"""Dates, fiscal periods and the periods encoded in context ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted written dates in order of preference: (shape, format).
DATE_FORMATS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"), (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{2}-\d{2}-\d{4}$", "MM-dd-yyyy"), (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"), (r"^[A-Z][a-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
]


def normalised_date(text: Column) -> Column:
    """A written date in the first accepted format that reads it, else null; month comes before day where both could be meant."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.when(trimmed.rlike(shape), F.try_to_timestamp(trimmed, F.lit(form)).cast("date")) for shape, form in DATE_FORMATS])


# Spellings of the periods, compared in capitals.
PERIOD_WORDS = {
    "annual": ["FY", "ANNUAL", "10-K", "YEAR", "YR", "FINAL", "A"],
    "Q1": ["1", "1Q", "Q1", "QTR1", "FIRST", "1ST"],
    "Q2": ["2", "2Q", "Q2", "QTR2", "SECOND", "2ND"],
    "Q3": ["3", "3Q", "Q3", "QTR3", "THIRD", "3RD"],
    "Q4": ["4", "4Q", "Q4", "QTR4", "FOURTH", "4TH"],
}


def standard_period(period: Column) -> Column:
    """``Q1`` to ``Q4`` or ``annual``; what begins like a quarter by its digit; else the text in capitals; null for empty."""
    text = F.upper(F.trim(period))
    named = F.coalesce(*[F.when(text.isin(*words), p) for p, words in PERIOD_WORDS.items()])
    digit = F.regexp_extract(text, r"^[QTR]*\s*([1-4])", 1)
    return F.when(F.coalesce(text, F.lit("")) != "", F.coalesce(named, F.when(digit != "", F.concat(F.lit("Q"), digit)), text))


def period_dialect(period: Column, dialect: str) -> Column:
    """A standard period in a dialect: ``internal``, ``folder``, ``display`` (annual is Q4) or ``old`` (1Q to 4Q)."""
    if dialect == "display":
        return F.when(period == "annual", "Q4").otherwise(period)
    if dialect == "old":
        shown = F.when(period == "annual", "Q4").otherwise(period)
        return F.when(shown.rlike("^Q[1-4]$"), F.concat(F.substring(shown, 2, 1), F.lit("Q"))).otherwise(period)
    return period


def fiscal_year(end: Column, fye_month: Column | int, fye_day: Column | int, form: Column) -> Column:
    """The fiscal year of a period end: the next one from the year end's day on, except for the annual report of that very day."""
    m, d = F.month(end), F.dayofmonth(end)
    month, day = (c if isinstance(c, Column) else F.lit(c) for c in (fye_month, fye_day))
    after = (m > month) | ((m == month) & (d >= day))
    closing = (form == "10-K") & (m == month) & (d == day)
    return F.year(end) + F.when(after & ~closing, 1).otherwise(0)


def fiscal_quarter(end: Column, fye_month: Column | int, form: Column) -> Column:
    """``annual`` for annual reports, else the quarter by months since the fiscal year end."""
    month = fye_month if isinstance(fye_month, Column) else F.lit(fye_month)
    since = F.pmod(F.month(end) - month, F.lit(12))
    quarter = F.when(since.between(1, 3), "Q1").when(since.between(4, 6), "Q2").when(since.between(7, 9), "Q3").otherwise("Q4")
    return F.when(form == "10-K", "annual").otherwise(quarter)


def quarter_months(fye_month: Column, quarter: Column) -> Column:
    """The three calendar months of a fiscal quarter."""
    return F.transform(F.sequence(F.lit(2), F.lit(0)), lambda back: F.pmod(fye_month + 3 * quarter - back - 1, F.lit(12)) + 1)


def quarter_map(fye_month: Column) -> Column:
    """For the calendar months 1 to 12 the fiscal quarter each lies in."""
    return F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.concat(F.lit("Q"), (F.floor(F.pmod(m - fye_month - 1, F.lit(12)) / 3) + 1).cast("string")))


def quarter_end(fye_month: Column, year: Column, quarter: Column) -> Column:
    """The last day of a fiscal quarter; the fiscal year is named by the calendar year it ends in."""
    month = F.pmod(fye_month + 3 * quarter - 1, F.lit(12)) + 1
    calendar = F.when(month <= fye_month, year).otherwise(year - 1)
    return F.last_day(F.make_date(calendar, month, F.lit(1)))


def current_fiscal_quarter(today: Column, fye_month: Column) -> Column:
    """``struct<fiscal_year, quarter>`` of a day given as a column."""
    ahead = F.when(F.month(today) > fye_month, 1).otherwise(0)
    return F.struct((F.year(today) + ahead).alias("fiscal_year"), (F.floor(F.pmod(F.month(today) - fye_month - 1, F.lit(12)) / 3) + 1).cast("int").alias("quarter"))


def duration_category(days: Column, form: Column) -> Column:
    """annual (also any annual report), quarter, six or nine months, else other."""
    return (
        F.when(days.between(350, 380) | (form == "10-K"), "annual").when(days.between(85, 95), "quarter")
        .when(days.between(175, 190), "six_months").when(days.between(265, 280), "nine_months").otherwise("other")
    )


def duration_label(start: Column, end: Column) -> Column:
    """A column heading for a period, by its length and its end."""
    days = F.datediff(end, start)
    year = F.year(end).cast("string")
    return (
        F.when(days.between(88, 95), F.concat(F.lit("Quarter "), F.quarter(end).cast("string"), F.lit(" "), year))
        .when(days.between(360, 371), F.concat(F.lit("Annual "), year)).when(days.between(175, 190), F.concat(F.lit("Semi-annual "), year))
        .otherwise(F.concat(F.lit("Period "), year))
    )


def duration_description(days: Column) -> Column:
    """Words for a duration: three, six or nine months, else null."""
    return F.when(days.between(85, 95), "three months").when(days.between(175, 190), "six months").when(days.between(265, 280), "nine months")


def nearest_quarter_month(month: Column) -> Column:
    """The month of 3, 6, 9, 12 nearest to a month, the earlier one on a tie."""
    ends = F.array(*[F.struct(F.abs(month - m).alias("gap"), F.lit(m).alias("month")) for m in (3, 6, 9, 12)])
    return F.array_min(ends)["month"]


def context_label(start: Column, end: Column, instant: Column, segment: Column) -> Column:
    """``FY2023`` for a year, ``2023_Q1`` for other periods by the quarter of their end, ``2023_Q1_END`` or ``2023_FY_END`` for days; segments in brackets."""
    days = F.datediff(end, start)
    q = lambda c: F.concat(F.lit("Q"), F.quarter(c).cast("string"))
    period = F.when(days.between(350, 380), F.concat(F.lit("FY"), F.year(end).cast("string"))).otherwise(F.concat(F.year(end).cast("string"), F.lit("_"), q(end)))
    day = F.concat(F.year(instant).cast("string"), F.when(F.month(instant) == 12, "_FY_END").otherwise(F.concat(F.lit("_"), q(instant), F.lit("_END"))))
    return F.concat(F.coalesce(period, day, F.lit("unknown")), F.when(segment == "Consolidated", "").otherwise(F.concat(F.lit(" ("), segment, F.lit(")"))))


PeriodReader = Callable[[Column], Column]
_FORMATS: list[tuple[str, str, PeriodReader]] = []
PERIOD_DDL = "struct<instant:string,startdate:string,enddate:string>"


def register_period_format(name: str, description: str, reader: PeriodReader) -> None:
    """Add a way to read a period out of a context id; the first registered that gives a period wins."""
    _FORMATS.append((name, description, reader))


def period_formats() -> list[tuple[str, str]]:
    """(name, description) of the registered formats in order."""
    return [(name, description) for name, description, _ in _FORMATS]


def _dashed(digits: Column) -> Column:
    return F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")


def _pattern(pattern: str, groups: int) -> PeriodReader:
    def read(ref: Column) -> Column:
        parts = [F.regexp_extract(ref, pattern, i + 1) for i in range(groups)]
        null = F.lit(None).cast("string")
        period = F.struct(
            (null if groups == 2 else _dashed(parts[0])).alias("instant"),
            (_dashed(parts[0]) if groups == 2 else null).alias("startdate"), (_dashed(parts[-1]) if groups == 2 else null).alias("enddate"),
        )
        return F.when(parts[0] != "", period)

    return read


register_period_format("cik_duration", "C_<cik>_<start>_<end>", _pattern(r"C_\d+_(\d{8})_(\d{8})", 2))
register_period_format("cik_instant", "C_<cik>_<day>", _pattern(r"C_\d+_(\d{8})$", 1))
register_period_format("duration", "..._D<start>-<end>", _pattern(r"_D(\d{8})-(\d{8})", 2))
register_period_format("instant", "..._I<day>", _pattern(r"_I(\d{8})", 1))


def context_period(ref: Column) -> Column:
    """The period encoded in a context id, null if no registered format reads it."""
    return F.coalesce(*[reader(ref) for _, _, reader in _FORMATS], F.lit(None).cast(PERIOD_DDL))


def period_format(ref: Column) -> Column:
    """The name of the registered format that reads a context id, null if none does."""
    return F.coalesce(*[F.when(reader(ref).isNotNull(), name) for name, _, reader in _FORMATS], F.lit(None).cast("string"))


def context_date(period_end: Column, ref: Column) -> Column:
    """The day a context is about: its period's end, else the day or end in its id, else an ISO date in its id."""
    p = context_period(ref)
    return F.coalesce(period_end, p["instant"], p["enddate"], F.nullif(F.regexp_extract(ref, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")))


MONTH_NAMES = "january|february|march|april|may|june|july|august|september|october|november|december"
_DATED = rf"(?:ended|ending)[^\n]*?(?:{MONTH_NAMES})\s+\d{{1,2}},?\s+(\d{{4}})"
_DATED_LATER = rf"[^\n]*?{_DATED}"
#: Where the fiscal year of a report is looked for in its first characters, in order; the year is the group.
YEAR_PATTERNS = {
    "10-K": [rf"(?:for|the|fiscal|year){_DATED_LATER}", rf"(?:for|the|period){_DATED_LATER}", r"(?:fiscal|year)[^\n]*?(\d{4})"],
    "10-Q": [
        rf"for the\s+(?:quarterly report|quarterly period|quarterly|three months)\s+{_DATED}", rf"for the\s+(?:quarter|three months)\s+{_DATED}",
        r"(?:fiscal|year)[^\n]*?(\d{4})",
    ],
}
#: A mention of the quarter, and the words in it, in order.
QUARTER_PATTERN = r"((?:quarterly report|form 10-q|quarterly period|quarterly)[^\n]*?(?:first|second|third|fourth|1st|2nd|3rd|4th|\sq1|\sq2|\sq3|\sq4))"
QUARTER_WORDS = {"Q1": "first|1st|q1", "Q2": "second|2nd|q2", "Q3": "third|3rd|q3", "Q4": "fourth|4th|q4"}
#: The day a quarterly report says its period ended.
STATED_END = rf"(?:quarterly report|quarterly|quarter|period)[^\n]*?(?:ended|ending)[^\n]*?((?:{MONTH_NAMES})\s+\d{{1,2}},?\s+\d{{4}})"
HEAD_CHARACTERS = 10_000


def period_in_document(text: Column, form: Column, period_end: Column, year_end_month: Column | None = None) -> Column:
    """``struct<fiscal_year, fiscal_period>`` of an annual or quarterly report, by what its first characters say.

    A 10-K is annual, its year the one named with a period's end, else with a fiscal year,
    else that of ``period_end``. A 10-Q has the quarter it mentions; where it mentions none
    and ``year_end_month`` (of the company's calendar) is known, that of the day it states
    for the period's end, else of ``period_end``, and the fiscal year by that calendar. Other
    forms, and what is found nowhere, are null.
    """
    head = F.lower(F.substring(text, 1, HEAD_CHARACTERS))
    first = lambda pattern: F.nullif(F.regexp_extract(head, pattern, 1), F.lit(""))
    end_year = F.year(period_end).cast("string")
    annual = F.coalesce(*[first(p) for p in YEAR_PATTERNS["10-K"]], end_year)
    mention = first(QUARTER_PATTERN)
    quarter = F.coalesce(*[F.when(mention.rlike(words), q) for q, words in QUARTER_WORDS.items()])
    stated = F.try_to_timestamp(F.initcap(F.regexp_replace(first(STATED_END), r"\s+", " ")), F.lit("MMMM d, yyyy")).cast("date")
    day = F.coalesce(stated, period_end)
    month = F.lit(None).cast("int") if year_end_month is None else year_end_month
    ahead = F.pmod(F.month(day) - month, F.lit(12))
    inferred = F.when(ahead == 0, "annual").otherwise(F.concat(F.lit("Q"), F.ceil(ahead / 3).cast("string")))
    inferred_year = (F.year(day) + F.when(F.month(day) > month, 1).otherwise(0)).cast("string")
    # A year by the calendar goes with a quarter by the calendar.
    year = F.coalesce(F.when(quarter.isNull() & month.isNotNull(), inferred_year), *[first(p) for p in YEAR_PATTERNS["10-Q"]], F.year(stated).cast("string"), end_year)
    return F.when(form == "10-K", F.struct(annual.alias("fiscal_year"), F.lit("annual").alias("fiscal_period"))).when(
        form == "10-Q", F.struct(year.alias("fiscal_year"), F.coalesce(quarter, inferred).alias("fiscal_period"))
    )
