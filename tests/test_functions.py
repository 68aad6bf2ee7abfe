"""Text, period and classification functions on hand-written cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from factloom.functions import classify, periods, text


def value(spark, column, **inputs):
    names = list(inputs)
    row = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{n} {'string' if not isinstance(inputs[n], (int, float)) else 'double'}" for n in names))
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,want", [("a b — €5 ½", "a b -- EUR5 1/2"), ("", ""), (None, None), ("plain", "plain")])
def test_plain_characters(spark, raw, want):
    assert value(spark, text.plain_characters(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw,want", [(None, ""), ("  x  ", "x"), ("exam- ple", "example"), ("a<b>c</b>", "ac"), ("a (Continued on next page) b", "a  b")])
def test_clean_text(spark, raw, want):
    assert value(spark, text.clean_text(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw,want", [("", 0), (None, 0), ("abcd" * 10, 10), ("{}[]:," * 10, int(int(60 / 2.5) * 1.05))])
def test_estimated_tokens(spark, raw, want):
    assert value(spark, text.estimated_tokens(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw,want", [("us-gaap:AssetsCurrent", "Assets Current"), ("Goodwill", "Goodwill"), ("a:b:NetIncomeLoss", "Net Income Loss")])
def test_readable(spark, raw, want):
    assert value(spark, text.readable_concept(F.col("v")), v=raw) == want


@pytest.mark.parametrize("a,b,same", [("1,000", "1000.0", True), ("x", "x", True), ("1", "2", False), (None, "1", False), ("x", "y", False)])
def test_same_value(spark, a, b, same):
    assert value(spark, text.same_value(F.col("a"), F.col("b")), a=a, b=b) is same


@pytest.mark.parametrize("raw,want", [("(1,200.50)", "-1200.5"), ("7.000", "7"), ("n/a", "n/a"), ("1.5e20", "150000000000000000000"), (None, None)])
def test_canonical_number(spark, raw, want):
    assert value(spark, text.canonical_number(F.col("v"), F.lit("0")), v=raw) == want


@pytest.mark.parametrize("raw,want", [("a | b", True), ("a\tb", True), ("Some prose about nothing.", False), (None, False), ("Total assets    $1,200\nNet income    3,400", True)])
def test_table_like(spark, raw, want):
    assert value(spark, text.table_like(F.col("v")), v=raw) is want


@pytest.mark.parametrize("raw,want", [("2021-05-02", (2021, 5, 2)), ("20210502", (2021, 5, 2)), ("05/02/2021", (2021, 5, 2)), ("2021/05/02", (2021, 5, 2)), ("05-02-2021", (2021, 5, 2)),
                                      ("May 2, 2021", (2021, 5, 2)), ("03-04-2021", (2021, 3, 4)), ("25-04-2021", (2021, 4, 25)), ("", None), ("2021-13-01", None), ("n/a", None), (None, None)])
def test_dates(spark, raw, want):
    assert value(spark, periods.normalised_date(F.col("v")), v=raw) == (datetime.date(*want) if want else None)


@pytest.mark.parametrize("raw,want", [("1Q", "Q1"), ("qtr2", "Q2"), ("third", "Q3"), ("FY", "annual"), ("10-K", "annual"), ("Q1-2023", "Q1"), ("Q7", "Q7"), ("", None), (None, None)])
def test_standard_period(spark, raw, want):
    assert value(spark, periods.standard_period(F.col("v")), v=raw) == want


@pytest.mark.parametrize("ref,want", [("C_0000789019_20200701_20210630", (None, "2020-07-01", "2021-06-30")), ("C_0000789019_20200701", ("2020-07-01", None, None)), ("x_D20200701-20210630", (None, "2020-07-01", "2021-06-30")),
                                      ("x_I20200701", ("2020-07-01", None, None)), ("i" + "0" * 32 + "_D20210201-20220130", (None, "2021-02-01", "2022-01-30")), ("FD2022Q3YTD", None), ("c-1", None), (None, None)])
def test_context_period(spark, ref, want):
    got = value(spark, periods.context_period(F.col("v")), v=ref)
    assert (tuple(got) if got else None) == want


def test_registering_a_period_format(spark):
    before = len(periods.period_formats())
    periods.register_period_format("year", "Y<year>", lambda ref: F.when(ref.rlike(r"^Y\d{4}$"), F.struct(F.lit(None).cast("string").alias("instant"), F.concat(F.substring(ref, 2, 4), F.lit("-01-01")).alias("startdate"), F.concat(F.substring(ref, 2, 4), F.lit("-12-31")).alias("enddate"))))
    try:
        assert len(periods.period_formats()) == before + 1
        assert tuple(value(spark, periods.context_period(F.col("v")), v="Y2020")) == (None, "2020-01-01", "2020-12-31")
    finally:
        periods._FORMATS.pop()


def test_fiscal_year_of_the_closing_day(spark):
    end = F.lit("2024-01-28").cast("date")
    assert value(spark, periods.fiscal_year(end, 1, 26, F.lit("10-K")), v="x") == 2025
    assert value(spark, periods.fiscal_year(F.lit("2024-06-30").cast("date"), 6, 30, F.lit("10-K")), v="x") == 2024
    assert value(spark, periods.fiscal_quarter(F.lit("2023-12-31").cast("date"), 9, F.lit("10-Q")), v="x") == "Q1"


@pytest.mark.parametrize("concept,want", [("us-gaap:Liabilities", "BALANCE_SHEET"), ("us-gaap:Revenues", "INCOME_STATEMENT"), ("x:Proceeds", "CASH_FLOW"), ("x:Zzz", "OTHER")])
def test_statement_type(spark, concept, want):
    assert value(spark, classify.statement_type(F.col("v")), v=concept) == want
