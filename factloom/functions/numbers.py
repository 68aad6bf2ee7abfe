"""Reading figures out of text: one Column expression, no Python on the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.let import let

# Scale words and the power of ten they stand for.
SCALE_WORDS = {
    "thousand": 3, "thousands": 3, "k": 3, "tausend": 3, "mille": 3, "mil": 3,
    "million": 6, "millions": 6, "mm": 6, "mn": 6, "m": 6, "mio.": 6, "mio": 6,
    "billion": 9, "billions": 9, "bn": 9, "b": 9, "mrd.": 9, "mrd": 9,
    "trillion": 12, "trillions": 12, "tn": 12,
}

# Unit words as written after a figure, and the unit they name.
UNIT_WORDS = {
    "%": "percent", "percent": "percent", "per cent": "percent", "pct": "percent",
    "bps": "bps", "bp": "bps", "basis points": "bps", "basis point": "bps",
    "shares": "shares", "share": "shares",
    "usd": "usd", "us$": "usd", "$": "usd", "dollars": "usd", "us dollars": "usd",
    "eur": "eur", "€": "eur", "euro": "eur", "euros": "eur",
    "per share": "usdpershare", "a share": "usdpershare",
    "usd per share": "usdpershare", "usd a share": "usdpershare",
    "cents per share": "centpershare", "cents a share": "centpershare",
    "us cents per share": "centpershare", "us cents a share": "centpershare",
    "¢ per share": "centpershare", "¢ a share": "centpershare",
    "square metres": "sqm", "square meters": "sqm", "sq m": "sqm", "sqm": "sqm", "m²": "sqm", "m2": "sqm",
    "square feet": "sqft", "sq. ft.": "sqft", "sq ft": "sqft", "sqft": "sqft", "ft²": "sqft", "ft2": "sqft",
    "acres": "acre", "acre": "acre", "ac": "acre", "hectares": "ha", "hectare": "ha", "ha": "ha",
    "kwh": "kwh", "kilowatt-hours": "kwh", "kilowatt hours": "kwh",
    "mwh": "mwh", "megawatt hours": "mwh", "megawatt-hours": "mwh",
    "gwh": "gwh", "gigawatt hours": "gwh", "gigawatt-hours": "gwh",
    "gj": "gj", "gigajoules": "gj", "mmbtu": "mmbtu",
    "kg": "kg", "kilograms": "kg", "kilogrammes": "kg", "t": "t", "tonnes": "t", "metric tons": "t",
    "lb": "lb", "lbs": "lb", "pounds": "lb", "short tons": "ust",
    "bbl": "bbl", "barrels": "bbl", "gal": "gal", "us gallons": "gal", "gallons": "gal",
    "m³": "m3", "m3": "m3", "cubic metres": "m3", "cubic meters": "m3",
    "km": "km", "kilometres": "km", "kilometers": "km", "mi": "mi", "miles": "mi",
    "°c": "c", "degrees celsius": "c", "°f": "f", "degrees fahrenheit": "f",
    "employees": "pure", "sites": "pure",
}


def _any(words) -> str:
    """An alternation, longest first, with every character taken literally."""
    literal = lambda w: "".join(c if c.isalnum() or c in " " else "\\" + c for c in w)
    return "|".join(literal(w) for w in sorted(words, key=lambda w: (-len(w), w)))


_GROUPED = r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d{1,3}(?: \d{3})+(?:\.\d+)?|\d+(?:\.\d+)?|\.\d+"
_CONTINENTAL = r"\d{1,3}(?:\.\d{3})*,\d+(?= ?(?:mio|mrd))"
#: groups: sign or bracket, currency, sign or bracket, figure, scale word, unit word
_FIGURE = (
    r"^([-+(])? ?(us\$|\$|usd|eur|€)? ?([-+(])? ?"
    rf"({_CONTINENTAL}|{_GROUPED})\)? ?"
    rf"(?:({_any(SCALE_WORDS)})(?![a-z]))? ?({_any(UNIT_WORDS)})?\)?$"
)
_BLANKS = "\u00a0\u2007\u2009\u202f\u3000\t\r\n"
_DASHES = "−‒–—﹣－"


def lookup(values: dict, key: Column) -> Column:
    """``values[key]``; null for a missing or null key."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def read_figure(value: Column) -> Column:
    """Text to ``struct<figure double, exponent int, unit string>``, null when it is not one number.

    ``figure`` is the plain number as written, with its sign (a minus or brackets) and
    before any scale word; ``exponent`` is the power of ten of a scale word (0 without);
    ``unit`` is the unit or currency written beside it, or null. A lone dash is zero.
    Digits mixed with letters, ranges, dates, notes and dotted codes are no numbers.
    """
    text = F.translate(F.translate(value, _BLANKS, " " * len(_BLANKS)), _DASHES, "-" * len(_DASHES))

    def build(parts: Column) -> Column:
        number, scale = parts[2], parts[3]
        continental = scale.isin("mio.", "mio", "mrd.", "mrd") & F.contains(number, F.lit(","))
        plain = F.when(continental, F.translate(number, ",.", ".")).otherwise(F.translate(number, ", ", ""))
        figure = plain.try_cast("double")
        signed = F.when(parts[1].isin("-", "(") | parts[0].isin("-", "("), -figure).otherwise(figure)
        written = F.when(parts[4] != "", parts[4])
        currency = F.when(parts[5].isin("eur", "€"), "eur").when(parts[5] != "", "usd")
        return F.struct(
            signed.alias("figure"),
            F.coalesce(lookup(SCALE_WORDS, scale), F.lit(0)).alias("exponent"),
            F.coalesce(lookup(UNIT_WORDS, written), currency).alias("unit"),
        )

    dash = F.struct(F.lit(0.0).alias("figure"), F.lit(0).alias("exponent"), F.lit(None).cast("string").alias("unit"))
    split = lambda t: F.split(F.regexp_replace(t, _FIGURE, "$1~$3~$4~$5~$6~$2"), "~")
    # Most texts are no figures at all: only what has a digit near its start is matched.
    read = lambda t: let(split(t), lambda p: F.when(F.size(p) == 6, build(p)))
    return let(F.lower(F.trim(text)), lambda t: F.when(t == "-", dash).when((F.length(t) < 64) & ~F.contains(t, F.lit("~")), read(t)))
