"""Text functions over Columns: special characters, clean-up, token estimates, names and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and the ASCII text that stands for them.
ONE_TO_ONE = {
    "\u00a0": " ", "\u2007": " ", "\u202f": " ", "‘": "'", "’": "'", "“": '"', "”": '"',
    "–": "-", "−": "-", "•": "*", "‣": ">", "⁃": "-", "◦": "o", "▪": "*", "▫": "*",
    "·": "*", "×": "x", "÷": "/",
}
ONE_TO_MANY = {
    "—": "--", "€": "EUR", "£": "GBP", "¥": "JPY", "®": "(R)", "™": "(TM)", "©": "(C)", "¼": "1/4", "½": "1/2", "¾": "3/4",
}
# Block tags and their short forms, replaced in this order.
TAG_SHORT = {"@CONTEXT_REF": "@CR", "@CONTEXT": "@CX", "@CONCEPT": "@C", "@VALUE": "@V", "@UNIT_REF": "@UR", "@DECIMALS": "@D", "@SECTION": "@S"}

#: White space of any kind, for engines whose ``\\s`` is ASCII.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def plain_characters(text: Column) -> Column:
    """Typographic characters as ASCII where that does not change the meaning."""
    out = F.translate(text, "".join(ONE_TO_ONE), "".join(ONE_TO_ONE.values()))
    for char, plain in ONE_TO_MANY.items():
        out = F.replace(out, F.lit(char), F.lit(plain))
    return out


#: The steps of ``clean_text`` in order: (pattern, replacement).
CLEAN_STEPS = [
    (rf"([^\n]){WS}+([^\n])", "$1 $2"),
    (r"\n{3,}", "\n\n"),
    (r"\x{a0}", " "),
    (rf"\n{WS}*\d+{WS}*\n", "\n"),
    (rf"(?i)\n{WS}*Page{WS}+\d+{WS}+of{WS}+\d+{WS}*\n", "\n"),
    (r"\(Continued[^\n]*?\)", ""),
    (rf"(?i)\n{WS}*Continued[^\n]*?\n", "\n"),
    (rf"([a-z])-{WS}+([a-z])", "$1$2"),
    (r"<[^>]+>", ""),
    (rf"^{WS}+|{WS}+$", ""),
]


def clean_text(text: Column) -> Column:
    """White space, page numbers, continuation marks, hyphenation and stray tags cleaned, in this order; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for pattern, replacement in CLEAN_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def short_tags(text: Column) -> Column:
    """Block tags in their short forms."""
    for tag, short in TAG_SHORT.items():
        text = F.replace(text, F.lit(tag), F.lit(short))
    return text


def less_white_space(text: Column) -> Column:
    """Blank lines collapsed, blanks at line ends and around pipes removed."""
    for pattern, replacement in ((r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"), (r" *\| *", "|"), (r"[ \t]{2,}", " ")):
        text = F.regexp_replace(text, pattern, replacement)
    return text


def estimated_tokens(text: Column) -> Column:
    """A rough token count from the make-up of a text: characters by a ratio between 2.5 and 4, cut off, plus 5 %, cut off."""
    length = F.length(text)
    special = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\p{Z}\s]", "")) / F.greatest(length, F.lit(1))
    digits = F.length(F.regexp_replace(F.substring(text, 1, 1000), r"[^\p{Nd}]", ""))
    ratio = (
        F.when(F.contains(text, F.lit("@")) & F.contains(text, F.lit("|")) & (special > 0.1), 3.0)
        .when(special > 0.15, 2.5).when(digits > 300, 3.0).otherwise(4.0)
    )
    return F.coalesce(F.floor(F.floor(length / ratio) * 1.05), F.lit(0)).cast("bigint")


def same_value(a: Column, b: Column) -> Column:
    """Equal as texts, or as decimal numbers without grouping commas."""
    number = lambda c: F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("decimal(38,10)")
    return F.coalesce((a == b) | F.coalesce(number(a) == number(b), F.lit(False)), F.lit(False))


def slug(text: Column) -> Column:
    """A name for use in paths: lower case, words joined by underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[^a-z0-9\s_-]", ""), r"[\s-]+", "_")


def local_name(concept: Column) -> Column:
    """A concept without its prefix."""
    return F.element_at(F.split(concept, ":"), -1)


def readable_concept(concept: Column) -> Column:
    """The local name in words: ``us-gaap:AssetsCurrent`` is ``Assets Current``; a capital follows every non-letter."""
    words = F.regexp_replace(local_name(concept), r"([a-z])([A-Z])", "$1 $2")
    return F.initcap(words)


def money_text(value: Column) -> Column:
    """``$1,234``, rounded half to even, a dash for null."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(F.bround(value, 0), 0)), F.lit("—"))


def shown_value(value: Column, measure: Column, decimals: Column) -> Column:
    """A value as shown in documents: currency sign, scale letter by decimals, ``shares`` after share counts."""
    letter = F.when(decimals == "-3", "K").when(decimals == "-6", "M").when(decimals == "-9", "B")
    unit = F.lower(measure)
    money = F.contains(unit, F.lit("usd")) & ~F.contains(unit, F.lit("shares"))
    body = F.when(money & ~value.startswith("$"), F.concat(F.lit("$"), value)).otherwise(value)
    body = F.when(money & letter.isNotNull(), F.concat(body, F.lit("["), letter, F.lit("]"))).otherwise(body)
    return F.when(unit.endswith("shares") & ~F.contains(unit, F.lit("usd")), F.concat(value, F.lit(" shares"))).otherwise(body)


def decimals_words(decimals: Column) -> Column:
    """What a decimals attribute says about the scale."""
    return F.when(decimals == "0", "units").when(decimals == "-3", "thousands").when(decimals == "-6", "millions").when(decimals == "-9", "billions")


def decimals_number(decimals: Column) -> Column:
    """A decimals attribute as a number: infinity for INF, null for what is no integer."""
    return F.when(F.upper(F.trim(decimals)) == "INF", F.lit(float("inf"))).otherwise(F.trim(decimals).try_cast("int").cast("double"))


def segment_text(segment: Column) -> Column:
    """A segment map as ``Dimension: Member, ...`` without prefixes and axis words; ``Consolidated`` when empty."""
    name = lambda c: F.regexp_replace(local_name(c), r"(?:Segment|Dimension|Axis|Member)$", "")
    parts = F.transform(F.map_entries(segment), lambda e: F.concat(name(e["key"]), F.lit(": "), name(e["value"])))
    return F.coalesce(F.nullif(F.array_join(F.array_sort(parts), ", "), F.lit("")), F.lit("Consolidated"))


def canonical_number(value: Column, decimals: Column) -> Column:
    """A figure as plain decimal text: no grouping, brackets as minus, rounded to its decimals, no trailing zeros; other text unchanged."""
    bare = F.regexp_replace(F.trim(value), r"^\((.*)\)$", "-$1")
    bare = F.translate(bare, "$, ", "")
    number = F.when(bare.rlike(r"^-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?$"), bare).try_cast("decimal(38,10)")
    places = decimals.try_cast("int")
    rounded = F.when(places.between(0, 10), F.bround(number, 10)).otherwise(number)
    plain = F.regexp_replace(F.regexp_replace(rounded.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(plain, value)


def table_like(paragraph: Column) -> Column:
    """Whether a paragraph is a table: pipes or tabs, or a financial mark with at least two lines of aligned figures."""
    lines = F.split(paragraph, "\n")
    figures = F.filter(lines, lambda line: line.rlike(r"\S {2,}\(?\$?\d[\d,.]*\)?\s*$"))
    columns = F.filter(lines, lambda line: line.rlike(r"\S {2,}\S.* {2,}\S"))
    financial = paragraph.rlike(r"(?i)\$|%|\b(?:total|net|assets|revenue)\b")
    return F.coalesce(
        F.contains(paragraph, F.lit("|")) | F.contains(paragraph, F.lit("\t")) | (financial & (F.size(figures) >= 2)) | (F.size(columns) >= 3), F.lit(False)
    )


def number_tokens(text: Column) -> Column:
    """The distinct numbers written in a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\d[\d,.]*\d|\d)"), 1))


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank texts."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", 0).otherwise(F.size(F.split(F.trim(text), r"\s+")))


#: Identifiers of contexts and concepts before the first words in capitals.
LEADING_IDENTIFIERS = (r"^(?:[a-z0-9:\-]+\s*)+(UNITED STATES|FORM|[A-Z]{3,})", "@NOTE: XBRL context identifiers removed\n\n$1")


def without_leading_identifiers(text: Column) -> Column:
    """A text without the identifiers it begins with, and a note that they are gone."""
    return F.regexp_replace(text, *LEADING_IDENTIFIERS)


def lost_numbers(before: Column, after: Column) -> Column:
    """The numbers written in one text and not in the other."""
    return F.array_except(number_tokens(before), number_tokens(after))
