"""Documents rendered from facts, and facts read back from documents.

A document is a DataFrame of lines ``filing_id, section_ord, line_ord, text`` until the
sink puts the lines together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import text as t
from factloom.operators.facts import context_codes, unique_units
from factloom.operators.ordered import carried, numbered

FIELDS = ("CONCEPT", "VALUE", "CONTEXT_REF", "UNIT_REF", "DECIMALS")


def fact_lines(facts: DataFrame) -> DataFrame:
    """One ``@CONCEPT: ... | @VALUE: ...`` line per fact; missing fields are empty."""
    e = lambda c: F.coalesce(F.regexp_replace(F.col(c), r"[\r\n|]+", " "), F.lit(""))
    columns = dict(zip(FIELDS, ("name", "value", "contextref", "unitref", "decimals")))
    line = F.concat_ws(" | ", *[F.concat(F.lit(f"@{k}: "), e(c)) for k, c in columns.items()])
    return facts.select("filing_id", F.lit(3).alias("section_ord"), F.col("fact_id").alias("line_ord"), line.alias("text"))


def document_lines(filings: DataFrame, contexts: DataFrame, units: DataFrame, facts: DataFrame) -> DataFrame:
    """All lines of the documents: header, context dictionary, units, facts."""
    tag = lambda name, c: F.concat(F.lit(f"@{name}: "), F.col(c).cast("string"))
    header = F.array_compact(F.array(tag("DOCUMENT", "company_ticker"), tag("TYPE", "filing_type"), tag("PERIOD", "period_end_date"), tag("FISCAL_YEAR", "fiscal_year"), tag("FISCAL_PERIOD", "fiscal_period")))
    head = filings.select("filing_id", F.lit(0).alias("section_ord"), F.posexplode(header).alias("line_ord", "text"))
    period = F.coalesce("period.instant", F.concat_ws(" to ", "period.startdate", "period.enddate"))
    c = context_codes(contexts)
    dictionary = c.select("filing_id", F.lit(1).alias("section_ord"), F.coalesce("context_pos", F.lit(0)).alias("line_ord"),
                          F.concat_ws(" | ", F.concat(F.lit("@CONTEXT: "), "context_id"), "code", period, t.segment_text(F.col("entity.segment"))).alias("text"))
    measures = unique_units(units).select("filing_id", F.lit(2).alias("section_ord"), F.lit(0).alias("line_ord"), F.concat_ws(" | ", F.concat(F.lit("@UNIT: "), "unit_id"), "measure").alias("text"))
    parts = [head, dictionary, measures, fact_lines(facts)]
    out = [p.select("filing_id", F.col("section_ord").cast("int").alias("section_ord"), F.col("line_ord").cast("bigint").alias("line_ord"), "text") for p in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def filing_lines(filings: DataFrame, contexts: DataFrame, units: DataFrame, facts: DataFrame, sections: DataFrame) -> DataFrame:
    """All lines of the whole documents: those of ``document_lines``, then statements by period, narrative sections, coverage and integrity.

    Parts come in the order of ``section_ord``; ``line_ord`` orders the lines of a part and the
    text those of one line number. A filing of any size stays lines until the sink.
    """
    from factloom.operators import pipeline, statements

    line = lambda df, part, order, text: df.select("filing_id", F.lit(part).alias("section_ord"), order.cast("bigint").alias("line_ord"), text.alias("text"))
    rows = statements.statement_rows(statements.statement_cells(facts))
    rank = F.coalesce(*[F.when(F.col("statement") == s, r) for s, r in statements.RANK.items()])
    told = line(rows, 4, rank, F.concat_ws(" | ", F.concat(F.lit("@STATEMENT: "), "statement"), "section", "text"))
    narrative = line(sections.where("section_id is not null and trim(coalesce(text_content, '')) <> ''"), 5, F.coalesce("pos", F.lit(0)), with_markers(F.col("text_content"), F.col("section_id")))
    c = pipeline.coverage(sections)
    covered = line(c, 6, F.lit(0), F.format_string("@DOCUMENT_COVERAGE: %.1f%% of required, %.1f%% of standard sections; missing: %s", "required_pct", "standard_pct", "missing"))
    i = pipeline.integrity(sections, facts)
    kept = line(i, 7, F.lit(0), F.format_string("@DATA_INTEGRITY: %d facts, %d tables, %.1f%% preserved, %d table rows, %d paragraphs, %d included", "xbrl_facts", "tables", "preservation_pct", "table_rows", "narrative", "included"))
    out = document_lines(filings, contexts, units, facts)
    for part in (told, narrative, covered, kept):
        out = out.unionByName(part)
    return out


def documents(lines: DataFrame) -> DataFrame:
    """(filing_id, text): the lines of each filing in order, with plain characters and less white space."""
    ordered = F.array_sort(F.collect_list(F.struct("section_ord", "line_ord", "text")))
    joined = F.array_join(F.transform(ordered, lambda s: s["text"]), "\n")
    return lines.groupBy("filing_id").agg(t.less_white_space(t.plain_characters(joined)).alias("text"))


def save_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(filing_id, size_before, size_after, reduction) of documents."""
    size = lambda df, name: df.select("filing_id", F.octet_length("text").alias(name))
    both = size(before, "size_before").join(size(after, "size_after"), "filing_id")
    return both.withColumn("reduction", 100.0 * (F.col("size_before") - F.col("size_after")) / F.greatest("size_before", F.lit(1)))


def read_fact_lines(texts: DataFrame) -> DataFrame:
    """Facts out of documents (filing_id, text): one row per ``@CONCEPT`` line; empty fields are null."""
    lines = texts.select("filing_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.col("line").startswith("@CONCEPT"))
    value = lambda k: F.nullif(F.trim(F.regexp_extract("line", rf"@{k}: ?([^|]*)", 1)), F.lit(""))
    names = dict(zip(FIELDS, ("name", "value", "contextref", "unitref", "decimals")))
    return lines.select("filing_id", "pos", *[value(k).alias(c) for k, c in names.items()])


def block_lines(facts: DataFrame) -> DataFrame:
    """Facts as grouped lines: ``@CONTEXT: c``, ``@PREFIX: p``, then ``concept|value`` rows.

    Every fact has a line. Names without a colon have the empty prefix, whose facts come
    straight after the context without a line of its own; a null context or name is empty.
    """
    name, colon = F.coalesce("name", F.lit("")), F.instr(F.coalesce("name", F.lit("")), ":")
    f = facts.select("filing_id", "fact_id", F.coalesce("contextref", F.lit("")).alias("contextref"), F.when(colon > 0, F.left(name, colon - 1)).otherwise("").alias("prefix"), F.when(colon > 0, F.substr(name, colon + 1)).otherwise(name).alias("local"), F.regexp_replace(F.coalesce("value", F.lit("")), r"[\r\n|]+", " ").alias("value"))
    heads = f.select("filing_id", "contextref").distinct()
    line = lambda df, kind, text: df.select("filing_id", "contextref", (F.col("prefix") if "prefix" in df.columns else F.lit("")).alias("prefix"), F.lit(kind).alias("kind"), (F.col("fact_id") if "fact_id" in df.columns else F.lit(0)).cast("bigint").alias("fact_id"), text.alias("text"))
    out = line(heads, 0, F.concat(F.lit("@CONTEXT: "), "contextref"))
    out = out.unionByName(line(f.select("filing_id", "contextref", "prefix").where("prefix <> ''").distinct(), 1, F.concat(F.lit("@PREFIX: "), "prefix")))
    return out.unionByName(line(f, 2, F.concat_ws("|", "local", "value")))


def read_block_lines(lines: DataFrame, order: list[str]) -> DataFrame:
    """Facts out of grouped lines: the context and prefix last seen are carried forward in the given order; a context begins with the empty prefix."""
    is_, rest = lambda tag: F.col("text").startswith(f"@{tag}: "), lambda tag: F.substr("text", F.lit(len(tag) + 4))
    # One mark holds both: every context line starts with the empty prefix, every prefix line knows its context.
    marked = lines.withColumn("context_mark", F.when(is_("CONTEXT"), rest("CONTEXT"))).withColumn("prefix_mark", F.when(is_("CONTEXT"), "").when(is_("PREFIX"), rest("PREFIX")))
    read = carried(carried(marked, ["filing_id"], order, "context_mark", "context"), ["filing_id"], order, "prefix_mark", "prefix_now")
    read = read.where(~(is_("CONTEXT") | is_("PREFIX"))).withColumn("contextref", F.nullif("context", F.lit(""))).withColumn("prefix", F.col("prefix_now"))
    parts = F.split("text", r"\|", 2)
    name = F.when(F.col("prefix") == "", parts[0]).otherwise(F.concat("prefix", F.lit(":"), parts[0]))
    return read.select("filing_id", "contextref", F.nullif(name, F.lit("")).alias("name"), parts[1].alias("value"))


def consolidated_contexts(facts: DataFrame) -> DataFrame:
    """Facts with hash-like context ids replaced by ``c-n``, numbered over the sorted distinct ids of a filing."""
    long = F.col("contextref").rlike(r"^i[0-9a-f]{32}_[DI]")
    ids = facts.where(long).select("filing_id", "contextref").distinct()
    ids = numbered(ids, ["filing_id"], ["contextref"]).withColumn("code", F.concat(F.lit("c-"), F.col("rn").cast("string"))).drop("rn")
    return facts.join(ids, ["filing_id", "contextref"], "left").withColumn("short_ref", F.coalesce("code", "contextref")).drop("code")


def deduplicated_blocks(blocks: DataFrame, key: str, text: str) -> DataFrame:
    """Blocks with equal text after the first become references: ``key, is_reference, first_key, body``.

    The first block of each text is found by an aggregate over its hash, so a text that
    makes up any share of the table is never gathered.
    """
    b = blocks.where(F.col(text).isNotNull()).select(key, F.col(text).alias("body"), F.md5(text).alias("hash"))
    first = b.groupBy("hash").agg(F.min(key).alias("first_key"))
    joined = b.join(first, "hash")
    ref = F.col(key) != F.col("first_key")
    return joined.select(key, ref.alias("is_reference"), "first_key", F.when(ref, F.concat(F.lit("@REF: "), F.col("hash"))).otherwise(F.col("body")).alias("body"))


def optimised(text: Column) -> Column:
    """Short tags and less white space."""
    return t.less_white_space(t.short_tags(text))


def spliced(document: Column, block: Column, marker: str = "@STATEMENTS") -> Column:
    """A block put after the dictionary, else before Item 8, else before the first section, else at the end; nothing if it is already there."""
    def before(mark: str) -> Column:
        at = F.instr(document, mark)
        return F.concat(F.left(document, at - 1), block, F.lit("\n"), F.substr(document, at))

    has = lambda mark: F.contains(document, F.lit(mark))
    dictionary = "@END_DICTIONARY"
    return (
        F.when(has(marker), document).when(has(dictionary), F.replace(document, F.lit(dictionary), F.concat(F.lit(dictionary + "\n"), block)))
        .when(has("@SECTION: ITEM_8"), before("@SECTION: ITEM_8")).when(has("@SECTION:"), before("@SECTION:")).otherwise(F.concat_ws("\n", document, block))
    )


def sections_of(texts: DataFrame, patterns: list[tuple[str, str]] | dict[str, list[tuple[str, str]]], lengths: tuple[int, int] | None = (6, 99)) -> DataFrame:
    """(filing_id, section_id, start, end): where the sections of documents (filing_id, text) are.

    A heading is a line, of as many characters as ``lengths`` says, that a pattern finds in
    any case; the first pattern in the list wins a line, the last line wins a section, and a
    section ends where the next one starts. Lists by filing type go by the documents'
    ``filing_type`` however it is spelled; that of the key "" is for all other types and amendments.
    """
    of = lambda ps: F.coalesce(*[F.when(F.col("line").rlike(f"(?i){p}"), s) for p, s in ps])
    section, kept = (of(patterns), []) if isinstance(patterns, list) else (of(patterns[""]), ["form"])
    if kept:
        plain = F.regexp_replace(F.upper(F.coalesce("filing_type", F.lit(""))), r"^\s*(FORM\s+)?|\s+$", "")
        texts = texts.withColumn("form", F.regexp_replace(plain, r"^10-?([KQ])$", "10-$1"))
        for form in sorted(set(patterns) - {""}):
            section = F.when(F.col("form") == form, of(patterns[form])).otherwise(section)
    line = texts.select("filing_id", *kept, F.length("text").alias("total"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    if lengths:
        section = F.when(F.length(F.trim("line")).between(*lengths), section)
    # The lines themselves are left behind before the shuffle.
    line = line.select("filing_id", "total", "n", F.length("line").alias("size"), section.alias("section_id"))
    w = Window.partitionBy("filing_id").orderBy("n")
    line = line.withColumn("start", F.coalesce(F.sum(F.col("size") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    found = line.where("section_id is not null")
    last = found.groupBy("filing_id", "section_id").agg(F.max_by(F.struct("start", "total"), "n").alias("m")).select("filing_id", "section_id", "m.*")
    return last.select("filing_id", "section_id", "start", F.coalesce(F.lead("start").over(Window.partitionBy("filing_id").orderBy("start")), F.col("total")).alias("end"))


def with_markers(text: Column, section: Column) -> Column:
    """A section's text between START and END marks."""
    return F.concat(F.lit("@SECTION_START: "), section, F.lit("\n"), text, F.lit("\n@SECTION_END: "), section)
