"""Scanning inline-tagged documents, relationship files and index pages.

Markup is parsed by a tolerant event parser, one document at a time inside Arrow batches;
what comes out are flat rows with their document order, so that every later rule (first
wins, last wins, carry forward) can be stated as DataFrame operations.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Scan(HTMLParser):
    """Collects elements as (tag, attributes, text, path, position) in document order."""

    def __init__(self, wanted: Callable[[str, dict], bool]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.stack, self.found, self.order = wanted, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        attributes = {k.lower(): v for k, v in attrs if v is not None}
        entry = None
        if self.wanted(tag, attributes):
            self.order += 1
            entry = [tag, attributes, [], "/".join(t for t, _ in self.stack), self.order]
            self.found.append(entry)
        self.stack.append((tag, entry))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        # An end tag closes everything opened since its start tag; one without a start tag is ignored.
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        for _, entry in self.stack:
            if entry is not None:
                entry[2].append(data)


def scan(markup: str, wanted: Callable[[str, dict], bool]) -> list[list]:
    """The wanted elements of a document; text is joined and stripped. Broken markup is read as far as it goes."""
    parser = _Scan(wanted)
    try:
        parser.feed(markup)
        parser.close()
    except (AssertionError, ValueError):
        pass
    for entry in parser.found:
        entry[2] = "".join(entry[2]).strip()
    return parser.found


#: What each mode of ``scan_facts`` takes for a fact.
FACT_MODES: dict[str, Callable[[str, dict], bool]] = {
    "contextref": lambda tag, a: "contextref" in a,
    "ix": lambda tag, a: tag in ("ix:nonfraction", "ix:nonnumeric"),
    "ix_star": lambda tag, a: tag.startswith("ix:") and "contextref" in a,
    "prefixed": lambda tag, a: ":" in tag and not tag.startswith("ix:") and "contextref" in a,
}

FACT_DDL = "filing_id string, pos bigint, name string, element string, contextref string, unitref string, decimals string, scale string, format string, value string"


def _rows_udtf(documents: DataFrame, key: str, markup: str, ddl: str, rows_of: Callable[[str, str], list[tuple]]) -> DataFrame:
    """Rows of ``rows_of(key, markup)`` for every document; null documents give none."""
    names = [part.strip().split(" ")[0] for part in ddl.split(",")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    types = [kinds[part.strip().split(" ")[1]] for part in ddl.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, rows = batch.slice(at, 64), []
                for k, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    rows += rows_of(k, text or "")
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return documents.select(key, markup).mapInArrow(run, ddl)


def scan_facts(documents: DataFrame, mode: str = "contextref", name_from: str = "attribute") -> DataFrame:
    """Facts of the documents (filing_id, html) in document order.

    ``mode``: any element with a context reference, only ``ix`` number and text tags, all
    ``ix`` tags with a context, or elements named by their concept. The concept is the
    ``name`` attribute, or the tag without one; with ``name_from='tag'`` always the tag.
    """
    wanted = FACT_MODES[mode]

    def rows(filing: str, html: str) -> list[tuple]:
        out = []
        for tag, a, text, _, n in scan(html, wanted):
            name = tag if name_from == "tag" else a.get("name", tag)
            out.append((filing, n, name, tag, a.get("contextref"), a.get("unitref"), a.get("decimals"), a.get("scale"), a.get("format"), text))
        return out

    return _rows_udtf(documents, "filing_id", "html", FACT_DDL, rows)


def scan_all_facts(documents: DataFrame) -> DataFrame:
    """The three scans as one bag: ``ix`` tags, context references, prefixed tags; duplicates are kept."""
    return scan_facts(documents, "ix").unionByName(scan_facts(documents, "contextref")).unionByName(scan_facts(documents, "prefixed"))


def scan_with_fallback(documents: DataFrame, modes: tuple[str, ...] = ("contextref", "ix", "prefixed")) -> DataFrame:
    """Per filing the facts of the first mode that finds any; each later mode sees only filings without facts so far."""
    out, left = None, documents
    for mode in modes:
        found = scan_facts(left, mode).withColumn("provenance", F.lit(mode))
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select("filing_id").distinct(), "filing_id", "left_anti")
    return out


_LOCAL = lambda tag: tag.rsplit(":", 1)[-1]


def scan_contexts(documents: DataFrame) -> DataFrame:
    """Contexts of the documents: id, period and dimensions, matched by local names."""
    ddl = "filing_id string, pos bigint, context_id string, kind string, dimension string, text string"
    parts = {"instant", "startdate", "enddate", "identifier", "explicitmember", "typedmember"}

    def rows(filing: str, html: str) -> list[tuple]:
        out, current, n = [], None, 0
        for tag, a, text, _, _ in scan(html, lambda t, _a: _LOCAL(t) == "context" or _LOCAL(t) in parts):
            if _LOCAL(tag) == "context":
                n, current = n + 1, a.get("id")
                out.append((filing, n, current, "context", None, None))
            elif current is not None:
                out.append((filing, n, current, _LOCAL(tag), a.get("dimension"), text))
        return out

    raw = _rows_udtf(documents, "filing_id", "html", ddl, rows)
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("text")))
    member = F.when(F.col("kind").isin("explicitmember", "typedmember") & F.col("dimension").isNotNull(), F.struct("dimension", "text"))
    # The last of repeated dimensions wins; the map is built from distinct keys.
    dims = F.map_from_entries(F.array_distinct(F.collect_list(member)))
    return raw.groupBy("filing_id", "pos", "context_id").agg(
        pick("instant").alias("instant"), pick("startdate").alias("startdate"), pick("enddate").alias("enddate"), pick("identifier").alias("identifier"), dims.alias("segment"))


def scan_units(documents: DataFrame) -> DataFrame:
    """Units of the documents; a ratio is ``numerator/denominator``."""

    def rows(filing: str, html: str) -> list[tuple]:
        out: list[list] = []
        for tag, a, text, _, _ in scan(html, lambda t, _a: _LOCAL(t) in ("unit", "measure")):
            if _LOCAL(tag) == "unit":
                out.append([filing, len(out) + 1, a.get("id"), None])
            elif out:
                out[-1][3] = text if out[-1][3] is None else f"{out[-1][3]}/{text}"
        return [tuple(r) for r in out]

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, pos bigint, unit_id string, measure string", rows)


def prefix_statistics(facts: DataFrame) -> DataFrame:
    """Facts and concepts per prefix."""
    prefix = F.when(F.contains("name", F.lit(":")), F.split("name", ":")[0]).otherwise("")
    return facts.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n_facts"), F.countDistinct("name").alias("n_concepts"))


#: Link kinds and the arcs they hold.
ARCS = {"presentationarc": "presentation", "calculationarc": "calculation", "definitionarc": "definition", "labelarc": "label"}


def scan_links(documents: DataFrame) -> dict[str, DataFrame]:
    """``arcs, locators, labels`` of relationship files (filing_id, html), also when embedded in a schema.

    Arcs have kind, role, from, to, ord, weight and arcrole in document order; locators map
    labels to concept references; labels have their role and text.
    """
    ddl = "filing_id string, link bigint, pos bigint, what string, kind string, role string, a string, b string, ord string, weight string, text string"
    names = {"loc", "label", *ARCS}

    def rows(filing: str, xml: str) -> list[tuple]:
        out, role, link = [], None, 0
        for tag, a, text, _, n in scan(xml, lambda t, _a: _LOCAL(t) in names or _LOCAL(t).endswith("link")):
            local = _LOCAL(tag)
            if local.endswith("link"):
                role, link = a.get("xlink:role"), link + 1
            elif local == "loc":
                out.append((filing, link, n, "loc", None, role, a.get("xlink:label"), a.get("xlink:href"), None, None, None))
            elif local == "label":
                out.append((filing, link, n, "label", None, a.get("xlink:role"), a.get("xlink:label"), None, None, None, text))
            else:
                out.append((filing, link, n, "arc", ARCS[local], role or a.get("xlink:arcrole"), a.get("xlink:from"), a.get("xlink:to"), a.get("order"), a.get("weight"), a.get("xlink:arcrole")))
        return out

    raw = _rows_udtf(documents, "filing_id", "html", ddl, rows)
    of = lambda what: raw.where(F.col("what") == what)
    arcs = of("arc").select("filing_id", "link", "pos", "kind", "role", F.col("a").alias("from_label"), F.col("b").alias("to_label"),
                            F.col("ord").try_cast("double").alias("ord"), F.col("weight").try_cast("double").alias("weight"), F.col("text").alias("arcrole"))
    locators = of("loc").select("filing_id", "link", "pos", F.col("a").alias("label"), F.col("b").alias("href"))
    labels = of("label").select("filing_id", "link", "pos", F.col("a").alias("label"), F.col("role").alias("label_role"), "text")
    return {"arcs": arcs, "locators": locators, "labels": labels}


def concept_arcs(links: dict[str, DataFrame], kind: str) -> DataFrame:
    """Arcs of a kind between concepts: both ends through the locators, the concept being the reference's fragment; the first of each (parent, child) per filing."""
    from factloom.operators.hierarchy import first_arcs

    first = links["locators"].groupBy("filing_id", "link", "label").agg(F.min_by("href", "pos").alias("href"))
    concept = F.regexp_replace(F.element_at(F.split("href", "#"), -1), "^([^_]+)_", "$1:")
    end = lambda label, name: first.select("filing_id", "link", F.col("label").alias(label), concept.alias(name))
    arcs = links["arcs"].where(F.col("kind") == kind).join(end("from_label", "parent"), ["filing_id", "link", "from_label"]).join(end("to_label", "child"), ["filing_id", "link", "to_label"])
    kept = first_arcs(arcs, ("filing_id", "parent", "child"))
    return kept.select("filing_id", "pos", "role", "parent", "child", F.coalesce("ord", F.lit(0.0)).alias("ord"), F.coalesce("weight", F.lit(1.0)).alias("weight"), "arcrole")


def concept_labels(links: dict[str, DataFrame]) -> DataFrame:
    """(filing_id, concept, label_role, text): the last label of each role wins."""
    concept = F.regexp_replace(F.element_at(F.split("href", "#"), -1), "^([^_]+)_", "$1:")
    loc = links["locators"].select("filing_id", "link", F.col("label").alias("from_label"), concept.alias("concept"))
    arcs = links["arcs"].where("kind = 'label'").select("filing_id", "link", "from_label", F.col("to_label").alias("label"))
    rows = arcs.join(loc, ["filing_id", "link", "from_label"]).join(links["labels"], ["filing_id", "link", "label"])
    return rows.groupBy("filing_id", "concept", "label_role").agg(F.max_by("text", "pos").alias("text"))


def scan_schema(documents: DataFrame) -> DataFrame:
    """The concept dictionary of schemas (filing_id, html)."""
    ddl = "filing_id string, pos bigint, concept_id string, name string, type_name string, substitution_group string, balance string, period_type string"

    def rows(filing: str, xml: str) -> list[tuple]:
        found = scan(xml, lambda t, a: _LOCAL(t) == "element" and "name" in a)
        return [(filing, n, a.get("id"), a["name"], a.get("type"), a.get("substitutiongroup"), a.get("xbrli:balance"), a.get("xbrli:periodtype")) for _, a, _, _, n in found]

    return _rows_udtf(documents, "filing_id", "html", ddl, rows)


def references(documents: DataFrame) -> DataFrame:
    """(filing_id, pos, kind, href, role): schema and linkbase references of documents and schemas."""

    def rows(filing: str, xml: str) -> list[tuple]:
        out = []
        for tag, a, _, _, n in scan(xml, lambda t, _a: _LOCAL(t) in ("schemaref", "linkbaseref")):
            role = a.get("xlink:role") or ""
            kind = next((k for k in ("presentation", "calculation", "definition", "label") if k in role.lower()), "schema" if _LOCAL(tag) == "schemaref" else "other")
            out.append((filing, n, kind, a.get("xlink:href"), role or None))
        return out

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, pos bigint, kind string, href string, role string", rows)


_BLOCKS = frozenset("p div tr li h1 h2 h3 h4 h5 h6 table section article title br td th".split())
_HIDDEN = frozenset("script style head ix:header noscript".split())


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag in _BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in _HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in _BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def visible_text(html: str) -> str:
    """The text a reader sees, blocks on lines of their own."""
    parser = _Text()
    parser.feed(html)
    parser.close()
    lines = (re.sub(r"[ \t\xa0]+", " ", line).strip() for line in "".join(parser.out).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


_NUMBER = re.compile(r"\d[\d,.]*\d|\d")
#: Attributes that only change how a table looks.
COSMETIC = re.compile(r"\s(?:style|class|width|height|align|valign|bgcolor|border|cellpadding|cellspacing|id)\s*=\s*(?:\"[^\"]*\"|'[^']*')", re.I)


def lean_table(html: str) -> str:
    """A table without cosmetic attributes, if all numbers survive, at most 1 % of its words are lost and it is smaller; else unchanged."""
    lean = re.sub(r">\s+<", "><", COSMETIC.sub("", html))
    words = lambda t: set(re.findall(r"\w+", re.sub(r"<[^>]+>", " ", t)))
    before, after = words(html), words(lean)
    numbers = lambda t: sorted(_NUMBER.findall(re.sub(r"<[^>]+>", " ", t)))
    kept = numbers(html) == numbers(lean) and len(before - after) <= 0.01 * len(before)
    return lean if kept and len(lean) < len(html) else html


def safe_text(html: str) -> str:
    """The visible text of a fragment, if its numbers are exactly those of the markup and at most 0.5 % of its words are lost; else the lean markup."""
    text = visible_text(html)
    bare = re.sub(r"<[^>]+>", " ", html)
    words = re.findall(r"\w+", bare)
    lost = len(set(words) - set(re.findall(r"\w+", text)))
    return text if sorted(_NUMBER.findall(bare)) == sorted(_NUMBER.findall(text)) and lost <= 0.005 * max(len(set(words)), 1) else lean_table(html)


def document_texts(documents: DataFrame) -> DataFrame:
    """(filing_id, title, text, n_tables, n_tags) of html documents."""

    def rows(filing: str, html: str) -> list[tuple]:
        title = next((t for tag, _, t, _, _ in scan(html, lambda t, _a: t in ("title", "h1")) if t), None)
        return [(filing, title, visible_text(html), len(re.findall(r"(?i)<table\b", html)), len(re.findall(r"<[a-zA-Z]", html)))]

    return _rows_udtf(documents, "filing_id", "html", "filing_id string, title string, text string, n_tables bigint, n_tags bigint", rows)


def table_facts(documents: DataFrame) -> DataFrame:
    """Two leading cells of table rows as facts ``Table<i>_<label>``: the fallback for documents without tags."""

    def rows(filing: str, html: str) -> list[tuple]:
        out, table, cells = [], 0, []

        def flush():
            if len(cells) >= 2 and cells[0] and re.search(r"\d", cells[1]):
                out.append((filing, len(out) + 1, f"Table{table}_{re.sub(r'[^0-9A-Za-z]+', '_', cells[0]).strip('_')}", "td", "AsOf", None, None, None, None, cells[1]))
            cells.clear()

        for tag, _, text, _, _ in scan(html, lambda t, _a: t in ("table", "tr", "td", "th")):
            if tag in ("table", "tr"):
                flush()
                table += tag == "table"
            else:
                cells.append(text)
        flush()
        return out

    return _rows_udtf(documents, "filing_id", "html", FACT_DDL, rows)


def filing_index(pages: DataFrame) -> DataFrame:
    """Rows of filing index tables (filing_id, html): form, description, accession number, date, amended or not, link."""
    ddl = "filing_id string, pos bigint, form string, description string, accession string, filing_date string, is_amended boolean, href string"

    def rows(filing: str, html: str) -> list[tuple]:
        out: list[list] = []
        for tag, a, text, _, _ in scan(html, lambda t, _a: t in ("tr", "td", "a")):
            if tag == "tr":
                out.append([[], None])
            elif out and tag == "td":
                out[-1][0].append(text)
            elif out and tag == "a" and out[-1][1] is None:
                out[-1][1] = a.get("href")
        found = []
        for cells, href in out:
            joined = " ".join(cells)
            m = re.search(r"(\d{10}-\d{2}-\d{6})", f"{joined} {href or ''}") or re.search(r"/(\d{10})(\d{2})(\d{6})/", href or "")
            if len(cells) < 2 or not m:
                continue
            accession = m.group(1) if m.lastindex == 1 else "-".join(m.groups())
            day = re.search(r"\d{4}-\d{2}-\d{2}", joined)
            amended = bool(re.search(r"/A\b|\bamend", joined, re.I))
            found.append((filing, len(found) + 1, cells[0], cells[1], accession, day.group() if day else None, amended, href))
        return found

    return _rows_udtf(pages, "filing_id", "html", ddl, rows)


def primary_document(pages: DataFrame) -> DataFrame:
    """(filing_id, href): the main document of an index page, without the viewer's prefix; typed rows before file names."""

    def rows(filing: str, html: str) -> list[tuple]:
        links, cells = [], []
        for tag, a, text, _, _ in scan(html, lambda t, _a: t in ("tr", "td", "a")):
            if tag == "tr":
                cells = []
            elif tag == "td":
                cells.append(text)
            elif a.get("href"):
                links.append((list(cells), a["href"]))
        plain = lambda h: re.sub(r"^.*/ix\?doc=", "", h)
        documents = [(c, plain(h)) for c, h in links if re.search(r"\.html?$", h) and "index" not in h.rsplit("/", 1)[-1]]
        typed = [h for c, h in documents if any(re.fullmatch(r"10-[KQ](/A)?", x) for x in c)]
        dated = [h for _, h in documents if re.search(r"\d{8}\.html?$", h)]
        best = next(iter(typed + dated + [h for _, h in documents]), None)
        return [(filing, best)] if best else []

    return _rows_udtf(pages, "filing_id", "html", "filing_id string, href string", rows)
