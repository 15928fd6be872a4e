"""Table functions over markup that is not well-formed XML."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import Settings
from ..functions.hashing import content_hash
from ..functions.text import blank_to_null, normalized_date, record_id, resolved_url, total_hint
from ..schemas import ANCHOR_ROW, HASHED, LISTING_ROW

#: Cells of a listing row (fixed positions); rows with fewer are no records.
N_CELLS, STATUS, DOWNLOAD = 9, 6, 8


class _Listing(HTMLParser):
    """Collects the cells of every row of one table, in any nesting, and the text of the page."""

    def __init__(self, table_id: str):
        super().__init__(convert_charrefs=True)
        self.table_id, self.depth, self.found = table_id, 0, False
        self.rows: list[list[dict]] = []
        self.cells: list[dict] = []
        self.text: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif not self.found and given.get("id") == self.table_id:
                self.depth, self.found = 1, True
        if not self.depth:
            return
        if tag == "tr":
            self.cells = []
            self.rows.append(self.cells)
        elif tag == "td" and self.rows:
            self.rows[-1].append({"text": [], "href": None})
        elif tag == "a" and self.rows and self.rows[-1] and given.get("href") is not None and self.rows[-1][-1]["href"] is None:
            self.rows[-1][-1]["href"] = given["href"].strip()

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if s := data.strip():
            self.text.append(s)
            if self.depth and self.rows and self.rows[-1]:
                self.rows[-1][-1]["text"].append(s)


#: Markup of plain tags only: names of letters and digits, attributes with values that hold no reference, no declaration, comment or raw text. Each part is tried once.
_PLAIN = re.compile(r"""[^<&]*+(?:<(?:/[a-zA-Z][a-zA-Z0-9]*+|[a-zA-Z][a-zA-Z0-9]*+(?:[ ]++[a-zA-Z]++=(?:"[^"<>&]*+"|[^\s"'=<>`&/\x00-\x1f]++))*+)[ ]*+>[^<&]*+)*+""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z0-9]+)([^>]*)>([^<]*)")
_PLAIN_ATTR = re.compile(r"""([a-zA-Z]+)=(?:"([^"]*)"|(\S+))""")
#: Elements whose content the parser does not read as markup.
_RAW = re.compile(r"<(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext)", re.I)


def _fed(page: _Listing, html: str) -> None:
    """What the parser does with the markup; plain tags are found by one expression, as most pages have no others."""
    if _RAW.search(html) or not _PLAIN.fullmatch(html):
        page.feed(html)
        page.close()
        return
    page.handle_data(html.partition("<")[0])
    start, end, data = page.handle_starttag, page.handle_endtag, page.handle_data
    for closing, tag, attrs, text in _PLAIN_TAG.findall(html):
        if closing:
            end(tag.lower())
        else:
            start(tag.lower(), [(name.lower(), a or b) for name, a, b in _PLAIN_ATTR.findall(attrs)] if attrs else ())
        if text:
            data(text)


def listing_cells(html: str, table_id: str) -> list[tuple]:
    """(nine texts, download href, second href) of the rows with at least nine cells.

    The second link is that of the status cell, else of the first other cell but the download cell; a cell's link is its
    first anchor's, and a blank one is none.
    """
    page = _Listing(table_id)
    _fed(page, html)
    out = []
    for cells in page.rows:
        if len(cells) < N_CELLS:
            continue
        href = [c["href"] or None for c in cells]
        others = [href[STATUS], *(h for i, h in enumerate(href) if i not in (STATUS, DOWNLOAD))]
        out.append((*(" ".join(c["text"]) for c in cells[:8]), href[DOWNLOAD], next((h for h in others if h), None)))
    return out


def parsed_rows(pages: DataFrame, html: str, parse: Callable[[str], Iterable[tuple]], row: StructType, errors: bool = False) -> DataFrame:
    """pages → its columns but the markup, and a row for each tuple that parse finds in it; none for a null page.

    Pages go to Python in Arrow batches, their other columns as they are. A page that cannot be parsed has no rows, or, with errors, one row of
    nulls that says why in a further column `error`.
    """
    row = StructType([*row.fields, StructField("error", StringType())]) if errors else row
    kinds = {"string": pa.string(), "int": pa.int32()}
    keys = pages.drop(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, found = [], []
            for i, page in enumerate(b.column(b.num_columns - 1)):
                try:
                    own = [(*x, None) if errors else x for x in parse(page.as_py())] if page.is_valid else []
                except (ValueError, AssertionError, RecursionError) as e:  # whatever markup the parser gives up on
                    own = [(*[None] * (len(row) - 1), f"{type(e).__name__}: {e}")] if errors else []
                at += [i] * len(own)
                found += own
            cols = zip(*found) if found else [()] * len(row)
            kept = b.select(range(b.num_columns - 1)).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(cols, row))], names=[*kept.schema.names, *row.names])

    return pages.select(*keys.columns, html).mapInArrow(run, StructType([*keys.schema.fields, *row.fields]))


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            href = dict(attrs).get("href")
            self.open = href is not None
            if self.open:
                self.found.append([href.strip(), []])

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open:
            self.found[-1][1].append(data.strip())


def anchor_rows(html: str) -> Iterator[tuple[int, str, str]]:
    """Every anchor with an href: its position from 1, the reference, and its text."""
    page = _Anchors()
    page.feed(html)
    page.close()
    for i, (href, text) in enumerate(page.found, 1):
        yield i, href, " ".join(filter(None, text))


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages → its columns but the markup, position, href, text."""
    return parsed_rows(pages, html, anchor_rows, ANCHOR_ROW)


def listing_records(pages: DataFrame, settings: Settings = Settings(), errors: bool = False) -> DataFrame:
    """pages (year, html) → records of the site's fields: parsed, normalized, hashed.

    Rows without a plain number are skipped; a number too large for an int stays in the id, and serial_no is NULL. errors: a page that
    cannot be parsed is a row with its year and error, in a further column; all others have NULL there.
    """
    table_id = settings.table_id
    rows = parsed_rows(pages.select("year", "html"), "html", lambda page: listing_cells(page, table_id), LISTING_ROW, errors)
    plain = F.col("serial").rlike("^[0-9]+$")
    rows = rows.where(plain | F.col("error").isNotNull() if errors else plain)
    base = F.lit(settings.base_url)
    out = rows.select(
        record_id(settings.id_prefix, F.col("year"), F.col("serial")).alias("id"),
        F.col("serial").try_cast("int").alias("serial_no"),
        F.col("year").cast("int").alias("year"),
        "case_info",
        "remarks",
        *(blank_to_null(F.col(c)).alias(c) for c in ("other_citation", "neutral_citation")),
        normalized_date(F.col("decision_date")).alias("decision_date"),
        *(blank_to_null(F.col(c)).alias(c) for c in ("sc_status", "category")),
        resolved_url(base, F.col("download_href")).alias("judgment_pdf_url"),
        resolved_url(base, F.col("second_href")).alias("sc_judgment_pdf_url"),
        *["error"] * errors,
    )
    out = out.withColumn("content_hash", content_hash(*(F.col(c) for c in HASHED)))
    return out.select(*(c for c in out.columns if c != "error"), "error") if errors else out


def page_shortfalls(pages: DataFrame, records: DataFrame) -> DataFrame:
    """year, hint, parsed of the pages whose own total exceeds the rows parsed."""
    hints = pages.select("year", total_hint(F.regexp_replace("html", "<[^>]*>", " ")).alias("hint"))
    counts = records.groupBy("year").agg(F.count("*").alias("n"))
    return hints.join(counts, "year", "left").select("year", "hint", F.coalesce("n", F.lit(0)).alias("parsed")).where(F.col("hint") > F.col("parsed"))
