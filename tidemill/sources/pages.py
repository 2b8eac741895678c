"""Captured result pages: JSON by native expressions, HTML grids by a batched parser, and how they are listed."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markers
from ..functions.status import message, status_label
from ..functions.text import cell, clip, date_only, normalise, unique_join, utf16_length
from ..schemas import COLUMNS, ROW, WIRE

# Fixed values of the captured pages: what cells' descriptions start with, and the class of the position line's element.
ARIA = "gridForsearch_pane_"
PAGER_CLASS = "pagerPos"
#: Longer plain holders and class lists are shown with an ellipsis.
SHOWN = 64


def captured(spark: SparkSession, path: str) -> DataFrame:
    """(query, page, body) of archived pages named <query>_p<N>.raw, read by Spark from wherever they are."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    read = spark.read.option("pathGlobFilter", "*_p*.raw").text(path, wholetext=True)
    return read.select(F.url_decode(F.regexp_extract(name, r"^(.*)_p(\d+)\.raw$", 1)).alias("query"), F.regexp_extract(name, r"_p(\d+)\.raw$", 1).cast("int").alias("page"), F.col("value").alias("body"))


def captured_lines(spark: SparkSession, path: str, stream: bool = False, files: int = 16) -> DataFrame:
    """(query, body) of answers captured as lines of JSON, in folders query=<name> with any number of files; filters on query reach the listing.

    As a stream it takes `files` files at a time, remembers in its checkpoint those that it has read, and reads none of them again when it is restarted; what is
    put there later it reads then. Listing and reading are Spark's, so the folder may be on any file system.
    """
    read = spark.readStream.option("maxFilesPerTrigger", files) if stream else spark.read
    return read.text(path).select(F.col("query").cast("string").alias("query"), F.col("value").alias("body"))


def outcomes(pages: DataFrame, body: str = "body", status: str | None = None) -> DataFrame:
    """pages, batch or stream, with `outcome`, num_found and n_docs: results, or no results where the site found none; blocked and http_error by
    the status (a column; 200 if not given) or the text; app_error and not_json. Only results have documents."""
    graded_ = markers.graded(F.col(status) if status else F.lit(200), F.coalesce(F.col(body), F.lit("")))
    read = decode(pages.withColumn("_grade", graded_), body)
    # A body that starts like JSON may still be none, or hold an error.
    own = F.when(F.col("_grade") != "ok", F.col("_grade")).when(F.col("verdict") != "ok", F.col("verdict")).when(F.col("page_data.num_found") == 0, "no results").otherwise("results")
    some = lambda c: F.when(F.col("outcome") == "results", c)
    return read.withColumn("outcome", own).withColumns({"num_found": some(F.col("page_data.num_found")), "n_docs": some(F.coalesce(F.size("page_data.docs"), F.lit(0)))}).drop("_grade", "verdict", "page_data")


def flex(v: Column) -> Column:
    """A variant as text: null is empty, what is no text is its JSON."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))


def flex_list(v: Column) -> Column:
    """A variant as an array of texts: null is empty, anything but an array is its one element."""
    several = F.try_variant_get(v, "$", "array<string>")
    one = F.try_variant_get(v, "$", "string")
    return F.when(several.isNotNull(), F.transform(several, lambda x: F.coalesce(x, F.lit("")))).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast("array<string>"))


def decode(pages: DataFrame, body: str = "body") -> DataFrame:
    """pages with `verdict` (ok, app_error, not_json) and `page_data`: struct(num_found, start, docs, highlighting), null unless ok."""
    wire = F.from_json(F.col(body), WIRE)
    is_json = F.try_parse_json(F.col(body)).isNotNull()
    error = F.when(F.col("_w.error").isNotNull() & ~F.is_variant_null(F.col("_w.error")), F.to_json(F.struct(F.col("_w.error").alias("e"))))
    failed = F.coalesce(markers.app_error(error), F.lit(False))
    verdict = F.when(~is_json, "not_json").when(failed, "app_error").when(F.col("_w.response").isNull(), "not_json").otherwise("ok")
    read = pages.withColumn("_w", F.when(is_json, wire)).withColumn("verdict", F.coalesce(verdict, F.lit("not_json")))
    response = F.col("_w.response")
    data = F.struct(F.coalesce(response["numFound"], F.lit(0)).alias("num_found"), F.coalesce(response["start"], F.lit(0)).alias("start"), response["docs"].alias("docs"), F.col("_w.highlighting").alias("highlighting"))
    return read.withColumn("page_data", F.when(F.col("verdict") == "ok", data)).drop("_w")


def _picked(shown: Column, field: str, language: Column, plain: Column, last: bool, default: Column) -> tuple[Column, Column]:
    """(text, whether it is a highlighted array): the highlights of the language, then of the field, win if their key is there, even when empty."""
    at = F.lit(-1 if last else 1)
    one = lambda a: F.nullif(F.try_element_at(a, at), F.lit(""))
    first, second = F.try_element_at(shown, F.lit(f"{field}_EN")), F.try_element_at(shown, F.lit(field))
    lit = F.coalesce(first, second)
    return F.when(lit.isNotNull(), F.array_join(lit, ",", "")).otherwise(F.coalesce(one(language), one(plain), default)), lit.isNotNull()


def row_columns(doc: Column, shown: Column, number: Column) -> list[Column]:
    """A document's row. shown: its highlights, map of field to texts."""
    names = {c: flex_list(doc[c]) for c in ("IRN", "NC", "VCS", "USC", "BRAND", "BRAND_EN", "HOL", "HOL_EN")}
    brand, _ = _picked(shown, "BRAND", names["BRAND_EN"], names["BRAND"], True, message(F.lit("NO_VERBAL_ELEMENTS")))
    holder, is_lit = _picked(shown, "HOL", names["HOL_EN"], names["HOL"], False, F.lit(""))
    dots = lambda c: F.when(utf16_length(c) > SHOWN, F.lit("...")).otherwise(F.lit(""))
    more = F.when(F.size(names["HOL"]) > 1, F.concat(F.lit("+"), (F.size(names["HOL"]) - 1).cast("string"))).otherwise(F.lit(""))
    holder = F.concat(holder, F.when(is_lit, F.lit("")).otherwise(dots(holder)), more)
    nice = unique_join(names["NC"])
    vienna = F.when(F.size(names["VCS"]) > 0, unique_join(F.transform(names["VCS"], lambda x: clip(x, 5)))).otherwise(unique_join(F.transform(names["USC"], lambda x: F.concat(F.lit("US"), clip(x, 5)))))
    registered = F.exists(names["IRN"], lambda x: x != "")
    found = {
        "brand": brand, "holder": holder, "status": status_label(flex(doc["STATUS"]), registered), "origin": flex(doc["OO"]), "reg_date": date_only(flex(doc["RD"])),
        "reg_number": F.array_join(names["IRN"], ", "), "nice": F.concat(nice, dots(nice)), "vienna": vienna, "record_id": flex(doc["ID"]), "record_status": flex(doc["STATUS"]),
    }
    return [*[cell(v).alias(c) for c, v in found.items()], number.cast("int").alias("number")]


def page_rows(decoded: DataFrame, *keep: str) -> DataFrame:
    """One row per document of decode()'s pages, with the columns in keep and num_found; documents are numbered from the page's start."""
    docs = decoded.filter("verdict = 'ok'").select(*keep, "page_data.num_found", "page_data.start", "page_data.highlighting", F.posexplode("page_data.docs").alias("pos", "doc"))
    # A missing entry of the highlights is an empty one.
    shown = F.try_element_at(F.coalesce("highlighting", F.create_map().cast("map<string,map<string,array<string>>>")), flex(F.col("doc.ID")))
    with_shown = docs.withColumn("shown", F.coalesce(shown, F.create_map().cast("map<string,array<string>>")))
    return with_shown.select(*keep, "num_found", *row_columns(F.col("doc"), F.col("shown"), F.col("start") + F.col("pos")))


class _Grid(HTMLParser):
    """Rows of a grid: direct <tr id=...> of each <tbody>, and their direct <td>. The parser repairs nothing, so bare <tbody> input needs no table around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.row: dict | None = None
        self.column: str | None = None
        self.title = self.text = ""
        self.depth = 0  # tables inside the current cell

    def handle_starttag(self, tag, attrs):
        at = dict(reversed(attrs))
        if tag == "table" and self.column is not None:
            self.depth += 1
        elif self.depth:
            return
        elif tag in ("tr", "tbody"):
            self._close_row()
            if tag == "tr" and at.get("id"):
                self.row = {}
        elif tag in ("td", "th") and self.row is not None:
            self._close_cell()
            described = at.get("aria-describedby") or ""
            if tag == "td" and described.startswith(ARIA):
                self.column, self.title, self.text = described[len(ARIA) :], at.get("title") or "", ""

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth:
            return
        elif tag == "td":
            self._close_cell()
        elif tag in ("tr", "tbody", "table"):
            self._close_row()

    def handle_data(self, data):
        if self.column is not None:
            self.text += data

    def _close_cell(self):
        if self.column is not None and self.row is not None:
            self.row[self.column] = " ".join((self.title if self.title.strip() else self.text).split())
        self.column = None

    def _close_row(self):
        self._close_cell()
        if self.row and self.row.get("BRAND"):
            self.rows.append(self.row)
        self.row, self.depth = None, 0


def grid(markup: str | None) -> list[dict] | None:
    """Rows of a grid's HTML; None for empty markup, which is an error."""
    if not markup or not markup.strip():
        return None
    parser = _Grid()
    parser.feed(markup)
    parser.close()
    parser._close_row()
    out = []
    for r in parser.rows:
        number = r.get("result_number", "")
        out.append({c: r.get(i, "") if c != "number" else (int(number) if number.lstrip("+-").isdecimal() and number.isascii() else -1) for c, i in COLUMNS.items()})
    return out


def parsed_grid(body: Column) -> Column:
    """A grid's rows as an array of ROW; null for empty markup."""

    @F.pandas_udf(f"array<{ROW.simpleString()}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for markup in batches:
            yield markup.map(grid)

    return run(body)


def grid_rows(pages: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    return pages.select(*keep, F.explode(parsed_grid(F.col(body))).alias("r")).select(*keep, "r.*")


def attempt_rows(pages: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    """Rows of captured answers, whichever engine gave them: JSON where the body is JSON, else the grid in its HTML. `engine` tells which; an
    application error, and markup without a grid, give no rows. Columns in keep must tell the pages apart only as far as the caller needs."""
    decoded = decode(pages, body)
    wanted = [c for c in keep]
    of_json = page_rows(decoded, *wanted).drop("num_found").withColumn("engine", F.lit("json"))
    of_html = grid_rows(decoded.filter("verdict = 'not_json'"), *wanted, body=body).withColumn("engine", F.lit("html"))
    return of_json.unionByName(of_html)


#: An ampersand that begins no reference with a semicolon.
_BARE = re.compile(r"&(?!(?:#\d+|#[xX][0-9a-fA-F]+|\w+);)")


def _kept_bare(markup: str) -> tuple[str, str]:
    """The markup with such ampersands as a character that it does not hold, and that character."""
    mark = next(c for c in map(chr, range(0xE000, 0xF900)) if c not in markup)
    return _BARE.sub(mark, markup), mark


def text_content(c: Column, bare: bool = True) -> Column:
    """HTML's text, entities decoded, tags (line breaks too) worth nothing. bare: also those few that HTML reads without their semicolon (&amp at the end of a title)."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        class Text(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.parts = []

            def handle_data(self, data):
                self.parts.append(data)

        def one(markup):
            parser = Text()
            mark = "&"
            if not bare:
                markup, mark = _kept_bare(markup)
            parser.feed(markup)
            parser.close()
            return "".join(parser.parts).replace(mark, "&")

        for texts in batches:
            yield texts.map(one, na_action="ignore")

    return run(c)


#: Elements whose content is never shown as text, and those that have none.
_UNSEEN, _VOID = frozenset(("script", "style", "noscript", "template", "head", "title")), frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Snapshot(_Grid):
    """A page in one pass: title, shown text, rows of the grid, and the text of the position line's own element.

    A site keeps a copy of its result pane for each way to search and shows one; what an element with `hidden` or `display: none` holds is not seen.
    """

    def __init__(self, pager_class: str) -> None:
        super().__init__()
        self.pager_class = pager_class
        self.titles: list[str] = []
        self.shown: list[str] = []
        self.line: str | None = None
        #: Open elements: (tag, whether what they hold is seen, whether it is the position line).
        self.open: list[tuple[str, bool, bool]] = []

    def _seen(self) -> bool:
        return not self.open or self.open[-1][1]

    def handle_starttag(self, tag, attrs):
        at = dict(reversed(attrs))
        seen = self._seen() and tag not in _UNSEEN and "hidden" not in at and not re.search(r"display\s*:\s*none", at.get("style") or "", re.I)
        own = self.pager_class in (at.get("class") or "").split()
        if tag not in _VOID:
            line = bool(self.open and self.open[-1][2])
            if own and seen and self.line is None:
                self.line, line = "", True
            self.open.append((tag, seen, line))
        if self._seen():
            self.shown.append(" ")
            super().handle_starttag(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._seen():
            self.shown.append(" ")
            super().handle_endtag(tag)
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        if any(tag == "title" for tag, _, _ in self.open):
            self.titles.append(data)
        elif self._seen():
            self.shown.append(data)
            if self.open and self.open[-1][2]:
                self.line += data
            super().handle_data(data)


def snapshot(markup: str | None, pager_class: str) -> tuple[str, str, int, str]:
    """(title, text, rows of the grid, position line) of a page's markup; empty ones where it has none."""
    parser = _Snapshot(pager_class)
    parser.feed(markup or "")
    parser.close()
    parser._close_row()
    return "".join(parser.titles).strip(), "".join(parser.shown), len(parser.rows), " ".join((parser.line or "").split())


def snapshot_of(pages: DataFrame, body: str = "body", pager_class: str = PAGER_CLASS) -> DataFrame:
    """What the classifier looks at, of captured HTML pages: title, text, grid_rows and pager, the text of the shown element of class pager_class.

    What only a script or an element that is not shown holds is none of these. A null page has no text, no rows and no position line.
    """

    @F.pandas_udf("title string, text string, grid_rows int, pager string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for markup in batches:
            yield pd.DataFrame([snapshot(m, pager_class) for m in markup], columns=["title", "text", "grid_rows", "pager"])

    seen = pages.withColumn("_seen", run(F.col(body)))
    return seen.withColumns({"title": F.col("_seen.title"), "text": normalise(F.col("_seen.text")), "grid_rows": F.col("_seen.grid_rows"), "pager": F.col("_seen.pager")}).drop("_seen")
