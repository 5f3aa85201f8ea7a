"""Stat tables and links from stored HTML pages.

Reading HTML needs Python; it runs per Arrow batch inside the tasks that read
the pages, without a shuffle. Keep ``spark.sql.execution.arrow.maxBytesPerBatch``
(or ``maxRecordsPerBatch``) low where pages are large.
"""

import re
import sys
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gridledger.operators.clean import has_activity

# The reader travels with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


ROWS_PER_BATCH = 5000
_STARTS = frozenset(["table", "tbody", "tr", "td", "th", "a"])
_ENDS = frozenset(f"/{tag}" for tag in _STARTS)

# Markup that can only be read one way: whole comments, and tags of quoted attributes
# with the text after them, up to the end of a cell and the text after that where one is
# next. A page of anything else goes through HTMLParser.
_COMMENT = re.compile(r"<!--(?!-?>)([^-]*+(?:-(?!-)[^-]*+)*+)-->")
_TAG_AND_TEXT = re.compile(r"<(?:([^<>&]++)>([^<]*+)(?:</(t[dh])>([^<]*+))?+)?")
_TAG = re.compile(
    r"(/?[a-zA-Z][a-zA-Z0-9]*|!(?i:doctype)[^<>]*+)"
    r'((?:[ \t\n]+[a-zA-Z][-a-zA-Z0-9]*="[^"<>&]*")*+)[ \t\n]*+'
)
_ATTRIBUTE = re.compile(r'([a-zA-Z][-a-zA-Z0-9]*)="([^"]*)"')
_CELLS = ("td", "th")
_TAGS = frozenset(["table", "tbody", "tr", "td", "th", "a"])
#: Their content is text to HTMLParser, also where it looks like tags.
_TEXT_ONLY = frozenset(
    ["script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp"]
)
_KNOWN_TAGS, _KNOWN_LENGTH = 4096, 200


def _read_tag(inside):
    """(start tag, end tag, tag of text only, attributes) of what is between the brackets:
    one of the names if it counts, and None if the tag is not a plain one."""
    plain = _TAG.fullmatch(inside)
    tag = plain[1].lower() if plain else "plaintext"
    if tag == "plaintext" or (tag[0] == "/" and plain[2]):
        return None
    if tag[0] == "/":
        return None, tag[1:] if tag[1:] in _TAGS else None, None, None
    attributes = {k.lower(): v for k, v in _ATTRIBUTE.findall(plain[2])}
    return tag if tag in _TAGS else None, None, tag if tag in _TEXT_ONLY else None, attributes


class _Page(HTMLParser):
    """Collects tables (id and stat rows), links and comments of a page.

    ``known`` holds tags read before: those of cells repeat from row to row.
    """

    def __init__(self, html, known=None):
        html = html or ""
        self._clear()
        if not self._feed_plain(html, {} if known is None else known):
            self._clear()
            super().__init__(convert_charrefs=True)
            self.feed(html)
            self.close()

    def _clear(self):
        self.tables, self.links, self.comments = [], [], []
        self._open, self._link = [], None

    def _feed_plain(self, html, known):
        """The calls that HTMLParser makes for the tags that count, from one pattern;
        False, perhaps after some of them, if the page is not of plain markup."""
        start_tag, end_tag, data = self._start, self.handle_endtag, self.handle_data
        pieces = _COMMENT.split(html) if "<!" in html else [html]
        self.comments = pieces[1::2]
        for piece in pieces[::2]:
            closing, text = None, piece.partition("<")[0]
            if text:
                data(unescape(text))
            for inside, text, ended, after in _TAG_AND_TEXT.findall(piece):
                if (read := known.get(inside)) is None:
                    if (read := _read_tag(inside)) is None:
                        return False
                    # Links hardly repeat.
                    if read[0] != "a" and len(inside) <= _KNOWN_LENGTH:
                        if len(known) >= _KNOWN_TAGS:
                            known.clear()
                        known[inside] = read
                start, end, text_only, attributes = read
                if closing:
                    if inside.rstrip(" \t\n").lower() != closing:
                        return False
                    closing = None
                if ended and start in _CELLS and not self._link and len(self._open) == 1:
                    self._whole_cell(attributes, unescape(text) if "&" in text else text)
                    continue
                if start:
                    start_tag(start, attributes)
                elif end:
                    end_tag(end)
                elif text_only:
                    if "&" in text or ended:
                        return False
                    closing = f"/{text_only}"
                if text and (self._open or self._link):
                    data(unescape(text) if "&" in text else text)
                if ended:
                    end_tag(ended)
                    if after:
                        data(unescape(after))
            if closing:
                return False
        return True

    def _whole_cell(self, attributes, text):
        """A cell of text only in the one open table: its start, text and end."""
        table = self._open[0]
        self._end_cell(table)
        row, stat = table["row"], attributes.get("data-stat")
        if row is not None and stat:
            row[stat] = text.strip()
            if stat == "player":
                row["pfr_player_id"] = attributes.get("data-append-csv") or None

    def handle_comment(self, data):
        self.comments.append(data)

    def handle_starttag(self, tag, attrs):
        self._start(tag, dict(attrs))

    def _start(self, tag, attrs):
        table = self._open[-1] if self._open else None
        if tag == "table":
            self._open.append({"id": attrs.get("id"), "body": 0, "row": None, "cell": None,
                               "rows": []})
            self.tables.append(self._open[-1])
        elif tag == "a":
            self._link = [attrs.get("href"), ""] if attrs.get("href") is not None else None
            if table and table["cell"] and table["cell"]["href"] is None:
                table["cell"]["href"] = attrs.get("href")
        elif table is None:
            return
        elif tag == "tbody":
            table["body"] += 1
        elif tag == "tr":
            self._end_row(table)
            header = "thead" in (attrs.get("class") or "").split()
            table["row"] = {} if table["body"] == 1 and not header else None
        elif tag in ("td", "th"):
            self._end_cell(table)
            table["cell"] = {"stat": attrs.get("data-stat"), "id": attrs.get("data-append-csv"),
                             "href": None, "text": ""}

    def handle_endtag(self, tag):
        table = self._open[-1] if self._open else None
        if tag == "a" and self._link:
            self.links.append((self._link[0], self._link[1].strip()))
            self._link = None
        if table is None:
            return
        if tag in ("td", "th"):
            self._end_cell(table)
        elif tag == "tr":
            self._end_row(table)
        elif tag in ("tbody", "table"):
            self._end_row(table)
            if tag == "table":
                self._open.pop()
            elif table["body"] == 1:
                table["body"] = 2

    def handle_data(self, data):
        if self._link:
            self._link[1] += data
        for table in self._open:
            if table["cell"]:
                table["cell"]["text"] += data

    def _end_cell(self, table):
        cell = table["cell"]
        if not cell:
            return
        table["cell"] = None
        if not cell["stat"] or table["row"] is None:
            return
        table["row"][cell["stat"]] = cell["text"].strip()
        if cell["stat"] == "player":
            link = cell["href"]
            table["row"]["pfr_player_id"] = cell["id"] or (
                link.split("/")[-1].replace(".htm", "") if link else None
            )

    def _end_row(self, table):
        self._end_cell(table)
        if table["row"]:
            table["rows"].append(table["row"])
        table["row"] = None


def _first_table(page, table_ids):
    for table_id in table_ids:
        for table in page.tables:
            if table["id"] == table_id:
                return table
    return None


def stat_rows(html, table_ids, comments_only=False, known=None):
    """Rows of the first listed table, in the page or else in its comments.

    None if there is no such table. ``known`` keeps attributes from page to page.
    """
    page = _Page(html, known)
    table = None if comments_only else _first_table(page, table_ids)
    for comment in page.comments:
        if table is not None:
            break
        if "<table" in comment and any(table_id in comment for table_id in table_ids):
            table = _first_table(_Page(comment, known), table_ids)
    return None if table is None else table["rows"]


def _batches(batches, rows_of, names, arrays):
    """(page_id, row number, ``names``) for all rows of a partition's pages, in batches of
    bounded size. ``arrays`` makes the named columns of rows; page ids stay as they came."""

    def batch_of(ids, places, numbers, held):
        columns = [ids.take(pa.array(places, pa.int64())), pa.array(numbers, pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, *arrays(held)], names=names)

    for batch in batches:
        ids, places, numbers, held = batch.column("page_id"), [], [], []
        for place, (page_id, html) in enumerate(zip(ids, batch.column("html"))):
            rows = rows_of(page_id.as_py(), html.as_py())
            held.extend(rows)
            places.extend([place] * len(rows))
            numbers.extend(range(len(rows)))
            if len(held) >= ROWS_PER_BATCH:
                yield batch_of(ids, places, numbers, held)
                places, numbers, held = [], [], []
        if held:
            yield batch_of(ids, places, numbers, held)


def _page_id_type(pages):
    return pages.schema["page_id"].dataType.simpleString()


def extract_tables(pages, table_ids, comments_only=False, required=False):
    """(page_id, row_no, cells) for every row of each page's stat table.

    ``cells`` maps data-stat names to text and holds ``pfr_player_id``. With
    ``required`` a page without the table fails the job.
    """
    table_ids = list(table_ids)

    def maps(rows):
        ends = accumulate(map(len, rows), initial=0)
        keys = pa.array(chain.from_iterable(rows), pa.string())
        values = pa.array(chain.from_iterable(map(dict.values, rows)), pa.string())
        return [pa.MapArray.from_arrays(pa.array(ends, pa.int32()), keys, values)]

    def read(batches):
        known = {}

        def rows_of(page_id, html):
            rows = stat_rows(html, table_ids, comments_only, known)
            if rows is None and required:
                raise ValueError(f"page {page_id} has none of the tables {table_ids}")
            return rows or []

        return _batches(batches, rows_of, ["page_id", "row_no", "cells"], maps)

    schema = f"page_id {_page_id_type(pages)}, row_no int, cells map<string,string>"
    asked = pages.select("page_id", "html")
    if not required:  # pages without any table are left out before Python sees them
        asked = asked.filter(F.rlike("html", F.lit("(?i)<table")))
    return asked.mapInArrow(read, schema)


def season_table(pages, table_ids):
    """Rows of the season table, which pages hide in a comment and must have."""
    return extract_tables(pages, table_ids, comments_only=True, required=True)


def category_rows(pages, table_ids, stats, activity=None):
    """Stat rows as text columns; with ``activity`` only those in which one of these
    cells is not "0" (a missing cell counts as "0")."""
    names = ["player", "pfr_player_id", *stats]
    cells = cell_columns(extract_tables(pages, table_ids), names)
    return has_activity(cells, activity) if activity else cells


def cell_columns(rows, names):
    """Chosen cells as text columns; a missing cell is NULL."""
    kept = [c for c in rows.columns if c != "cells"]
    return rows.select(*kept, *[F.col("cells")[name].alias(name) for name in names])


def page_links(pages):
    """(page_id, pos, href, link_text) of the links outside comments."""

    def texts(links):
        return [pa.array([link[i] for link in links], pa.string()) for i in (0, 1)]

    def read(batches):
        known = {}
        return _batches(
            batches, lambda _, html: _Page(html, known).links,
            ["page_id", "pos", "href", "link_text"], texts,
        )

    schema = f"page_id {_page_id_type(pages)}, pos int, href string, link_text string"
    return pages.select("page_id", "html").mapInArrow(read, schema)
