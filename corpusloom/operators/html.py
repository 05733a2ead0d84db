"""Extraction from stored HTML: page text, links, message fields.

What a piece of text or a link is in decides whether it counts, so text and links come from one small streaming tag
handler over Arrow batches of the HTML column. It takes any string: what is no proper markup is skipped as browsers do.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.functions.dates import message_time
from corpusloom.functions.text import strip_space
from corpusloom.functions.urls import canonical_url, is_same_site, resolve_url

# Elements whose content is not page text, and elements that never have content.
REMOVED = frozenset(("script", "style", "nav", "footer", "header"))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param",
    "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
))
_BODIES = ("main", "article", "body")

PAGE = "struct<title:string,content:string,links:array<struct<href:string,label:string>>>"
LINKS = "array<struct<href:string,label:string>>"
HREFS = "array<string>"
MESSAGE = "struct<subject:string,author:string,date:string,message_id:string,content:string>"


class _Walker(HTMLParser):
    """Keeps the stack of open elements; an end tag closes everything down to its nearest open partner."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, object]] = []
        self._names: Counter[str] = Counter()
        self._text: list[str] = []

    def walk(self, html: str):
        self.feed(html)
        self.close()
        self._flush()
        while self.open:
            self._pop()
        return self

    def _pop(self) -> str:
        name, mark = self.open.pop()
        self._names[name] -= 1
        self.left(name, mark)
        return name

    def handle_starttag(self, tag, attrs):
        self._flush()
        mark = self.entered(tag, dict(attrs))
        if tag in VOID:
            self.left(tag, mark)
        else:
            self.open.append((tag, mark))
            self._names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if self._names[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        self._text.append(data)

    def handle_comment(self, data):
        self._flush()

    def parse_marked_section(self, i, report=1):
        """``<![`` outside of foreign markup is a comment up to the next ``>``, whatever its keyword."""
        end = self.rawdata.find(">", i + 3)
        if end < 0:
            return -1
        self._flush()
        return end + 1

    def unknown_decl(self, data):
        self._flush()

    def _flush(self):
        if self._text:
            self.text("".join(self._text))
            self._text.clear()

    def entered(self, tag, attrs):
        """Called on a start tag; the result is handed to :meth:`left`."""

    def left(self, tag, mark):
        """Called when an element closes."""

    def text(self, data):
        """Called with one uninterrupted run of text."""


class _Page(_Walker):
    def __init__(self) -> None:
        super().__init__()
        self.hidden = 0
        self.first: dict[str, list[str]] = {}
        self.recording: list[list[str]] = []
        self.links: list[tuple[str, list[str]]] = []

    def entered(self, tag, attrs):
        if tag in REMOVED:
            self.hidden += 1
            return None
        if self.hidden:
            return None
        record = None
        if tag in ("title", "h1", *_BODIES) and tag not in self.first:
            record = self.first[tag] = []
        elif tag == "a" and attrs.get("href") is not None:
            record = []
            self.links.append((attrs["href"], record))
        if record is not None:
            self.recording.append(record)
        return record

    def left(self, tag, mark):
        if tag in REMOVED:
            self.hidden -= 1
        if mark is not None:
            self.recording = [r for r in self.recording if r is not mark]

    def text(self, data):
        data = data.strip()
        if data and not self.hidden:
            for record in self.recording:
                record.append(data)

    def row(self) -> dict:
        title = self.first.get("title", self.first.get("h1"))
        body = next((self.first[tag] for tag in _BODIES if tag in self.first), [])
        return {
            "title": None if title is None else "".join(title),
            "content": "\n".join(body),
            "links": [{"href": href, "label": "".join(label)} for href, label in self.links],
        }


class _AllLinks(_Page):
    """Every anchor of the page, also those in navigation."""

    def entered(self, tag, attrs):
        return None if tag in REMOVED else super().entered(tag, attrs)

    def left(self, tag, mark):
        if tag not in REMOVED:
            super().left(tag, mark)


class _Message(_Walker):
    def __init__(self) -> None:
        super().__init__()
        self.found: dict[str, list[str]] = {}
        self.recording: list[list[str]] = []
        self.label: list[str] | None = None
        self.label_depth = 0
        self.fields: dict[str, str] = {}

    def entered(self, tag, attrs):
        slot = None
        if tag in ("h1", "title", "pre", "main"):
            slot = tag
        elif tag == "div" and "message-body" in (attrs.get("class") or "").split():
            slot = "div"
        record = None
        if slot and slot not in self.found:
            record = self.found[slot] = []
        elif tag == "th":
            record = self.label = []
            self.label_depth = len(self.open)
        elif tag == "td" and self.label is not None and len(self.open) == self.label_depth:
            record = []
        if record is not None:
            self.recording.append(record)
        return record

    def left(self, tag, mark):
        if mark is not None:
            self.recording = [r for r in self.recording if r is not mark]
            if tag == "td":
                label = _squeezed(self.label).lower()
                field = next((f for f, word in _FIELD_WORDS if word in label), None)
                if field:
                    self.fields[field] = _squeezed(mark)
                self.label = None
        elif tag == "tr":
            self.label = None

    def text(self, data):
        for record in self.recording:
            record.append(data)

    def row(self) -> dict:
        subject = self.found.get("h1", self.found.get("title"))
        body = next((self.found[s] for s in ("pre", "div", "main") if s in self.found), [])
        return {
            "subject": "" if subject is None else _squeezed(subject),
            "author": self.fields.get("author"),
            "date": self.fields.get("date"),
            "message_id": self.fields.get("message_id"),
            "content": "".join(body),
        }


# The word that identifies a header row, tried in this order.
_FIELD_WORDS = (("author", "from"), ("date", "date"), ("message_id", "message-id"))


def _squeezed(parts: list[str]) -> str:
    return "".join(p.strip() for p in parts)


# Characters of HTML whose rows are held as Python objects at once, about.
_SLICE = 1 << 20


def _parser(walker: type[_Walker], result: str):
    @arrow_udf(result)
    def parse(pages: pa.Array) -> pa.Array:
        return _found(pages, walker, result)

    return parse


def _found(pages: pa.Array, walker: type[_Walker], result: str) -> pa.Array:
    """What a walker finds on each page. Rows go into Arrow slice by slice, so that many pages take no more Python objects than few."""
    parts, rows, size = [], [], 0
    for page in pages:
        html = page.as_py()
        rows.append(None if html is None else _PART[result](walker().walk(html).row()))
        size += len(html or "")
        if size >= _SLICE:
            parts.append(pa.array(rows, _ARROW[result]))
            rows, size = [], 0
    return pa.concat_arrays([*parts, pa.array(rows, _ARROW[result])])


_LINK = pa.struct([("href", pa.string()), ("label", pa.string())])
_ARROW = {
    PAGE: pa.struct([("title", pa.string()), ("content", pa.string()), ("links", pa.list_(_LINK))]),
    LINKS: pa.list_(_LINK),
    HREFS: pa.list_(pa.string()),
    MESSAGE: pa.struct([(f, pa.string()) for f in ("subject", "author", "date", "message_id", "content")]),
}
# What of a walker's row is wanted.
_PART = {
    PAGE: lambda row: row,
    LINKS: lambda row: row["links"],
    HREFS: lambda row: [link["href"] for link in row["links"]],
    MESSAGE: lambda row: row,
}


def extract_pages(
    pages: DataFrame, html: str = "html", url: str = "url", status_code: Column | None = None,
    content_type: Column | None = None,
) -> DataFrame:
    """Add title, content, same-site absolute links and response metadata of each page.

    Script, style, nav, footer and header elements are ignored. The title is the title element, else the first h1;
    the text is that of the first main, else article, else body element, one line per text node.
    """
    parsed = pages.withColumn("_page", _parser(_Page, PAGE)(F.col(html)))
    links = F.transform(
        F.filter("_page.links", lambda a: is_same_site(F.col(url), a["href"])),
        lambda a: resolve_url(F.col(url), a["href"]),
    )
    unknown = F.lit(None)
    metadata = F.struct(
        (unknown if status_code is None else status_code).cast("int").alias("status_code"),
        (unknown if content_type is None else content_type).cast("string").alias("content_type"),
    )
    return parsed.select(
        *pages.columns, F.col("_page.title").alias("title"), F.col("_page.content").alias("content"),
        links.alias("links"), metadata.alias("metadata"),
    )


def page_links(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    strip_regions: bool = True,
    same_site: bool = True,
    where: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per link ``(page_url, <keep>, position, href, link)`` with ``link`` absolute.

    Links are those of :func:`extract_pages`: every start tag ``a`` with an ``href``, quoted or bare, entities decoded, comments
    and scripts left out. With ``strip_regions`` so are links inside navigation, header and footer.
    ``where`` is any predicate over the result columns.
    """
    hrefs = _parser(_Page if strip_regions else _AllLinks, HREFS)(F.col(html))
    found = pages.select(F.col(url).alias("page_url"), *keep, F.posexplode(hrefs).alias("position", "href"))
    if same_site:
        found = found.where(is_same_site("page_url", "href"))
    found = found.withColumn("link", resolve_url("page_url", "href"))
    return found if where is None else found.where(where)


def list_page_links(pages: DataFrame, needle: str = "/message-id/", url: str = "url", html: str = "html") -> DataFrame:
    """Links of index pages whose address contains ``needle``, with their text: (page_url, position, link, label)."""
    anchors = F.posexplode(_parser(_AllLinks, LINKS)(F.col(html))).alias("position", "_a")
    found = pages.select(F.col(url).alias("page_url"), anchors).where(F.col("_a.href").contains(needle))
    return found.select(
        "page_url", "position", resolve_url("page_url", F.col("_a.href")).alias("link"),
        F.col("_a.label").alias("label"),
    )


def extract_messages(
    pages: DataFrame, html: str = "html", url: str = "url", list_name: str = "pgsql-hackers",
    link_subject: str | None = None, missing: str | None = None,
) -> DataFrame:
    """Message archive pages to rows: id (last URL segment), message_id, subject, author, date, content, url, list_name.

    ``link_subject`` names a column used where the page itself has no subject. Missing header fields are null, or
    ``missing``.
    """

    def header(name: str) -> Column:
        return F.coalesce(F.col(f"_m.{name}"), F.lit(missing)).alias(name)

    parsed = pages.withColumn("_m", _parser(_Message, MESSAGE)(F.col(html)))
    subject = F.col("_m.subject")
    if link_subject:
        subject = F.coalesce(F.nullif(subject, F.lit("")), F.col(link_subject), F.lit(""))
    return parsed.select(
        F.element_at(F.split(url, "/"), -1).alias("id"),
        header("message_id"),
        subject.alias("subject"),
        header("author"),
        header("date"),
        F.col("_m.content").alias("content"),
        F.col(url).alias("url"),
        F.lit(list_name).alias("list_name"),
    )


def message_rows(messages: DataFrame, crawled_at: Column | None = None) -> DataFrame:
    """Extracted messages in the layout of the messages table: dates parsed and threads keyed."""
    return messages.select(
        "id", "message_id", "subject", "author", "date", message_time("date").alias("date_parsed"), "content", "url",
        thread_key("subject").alias("thread_id"), "list_name",
        (F.current_timestamp().cast("timestamp_ntz") if crawled_at is None else crawled_at).alias("crawled_at"),
    )


def thread_key(subject: str) -> Column:
    """Thread id from the subject alone: reply and forward prefixes removed, lower-cased, hashed."""
    bare = F.regexp_replace(subject, r"(?i)^\s*((re|fwd?)\s*:\s*)+", "")
    return F.md5(F.lower(strip_space(bare)))


def url_keys(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.select(url, canonical_url(url).alias("canonical"))
