"""Metadata of landing pages, read by the standard library's parser in Arrow UDFs."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """Collects named metas, anchors, and the first heading of each kind."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.meta: list[tuple[str, str]] = []
        self.links: list[str] = []
        self.heads: dict[str, list[str]] = {}
        self.open: list[str] = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and "name" in a:
            self.meta.append((a["name"], a.get("content", "")))
        elif tag == "a" and "href" in a:
            self.links.append(a["href"])
        if tag in ("h1", "h2", "title") and tag not in self.heads:
            self.heads[tag] = []
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            self.open.remove(tag)

    def handle_data(self, data: str) -> None:
        for tag in self.open:
            self.heads[tag].append(data.strip())

    def first(self, name: str) -> str | None:
        """The first tag of that name decides, even if it is empty."""
        found = next((c.strip() for n, c in self.meta if n == name), "")
        return found or None

    def every(self, name: str) -> list[str]:
        return [c.strip() for n, c in self.meta if n == name and c.strip()]

    def title(self) -> str | None:
        tag = next((t for t in ("h2", "h1", "title") if t in self.heads), None)
        return " ".join(x for x in self.heads[tag] if x) if tag else None

    def pdf(self, base: str, paper_id: str) -> str | None:
        pdfs = [u for u in (urljoin(base, h) for h in self.links) if urlparse(u).path.lower().endswith(".pdf")]
        named = (u for u in pdfs if urlparse(u).path.endswith(f"/{paper_id}.pdf"))
        return next(named, None) or next((u for u in pdfs if "checklist" not in u.lower()), None)


LANDING = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("authors", T.ArrayType(T.StringType())), T.StructField("pdf_url", T.StringType()), T.StructField("venue", T.StringType()),
    T.StructField("published", T.StringType()), T.StructField("error", T.StringType()),
])


@F.pandas_udf(LANDING)
def landing_metadata(html: pd.Series, url: pd.Series, paper_id: pd.Series) -> pd.DataFrame:
    """Fields of a landing page with their fallbacks; a missing title or PDF is the row's error."""
    rows = []
    for text, base, pid in zip(html, url, paper_id):
        page = _Page(text or "")
        title, pdf = page.first("citation_title") or page.title(), page.first("citation_pdf_url") or page.pdf(base or "", pid or "")
        missing = [n for n, v in (("paper_id", pid), ("title", title), ("pdf_url", pdf)) if not v]
        rows.append((title, page.every("citation_author"), pdf, page.first("citation_conference_title") or page.first("citation_journal_title"), page.first("citation_publication_date") or page.first("citation_date"), "missing " + ", ".join(missing) if missing else None))
    return pd.DataFrame(rows, columns=LANDING.names)
