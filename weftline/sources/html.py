"""Links and elements of HTML held in a column."""

from __future__ import annotations

import html as entities
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import strip

# The forms of links that name books and verses, and what a page of a verse must say.
ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
BOOK = r"^Book\s+([0-9]+)\s*-"
VERSE_FULL, VERSE_SHORT = r"^Verse\s+([0-9]+)\.([0-9]+)\.([0-9]+)$", r"^Verse\s+([0-9]+)\.([0-9]+)$"
NO_QUOTE = "no <blockquote> found (structure mismatch)"
EMPTY_QUOTE = "blockquote present but empty"
NO_LABEL = "blockquote found but no 'English translation' label nearby -- verify structure"
LABEL = re.compile("English translation", re.IGNORECASE)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


@F.pandas_udf(T.StringType())
def _decoded(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else entities.unescape(s))


def decoded(x: Column) -> Column:
    """Text without character references; text that has none does not reach Python."""
    return F.coalesce(_decoded(F.when(F.contains(x, F.lit("&")), x)), x)


@F.pandas_udf(T.StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href, strict=True)], dtype=object)


def url_join(base: Column, href: Column) -> Column:
    """The address that a link on a page of address ``base`` leads to."""
    return _joined(base, href)


def links(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """[A16, J4] (keys, pos, href, label) per anchor with an address, quoted in any way or not at all.

    A label is the pieces of text between tags, each without outer white space, put together.
    """
    # A page is searched once, for whole anchors; their parts are taken from each.
    rows = df.select(*keys, F.posexplode(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))).alias("pos", "_a"))
    part = lambda k: F.regexp_extract("_a", ANCHOR, k)
    rows = rows.select(*keys, "pos", F.concat(part(1), part(2), part(3)).alias("_h"), F.split(part(4), "<[^>]*>", -1).alias("_l"))
    return rows.select(*keys, "pos", decoded(F.col("_h")).alias("href"), decoded(F.array_join(F.transform("_l", strip), "")).alias("label"))


def books(rows: DataFrame, base: Column) -> DataFrame:
    """[A16, H7] Links whose label names a book, with its number and full address, to be sorted by number."""
    rows = rows.filter(F.col("label").rlike(BOOK))
    return rows.withColumn("book", F.regexp_extract("label", BOOK, 1).cast("long")).withColumn("url", url_join(base, F.col("href")))


def verses(rows: DataFrame, book: Column, base: Column) -> DataFrame:
    """[A17] Links whose label names a verse; a short name takes its book from the context; others are dropped."""
    full, short = F.col("label").rlike(VERSE_FULL), F.col("label").rlike(VERSE_SHORT)
    part = lambda pattern, k: F.regexp_extract("label", pattern, k).cast("long")
    return rows.filter(full | short).withColumns({
        "book": F.when(full, part(VERSE_FULL, 1)).otherwise(book), "chapter": F.when(full, part(VERSE_FULL, 2)).otherwise(part(VERSE_SHORT, 1)),
        "verse": F.when(full, part(VERSE_FULL, 3)).otherwise(part(VERSE_SHORT, 2)), "url": url_join(base, F.col("href")),
    })


def element_text(html: Column, name: str) -> Column:
    """[A18] Text of the first element of a name: tags out, one line per piece of text; null if there is none or it is empty."""
    inner = F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}>", 1)
    plain = F.regexp_replace(F.regexp_replace(inner, r"(?is)<(script|style)\b.*?</\1>", ""), r"<[^>]*>", "\n")
    return F.nullif(F.trim(F.regexp_replace(F.trim(F.regexp_replace(plain, r"[ \t\r]*\n\s*", "\n")), r"^\n+|\n+$", "")), F.lit(""))


class _Pieces(HTMLParser):
    """Pieces of text, each with the elements that it stands in, outermost first: (name, id, number)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str | None, int]] = []
        self.seen: list[tuple[str, str | None, int]] = []
        self.within: list[tuple[tuple[str, str | None, int], tuple]] = []
        self.texts: list[tuple[str, tuple]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        element = (tag, dict(attrs).get("id"), len(self.seen))
        self.seen.append(element)
        self.within.append((element, tuple(self.open)))
        if tag not in _VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.texts.append((data, tuple(self.open)))


def quoted_verse(html: str | None) -> tuple[str | None, str | None]:
    """[A18] (text, reason): the first block quote inside the element ``scontent``, or inside the page if there is none.

    Its pieces of text, without outer white space, one a line.  A page without one, or with an empty one,
    has a reason for review and no text; one that nowhere speaks of a translation has both.
    """
    page = _Pieces()
    page.feed(html or "")
    page.close()
    scope = next((e for e in page.seen if e[1] == "scontent"), None)
    quote = next((e for e, around in page.within if e[0] == "blockquote" and (scope is None or scope in around)), None)
    if quote is None:
        return None, NO_QUOTE
    text = "\n".join(t.strip() for t, around in page.texts if quote in around and t.strip())
    if not text:
        return None, EMPTY_QUOTE
    labelled = any(LABEL.search(t) for t, around in page.texts if scope is None or scope in around)
    return text, None if labelled else NO_LABEL


def quoted_verses(html: Column) -> Column:
    """[A18] A struct (text, reason) of :func:`quoted_verse`."""

    @F.pandas_udf("text string, reason string")
    def read(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([quoted_verse(t) for t in x], columns=["text", "reason"], dtype=object)

    return read(html)


def fetched(pages: DataFrame, url: str, html: str) -> tuple[DataFrame, DataFrame]:
    """[A15] Pages that were fetched, and review rows (url, reason) for those that were not; fetching itself is no job of an engine."""
    failed = pages.filter(F.col(html).isNull()).select(F.col(url).alias("url"), F.lit("page fetch failed").alias("reason"))
    return pages.filter(F.col(html).isNotNull()), failed
