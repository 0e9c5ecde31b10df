"""Sources and sinks for corpora on disk: documents of several formats with explicit positions.

All readers go through Spark's own file sources, so any store works; only the parsing of formats that
Spark lacks is Python, over whole files of bounded size.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import without_frontmatter
from weftline.scratch import Scratch, delete
from weftline.sources.stores import write_files

SCRIPTS = "struct<devanagari:string,iast:string,english:string>"
#: The record of a corpus entry.
ENTRY = (
    f"entry_id string, title {SCRIPTS}, work {SCRIPTS}, corpusName struct<devanagari:string,iast:string,note:string>, workSlug string, partOf string, "
    "sequence double, author string, authorGroup string, goswami string, category string, "
    "commentaries array<struct<id:string,label:string,labelIast:string,commentator:string,note:string>>, availableScripts array<string>, body string"
)
#: Stands for a null key in a file's name, as in Spark's own folders.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
REQUIRED = ("title", "work", "workSlug", "sequence")
RUN = "struct<text:string,bold:boolean,italic:boolean,underline:boolean,size:double,font:string,color:string>"
PARAGRAPH = f"path string, para_idx int, part string, runs array<{RUN}>"


_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "a": "\a", "b": "\b", "e": "\x1b", "f": "\f", "v": "\v", "/": "/", "\\": "\\", '"': '"', " ": " ", "_": "\xa0"}
_ESCAPED = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", re.DOTALL)


class _Flow:
    """Values written on one line: plain, quoted with escapes, lists in brackets and maps in braces, comments after a blank and ``#``."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _skip(self) -> None:
        while self.at < len(self.text) and self.text[self.at] in " \t":
            self.at += 1
        if self.text.startswith("#", self.at) and (not self.at or self.text[self.at - 1] in " \t"):
            self.at = len(self.text)

    def whole(self):
        """The value of the whole line."""
        found = self.value("")
        self._skip()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at :]!r} after a value")
        return found

    def value(self, ends: str):
        self._skip()
        first = self.text[self.at : self.at + 1]
        if first == '"':
            return self._double()
        if first == "'":
            return self._single()
        if first == "[":
            return self._items("]", lambda: self.value(",]"))
        if first == "{":
            return dict(self._items("}", self._pair))
        return self._plain(ends)

    def _double(self) -> str:
        m = re.compile(r'"((?:[^"\\]|\\.)*)"', re.DOTALL).match(self.text, self.at)
        if not m:
            raise ValueError(f"unclosed quote in {self.text!r}")
        self.at = m.end()
        return _ESCAPED.sub(lambda e: chr(int(e[1] or e[2] or e[3], 16)) if e[1] or e[2] or e[3] else _ESCAPES.get(e[4], e[4]), m[1])

    def _single(self) -> str:
        m = re.compile(r"'((?:[^']|'')*)'").match(self.text, self.at)
        if not m:
            raise ValueError(f"unclosed quote in {self.text!r}")
        self.at = m.end()
        return m[1].replace("''", "'")

    def _plain(self, ends: str) -> str | None:
        start = self.at
        while self.at < len(self.text) and self.text[self.at] not in ends and not (self.text[self.at] == "#" and self.text[self.at - 1] in " \t"):
            if ends and self.text[self.at] == ":" and self.text[self.at + 1 : self.at + 2] in ("", " ", ",", "}", "]"):
                break
            self.at += 1
        found = self.text[start : self.at].strip()
        return None if found in ("", "~", "null") else found

    def _items(self, end: str, item: Callable) -> list:
        out, self.at = [], self.at + 1
        while True:
            self._skip()
            if self.at >= len(self.text):
                raise ValueError(f"unclosed {end} in {self.text!r}")
            if self.text[self.at] == end:
                self.at += 1
                return out
            out.append(item())
            self._skip()
            if self.text.startswith(",", self.at):
                self.at += 1

    def _pair(self) -> tuple:
        key = self.value(",}")
        self._skip()
        if not self.text.startswith(":", self.at):
            return key, None
        self.at += 1
        return key, self.value(",}")


_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s"'#\[\]{},&*!|>%@`-][^#:]*?|-[^\s#:][^#:]*?)\s*:(?=\s|$)""")


def parse_header(text: str) -> dict:
    """[A1] The YAML of headers: nested maps, lists of maps or scalars, values on one line (:class:`_Flow`), folded and literal blocks, comments."""
    rows = [(len(x) - len(x.lstrip(" ")), x.rstrip()) for x in text.split("\n")]
    at = 0

    def blank(i: int) -> bool:
        return not rows[i][1].strip() or rows[i][1].lstrip().startswith("#")

    def skip() -> None:
        nonlocal at
        while at < len(rows) and blank(at):
            at += 1

    def lines_of(indent: int, style: str) -> str:
        """A literal or folded block: lines deeper than ``indent``, at the depth of the first."""
        nonlocal at
        parts, depth = [], None
        while at < len(rows) and (not rows[at][1].strip() or rows[at][0] > indent):
            if depth is None and rows[at][1].strip():
                depth = rows[at][0]
            parts.append(rows[at][1][depth or 0 :])
            at += 1
        tail = len(parts)
        while parts and not parts[-1].strip():
            parts.pop()
        if style[0] == "|":
            out = "\n".join(parts)
        else:
            out = re.sub(r"(?<=[^\n])\n(?=[^\n ])", " ", "\n".join(parts))
            out = re.sub(r"\n(\n+)", r"\1", out)
        return out + ("" if style.endswith("-") or not out else "\n" if not style.endswith("+") else "\n" * (1 + tail - len(parts)))

    def value(indent: int, rest: str):
        if re.fullmatch(r"[|>][+-]?(\s+#.*)?", rest):
            return lines_of(indent, rest.split()[0])
        if rest and not rest.startswith("#"):
            return _Flow(rest).whole()
        skip()
        if at < len(rows) and (rows[at][0] > indent or rows[at][0] == indent and is_item(at)):
            return block(rows[at][0])
        return None

    def is_item(i: int) -> bool:
        return rows[i][1].lstrip() == "-" or rows[i][1].lstrip().startswith("- ")

    def block(indent: int):
        nonlocal at
        if is_item(at):
            out = []
            while at < len(rows) and rows[at][0] == indent and is_item(at):
                rest = rows[at][1].lstrip()[1:]
                inner = indent + 1 + len(rest) - len(rest.lstrip(" "))
                rest = rest.strip()
                if _KEY.match(rest):
                    rows[at] = (inner, " " * inner + rest)
                    out.append(block(inner))
                else:
                    at += 1
                    out.append(value(indent, rest))
                skip()
            return out
        found = {}
        while at < len(rows) and rows[at][0] == indent and not is_item(at):
            line = rows[at][1].strip()
            m = _KEY.match(line)
            if not m:
                raise ValueError(f"no key in {line!r}")
            at += 1
            found[_Flow(m[1]).whole()] = value(indent, line[m.end() :].strip())
            skip()
        return found

    skip()
    return block(rows[at][0]) if at < len(rows) else {}


def entry_of(entry_id: str, text: str, strict: bool = True) -> dict:
    """[A1] One entry from its file's text: the validated header and the body as it is."""
    parts = re.split(r"^---[ \t]*$\n?", text, maxsplit=2, flags=re.MULTILINE)
    head, body = (parse_header(parts[1]), parts[2]) if len(parts) == 3 and not parts[0].strip() else ({}, text)
    missing = [k for k in REQUIRED if head.get(k) is None]
    if strict and missing:
        raise ValueError(f"{entry_id}: the header lacks {', '.join(missing)}")
    row = {k: ({n: (head.get(k) or {}).get(n) for n in ("devanagari", "iast", "note" if k == "corpusName" else "english")} if head.get(k) else None) for k in ("title", "work", "corpusName")}
    row |= {k: head.get(k) for k in ("workSlug", "partOf", "author", "authorGroup", "goswami", "category", "availableScripts")}
    row |= {"entry_id": entry_id, "body": body, "sequence": None if head.get("sequence") is None else float(head["sequence"])}
    row["commentaries"] = None if head.get("commentaries") is None else [{n: c.get(n) for n in ("id", "label", "labelIast", "commentator", "note")} for c in head["commentaries"]]
    return row


#: Names of the columns of an entry, in order.
ENTRY_COLUMNS = ("entry_id", "title", "work", "corpusName", "workSlug", "partOf", "sequence", "author", "authorGroup", "goswami", "category", "commentaries", "availableScripts", "body")


def read_entries(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """[A1, A2] Markdown files with a header, validated: one row per file, body as it is."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    rows = files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.md$", 1).alias("entry_id"), "value")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([entry_of(i, x, strict) for i, x in zip(pdf["entry_id"], pdf["value"], strict=True)], columns=list(ENTRY_COLUMNS))

    return rows.mapInPandas(parse, ENTRY)


def read_slices(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """[A9] (path, line_no, line) of text files, from the first line that begins with ``start`` up to, without it, the first after it with ``end``."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.split("value", "\r?\n", -1).alias("ls"))
    lines = F.transform("ls", lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line")))
    first = F.get(F.filter(lines, lambda r: r["line"].startswith(start)), 0)["line_no"]
    rows = files.select("path", lines.alias("lines"), first.alias("a"))
    last = F.coalesce(F.get(F.filter("lines", lambda r: (r["line_no"] > F.col("a")) & r["line"].startswith(end)), 0)["line_no"], F.size("lines") + 1)
    return rows.withColumn("z", last).select("path", F.explode(F.filter("lines", lambda r: (r["line_no"] >= F.col("a")) & (r["line_no"] < F.col("z")))).alias("r")).select("path", "r.*")


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _flag(props, name: str) -> bool | None:
    el = None if props is None else props.find(_W + name)
    return None if el is None else el.get(_W + "val") not in ("0", "false", "none")


def _run(r) -> dict:
    props = r.find(_W + "rPr")
    get = lambda name, key="val": None if props is None or props.find(_W + name) is None else props.find(_W + name).get(_W + key)
    text = "".join({"t": x.text or "", "tab": "\t", "br": "\n", "cr": "\n"}.get(x.tag.removeprefix(_W), "") for x in r)
    size = get("sz")
    return {"text": text, "bold": _flag(props, "b"), "italic": _flag(props, "i"), "underline": _flag(props, "u"), "size": float(size) / 2 if size else None, "font": get("rFonts", "ascii"), "color": get("color")}


_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _related(z: zipfile.ZipFile) -> dict[str, str]:
    """Parts that the main document refers to, by id."""
    name = "word/_rels/document.xml.rels"
    if name not in z.namelist():
        return {}
    return {r.get("Id"): "word/" + r.get("Target").removeprefix("/word/") for r in ElementTree.fromstring(z.read(name))}


def docx_paragraphs(data: bytes | io.IOBase, parts: set[str] | None = None) -> Iterator[tuple[str, list[dict]]]:
    """[A4, A5] (part, runs) in the fixed order: body, tables with nested cells, headers and footers, foot- and endnotes.

    Headers and footers go section by section: the usual, the first page's and the even pages' header and
    footer, each with its tables.  A section without one of its own repeats the section's before; where
    there is none either, an empty paragraph stands for it, so that positions agree with other readers.  With
    ``parts`` the runs of other parts are not read: their paragraphs have none, but keep their positions.
    """
    with zipfile.ZipFile(io.BytesIO(data) if isinstance(data, bytes | bytearray) else data) as z:
        names, related = z.namelist(), _related(z)
        body = ElementTree.fromstring(z.read("word/document.xml")).find(_W + "body")

        def own(parent, part: str):
            for p in parent.findall(_W + "p"):
                yield part, [_run(r) for r in p.iter(_W + "r")] if parts is None or part in parts else []

        def cells(parent, part: str):
            for table in parent.findall(_W + "tbl"):
                for cell in table.iterfind(f"{_W}tr/{_W}tc"):
                    yield from own(cell, part)
                    yield from cells(cell, part)

        yield from own(body, "body")
        yield from cells(body, "table")
        current: dict[tuple[str, str], str] = {}
        for section in body.iter(_W + "sectPr"):
            for kind in ("header", "footer"):
                for ref in section.findall(f"{_W}{kind}Reference"):
                    current[kind, ref.get(_W + "type")] = related.get(ref.get(_R + "id"), "")
            for page in ("default", "first", "even"):
                for kind in ("header", "footer"):
                    name = current.get((kind, page))
                    if name in names:
                        root = ElementTree.fromstring(z.read(name))
                        yield from own(root, kind)
                        yield from cells(root, kind)
                    else:
                        yield kind, []
        for kind in ("footnote", "endnote"):
            if f"word/{kind}s.xml" in names:
                for note in ElementTree.fromstring(z.read(f"word/{kind}s.xml")).findall(_W + kind):
                    if note.get(_W + "type") not in ("separator", "continuationSeparator"):
                        yield from own(note, kind)


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """[A4-A6, J6] (path, para_idx, part, runs) of word-processor files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([(name, i, part, runs) for i, (part, runs) in enumerate(docx_paragraphs(data))], columns=["path", "para_idx", "part", "runs"])

    return files.mapInPandas(parse, PARAGRAPH)


def read_pages(spark: SparkSession, path: str, schema: str = "page int, source_image string, ocr_engine string, raw_text string, processed_at string", pages: tuple[int, int] | None = None) -> DataFrame:
    """[A8, A14] One JSON file per page, in a range of pages if one is given."""
    rows = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "page_*.json").json(path)
    return rows.filter(F.col("page").between(*pages)) if pages else rows


def read_verses(spark: SparkSession, path: str, book: int | None = None) -> DataFrame:
    """[A7] Verse records from CSV, one book or all."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("book int, chapter int, verse_number int, original_text string, source_url string").csv(path)
    return rows if book is None else rows.filter(F.col("book") == book)


def rewritten(runs: Column, text: Column) -> Column:
    """[B1] A paragraph's runs with new text: the first run's format for all of it; a plain run if there was none."""
    alone = F.from_json(F.to_json(F.struct(text.alias("text"))), RUN)
    return F.array(F.when(F.size(runs) > 0, F.get(runs, 0).withField("text", text)).otherwise(alone))


def append_log(df: DataFrame, path: str) -> bool:
    """[B2, B4] Append review rows as CSV with a header; nothing is written where there is nothing to review.

    The rows are made once, into the shared folder, where they are counted before they are appended.
    """
    scratch = Scratch(df.sparkSession, "log")
    rows = scratch.write(df, "rows")
    some = not rows.isEmpty()
    if some:
        rows.write.mode("append").option("header", True).csv(path)
    scratch.drop(rows)
    return some


def write_chapters(df: DataFrame, keys: list[str], idx: str, body: str, path: str) -> None:
    """[B5, B6] One text per key, its parts in order, in a file named by the keys.

    All files lie in one folder, which is listed at once: a folder for each key would be a task and a listing each.
    """
    parts = F.array_sort(F.collect_list(F.struct(idx, body)))
    texts = df.groupBy(*keys).agg(F.concat(F.array_join(F.transform(parts, lambda r: r[body]), "\n\n"), F.lit("\n")).alias("value"))
    name = F.concat(F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.coalesce(F.url_encode(F.col(k).cast("string")), F.lit(NO_KEY))) for k in keys]), F.lit(".txt"))
    delete(df.sparkSession, path)
    write_files(texts.select(name.alias("name"), "value"), path, "name", "value")


def read_chapters(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """[B5] The keys, as strings, and ``body`` of files of :func:`write_chapters`."""
    # A file's address is escaped once more than its name.
    name = F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.txt$", 1), F.lit("+"), F.lit("%2B")))
    rows = spark.read.text(path, wholetext=True).select("value", name.alias("_n"))
    key = lambda k: F.url_decode(F.nullif(F.regexp_extract("_n", f"(?:^|,){re.escape(k)}=([^,]*)", 1), F.lit(NO_KEY)))
    return rows.select(*[key(k).alias(k) for k in keys], F.regexp_replace("value", r"\n\z", "").alias("body"))


def rendered(df: DataFrame, keys: list[str], idx: str, kind: str, text: str) -> DataFrame:
    """[B7, B8, B9] Markdown of ordered parts: runs of quoted ones as one block quote, ``sutra`` ones marked up, others plain."""
    from weftline.operators.ordered import islands

    rows = df.withColumn("_q", F.col(kind) == "quoted")
    rows = islands(rows, keys, [idx], "_q")
    rows = rows.withColumn("_g", F.when(F.col("_q"), F.lit(0)).otherwise(F.col(idx)))
    one = rows.groupBy(*keys, "block", "_g", "_q").agg(
        F.min(idx).alias("_i"), F.first(kind).alias("_k"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx, text))), lambda r: r[text]), "  \n> ").alias("_t")
    )
    part = F.when(F.col("_q"), F.concat(F.lit("> "), "_t")).when(F.col("_k") == "sutra", F.concat(F.lit('<p class="sutra">'), F.regexp_replace("_t", "^॥ ", ""), F.lit("</p>"))).otherwise(F.col("_t"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", part.alias("t")))), lambda r: r["t"]), "\n\n")
    return one.groupBy(*keys).agg(F.regexp_replace(body, r"\n{3,}", "\n\n").alias("markdown"))


def quoted(x: Column) -> Column:
    """A string as a header writes it: quoted, with backslashes, quotes and line ends escaped."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), x, F.lit('"'))


def with_header(body: Column, fields: list[tuple[str, Column]]) -> Column:
    """[B6] A file of an entry: a header of fields in order, of which ``a.b`` is the part b of a, and a body."""
    lines, open_ = [F.lit("---")], None
    for name, value in fields:
        group, _, part = name.rpartition(".")
        if group and group != open_:
            lines.append(F.lit(f"{group}:"))
        open_ = group
        lines.append(F.concat(F.lit(f"  {part}: " if group else f"{name}: "), value))
    return F.concat(F.array_join(F.array(*lines, F.lit("---")), "\n"), F.lit("\n"), body)


def write_map(df: DataFrame, path: str, tsv: bool = False) -> None:
    """[B11] A map of rows as JSON lines, or as tab-separated values without a header."""
    if tsv:
        df.write.mode("overwrite").option("sep", "\t").option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").json(path)


def as_json(*columns: Column | str) -> Column:
    """[B13] A node as JSON text; fields that are null are left out."""
    return F.to_json(F.struct(*columns))


__all__ = ["append_log", "as_json", "docx_paragraphs", "parse_header", "read_docx", "read_entries", "read_pages", "read_slices", "read_verses", "quoted", "rendered", "rewritten", "read_chapters", "with_header", "without_frontmatter", "write_chapters", "write_map"]
